"""A session with the settings that results rely on."""

from pyspark.sql import SparkSession


def session(name: str = "pitchline", **conf) -> SparkSession:
    b = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()
