"""CSV in, CSV, Parquet and JSON out, through Spark's file systems."""

from __future__ import annotations

import json
import logging
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..errors import DataProcessingError, DatasetNotFoundError, InvalidDatasetError
from ..schema import SEQ

log = logging.getLogger(__name__)

#: Texts that stand for a missing value in CSV.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def discover_csv(spark: SparkSession, directory: str) -> list[str]:
    """The directory's own *.csv files by name."""
    fs, p = _fs(spark, directory)
    if not fs.exists(p) or not fs.getFileStatus(p).isDirectory():
        raise DatasetNotFoundError(directory)
    names = [s.getPath().toString() for s in fs.listStatus(p) if s.isFile()]
    return sorted(n for n in names if n.lower().endswith(".csv"))


_RAW = "_raw_line"


def load_csv(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """All columns as text, missing values null, with match_seq by line order and the file's name as _file.

    Quotes in quotes are doubled. Rows with too few fields are filled with nulls; a row with too many, or text that isn't UTF-8, makes the whole
    file an InvalidDatasetError. The file is read once for these checks. The line order is the order of the file's splits; the result
    should be written once (see ingest) to fix it. multiline: quoted fields may hold line breaks, and then a file is one split.
    """
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        raise DatasetNotFoundError(path)
    read = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    try:
        names = read.csv(path).columns
        if not names:
            raise InvalidDatasetError(f"{path}: no columns")
        schema = StructType([*[StructField(c, StringType()) for c in names], StructField(_RAW, StringType())])
        df = read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RAW).schema(schema).csv(path)
        # a flagged row has too few fields or too many: its separators outside quotes tell which
        commas = F.regexp_count(F.regexp_replace(F.col(_RAW), r'"(?:[^"]|"")*"', ""), F.lit(","))
        text = F.concat_ws("", *[F.col(f"`{c}`") for c in names])
        r = df.select(commas.alias("commas"), F.contains(text, F.lit("\ufffd")).alias("odd")).agg(F.max("commas"), F.max("odd")).first()
    except (PySparkException, Py4JJavaError) as e:
        raise InvalidDatasetError(f"{path}: {str(e).splitlines()[0]}") from e
    if (r[0] or 0) >= len(names):
        raise InvalidDatasetError(f"{path}: a row has {r[0] + 1} fields for {len(names)} columns")
    if r[1]:
        raise InvalidDatasetError(f"{path}: it isn't UTF-8")
    df = df.select([F.when(~F.col(f"`{c}`").isin(*MISSING), F.col(f"`{c}`")).alias(c) for c in names])
    return df.withColumn("_file", F.lit(path.rsplit("/", 1)[-1])).withColumn(SEQ, F.monotonically_increasing_id())


def load_matches(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The union of the files that can be read, columns by name; match_seq orders files as given, then lines. Others are left out with a warning."""
    good, bad = [], {}
    for i, p in enumerate(paths):
        try:
            good.append(load_csv(spark, p).withColumn(SEQ, F.col(SEQ) + F.lit(i).cast("long") * F.lit(1 << 48)))
        except (InvalidDatasetError, DatasetNotFoundError) as e:
            bad[p] = str(e)
            log.warning("left out: %s", e)
    if not good:
        raise DataProcessingError(f"no file can be read: {bad}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), good)


def save_dataset(df: DataFrame, path: str, kind: str = "csv") -> None:
    w = df.write.mode("overwrite")
    w.option("header", True).csv(path) if kind == "csv" else w.parquet(path)


def save_text(spark: SparkSession, text: str, path: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def save_json(spark: SparkSession, value, path: str) -> None:
    save_text(spark, json.dumps(value, indent=2, default=str), path)


def load_json(spark: SparkSession, path: str):
    return json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))


def append_metrics(spark: SparkSession, row: dict, path: str) -> None:
    """One more line of scalar values in a CSV folder."""
    flat = {k: v for k, v in row.items() if isinstance(v, (int, float, str, bool))}
    spark.createDataFrame([tuple(str(v) for v in flat.values())], [*flat]).coalesce(1).write.mode("append").option("header", True).csv(path)


def checksum(spark: SparkSession, path: str) -> str:
    """SHA-256 of a file, or of a folder's data files one after the other by name, read in blocks through Spark's file system."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        raise DatasetNotFoundError(path)
    files = [p] if fs.getFileStatus(p).isFile() else sorted((s.getPath() for s in fs.listStatus(p) if s.isFile() and s.getPath().getName()[:1] not in "._"), key=lambda x: x.getName())
    jvm, digest = spark._jvm, spark._jvm.java.security.MessageDigest.getInstance("SHA-256")
    for f in files:
        stream = jvm.java.security.DigestInputStream(fs.open(f), digest)
        try:
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, jvm.java.io.OutputStream.nullOutputStream(), 1 << 16)
        finally:
            stream.close()
    return bytes(b % 256 for b in digest.digest()).hex()


def modified(spark: SparkSession, directory: str) -> list[tuple[int, str]]:
    """(time, path) of a directory's own entries, the newest first."""
    fs, p = _fs(spark, directory)
    if not fs.exists(p) or not fs.getFileStatus(p).isDirectory():
        raise DatasetNotFoundError(directory)
    return sorted(((s.getModificationTime(), s.getPath().toString()) for s in fs.listStatus(p)), reverse=True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def ensure_directories(spark: SparkSession, paths) -> None:
    for path in paths:
        fs, p = _fs(spark, path)
        fs.mkdirs(p)
