"""Match tables derived from the driver's orders and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import winner
from ..schema import COUNTS


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """match_seq, Date, HomeTeam, AwayTeam, FTHG, FTAG, FTR: one match an order."""
    d = sf_dir.rstrip("/")
    rows = spark.read.parquet(f"{d}/orders.parquet").join(spark.read.parquet(f"{d}/customer.parquet"), F.col("o_custkey") == F.col("c_custkey"))
    team = lambda n: F.concat(F.lit("TEAM_"), n.cast("string"))
    home = F.col("c_nationkey").cast("long")
    rows = rows.select(
        F.col("o_orderkey").alias("match_seq"),
        F.col("o_orderdate").alias("Date"),
        team(home).alias("HomeTeam"),
        team((home + 1 + F.col("o_orderkey") % 24) % 25).alias("AwayTeam"),
        (F.floor("o_totalprice").cast("long") % 5).alias("FTHG"),
        (F.col("o_custkey") % 4).alias("FTAG"),
    )
    return rows.withColumn("FTR", winner("FTHG", "FTAG"))


def unique_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The match with the smallest match_seq of each (Date, HomeTeam, AwayTeam)."""
    rows = matches(spark, sf_dir)
    return rows.groupBy("Date", "HomeTeam", "AwayTeam").agg(F.min_by(F.struct("match_seq", "FTHG", "FTAG", "FTR"), "match_seq").alias("m")).select("m.match_seq", "Date", "HomeTeam", "AwayTeam", "m.FTHG", "m.FTAG", "m.FTR")


def dirty_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 16 columns as text with padded names, a bad score, missing dates and repeated rows, and match_seq."""
    m, seq = matches(spark, sf_dir), F.col("match_seq")
    rows = m.select(
        "match_seq",
        F.when(seq % 53 != 0, F.date_format("Date", "yyyy-MM-dd")).alias("Date"),
        F.when(seq % 7 == 0, F.concat(F.lit("  "), "HomeTeam", F.lit(" "))).otherwise(F.col("HomeTeam")).alias("HomeTeam"),
        "AwayTeam",
        F.when(seq % 101 == 0, "x").otherwise(F.col("FTHG").cast("string")).alias("FTHG"),
        F.col("FTAG").cast("string").alias("FTAG"),
        "FTR",
        *[((seq + 3 * i) % (7 + i)).cast("string").alias(c) for i, c in enumerate(COUNTS[2:])],
    )
    again = rows.where(seq % 97 == 0).withColumn("match_seq", seq + 1_000_000_000)
    return rows.unionByName(again)
