"""Cleaning: one lazy chain from text columns to typed, complete rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import date_column, strip, to_number
from ..schema import MATCHES, SEQ, TYPES, MatchSchema
from .order import ranked


def remove_duplicates(df: DataFrame) -> DataFrame:
    """Rows equal in all but match_seq: the one with the smallest match_seq stays."""
    cols = [c for c in df.columns if c != SEQ]
    if SEQ not in df.columns:
        return df.dropDuplicates()
    return df.groupBy(*cols).agg(F.min(SEQ).alias(SEQ)).select(*df.columns)


def standardize_names(df: DataFrame, columns=("HomeTeam", "AwayTeam")) -> DataFrame:
    return df.withColumns({c: strip(c) for c in columns if c in df.columns})


def convert_dates(df: DataFrame, column: str = "Date") -> DataFrame:
    return df.withColumn(column, date_column(df, column))


def _typed(df: DataFrame, c: str, kind: str) -> Column:
    if kind == "integer":
        return F.coalesce(to_number(F.when(~F.isnan(to_number(c)) & (F.abs(to_number(c)) < 9.2e18), to_number(c)), "double"), F.lit(0.0)).cast("long")
    if kind == "float":
        return to_number(c)
    return date_column(df, c) if kind == "date" else F.col(c).cast("string")


def convert_types(df: DataFrame, schema: MatchSchema = MATCHES) -> DataFrame:
    """Integers: coerced, missing 0, truncated; floats and dates: coerced; strings: cast."""
    kinds = {c: k for c, k in schema.kinds().items() if c in df.columns}
    return df.withColumns({c: _typed(df, c, k) for c, k in kinds.items() if df.schema[c].dataType != TYPES[k]})


def fill_missing(df: DataFrame, schema: MatchSchema = MATCHES) -> DataFrame:
    """Rows without date or team go; missing numbers are 0 and missing categories "Unknown"."""
    have = lambda cols: [c for c in cols if c in df.columns]
    out = df.na.drop(subset=have(["Date", "HomeTeam", "AwayTeam"]))
    return out.na.fill(0, have(schema.numeric)).na.fill("Unknown", have(schema.categorical))


def clean(df: DataFrame, schema: MatchSchema = MATCHES) -> DataFrame:
    """Deduplicate, strip names, parse dates, set types, fill. Rows carry match_seq; sort with chronological at a sink."""
    return fill_missing(convert_types(convert_dates(standardize_names(remove_duplicates(df))), schema), schema)


def chronological(df: DataFrame) -> DataFrame:
    return df.orderBy(*[c for c in ("Date", SEQ) if c in df.columns])


def apply_aliases(df: DataFrame, aliases: dict[str, str], columns=("HomeTeam", "AwayTeam")) -> DataFrame:
    """Team names by an alias map of the caller's; others stay."""
    if not aliases:
        return df
    m = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
    return df.withColumns({c: F.coalesce(m[F.col(c)], F.col(c)) for c in columns if c in df.columns})


def row_numbers(df: DataFrame, order: list[str]) -> DataFrame:
    """match_seq, from 1, by a given order, for inputs that have none; use sources.files for files."""
    return ranked(df, order, SEQ).withColumn(SEQ, F.col(SEQ) + 1)
