"""Guarded and coercing column expressions; the session may be in ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

#: Tried in this order, on text alone; month first where both orders fit. A fraction has up to nine digits.
DATE_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss[.SSSSSSSSS]", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]", "M/d/yyyy", "d/M/yyyy", "M/d/yy", "d/M/yy", "d-M-yyyy", "yyyy/M/d", "d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy")


def ratio(x: Column, n: Column) -> Column:
    """x / n, or 0 where n is 0."""
    return F.when(n > 0, x / n).otherwise(F.lit(0.0))


def strip(c) -> Column:
    """ASCII white space off both ends."""
    return F.btrim(F.col(c) if isinstance(c, str) else c, F.lit(" \t\n\x0b\x0c\r"))


def parse_date(c, formats=DATE_FORMATS) -> Column:
    """A timestamp from text by the first format that fits, else null."""
    text = strip((F.col(c) if isinstance(c, str) else c).cast("string"))
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def date_column(df: DataFrame, name: str = "Date") -> Column:
    """A column as a timestamp: dates and timestamps as they are, text by parse_date."""
    if isinstance(df.schema[name].dataType, (DateType, TimestampType, TimestampNTZType)):
        return F.col(f"`{name}`").cast("timestamp")
    return parse_date(F.col(f"`{name}`"))


def to_number(c, kind: str = "double") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast(kind)


def winner(home, away, labels=("H", "D", "A")) -> Column:
    return F.when(F.col(home) > F.col(away), labels[0]).when(F.col(home) < F.col(away), labels[2]).when(F.col(home) == F.col(away), labels[1])


def points(result, is_home) -> Column:
    """3, 1 or 0 for a team, from the match's result and the team's side."""
    won = F.when(is_home, result == "H").otherwise(result == "A")
    return F.when(won, 3).when(result == "D", 1).otherwise(0)
