"""Checks: each set of checks is one aggregation, whose counts then decide in a fixed order."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import DuplicateMatchError, InvalidDateError, InvalidScoreError, MissingColumnError, ValidationFailed
from ..functions.expr import date_column, strip, to_number, winner
from ..schema import MATCHES, SEQ, MatchSchema

NAME = r"^[a-zA-Z0-9\s\-'&.]+$"


def _count(c: Column) -> Column:
    return F.coalesce(F.sum(F.coalesce(c, F.lit(False)).cast("long")), F.lit(0))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row, duplicates: rows beyond the first of each set of equal rows (match_seq apart)."""
    cols = [c for c in df.columns if c != SEQ]
    n = df.groupBy(*cols).count()
    return n.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicates"))


def bad_score(c: str, kind: str) -> Column:
    """Text that is no whole number, or a negative number."""
    value = F.col(c)
    if kind == "string":
        whole = value.rlike(r"^\s*[+-]?\d+\s*$")
        return value.isNotNull() & (~whole | (F.when(whole, to_number(F.trim(value), "double")) < 0))
    return value < 0


def validation_counts(df: DataFrame, schema: MatchSchema = MATCHES) -> DataFrame:
    """One row: nulls_<column> of all columns, bad_dates, bad_scores, bad_names."""
    cols = [c for c in df.columns if c != SEQ]
    kinds = dict(df.dtypes)
    numbers = [c for c in schema.numeric if c in cols]
    bad_names = [strip(c) for c in ("HomeTeam", "AwayTeam") if c in cols]
    name = lambda c: c.isNotNull() & ((F.length(c) == 0) | (F.length(c) > 50) | ~c.rlike(NAME))
    total = lambda xs: sum((_count(x) for x in xs), F.lit(0).cast("long")).cast("long")
    return df.agg(
        *[_count(F.col(f"`{c}`").isNull()).alias(f"nulls_{c}") for c in cols],
        _count(F.col("Date").isNotNull() & date_column(df).isNull()).alias("bad_dates"),
        total([bad_score(c, kinds[c]) for c in numbers]).alias("bad_scores"),
        total([name(c) for c in bad_names]).alias("bad_names"),
    )


@dataclass
class ValidationReport:
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)
    checks: dict[str, int] = field(default_factory=dict)

    @property
    def ok(self) -> bool:
        return not self.errors

    def summary(self) -> str:
        return f"{len(self.checks)} checks, {len(self.errors)} errors, {len(self.warnings)} warnings"


def validate(df: DataFrame, schema: MatchSchema = MATCHES) -> ValidationReport:
    """Columns, duplicates, nulls, dates, scores, names; the first that fails is raised."""
    schema.require(df.columns)
    report = ValidationReport()
    n = duplicate_rows(df).first().duplicates
    report.checks["duplicates"] = n
    if n:
        raise ValidationFailed("duplicate rows", n)
    row = validation_counts(df, schema).first().asDict()
    nulls = {k[6:]: v for k, v in row.items() if k.startswith("nulls_") and v}
    report.checks |= {"nulls": sum(nulls.values())} | {k: row[k] for k in ("bad_dates", "bad_scores", "bad_names")}
    if nulls:
        raise ValidationFailed("nulls", sum(nulls.values()), f"({', '.join(f'{k}: {v}' for k, v in nulls.items())})")
    if row["bad_dates"]:
        some = [r[0] for r in df.where(F.col("Date").isNotNull() & date_column(df).isNull()).select("Date").limit(3).collect()]
        raise InvalidDateError("dates", row["bad_dates"], f"such as {some}")
    if row["bad_scores"]:
        raise InvalidScoreError("scores", row["bad_scores"])
    if row["bad_names"]:
        raise ValidationFailed("team names", row["bad_names"])
    return report


def contract_counts(df: DataFrame, now: Column | None = None) -> DataFrame:
    """One row of violations: invalid_dates, future_dates, negative_goals, bad_labels, wrong_labels, repeated_keys, bad_integers."""
    date, h, a = date_column(df), to_number("FTHG"), to_number("FTAG")
    whole = (h == F.floor(h)) & (a == F.floor(a))
    counts = [c for c in MATCHES.numeric if c in df.columns]
    rows = df.select("*", date.alias("_d"), h.alias("_h"), a.alias("_a"))
    one = rows.agg(
        _count(F.col("_d").isNull()).alias("invalid_dates"),
        _count(F.col("_d") > (now if now is not None else F.current_timestamp())).alias("future_dates"),
        _count((F.col("_h") < 0) | (F.col("_a") < 0)).alias("negative_goals"),
        _count(~F.coalesce(F.col("FTR").isin("H", "D", "A"), F.lit(False))).alias("bad_labels"),
        _count(F.col("FTR").isin("H", "D", "A") & whole & (F.col("FTR") != winner("_h", "_a"))).alias("wrong_labels"),
        sum((_count(F.col(c).isNotNull() & to_number(c).isNull()) for c in counts), F.lit(0).cast("long")).alias("bad_integers"),
    )
    keys = df.groupBy("Date", "HomeTeam", "AwayTeam").count().where("count > 1").agg(F.coalesce(F.sum("count"), F.lit(0)).alias("repeated_keys"))
    return one.crossJoin(F.broadcast(keys))  # one row beside one row


def check_contracts(df: DataFrame, now: Column | None = None) -> None:
    missing = [c for c in MATCHES.required if c not in df.columns]
    if missing:
        raise MissingColumnError(missing)
    r = contract_counts(df, now).first().asDict()
    for name, error in (("invalid_dates", InvalidDateError), ("future_dates", InvalidDateError), ("negative_goals", InvalidScoreError), ("bad_labels", InvalidScoreError), ("wrong_labels", InvalidScoreError), ("repeated_keys", DuplicateMatchError), ("bad_integers", InvalidScoreError)):
        if r[name]:
            raise error(name.replace("_", " "), r[name])
