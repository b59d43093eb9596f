"""Labelled datasets and splits."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import asdict, dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..errors import DuplicateMatchError, InvalidMatchError, MissingColumnError, SplittingError
from ..functions.expr import date_column, to_number
from ..schema import SEQ
from .order import ranked, slot, sums_before

#: Result columns, in order of precedence.
RESULTS = ("FTR", "Result", "MatchResult", "match_result", "result")
#: Results as labels.
LABELS = {"H": "HOME_WIN", "D": "DRAW", "A": "AWAY_WIN", "HOME_WIN": "HOME_WIN", "DRAW": "DRAW", "AWAY_WIN": "AWAY_WIN"}


def label(df: DataFrame) -> DataFrame:
    """Adds target_label from, in this order: itself, the first result column there is, the scores."""
    if "target_label" in df.columns:
        return df
    found = [c for c in RESULTS if c in df.columns]
    if found:
        names = F.create_map(*[F.lit(x) for kv in LABELS.items() for x in kv])
        return df.withColumn("target_label", names[F.upper(F.col(found[0]).cast("string"))])
    if {"FTHG", "FTAG"} <= set(df.columns):
        h, a = to_number("FTHG"), to_number("FTAG")
        return df.withColumn("target_label", F.when(h > a, "HOME_WIN").when(h < a, "AWAY_WIN").when(h == a, "DRAW"))
    raise InvalidMatchError("neither a label nor a result nor scores")


def from_records(spark: SparkSession, records) -> DataFrame:
    """Matches from an iterable of mappings, with match_seq in their order; names that some leave out are null there."""
    if isinstance(records, (str, bytes, dict)) or not isinstance(records, Iterable):
        raise InvalidMatchError("matches must be a DataFrame or an iterable of records")
    rows = [dict(r) for r in records]
    names = list(dict.fromkeys(k for r in rows for k in r))
    if not names:
        raise InvalidMatchError("no matches")
    text = {n for n in names if len({type(r[n]) for r in rows if r.get(n) is not None}) > 1}  # of several types: as text
    value = lambda n, v: str(v) if n in text and v is not None else v
    kinds = {bool: "boolean", int: "long", float: "double", date: "date", datetime: "timestamp"}
    kind = lambda n: "string" if n in text else next((kinds.get(type(r[n]), "string") for r in rows if r.get(n) is not None), "string")
    schema = ", ".join([*(f"`{n}` {kind(n)}" for n in names), *([] if SEQ in names else [f"{SEQ} long"])])
    return spark.createDataFrame([(*[value(n, r.get(n)) for n in names], *([] if SEQ in names else [i])) for i, r in enumerate(rows)], schema)


def build_dataset(df, spark: SparkSession | None = None) -> DataFrame:
    """Checked and labelled matches; raises for missing columns, no rows, bad dates, repeated keys or missing labels.

    df: a DataFrame, or records (see from_records; spark, or the active session, reads them).
    """
    if not isinstance(df, DataFrame):
        df = from_records(spark or SparkSession.active(), df)
    missing = [c for c in ("Date", "HomeTeam", "AwayTeam") if c not in df.columns]
    if missing:
        raise MissingColumnError(missing)
    out = label(df.withColumn("Date", date_column(df)))
    r = out.agg(F.count("*").alias("n"), F.count("Date").alias("dates"), F.count("target_label").alias("labels")).first()
    if not r.n:
        raise InvalidMatchError("no matches")
    if r.dates < r.n:
        raise InvalidMatchError(f"{r.n - r.dates} dates can't be read")
    if n := out.groupBy("Date", "HomeTeam", "AwayTeam").count().where("count > 1").limit(1).count():
        raise DuplicateMatchError("repeated matches", n)
    if r.labels < r.n:
        raise InvalidMatchError(f"{r.n - r.labels} matches have no label")
    return out


@dataclass(frozen=True)
class SplitConfig:
    train: float = 0.7
    validation: float = 0.15
    test: float = 0.15
    seed: int = 42

    def __post_init__(self):
        if abs(self.train + self.validation + self.test - 1) > 1e-4:
            raise SplittingError("the shares must add up to 1")
        if self.train <= 0 or self.validation < 0 or self.test < 0:
            raise SplittingError("train must be above 0 and the others not below")


def chronological_position(df: DataFrame) -> DataFrame:
    """Adds position, from 0, in order of (Date, match_seq)."""
    return ranked(df, ["Date", SEQ], "position")


def split_chronological(df: DataFrame, config: SplitConfig = SplitConfig(), check: bool = True) -> DataFrame:
    """Adds split: train, validation or test, the earliest first; sizes are whole parts of n, the rest is test."""
    n = df.count()
    if n < 3:
        raise SplittingError("at least three matches are needed")
    keys = [c for c in ("Date", "HomeTeam", "AwayTeam", "FTHG", "FTAG") if c in df.columns]
    if check and df.groupBy(*keys).count().where("count > 1").limit(1).count():
        raise SplittingError("repeated matches")
    t, v = int(n * config.train), int(n * config.validation)
    at = F.col("position")
    return chronological_position(df).withColumn("split", F.when(at < t, "train").when(at < t + v, "validation").otherwise("test"))


def split_metadata(split: DataFrame) -> DataFrame:
    """(split, n, first, last)."""
    return split.groupBy("split").agg(F.count("*").alias("n"), F.min("Date").alias("first"), F.max("Date").alias("last"))


PARTS = ("train", "validation", "test")


@dataclass
class SplitSummary:
    """What a split came to: rows and, of a chronological one, first and last dates by part."""

    counts: dict
    dates: dict
    seed: int
    features: int
    target: str | None = None
    created: datetime = field(default_factory=lambda: datetime.now(timezone.utc))

    def to_dict(self) -> dict:
        text = lambda v: v.isoformat() if isinstance(v, (date, datetime)) else v
        return asdict(self) | {"dates": {k: [text(x) for x in v] for k, v in self.dates.items()}, "created": self.created.isoformat()}

    def describe(self) -> str:
        total = sum(self.counts.values()) or 1
        parts = ", ".join(f"{p} {self.counts[p]} ({100 * self.counts[p] / total:.1f} %)" for p in PARTS if self.counts.get(p))
        return f"{parts}; {self.features} features{f', by {self.target}' if self.target else ''}"


def summarize(split: DataFrame, seed: int = 42, target: str | None = None) -> SplitSummary:
    rows = (split_metadata(split) if "Date" in split.columns else split.groupBy("split").agg(F.count("*").alias("n"))).collect()  # three rows
    dates = {r.split: (r["first"], r["last"]) for r in rows} if "Date" in split.columns else {}
    return SplitSummary({p: next((r.n for r in rows if r.split == p), 0) for p in PARTS}, dates, seed, len([c for c in split.columns if c not in ("split", "position", SEQ, target)]), target)


def verify_no_overlap(split: DataFrame, key: str = SEQ) -> bool:
    """True if no key is in two parts; else SplittingError."""
    n = split.groupBy(key).agg(F.count_distinct("split").alias("n")).where("n > 1").limit(1).count()
    if n:
        raise SplittingError("a match is in two parts")
    return True


def verify_complete_coverage(split: DataFrame, total: int) -> bool:
    """True if the parts have total rows together; else SplittingError."""
    n = split.where(F.col("split").isin(*PARTS)).count()
    if n != total:
        raise SplittingError(f"the parts have {n} rows of {total}")
    return True


def verify_chronological(split: DataFrame) -> bool:
    """True if no part has a date before the last one of an earlier part; else SplittingError."""
    rows = {r.split: r for r in split_metadata(split).collect()}
    kept = [rows[p] for p in PARTS if p in rows]
    for a, b in zip(kept, kept[1:]):
        if b["first"] < a["last"]:
            raise SplittingError(f"{b.split} begins before {a.split} ends")
    return True


def split_random(df: DataFrame, test: float = 0.2, validation: float = 0.0, stratify: str | None = None, seed: int = 42, shuffle: bool = True) -> DataFrame:
    """Adds split with exact quotas, by stratum if one is named (null is one); the order is that of MD5 digests of `seed:match_seq`."""
    if stratify and not shuffle:
        raise SplittingError("stratified splits need shuffling")
    if stratify and stratify not in df.columns:
        raise SplittingError(f"no column {stratify} to stratify by")
    if not (0 <= test < 1 and 0 <= validation < 1 and test + validation < 1):
        raise SplittingError("shares must lie between 0 and 1")
    # ranks within (stratum, slot) and the slots' counts give ranks in the stratum without one task for it
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col(SEQ).cast("string")).cast("binary")) if shuffle else F.col(SEQ)
    at = F.conv(F.substring(key, 1, 2), 16, 10).cast("int") if shuffle else slot(df, SEQ)
    rows = df.withColumn("_k", key).withColumn("_s", F.coalesce(F.concat(F.lit("="), F.col(stratify).cast("string")), F.lit("-")) if stratify else F.lit("all")).withColumn("_b", at)
    starts = sums_before(rows, ["_s"], "_b", F.lit(1), "_before").join(rows.groupBy("_s").agg(F.count("*").alias("_all")), "_s")
    rank = F.row_number().over(Window.partitionBy("_s", "_b").orderBy("_k", SEQ)) - 1
    rows = rows.withColumn("_r", rank).join(F.broadcast(starts), ["_s", "_b"]).withColumn("_r", F.col("_r") + F.col("_before"))
    v, t = F.round(F.col("_all") * validation), F.round(F.col("_all") * test)
    part = F.when(F.col("_r") < v, "validation").when(F.col("_r") < v + t, "test").otherwise("train")
    return rows.withColumn("split", part).select(*df.columns, "split")
