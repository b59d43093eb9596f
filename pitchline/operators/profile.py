"""Dataset profiles. Wide aggregates run in chunks of columns, so generated code stays small."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..errors import ValidationFailed
from ..schema import SEQ
from .order import quantiles

CHUNK = 40


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType) and f.name != SEQ]


def _q(c: str):
    return F.col(f"`{c}`")


def _real(c: str):
    """The column with NaN as null."""
    return F.when(~F.isnan(_q(c).cast("double")), _q(c))


def _stack(df: DataFrame, cols: list[str], measures: dict) -> DataFrame:
    """(feature, measures): one aggregation for each chunk of columns, unpivoted."""
    out = []
    for i in range(0, len(cols), CHUNK):
        part = cols[i : i + CHUNK]
        one = df.agg(*[m(c).alias(f"m{j}_{k}") for j, c in enumerate(part) for k, m in measures.items()])
        rows = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), *[F.col(f"m{j}_{k}").alias(k) for k in measures]) for j, c in enumerate(part)]))
        out.append(one.select(rows.alias("r")).select("r.*"))
    return reduce(DataFrame.unionByName, out)


def _six(c):
    return F.round(c, 6)


def missing(df: DataFrame) -> DataFrame:
    cols = [c for c in df.columns if c != SEQ]
    numeric = set(numeric_columns(df))
    gone = lambda c: _q(c).isNull() | F.isnan(_q(c).cast("double")) if c in numeric else _q(c).isNull()
    inf = lambda c: F.sum((F.abs(_q(c).cast("double")) == float("inf")).cast("long")) if c in numeric else F.lit(0).cast("long")
    return _stack(df, cols, {"missing": lambda c: F.coalesce(F.sum(gone(c).cast("long")), F.lit(0)), "infinite": lambda c: F.coalesce(inf(c), F.lit(0))})


def describe(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(feature, count, mean, std, min, q25, q50, q75, max, missing): exact quantiles, rounded to 6 places."""
    d, cols = lambda c: _real(c).cast("double"), cols or numeric_columns(df)
    base = _stack(df, cols, {
        "count": lambda c: F.count(_real(c)), "mean": lambda c: _six(F.avg(d(c))), "std": lambda c: _six(F.stddev_samp(d(c))), "min": lambda c: _six(F.min(d(c))),
        "max": lambda c: _six(F.max(d(c))), "missing": lambda c: F.count("*") - F.count(_real(c)),
    })
    shares = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    q = quantiles(df, {c: d(c) for c in cols}, list(shares.values()))
    q = q.groupBy("feature").agg(*[_six(F.max(F.when(F.col("share") == s, F.col("value")))).alias(n) for n, s in shares.items()])
    return base.join(F.broadcast(q), "feature", "left").select("feature", "count", "mean", "std", "min", *shares, "max", "missing")


def constants(df: DataFrame, threshold: float = 0.01) -> DataFrame:
    """(feature, distinct, is_constant, is_near_constant, ratio) of numeric columns; null counts as a value."""
    rows = _stack(df, numeric_columns(df), {"distinct": lambda c: F.count_distinct(_real(c)) + F.coalesce(F.max(_real(c).isNull().cast("long")), F.lit(0)), "n": lambda c: F.count("*")})
    r = F.when(F.col("n") > 0, F.col("distinct") / F.col("n")).otherwise(0.0)
    return rows.select("feature", "distinct", (F.col("distinct") <= 1).alias("is_constant"), ((F.col("distinct") > 1) & (r <= threshold)).alias("is_near_constant"), _six(r).alias("ratio"))


def correlations(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(a, b, corr) for all pairs of numeric columns, over rows that have both; null where one is constant."""
    pairs = list(combinations(cols or numeric_columns(df), 2))
    out = []
    for i in range(0, len(pairs), CHUNK):
        part = pairs[i : i + CHUNK]
        x = lambda a, b: F.when(_real(b).isNotNull(), _real(a).cast("double"))
        spread = lambda a, b: F.stddev_pop(x(a, b)) * F.stddev_pop(x(b, a))
        one = df.agg(*[F.when(spread(a, b) > 0, F.covar_pop(x(a, b), x(b, a)) / F.when(spread(a, b) > 0, spread(a, b))).alias(f"c{j}") for j, (a, b) in enumerate(part)])
        out.append(one.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{j}").alias("corr")) for j, (a, b) in enumerate(part)])).alias("r")).select("r.*"))
    rows = reduce(DataFrame.unionByName, out)
    return rows.select("a", "b", _six(F.when(~F.isnan("corr"), F.col("corr"))).alias("corr"))


def highly_correlated(df: DataFrame, threshold: float = 0.9, limit: int = 20, cols=None) -> DataFrame:
    return correlations(df, cols).where(F.abs("corr") >= threshold).orderBy(F.abs("corr").desc(), "a", "b").limit(limit)


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """(value, n, ratio): one row a value; the total is a window over those rows."""
    n = df.groupBy(_q(target).cast("string").alias("value")).agg(F.count("*").alias("n"))
    return n.select("value", "n", _six(F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1)))).alias("ratio"))


def summary(df: DataFrame) -> DataFrame:
    """(feature, dtype, count, distinct, missing, min, max, mean, std) of numeric columns."""
    kinds = F.create_map(*[F.lit(x) for kv in df.dtypes for x in kv])
    d = lambda c: _real(c).cast("double")
    rows = _stack(df, numeric_columns(df), {"count": lambda c: F.count(_real(c)), "distinct": lambda c: F.count_distinct(_real(c)) + F.coalesce(F.max(_real(c).isNull().cast("long")), F.lit(0)), "missing": lambda c: F.count("*") - F.count(_real(c)), "min": lambda c: _six(F.min(d(c))), "max": lambda c: _six(F.max(d(c))), "mean": lambda c: _six(F.avg(d(c))), "std": lambda c: _six(F.stddev_samp(d(c)))})
    return rows.withColumn("dtype", kinds[F.col("feature")])


def duplicate_columns(df: DataFrame) -> list[list[str]]:
    """Sets of columns with equal contents: bucketed by an order-free hash, then compared value by value."""
    cols = [c for c in df.columns if c != SEQ]
    key = F.col(SEQ) if SEQ in df.columns else F.lit(0)
    sums = df.agg(*[F.sum(F.pmod(F.xxhash64(key, _q(c).cast("string")), F.lit(1 << 40))).alias(f"h{i}") for i, c in enumerate(cols)]).first()
    buckets: dict = {}
    for c, h in zip(cols, sums):
        buckets.setdefault(h, []).append(c)
    out = []
    for group in (g for g in buckets.values() if len(g) > 1):
        same = df.agg(*[F.bool_and(_q(group[0]).eqNullSafe(_q(c))).alias(f"s{i}") for i, c in enumerate(group)]).first()
        if len(found := [c for c, s in zip(group, same) if s]) > 1:
            out.append(found)
    return out


@dataclass
class QualityReport:
    rows: int = 0
    columns: int = 0
    missing: dict = field(default_factory=dict)
    infinite: dict = field(default_factory=dict)
    duplicate_rows: int = 0
    duplicate_columns: list = field(default_factory=list)
    constant: list = field(default_factory=list)
    near_constant: dict = field(default_factory=dict)
    invalid_types: dict = field(default_factory=dict)
    target: dict = field(default_factory=dict)
    warnings: list = field(default_factory=list)

    @property
    def is_valid(self) -> bool:
        return not (self.missing or self.infinite or self.duplicate_rows or self.duplicate_columns or self.constant or self.near_constant or self.invalid_types)


def profile(df: DataFrame, target: str | None = None, near: float = 0.01, imbalance: float = 0.9) -> QualityReport:
    """All checks. An uneven target warns and leaves the report valid. The table is kept while it is read again and again, then let go."""
    if target is not None and target not in df.columns:
        raise ValidationFailed("target column is missing", 0, target)
    kept = df.persist()
    try:
        return _profile(kept, target, near, imbalance)
    finally:
        kept.unpersist()


def _profile(df: DataFrame, target: str | None, near: float, imbalance: float) -> QualityReport:
    from .validate import duplicate_rows

    features = df.drop(target) if target else df
    numeric = set(numeric_columns(features))
    r = QualityReport(rows=df.count(), columns=len([c for c in features.columns if c != SEQ]))
    r.invalid_types = {c: t for c, t in features.dtypes if c not in numeric and c != SEQ}
    for row in missing(features).collect():  # a row a column
        if row.missing:
            r.missing[row.feature] = row.missing
        if row.infinite:
            r.infinite[row.feature] = row.infinite
    r.duplicate_rows = duplicate_rows(df).first().duplicates
    r.duplicate_columns = duplicate_columns(features)
    for row in constants(features, near).collect() if numeric else []:
        if row.is_constant:
            r.constant.append(row.feature)
        elif row.is_near_constant:
            r.near_constant[row.feature] = row.ratio
    if target:
        r.target = {x.value: x.ratio for x in target_distribution(df, target).collect()}
        if r.target and max(r.target.values()) >= imbalance:
            r.warnings += ["the target is imbalanced", "consider resampling or class weights"]
    return r
