"""Fit and transform: a fit is one aggregation, a model emits column expressions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from ..errors import DataProcessingError, PreprocessingError
from ..schema import SEQ
from .order import quantiles

_DATES = ("date", "time", "timestamp", "dt")


def detect(df: DataFrame, skip=()) -> dict[str, list[str]]:
    """Columns by kind, from the schema alone; a name that contains a date word is a date whatever its type."""
    out: dict[str, list[str]] = {"date": [], "numerical": [], "categorical": [], "metadata": []}
    for f in df.schema:
        if f.name in (SEQ, *skip):
            continue
        kind = "date" if any(w in f.name.lower() for w in _DATES) else "numerical" if isinstance(f.dataType, NumericType) else "categorical" if isinstance(f.dataType, StringType) else "metadata"
        out[kind].append(f.name)
    return out


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def prepare_features(df: DataFrame, exclude=()) -> DataFrame:
    """All columns but those left out; names that aren't there are ignored."""
    return df.drop(*exclude)


def prepare_labels(df: DataFrame, label: str) -> DataFrame:
    """The label alone, with match_seq if there is one."""
    if label not in df.columns:
        raise DataProcessingError(f"no label column {label}")
    return df.select(*[c for c in (SEQ,) if c in df.columns and c != label], _c(label))


def imputation(df: DataFrame, numerical: list[str], categorical: list[str], strategy: str = "mean", categories: str = "most_frequent", constant: float = 0.0) -> dict:
    """Fill values: mean, median or mode (the smallest on a tie) or a constant; categories most_frequent or "MISSING"."""
    how = {"mean": F.avg, "median": None, "mode": lambda c: F.mode(c, True).cast("double"), "most_frequent": lambda c: F.mode(c, True).cast("double")}
    if strategy not in (*how, "constant") or categories not in ("most_frequent", "constant"):
        raise PreprocessingError(f"no strategy {strategy} or {categories}")
    fills: dict = {c: constant for c in numerical} if strategy == "constant" else {}
    fills |= {c: "MISSING" for c in categorical} if categories == "constant" else {}
    real = lambda c: F.when(~F.isnan(_c(c).cast("double")), _c(c).cast("double"))
    if strategy == "median" and numerical:
        found = {r.feature: r.value for r in quantiles(df, {c: real(c) for c in numerical}, [0.5]).collect()}  # a row a column
        fills |= {c: found.get(c, constant) for c in numerical}
    asked = [how[strategy](real(c)).alias(c) for c in numerical if c not in fills] + [F.mode(_c(c), True).alias(c) for c in categorical if c not in fills]
    if asked:
        row = df.agg(*asked).first().asDict()
        fills |= {c: (constant if c in numerical else "MISSING") if v is None else v for c, v in row.items()}
    return fills


def impute(df: DataFrame, fills: dict) -> DataFrame:
    value = lambda c, v: F.coalesce(F.when(~F.isnan(_c(c).cast("double")), _c(c).cast("double")), F.lit(float(v))) if not isinstance(v, str) else F.coalesce(_c(c), F.lit(v))
    return df.withColumns({c: value(c, v) for c, v in fills.items()})


def categories(df: DataFrame, columns: list[str], most: int = 10_000) -> dict[str, list[str]]:
    """Sorted distinct values of each column: encodings are held by the driver, so more than `most` values of one are refused, not cut."""
    if not columns:
        return {}
    rows = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), _c(c).cast("string").alias("v")) for i, c in enumerate(columns)])).alias("r")).select("r.*").where("v is not null").distinct()
    counts = {r.i: r["count"] for r in rows.groupBy("i").count().collect()}  # a row a column
    if many := [c for i, c in enumerate(columns) if counts.get(i, 0) > most]:
        raise PreprocessingError(f"more than {most} categories: {', '.join(many)}")
    found: dict[str, list[str]] = {c: [] for c in columns}
    for r in rows.collect():
        found[columns[r.i]].append(r.v)
    return {c: sorted(v, key=lambda x: x.encode()) for c, v in found.items()}


def label_encode(df: DataFrame, classes: dict[str, list[str]], strict: bool = False) -> DataFrame:
    """Index in the sorted classes; unseen values are -1 or, if strict, an error when the rows are read."""
    def code(c, values):
        at = (F.array_position(F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>"), _c(c).cast("string")) - 1).cast("long")
        return F.when(at < 0, F.raise_error(F.concat(F.lit(f"{c}: unseen value "), _c(c).cast("string")))).otherwise(at) if strict else at

    return df.withColumns({c: code(c, v) for c, v in classes.items()})


def one_hot(df: DataFrame, classes: dict[str, list[str]]) -> DataFrame:
    """column_value for each fitted value, 0 or 1; unseen values are 0 in all."""
    out = df
    for c, values in classes.items():
        out = out.withColumns({f"{c}_{v}": F.coalesce((_c(c).cast("string") == v).cast("long"), F.lit(0)) for v in values}).drop(c)
    return out


def scaling(df: DataFrame, columns: list[str], method: str = "standard") -> dict[str, tuple[float, float]]:
    """(shift, divisor) of each column: standard with the population's deviation, or minmax; a constant column divides by 1."""
    if method not in ("standard", "minmax"):
        raise PreprocessingError(f"no scaling {method}")
    if not columns:
        return {}
    pair = lambda c: (F.avg(_c(c).cast("double")), F.stddev_pop(_c(c).cast("double"))) if method == "standard" else (F.min(_c(c).cast("double")), F.max(_c(c).cast("double")) - F.min(_c(c).cast("double")))
    row = df.agg(*[x.alias(f"{i}_{j}") for i, c in enumerate(columns) for j, x in enumerate(pair(c))]).first()
    return {c: (row[f"{i}_0"] or 0.0, row[f"{i}_1"] or 1.0) for i, c in enumerate(columns)}


def scale(df: DataFrame, factors: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (_c(c).cast("double") - F.lit(m)) / F.lit(s) for c, (m, s) in factors.items()})


@dataclass(frozen=True)
class PreprocessingModel:
    kinds: dict
    fills: dict
    labels: dict
    hot: dict
    factors: dict
    target: str | None
    drop: list

    def metadata(self, df: DataFrame) -> dict:
        """Columns by kind, what was done to each, and the shapes before and after; nothing is run."""
        out = self.transform(df).columns
        done = {c: {"fill": v} for c, v in self.fills.items()}
        for c in self.labels:
            done.setdefault(c, {})["encoding"] = "label"
        for c in self.hot:
            done.setdefault(c, {})["encoding"] = "one-hot"
        for c, (shift, divisor) in self.factors.items():
            done.setdefault(c, {})["scale"] = {"shift": shift, "divisor": divisor}
        return {"kinds": self.kinds, "features": done, "target": self.target, "dropped": self.drop, "columns_in": len(df.columns), "columns_out": len(out), "classes": self.labels | self.hot}

    def transform(self, df: DataFrame) -> DataFrame:
        missing = [c for c in self.fills if c not in df.columns]
        if missing:
            raise PreprocessingError(f"columns of the fit are missing: {', '.join(missing)}")
        out = scale(one_hot(label_encode(impute(df, self.fills), self.labels, strict=True), self.hot), self.factors)
        return out.drop(*self.drop)

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """(features, target), both with match_seq if there is one."""
        out, key = self.transform(df), [c for c in (SEQ,) if c in df.columns]
        return (out.drop(self.target), out.select(*key, self.target)) if self.target else (out, None)


@dataclass
class Preprocessing:
    target: str | None = None
    numeric: str = "mean"
    category: str = "most_frequent"
    encoding: str = "auto"
    scaler: str = "standard"
    auto_limit: int = 10
    skip: tuple = field(default_factory=tuple)

    def fit(self, df: DataFrame) -> PreprocessingModel:
        if self.target and self.target not in df.columns:
            raise PreprocessingError(f"no target {self.target}")
        kinds = detect(df, (*self.skip, *([self.target] if self.target else [])))
        fills = imputation(df, kinds["numerical"], kinds["categorical"], self.numeric, self.category)
        filled = impute(df, fills)
        classes = categories(filled, kinds["categorical"])
        few = lambda v: self.encoding == "label" or self.encoding == "auto" and len(v) <= self.auto_limit
        labels = {c: v for c, v in classes.items() if few(v)}
        factors = {} if self.scaler == "disabled" else scaling(filled, kinds["numerical"], self.scaler)
        return PreprocessingModel(kinds, fills, labels, {c: v for c, v in classes.items() if c not in labels}, factors, self.target, kinds["date"] + kinds["metadata"])

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)
