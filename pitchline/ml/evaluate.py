"""Binary classification metrics as aggregations over (label, prediction, probability)."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..errors import EvaluationError
from ..functions.expr import ratio
from ..operators.order import slot, sums_before
from ..sources.files import append_metrics, save_json


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).cast("long").alias("label"), F.col(prediction).cast("long").alias("prediction")).agg(F.count("*").alias("n"))


def metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: n, accuracy, precision, recall, f1, tp, fp, fn, tn; 0 where nothing is divided."""
    y, p = F.col(label), F.col(prediction)
    s = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    n = df.agg(F.count("*").alias("n"), s((y == 1) & (p == 1)).alias("tp"), s((y == 0) & (p == 1)).alias("fp"), s((y == 1) & (p == 0)).alias("fn"), s((y == 0) & (p == 0)).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return n.select("n", ratio(tp + tn, F.col("n")).alias("accuracy"), ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"), "tp", "fp", "fn", "tn")


def roc_auc(df: DataFrame, label: str = "label", score: str = "probability") -> DataFrame:
    """One row, auc: Mann-Whitney with half for ties; distinct scores are summed up slot by slot."""
    by = df.groupBy(F.col(score).alias("s")).agg(F.sum((F.col(label) == 1).cast("long")).alias("p"), F.sum((F.col(label) == 0).cast("long")).alias("q"))
    by = by.withColumn("slot", slot(df.select(F.col(score).alias("s")), "s"))
    within = F.coalesce(F.sum("q").over(Window.partitionBy("slot").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    by = by.withColumn("within", within).join(F.broadcast(sums_before(by, [], "slot", F.col("q"), "before")), "slot").withColumn("below", F.col("before") + F.col("within"))
    t = by.agg(F.sum(F.col("p") * (F.col("below") + F.col("q") / 2)).alias("u"), F.sum("p").alias("p"), F.sum("q").alias("q"))
    return t.select(F.when(F.col("p") * F.col("q") > 0, F.col("u") / (F.col("p") * F.col("q"))).alias("auc"))


def log_loss(df: DataFrame, label: str = "label", score: str = "probability", eps: float = 1e-15) -> DataFrame:
    p = F.greatest(F.lit(eps), F.least(F.lit(1 - eps), F.col(score).cast("double")))
    return df.agg((-F.avg(F.when(F.col(label) == 1, F.log(p)).otherwise(F.log(1 - p)))).alias("log_loss"))


def check(df: DataFrame, label: str = "label", prediction: str = "prediction", score: str | None = None) -> None:
    bad = (~F.col(label).isin(0, 1)) | (~F.col(prediction).isin(0, 1)) | F.col(label).isNull() | F.col(prediction).isNull()
    if score:
        bad = bad | F.col(score).isNull() | F.isnan(F.col(score)) | ~F.col(score).between(0, 1)
    r = df.agg(F.count("*").alias("n"), F.sum(bad.cast("long")).alias("bad")).first()
    if not r.n or r.bad:
        raise EvaluationError("no rows" if not r.n else f"{r.bad} rows have labels, predictions or probabilities out of range")


def evaluate(df: DataFrame, label: str = "label", prediction: str = "prediction", score: str | None = None) -> dict:
    check(df, label, prediction, score)
    out = metrics(df, label, prediction).first().asDict()
    if score:
        out |= {"roc_auc": roc_auc(df, label, score).first().auc, "log_loss": log_loss(df, label, score).first().log_loss}
    return out


def rank(results: dict[str, dict], metric: str = "f1", higher: bool = True) -> list[tuple[str, float]]:
    missing = [m for m, r in results.items() if metric not in r]
    if missing:
        raise EvaluationError(f"{metric} is missing for {', '.join(missing)}")
    return sorted(((m, r[metric]) for m, r in results.items()), key=lambda x: (-x[1] if higher else x[1], x[0]))


def folds(df: DataFrame, k: int, label: str | None = None, key: str = "match_seq", seed: int = 42) -> DataFrame:
    """Adds fold 0..k-1: within each label, rows are numbered by a seeded hash order and dealt in turn, so folds are exact k-ths of it."""
    if k < 2:
        raise EvaluationError("at least two folds")
    keys = [label] if label else []
    rows = df.withColumn("_k", F.xxhash64(F.lit(seed), F.col(key))).withColumn("_slot", F.shiftright("_k", 58))
    within = F.row_number().over(Window.partitionBy(*keys, "_slot").orderBy("_k", key)) - 1
    starts = sums_before(rows, keys, "_slot", F.lit(1), "_before")
    rows = rows.withColumn("_within", within).alias("a").join(F.broadcast(starts).alias("b"), [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*keys, "_slot")])
    return rows.select(*[F.col(f"a.`{c}`") for c in df.columns], ((F.col("b._before") + F.col("a._within")) % k).cast("int").alias("fold"))


@dataclass
class EvaluationMetadata:
    """What an evaluation was of: model and version, data, rows, how they were split."""

    model: str
    dataset: str
    rows: int
    split: str = "holdout"
    version: str = "1"
    hyperparameters: dict = field(default_factory=dict)
    created: datetime = field(default_factory=lambda: datetime.now(timezone.utc))

    def to_dict(self) -> dict:
        return asdict(self) | {"created": self.created.isoformat()}


def evaluate_predictions(df: DataFrame, model: str, dataset: str, label: str = "label", prediction: str = "prediction", score: str | None = None, split: str = "holdout", **more) -> tuple[dict, EvaluationMetadata]:
    """(metrics, metadata) of predictions; more: version and hyperparameters of the model."""
    found = evaluate(df, label, prediction, score)
    return found, EvaluationMetadata(model, dataset, found["n"], split, **more)


def export_json(spark, metrics: dict, metadata: EvaluationMetadata, path: str) -> None:
    save_json(spark, {"metadata": metadata.to_dict(), "metrics": metrics}, path)


def export_csv(spark, metrics: dict, metadata: EvaluationMetadata, path: str) -> None:
    """One more line of the metadata and the scalar metrics."""
    head = {k: v for k, v in metadata.to_dict().items() if k != "hyperparameters"}
    append_metrics(spark, head | metrics, path)
