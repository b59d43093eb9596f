"""Training, cross-validation, selection and prediction with pyspark.ml."""

from __future__ import annotations

import json
import time
from dataclasses import dataclass, field
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import DatasetNotFoundError, EvaluationError, FeatureMismatchError, ModelLoadError, NoModelsTrainedError
from ..sources.files import exists, load_json, modified, save_json
from . import evaluate as E

REGISTRY = {
    "logistic_regression": lambda seed, n: LogisticRegression(maxIter=100, regParam=1.0 / max(n, 1), standardization=False),
    "decision_tree": lambda seed, n: DecisionTreeClassifier(seed=seed, maxDepth=10),
    "random_forest": lambda seed, n: RandomForestClassifier(seed=seed, numTrees=50, maxDepth=10),
}


@dataclass
class Training:
    algorithm: str
    features: list[str]
    model: PipelineModel
    train_rows: int
    train_score: float
    validation_score: float | None = None
    seed: int = 42
    seconds: float = field(default=0.0)

    def metadata(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "model"}


def train(df: DataFrame, features: list[str], label: str = "label", algorithm: str = "logistic_regression", validation: DataFrame | None = None, seed: int = 42) -> Training:
    if algorithm not in REGISTRY:
        raise EvaluationError(f"no model {algorithm}")
    missing = [c for c in (*features, label) if c not in df.columns]
    if missing:
        raise FeatureMismatchError(f"missing: {', '.join(missing)}")
    n, nulls = df.agg(F.count("*"), F.sum(F.col(label).isNull().cast("long"))).first()
    if not n:
        raise EvaluationError("no rows to train on")
    if nulls:
        raise EvaluationError(f"{nulls} rows have no label")
    began = time.time()
    stages = [VectorAssembler(inputCols=features, outputCol="_features"), REGISTRY[algorithm](seed, n).setFeaturesCol("_features").setLabelCol(label)]
    model = Pipeline(stages=stages).fit(df.withColumn(label, F.col(label).cast("double")))
    score = lambda d: model.transform(d).agg(F.avg((F.col("prediction") == F.col(label)).cast("double"))).first()[0]
    return Training(algorithm, features, model, n, score(df), score(validation) if validation is not None else None, seed, time.time() - began)


def check_input(t: Training, df: DataFrame) -> None:
    """Columns of the training there, and at least one row; else FeatureMismatchError."""
    missing = [c for c in t.features if c not in df.columns]
    if missing:
        raise FeatureMismatchError(f"missing: {', '.join(missing)}")
    if df.isEmpty():
        raise FeatureMismatchError("no rows to predict")


def predict(t: Training, df: DataFrame) -> DataFrame:
    """Adds prediction, probabilities (by label) and confidence; any number of rows."""
    missing = [c for c in t.features if c not in df.columns]
    if missing:
        raise FeatureMismatchError(f"missing: {', '.join(missing)}")
    out = t.model.transform(df).withColumn("probabilities", vector_to_array("probability"))
    return out.withColumn("confidence", F.array_max("probabilities")).drop("_features", "rawPrediction", "probability")


def outcome_probabilities(predicted: DataFrame, labels: list[str]) -> DataFrame:
    """home_win, draw, away_win by stored label names, 0 for a class that the model never saw."""
    at = lambda name: F.coalesce(F.get("probabilities", F.lit(labels.index(name))), F.lit(0.0)) if name in labels else F.lit(0.0)
    return predicted.withColumns({n.lower(): at(n) for n in ("HOME_WIN", "DRAW", "AWAY_WIN")})


def cross_validate(df: DataFrame, features: list[str], label: str = "label", algorithm: str = "logistic_regression", k: int = 5, key: str = "match_seq", seed: int = 42) -> dict:
    """Mean metrics over stratified folds and the sum of their confusion matrices."""
    rows = E.folds(df, k, label, key, seed).cache()
    try:
        results = [E.evaluate(predict(train(rows.where(F.col("fold") != i), features, label, algorithm, seed=seed), rows.where(F.col("fold") == i)), label) for i in range(k)]
    finally:
        rows.unpersist()
    counts = ("n", "tp", "fp", "fn", "tn")
    return {m: sum(r[m] for r in results) / (1 if m in counts else k) for m in results[0]}


def select(df: DataFrame, test: DataFrame, features: list[str], label: str = "label", algorithms=None, metric: str = "f1", path: str | None = None, seed: int = 42):
    """(best Training, ranking, metrics by model); a model that fails is left out, none left is an error."""
    unknown = [a for a in algorithms or () if a not in REGISTRY]
    if algorithms is not None and not list(algorithms):
        raise EvaluationError("no models to choose from")
    if unknown:
        raise EvaluationError(f"no model {', '.join(unknown)}")
    for name, table in (("training", df), ("test", test)):
        lost = [c for c in (*features, label) if c not in table.columns]
        if lost:
            raise FeatureMismatchError(f"missing in the {name} rows: {', '.join(lost)}")
        if table.isEmpty():
            raise EvaluationError(f"no {name} rows")
    results, trained, failures = {}, {}, {}
    df, test = df.cache(), test.cache()  # each model reads them many times
    try:
        for a in algorithms or list(REGISTRY):
            try:
                trained[a] = train(df, features, label, a, seed=seed)
                scored = predict(trained[a], test).withColumn("_p", F.col("probabilities")[1])
                results[a] = E.evaluate(scored, label, "prediction", "_p")
            except Exception as e:
                failures[a] = str(e)
                trained.pop(a, None)
    finally:
        df.unpersist()
        test.unpersist()
    if not results:
        raise NoModelsTrainedError(json.dumps(failures))
    ranking = E.rank(results, metric)
    best = trained[ranking[0][0]]
    if path:
        save(best, path, {"ranking": ranking, "metrics": results})
    return best, ranking, results


@dataclass
class SelectionMetadata:
    """What a selection tried, by which metric, and what came of it."""

    metric: str
    best: str
    ranking: list
    train_rows: int
    features: list
    created: datetime = field(default_factory=lambda: datetime.now(timezone.utc))

    def to_dict(self) -> dict:
        return {k: v.isoformat() if isinstance(v, datetime) else v for k, v in self.__dict__.items()}


def selection_metadata(best: Training, ranking: list, metric: str = "f1") -> SelectionMetadata:
    return SelectionMetadata(metric, best.algorithm, [list(r) for r in ranking], best.train_rows, list(best.features))


def save(t: Training, path: str, more: dict | None = None) -> None:
    from pyspark.sql import SparkSession

    t.model.write().overwrite().save(f"{path}/model")
    save_json(SparkSession.active(), t.metadata() | (more or {}), f"{path}/metadata.json")


def load(path: str) -> Training:
    from pyspark.sql import SparkSession

    spark = SparkSession.active()
    try:
        meta = load_json(spark, f"{path}/metadata.json")
        keep = {k: meta[k] for k in ("algorithm", "features", "train_rows", "train_score", "validation_score", "seed", "seconds")}
        return Training(model=PipelineModel.load(f"{path}/model"), **keep)
    except (PySparkException, Py4JJavaError, KeyError, ValueError) as e:
        raise ModelLoadError(f"{path}: {str(e).splitlines()[0]}") from e


BEST = "best_model"


def persist_best(t: Training, directory: str, more: dict | None = None) -> str:
    """Save under directory as the best model and, beside it, under its name and time; the latter's path."""
    path = f"{directory}/{t.algorithm}_{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}"
    save(t, path, more)
    save(t, f"{directory}/{BEST}", more)
    return path


def load_best(directory: str) -> Training:
    """The best model of a directory, or where there is none the one saved last."""
    from pyspark.sql import SparkSession

    spark = SparkSession.active()
    if exists(spark, f"{directory}/{BEST}"):
        return load(f"{directory}/{BEST}")
    try:
        found = [p for _, p in modified(spark, directory) if exists(spark, f"{p}/metadata.json")]
    except DatasetNotFoundError as e:
        raise ModelLoadError(f"no directory {directory}") from e
    if not found:
        raise ModelLoadError(f"no models in {directory}")
    return load(found[0])


@dataclass
class PredictionMetadata:
    model: str
    milliseconds: float
    confidence: float
    rows: int = 1
    created: datetime = field(default_factory=lambda: datetime.now(timezone.utc))

    def to_dict(self) -> dict:
        return {k: v.isoformat() if isinstance(v, datetime) else v for k, v in self.__dict__.items()}


class MatchPredictor:
    """Predictions by a directory's best model; labels are the class names by the model's class numbers."""

    def __init__(self, directory: str, labels=("AWAY_WIN", "DRAW", "HOME_WIN")):
        self.training, self.labels = load_best(directory), list(labels)

    def predict(self, df: DataFrame) -> DataFrame:
        """Any number of matches: home_win, draw, away_win and confidence beside them."""
        check_input(self.training, df)
        return outcome_probabilities(predict(self.training, df), self.labels)

    def predict_one(self, df: DataFrame) -> tuple[dict[str, float], float, PredictionMetadata]:
        """(outcomes, confidence, metadata with the time it took) of a table of one match."""
        began = time.time()
        rows = self.predict(df).select("home_win", "draw", "away_win", "confidence").limit(2).collect()
        if len(rows) != 1:
            raise FeatureMismatchError("one match is asked for")
        r = rows[0].asDict()
        confidence = r.pop("confidence")
        return r, confidence, PredictionMetadata(self.training.algorithm, 1000 * (time.time() - began), confidence)
