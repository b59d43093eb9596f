"""Files, ingest runs, splits, models and reports: what a run must survive and what it must leave behind."""

import hashlib
import json
import math
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from pitchline import errors as X
from pitchline.functions.expr import date_column, parse_date, strip
from pitchline.ml import evaluate as E
from pitchline.ml import models as M
from pitchline.operators import clean as C
from pitchline.operators import dataset as D
from pitchline.operators import order as O
from pitchline.operators import preprocess as P
from pitchline.plans import features as G
from pitchline.plans import ingest as I
from pitchline.schema import COUNTS
from pitchline.sources import files as S
from pitchline.sources.derived import matches

COLS = ["Date", "HomeTeam", "AwayTeam", "FTHG", "FTAG", "FTR", *COUNTS[2:]]
GOOD = [("2023-01-02", "Ars", "Che", "2", "1", "H"), ("2023-01-01", "Liv", "Ars", "0", "0", "D")]
D1 = "/root/testdata/sf0.001"


def test_dates_with_fractions_and_types(spark):
    rows = ["2024-01-01 10:00:00.5", "2024-01-01T10:00:00.123456", "2024-01-01", " 3/4/2024\t", "25/12/2023", "no", None, "2024-02-30"]
    df = spark.createDataFrame([(x,) for x in rows], "d string")
    got = [r[0] for r in df.select(parse_date("d")).collect()]
    assert got[:5] == [datetime(2024, 1, 1, 10, 0, 0, 500000), datetime(2024, 1, 1, 10, 0, 0, 123456), datetime(2024, 1, 1), datetime(2024, 3, 4), datetime(2023, 12, 25)]
    assert got[5:] == [None, None, None]
    typed = spark.sql("select timestamp_ntz'2024-01-01 10:00:00.5' as n, timestamp'2024-01-01 10:00:00.5' as t, date'2024-01-02' as d")
    assert tuple(typed.select(*[date_column(typed, c) for c in "ntd"]).first()) == (datetime(2024, 1, 1, 10, 0, 0, 500000),) * 2 + (datetime(2024, 1, 2),)
    assert spark.createDataFrame([("\t a b \n",)], "s string").select(strip("s")).first()[0] == "a b"
    kept = C.clean(spark.createDataFrame([(0, "2024-01-01 10:00:00.5", "A", "B", "1", "0", "H")], "match_seq long, Date string, HomeTeam string, AwayTeam string, FTHG string, FTAG string, FTR string"))
    assert kept.count() == 1


def write(path, *lines, end="\n"):
    path.write_bytes(end.join(x if isinstance(x, str) else x.decode("latin-1") for x in lines).encode("latin-1"))


def test_csv_as_written_by_others(spark, tmp_path):
    good = tmp_path / "a.csv"
    good.write_text('Date,HomeTeam,AwayTeam\n2023-01-01,"A ""x, y"" B",C\n2023-01-02,Short\n2023-01-03,"line\nbreak",NA\n2023-01-04,"com,ma","é"\n', encoding="utf-8")
    rows = S.load_csv(spark, f"file://{good}").orderBy("match_seq").collect()
    assert [(r.HomeTeam, r.AwayTeam) for r in rows] == [('A "x, y" B', "C"), ("Short", None), ("line\nbreak", None), ("com,ma", "é")]
    write(tmp_path / "b.csv", "Date,HomeTeam,AwayTeam", "2023-01-01,A,B,C,D", "2023-01-01,A,B")
    write(tmp_path / "c.csv", "Date,HomeTeam,AwayTeam", "2023-01-01,\xff\xfe,B")
    write(tmp_path / "d.csv", "")
    for name in "bcd":
        with pytest.raises(X.InvalidDatasetError):
            S.load_csv(spark, f"file://{tmp_path}/{name}.csv")
    paths = S.discover_csv(spark, f"file://{tmp_path}")
    assert len(paths) == 4 and S.load_matches(spark, paths).count() == 4
    with pytest.raises(X.DataProcessingError):
        S.load_matches(spark, paths[1:])


def settings(tmp_path):
    return I.Settings(*(f"file://{tmp_path}/{x}" for x in ("raw", "processed", "metadata", "reports")), logs=f"file://{tmp_path}/logs")


def one_json(folder, pattern="*.json"):
    return [json.loads(p.read_text()) for p in sorted(folder.glob(pattern))]


def test_ingest_skips_bad_files_and_counts(spark, tmp_path):
    raw, s = tmp_path / "raw", settings(tmp_path)
    raw.mkdir()
    s.ensure(spark)
    assert (tmp_path / "logs").is_dir() and (tmp_path / "processed").is_dir()
    write(raw / "a.csv", ",".join(COLS), *(",".join([*r, *["1"] * 10]) for r in GOOD))
    write(raw / "b.csv", ",".join(COLS), "1,2,3,4,5,6,7,8,9,10,11,12,13,14,15,16,17")
    paths = S.discover_csv(spark, s.raw)
    r = I.ingest(spark, paths, s, "2023")
    assert r.status == "ok" and r.steps["rows"] == {"in": 2, "out": 2} and (r.rows_removed, r.duplicate_rows, r.missing_values_fixed) == (0, 0, 0)
    assert len(r.warnings) == 1 and "b.csv" in r.warnings[0]
    meta = one_json(tmp_path / "metadata")[0]
    assert meta["league"] == {"league": "EPL", "league_name": "English Premier League", "season": "2023", "country": "England", "competition": "Premier League", "source": "Official Premier League", "data_provider": "Opta"}
    parts = sorted((tmp_path / "processed" / "epl_2023.csv").glob("part-*"))
    assert meta["checksum"] == hashlib.sha256(b"".join(p.read_bytes() for p in parts)).hexdigest()
    logged = "".join(p.read_text() for p in (tmp_path / "logs").glob("*.log"))
    assert r.execution_id in logged and "left out" in logged
    # any failure ends in a report that says so
    with pytest.raises(X.DataProcessingError):
        I.ingest(spark, paths[1:], s, "2024")
    assert [x["status"] for x in one_json(tmp_path / "reports", "epl_2024*")] == ["failed"]
    write(raw / "a.csv", ",".join(COLS[:-1]), *(",".join([*r, *["1"] * 9]) for r in GOOD))
    with pytest.raises(X.SchemaMismatchError):
        I.ingest(spark, paths[:1], s, "2025")
    assert one_json(tmp_path / "reports", "epl_2025*")[0]["error"].startswith("MissingColumnError")


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    import pitchline.session as session

    raw = tmp_path / "raw"
    raw.mkdir()
    write(raw / "a.csv", ",".join(COLS), *(",".join([*r, *["1"] * 10]) for r in GOOD))
    for k, v in (("DATA_PROCESSED_PATH", "processed"), ("DATA_METADATA_PATH", "metadata"), ("REPORT_PATH", "reports"), ("LOG_PATH", "logs")):
        monkeypatch.setenv(k, f"file://{tmp_path}/{v}")
    monkeypatch.setattr(session, "session", lambda: spark)
    assert I.main(["--raw", f"file://{raw}", "--season", "2020", "--league", "la_liga"]) == 0 and capsys.readouterr().out.startswith("ok")
    assert one_json(tmp_path / "metadata")[0]["league"]["league_name"] == "LaLiga"
    assert I.main(["--raw", f"file://{tmp_path}/none"]) == 1
    assert I.Settings.load({"DATA_RAW_PATH": "x", "RANDOM_SEED": "7"}, "/base").raw == "/base/x"
    assert I.resolve("s3://b/x", "/base") == "s3://b/x" and I.resolve("/abs", "/base") == "/abs"
    with pytest.raises(ValueError):
        I.league("NOPE")


def test_records_and_split_checks(spark):
    out = D.build_dataset([{"Date": "2023-01-01", "HomeTeam": "A", "AwayTeam": "B", "FTHG": 1, "FTAG": "0"}, {"Date": date(2023, 1, 2), "HomeTeam": "B", "AwayTeam": "A", "FTHG": 2, "FTAG": 2}], spark)
    assert [(r.match_seq, r.target_label) for r in out.orderBy("match_seq").collect()] == [(0, "HOME_WIN"), (1, "DRAW")]
    for bad in ([], "text", 5, [{}]):
        with pytest.raises(X.InvalidMatchError):
            D.build_dataset(bad, spark)
    df = matches(spark, D1).withColumn("Date", F.col("Date").cast("timestamp"))
    s = D.split_chronological(df, check=False).cache()
    assert D.verify_no_overlap(s) and D.verify_complete_coverage(s, df.count()) and D.verify_chronological(s)
    with pytest.raises(X.SplittingError):
        D.verify_complete_coverage(s, df.count() + 1)
    with pytest.raises(X.SplittingError):
        D.verify_no_overlap(s.unionByName(s.where("split = 'train'").limit(1).withColumn("split", F.lit("test"))))
    with pytest.raises(X.SplittingError):
        D.verify_chronological(s.withColumn("split", F.when(F.col("split") == "test", "train").otherwise("test")))
    text = D.summarize(s)
    assert text.counts["train"] == int(0.7 * df.count()) and "train" in text.describe() and "T" in text.to_dict()["dates"]["train"][0]
    r = D.split_random(df, 0.2, 0.1, "FTR")
    assert D.summarize(r.drop("Date"), target="FTR").to_dict()["dates"] == {} and "by FTR" in D.summarize(r, target="FTR").describe()
    with pytest.raises(X.SplittingError):
        D.split_random(df, 0.2, stratify="nope")


def test_order_over_slots(spark, monkeypatch):
    monkeypatch.setattr(O, "SLOT_ROWS", 20)
    rng = random.Random(2)
    rows = [(i, rng.choice([None, 1.5, rng.random() * 100, float("nan")])) for i in range(900)]
    df = spark.createDataFrame(rows, "k long, v double").repartition(5)
    got = {r.k: r.at for r in O.ranked(df, ["v", "k"], "at").collect()}
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] is not None and math.isnan(r[1]), r[1] if r[1] is not None and not math.isnan(r[1]) else 0, r[0]))
    assert got == {k: i for i, (k, _) in enumerate(want)}
    assert df.select(O.slot(df, "v").alias("s")).distinct().count() > 10
    s = spark.createDataFrame([(int(rng.random() < 0.4), round(rng.random(), 2)) for _ in range(700)], "label int, p double")
    pos, neg = [r.p for r in s.collect() if r.label], [r.p for r in s.collect() if not r.label]
    brute = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert E.roc_auc(s, "label", "p").first().auc == pytest.approx(brute)
    f = E.folds(spark.range(1003).selectExpr("id as match_seq", "cast(id % 3 = 0 as int) as label"), 5, "label")
    sizes = [r["count"] for r in f.groupBy("label", "fold").count().collect()]
    assert len(sizes) == 10 and all(max(x) - min(x) <= 1 for x in ([r["count"] for r in f.where(F.col("label") == y).groupBy("fold").count().collect()] for y in (0, 1)))
    assert C.row_numbers(df.select("v"), ["v"]).agg(F.min("match_seq"), F.max("match_seq"), F.count_distinct("match_seq")).first()[:] == (1, 900, 900)


def test_quantiles_are_exact(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, float("nan"), 3.0, rng.random()]), float(rng.randint(0, 5)), None) for _ in range(1001)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(4)
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {(r.feature, r.share): r.value for r in O.quantiles(df, {c: F.col(c) for c in "abc"}, shares).collect()}
    want = df.select(*[F.percentile(F.when(~F.isnan(c), F.col(c)), shares).alias(c) for c in "ab"]).first()
    assert got == {(c, s): pytest.approx(v) for c in "ab" for s, v in zip(shares, want[c])}
    assert P.imputation(df, ["a", "c"], [], "median", constant=7.0) == {"a": pytest.approx(want.a[3]), "c": 7.0}


def test_preprocess_interfaces(spark):
    df = spark.createDataFrame([(0, 1.0, "b"), (1, 2.0, "a")], "match_seq long, v double, c string")
    assert P.prepare_features(df, ["c", "none"]).columns == ["match_seq", "v"] and P.prepare_labels(df, "c").columns == ["match_seq", "c"]
    with pytest.raises(X.DataProcessingError):
        P.prepare_labels(df, "none")
    with pytest.raises(X.PreprocessingError):
        P.categories(df, ["c"], most=1)
    meta = P.Preprocessing().fit(df).metadata(df)
    assert meta["features"]["c"] == {"fill": "a", "encoding": "label"} and meta["columns_out"] == 3 and meta["features"]["v"]["scale"] == {"shift": 1.5, "divisor": 0.5}


def test_models_are_kept_and_found_again(spark, tmp_path):
    rng = random.Random(1)
    df = spark.createDataFrame([(i, float(y) + rng.random(), y) for i, y in enumerate([0, 1, 2] * 30)], "match_seq long, x double, label int")
    t, where = M.train(df, ["x"]), f"file://{tmp_path}/models"
    with pytest.raises(X.ModelLoadError):
        M.load_best(where)
    first = M.persist_best(t, where, {"note": 1})
    assert M.load_best(where).features == ["x"] and M.load(first).train_rows == 90
    one, p = df.where("match_seq = 2"), M.MatchPredictor(where)
    outcome, confidence, meta = p.predict_one(one)
    assert sum(outcome.values()) == pytest.approx(1) and confidence == max(outcome.values()) and meta.milliseconds > 0 and meta.to_dict()["model"] == "logistic_regression"
    assert p.predict(df).count() == 90 and max(outcome, key=outcome.get) == "home_win"
    for bad in (df.limit(0), df.drop("x")):
        with pytest.raises(X.FeatureMismatchError):
            p.predict(bad)
    import shutil

    shutil.rmtree(tmp_path / "models" / M.BEST)
    assert M.load_best(where).algorithm == "logistic_regression"  # the newest, without a best one
    binary = M.outcome_probabilities(M.predict(M.train(df.where("label < 2"), ["x"]), one), ["AWAY_WIN", "DRAW", "HOME_WIN"]).first()
    assert binary.home_win == 0.0
    meta = E.EvaluationMetadata("m", "d", 90, "KFold")
    E.export_json(spark, {"f1": 0.5}, meta, f"file://{tmp_path}/e.json")
    assert S.load_json(spark, f"file://{tmp_path}/e.json")["metadata"]["split"] == "KFold"
    for _ in range(2):
        E.export_csv(spark, {"f1": 0.5, "matrix": [[1]]}, meta, f"file://{tmp_path}/e.csv")
    rows = spark.read.option("header", True).csv(f"file://{tmp_path}/e.csv")
    assert rows.count() == 2 and rows.first().f1 == "0.5" and "matrix" not in rows.columns


def test_generators_share_a_pass(spark):
    m = matches(spark, D1)
    together = G.run_features(m).orderBy("match_seq").collect()
    for g in G.REGISTRY.instances():
        alone = g.generate(m).orderBy("match_seq").collect()
        cols = [c for c in alone[0].asDict() if c != "match_seq"]
        assert [[r[c] for c in cols] for r in alone] == [[r[f"{g.name}::{c}"] for c in cols] for r in together]
    with pytest.warns(UserWarning, match="left out"):
        some = G.run_features(m.drop("FTR"))
    assert "head_to_head::h2h_draws" in some.columns and "recent_form::home_wins_last5" not in some.columns
    with pytest.raises(X.FeatureError):
        G.run_features(m, [G.GoalDifference(), G.GoalDifference()], prefix=False)
    for period in ("year", "day"):
        assert G.run_features(m, period=period).orderBy("match_seq").collect() == together
    wide = G.run_features(m, [G.GoalDifference({"window": 3}), G.RecentForm()]).drop("Date")
    assert wide.count() == m.count()


def test_metadata_of_runs(spark):
    m = matches(spark, D1)
    rows = {r["name"]: r for r in G.describe(matches=m)}
    assert len(rows) == 6 and rows["rest_days"]["columns"][0] == "home_rest_days" and rows["recent_form"]["window"] == 5
    new = G.Registry()
    assert sorted(new.discover(G)) == sorted(rows) and new.discover(G) == []
    df = spark.createDataFrame([(i, i % 2, i % 2, 0.2 + 0.6 * (i % 2), float(i % 2)) for i in range(40)], "match_seq long, label int, prediction int, p double, x double")
    found, meta = E.evaluate_predictions(df, "m", "d", score="p", version="3")
    assert found["accuracy"] == 1.0 and (meta.rows, meta.version, meta.to_dict()["model"]) == (40, "3", "m")
    df = df.drop("prediction")
    best, ranking, _ = M.select(df, df, ["x"], algorithms=["decision_tree"])
    assert M.selection_metadata(best, ranking).to_dict()["best"] == "decision_tree"
    for bad in (lambda: M.select(df, df, ["x"], algorithms=["none"]), lambda: M.select(df, df, ["x"], algorithms=[]), lambda: M.select(df, df.limit(0), ["x"]), lambda: M.train(df.withColumn("label", F.lit(None).cast("int")), ["x"]), lambda: M.train(df.limit(0), ["x"])):
        with pytest.raises(X.EvaluationError):
            bad()
    with pytest.raises(X.FeatureMismatchError):
        M.select(df, df.drop("x"), ["x"])


def test_streaming_form_equals_the_batch(spark, tmp_path):
    from pitchline.operators.history import FACTS, team_view, with_running
    from pitchline.streaming.form import running_form

    m = matches(spark, D1).orderBy("Date", "match_seq").limit(200).coalesce(1)
    m.write.parquet(str(tmp_path / "in"))
    q = running_form(spark.readStream.schema(m.schema).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName("form2").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    cols = ["match_seq", "is_home", "team", "matches", "points", "goals_for", "goals_against"]
    batch = with_running(team_view(spark.read.parquet(str(tmp_path / "in"))), ["team"], FACTS, 5, "_").select("match_seq", "is_home", "team", *[F.col(f"_{c}").alias(c) for c in cols[3:]])
    key = lambda rows: sorted(map(tuple, rows))
    assert key(spark.sql(f"select {', '.join(cols)} from form2").collect()) == key(batch.collect())
