import pytest
from pyspark.sql import functions as F

from pitchline import errors as X
from pitchline.ml import evaluate as E
from pitchline.operators import clean as C
from pitchline.operators import dataset as D
from pitchline.operators import preprocess as P
from pitchline.operators import profile as Q
from pitchline.operators import validate as V
from pitchline.schema import COUNTS, MATCHES, Field

COLS = ["match_seq", "Date", "HomeTeam", "AwayTeam", "FTHG", "FTAG", "FTR", *COUNTS[2:]]
TEXT = "match_seq long, " + ", ".join(f"{c} string" for c in COLS[1:])


def raw(spark, *rows):
    fill = ["1"] * 10
    return spark.createDataFrame([(i, *r, *fill) for i, r in enumerate(rows)], TEXT)


GOOD = [("2023-01-02", "Ars", "Che", "2", "1", "H"), ("2023-01-01", "Liv", "Ars", "0", "0", "D")]


def test_schema_is_immutable():
    assert MATCHES.required[0] == "Date" and len(MATCHES.required) == 16 and len(MATCHES.numeric) == 12
    more = MATCHES.with_column(Field("xG", "float", "numeric", False))
    assert "xG" in more.optional and "xG" not in MATCHES.kinds()
    with pytest.raises(KeyError):
        MATCHES.kind("xG")


def test_clean(spark):
    df = raw(spark, ("2023-01-02", "  Ars\t", "Che", "2.9", "x", "H"), ("2023-01-02", "  Ars\t", "Che", "2.9", "x", "H"), (None, "A", "B", "1", "1", "D"), ("15/03/2023", "A", None, "1", "1", "D"), ("01/02/2023", "A", "B", None, "1", None))
    rows = C.chronological(C.clean(df)).collect()
    assert [(r.match_seq, r.HomeTeam, r.FTHG, r.FTAG, r.FTR) for r in rows] == [(0, "Ars", 2, 0, "H"), (4, "A", 0, 1, "Unknown")]
    assert rows[1].Date.month == 1
    assert C.apply_aliases(df, {"B": "Beta"}).where("AwayTeam = 'Beta'").count() == 2


def test_validate(spark):
    assert V.validate(raw(spark, *GOOD)).ok
    with pytest.raises(X.SchemaMismatchError):
        V.validate(raw(spark, *GOOD).drop("FTR"))
    for bad, error in ((GOOD[0], X.ValidationFailed), (("no", "A", "B", "1", "1", "D"), X.InvalidDateError), (("2023-01-01", "A", "B", "2.5", "1", "D"), X.InvalidScoreError), (("2023-01-01", "A", "B", "-1", "1", "D"), X.InvalidScoreError), (("2023-01-01", "A#", "B", "1", "1", "D"), X.ValidationFailed), ((None, "A", "B", "1", "1", "D"), X.ValidationFailed)):
        with pytest.raises(error):
            V.validate(raw(spark, *GOOD, bad))


def test_contracts(spark):
    V.check_contracts(raw(spark, *GOOD))
    for bad, error in ((("2099-01-01", "A", "B", "1", "1", "D"), X.InvalidDateError), (("2023-01-01", "A", "B", "1", "1", "H"), X.InvalidScoreError), (("2023-01-01", "A", "B", "-1", "1", "A"), X.InvalidScoreError), (("2023-01-02", "Ars", "Che", "0", "1", "A"), X.DuplicateMatchError)):
        with pytest.raises(error):
            V.check_contracts(raw(spark, *GOOD, bad))


def test_profile(spark):
    df = spark.createDataFrame([(i, 1.0, float(i) if i else None, float("inf") if i == 3 else 0.5 * i, i % 2) for i in range(4)], "match_seq long, a double, b double, c double, y int")
    r = Q.profile(df, "y", near=0.5)
    assert r.constant == ["a"] and r.missing == {"b": 1} and r.infinite == {"c": 1} and not r.is_valid
    d = {x.feature: x for x in Q.describe(df).collect()}
    assert d["b"].q50 == 2.0 and d["b"].missing == 1
    assert Q.duplicate_columns(df.withColumn("z", F.col("b"))) == [["b", "z"]]
    assert Q.correlations(df, ["a", "b"]).first().corr is None
    one = spark.createDataFrame([(i, float(i), int(i == 0)) for i in range(10)], "match_seq long, a double, y int")
    assert Q.profile(one, "y").is_valid and Q.profile(one, "y").warnings


def test_dataset_and_splits(spark):
    df = raw(spark, *GOOD, ("2023-01-03", "A", "B", "0", "1", "A"))
    assert sorted(r.target_label for r in D.build_dataset(df).collect()) == ["AWAY_WIN", "DRAW", "HOME_WIN"]
    assert sorted(r.target_label for r in D.build_dataset(df.drop("FTR")).collect()) == ["AWAY_WIN", "DRAW", "HOME_WIN"]
    with pytest.raises(X.DuplicateMatchError):
        D.build_dataset(raw(spark, GOOD[0], GOOD[0]))
    with pytest.raises(X.InvalidMatchError):
        D.build_dataset(raw(spark, ("2023-01-02", "Ars", "Che", "2", "1", "Q")))
    with pytest.raises(X.InvalidMatchError):
        D.build_dataset(df.limit(0))
    many = spark.range(100).selectExpr("id as match_seq", "timestamp_ntz'2023-01-01' + make_dt_interval(cast(id / 3 as int)) as Date", "'A' as HomeTeam", "cast(id as string) as AwayTeam", "if(id % 4 = 0, 'x', 'y') as c")
    s = D.split_chronological(many)
    assert {r.split: r.n for r in D.split_metadata(s).collect()} == {"train": 70, "validation": 15, "test": 15}
    assert [r.match_seq for r in s.orderBy("position").collect()] == list(range(100))
    for strata in (None, "c"):
        n = {(r.split): r["count"] for r in D.split_random(many, 0.2, 0.12, strata).groupBy("split").count().collect()}
        assert n == {"train": 68, "validation": 12, "test": 20}
    with pytest.raises(X.SplittingError):
        D.SplitConfig(0.5, 0.1, 0.1)
    with pytest.raises(X.SplittingError):
        D.split_chronological(many.limit(2))


def test_preprocess(spark):
    df = spark.createDataFrame([(0, 1.0, "b", "x1"), (1, None, "a", "x2"), (2, 3.0, None, "x3"), (3, float("nan"), "a", "x4")], "match_seq long, v double, c string, k string")
    m = P.Preprocessing(auto_limit=3).fit(df)
    assert m.fills["v"] == 2.0 and m.fills["c"] == "a" and m.labels == {"c": ["a", "b"]}
    out = {r.match_seq: r for r in m.transform(df).collect()}
    assert out[0].c == 1 and out[1].v == 0.0 and out[2]["k_x3"] == 1
    assert P.label_encode(df.withColumn("c", F.lit("new")), m.labels).first().c == -1
    with pytest.raises(Exception):
        m.transform(df.withColumn("c", F.lit("new"))).collect()
    assert P.scaling(df.withColumn("v", F.lit(2.0)), ["v"], "minmax") == {"v": (2.0, 1.0)}


def test_evaluate(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (0, 1, 0.6), (1, 0, 0.4), (0, 0, 0.1)], "label int, prediction int, p double")
    r = E.evaluate(df, score="p")
    assert (r["accuracy"], r["f1"], r["roc_auc"]) == (0.5, 0.5, 0.75)
    assert E.metrics(df.limit(0)).first().f1 == 0.0
    with pytest.raises(X.EvaluationError):
        E.evaluate(df.withColumn("label", F.lit(2)))
    assert E.rank({"a": {"f1": 0.1}, "b": {"f1": 0.3}})[0][0] == "b"


def test_ingest(spark, tmp_path):
    from pitchline.plans.ingest import Settings, ingest
    from pitchline.sources import files as S

    raw_dir = tmp_path / "raw"
    raw_dir.mkdir()
    lines = [",".join(COLS[1:]), *(",".join([*r, *["1"] * 10]) for r in GOOD)]
    (raw_dir / "a.csv").write_text("\n".join(lines))
    s = Settings(*(f"file://{tmp_path}/{x}" for x in ("raw", "processed", "metadata", "reports")), logs=f"file://{tmp_path}/logs")
    paths = S.discover_csv(spark, s.raw)
    assert ingest(spark, paths, s, "2023").status == "ok"
    assert ingest(spark, paths, s, "2023").steps["rows"] == {"in": 2, "out": 2}
    assert sorted(p.name for p in (tmp_path / "metadata").glob("*.json")) == ["epl_2023_v1.json", "epl_2023_v2.json"]
    (raw_dir / "a.csv").write_text("\n".join([*lines, lines[1]]))
    with pytest.raises(X.PitchlineError):
        ingest(spark, paths, s, "2024")
    assert not (tmp_path / "processed" / "epl_2024.csv").exists()
    with pytest.raises(X.DatasetNotFoundError):
        S.discover_csv(spark, f"file://{tmp_path}/none")


def test_streaming_form(spark, tmp_path):
    from pitchline.sources.derived import matches
    from pitchline.streaming.form import running_form

    m = matches(spark, "/root/testdata/sf0.001").limit(200)
    m.write.parquet(str(tmp_path / "in"))
    out = running_form(spark.readStream.schema(m.schema).parquet(str(tmp_path / "in")))
    q = out.writeStream.format("memory").queryName("form").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("select * from form").count() == 400


def test_registered_queries_match_sql(spark):
    import duckdb

    import __spark_entry__ as entry

    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("orders", "customer", "labels"):
        con.execute(f"create view {t} as select * from '{d}/{t}.parquet'")
    from pitchline.queries import QUERIES, SQL

    assert set(QUERIES) <= set(entry.queries()) and entry.entry(spark).count() > 0
    for name in ("feat_goal_difference", "feat_head_to_head", "feat_rest_days", "clean_full", "eval_auc"):
        got = QUERIES[name](spark, d)
        r = con.execute(SQL[name])
        cols = [c[0] for c in r.description]
        assert sorted(got.columns) == sorted(cols)
        rows = lambda xs: sorted([tuple(round(v, 6) if isinstance(v, float) else v for v in x) for x in xs], key=str)
        assert rows(got.select(*[f"`{c}`" for c in cols]).collect()) == rows(r.fetchall())


def test_registered_selection_trains_every_model(spark, monkeypatch):
    from pitchline.ml import models as M
    from pitchline.queries import QUERIES

    seen, select = [], M.select
    monkeypatch.setattr(M, "select", lambda *a, **b: seen.append(select(*a, **b)) or seen[-1])
    rows = QUERIES["ml_select_predict"](spark, "/root/testdata/sf0.001")
    best, ranking, results = seen[0]
    assert set(results) == set(M.REGISTRY) and {r[0] for r in ranking} == set(M.REGISTRY)
    assert best.algorithm == ranking[0][0] and [r.model for r in rows.select("model").distinct().collect()] == [best.algorithm]


def test_registered_lookup_without_limit_matches_sql(spark):
    import duckdb

    from pitchline.queries import QUERIES, SQL

    d = "/root/testdata/sf0.1"
    con = duckdb.connect()
    for t in ("orders", "customer"):
        con.execute(f"create view {t} as select * from '{d}/{t}.parquet'")
    want = [r[0] for r in con.execute(SQL["hist_get_matches_all"]).fetchall()]
    got = [r.match_seq for r in QUERIES["hist_get_matches_all"](spark, d).collect()]
    assert got == want and len(got) > 200
    assert [r.match_seq for r in QUERIES["hist_get_matches"](spark, d).collect()] == got[:200]
