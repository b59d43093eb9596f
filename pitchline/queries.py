"""The registered queries over the driver's tables, each with the SQL that must give the same rows."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from .ml import evaluate as E
from .operators import clean as C
from .operators import dataset as D
from .operators import history as H
from .operators import preprocess as P
from .operators import profile as Q
from .operators import validate as V
from .plans import features as G
from .schema import COUNTS, SEQ
from .sources.derived import dirty_matches, matches, unique_matches

QUERIES: dict = {}
SQL: dict = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


# ---------------------------------------------------------------- SQL pieces
_M = """m AS (SELECT *, CASE WHEN "FTHG" > "FTAG" THEN 'H' WHEN "FTHG" < "FTAG" THEN 'A' ELSE 'D' END AS "FTR" FROM (
  SELECT o_orderkey AS match_seq, o_orderdate AS "Date", 'TEAM_' || c_nationkey AS "HomeTeam", 'TEAM_' || ((c_nationkey + 1 + o_orderkey % 24) % 25) AS "AwayTeam",
         CAST(floor(o_totalprice) AS BIGINT) % 5 AS "FTHG", o_custkey % 4 AS "FTAG" FROM orders JOIN customer ON o_custkey = c_custkey))"""
_U = _M + """, u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "Date", "HomeTeam", "AwayTeam" ORDER BY match_seq) AS rn FROM m) WHERE rn = 1)"""
_L = _M + """, l AS (
  SELECT match_seq, "Date", "HomeTeam" AS team, TRUE AS is_home, "FTHG" AS gf, "FTAG" AS ga, CASE "FTR" WHEN 'H' THEN 3 WHEN 'D' THEN 1 ELSE 0 END AS p FROM m
  UNION ALL SELECT match_seq, "Date", "AwayTeam", FALSE, "FTAG", "FTHG", CASE "FTR" WHEN 'A' THEN 3 WHEN 'D' THEN 1 ELSE 0 END FROM m)"""
_SUMS = """count(p) AS n, coalesce(sum((p = 3)::INT), 0) AS w, coalesce(sum((p = 1)::INT), 0) AS d, coalesce(sum((p = 0)::INT), 0) AS lo, coalesce(sum(gf), 0) AS gf, coalesce(sum(ga), 0) AS ga,
  coalesce(sum(p), 0) AS p, coalesce(sum((ga = 0)::INT), 0) AS cs, coalesce(sum((gf = 0)::INT), 0) AS fs"""


def _strict(venue: bool = False, limit: int = 5) -> str:
    same = "AND h.is_home = x.is_home" if venue else ""
    return f"""{_L}, past AS (
  SELECT x.match_seq, x.is_home, h.gf, h.ga, h.p, row_number() OVER (PARTITION BY x.match_seq, x.is_home ORDER BY h."Date" DESC, h.match_seq DESC) AS rn
  FROM l x JOIN l h ON h.team = x.team AND h."Date" < x."Date" {same}),
s AS (SELECT x.match_seq, x.is_home, {_SUMS.replace('(p', '(past.p').replace('(gf', '(past.gf').replace('(ga', '(past.ga')}
  FROM l x LEFT JOIN past ON past.match_seq = x.match_seq AND past.is_home = x.is_home AND past.rn <= {limit} GROUP BY x.match_seq, x.is_home)"""


_R = lambda x, n="n": f"CASE WHEN {n} > 0 THEN {x}::DOUBLE / {n} ELSE 0 END"
_RATE = {"goals_per_match": _R("gf"), "goals_against_per_match": _R("ga"), "points_per_match": _R("p"), "win_rate": _R("w"), "draw_rate": _R("d"), "loss_rate": _R("lo"), "clean_sheet_rate": _R("cs"), "failed_to_score_rate": _R("fs")}


def _sides(cols: dict[str, str], name=lambda side, c: f"{side}_{c}") -> str:
    return ", ".join(f'max(CASE WHEN is_home = {h} THEN {x} END) AS "{name(side, c)}"' for c, x in cols.items() for side, h in (("home", "TRUE"), ("away", "FALSE")))


def _both(base: str, cols: dict[str, str], name=lambda side, c: f"{side}_{c}") -> str:
    return f"WITH {base} SELECT match_seq, {_sides(cols, name)} FROM s GROUP BY match_seq"


_GD = {"goals_for": "gf::DOUBLE", "goals_against": "ga::DOUBLE", "goal_difference": "(gf - ga)::DOUBLE", "average_goal_difference": _R("(gf - ga)")}
_FRAME = 'OVER (PARTITION BY team ORDER BY "Date", match_seq ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)'
_RUN = f"""{_L}, s AS (SELECT match_seq, is_home, count(*) {_FRAME} AS n, coalesce(sum(p) {_FRAME}, 0) AS p, coalesce(sum((p = 3)::INT) {_FRAME}, 0) AS w, coalesce(sum((p = 1)::INT) {_FRAME}, 0) AS d,
  coalesce(sum((p = 0)::INT) {_FRAME}, 0) AS lo, coalesce(sum(gf) {_FRAME}, 0) AS gf, coalesce(sum(ga) {_FRAME}, 0) AS ga, coalesce(sum((ga = 0)::INT) {_FRAME}, 0) AS cs FROM l)"""
_FORM = {"form_points_last5": "p::DOUBLE", "wins_last5": "w::DOUBLE", "draws_last5": "d::DOUBLE", "losses_last5": "lo::DOUBLE", "goals_scored_last5": "gf::DOUBLE", "goals_conceded_last5": "ga::DOUBLE", "goal_difference_last5": "(gf - ga)::DOUBLE", "points_per_match": _R("p")}
_ROLL = {"Team Form": "p::DOUBLE", "Goals Average": _R("gf"), "Goals Conceded Average": _R("ga"), "Win Percentage": _R("w"), "Clean Sheet Percentage": _R("cs"), "Goal Difference": _R("(gf - ga)")}
_H2H = f"""{_M}, past AS (
  SELECT x.match_seq, CASE WHEN h."HomeTeam" = x."HomeTeam" THEN h."FTHG" ELSE h."FTAG" END AS hg, CASE WHEN h."HomeTeam" = x."HomeTeam" THEN h."FTAG" ELSE h."FTHG" END AS ag,
         row_number() OVER (PARTITION BY x.match_seq ORDER BY h."Date" DESC, h.match_seq DESC) AS rn
  FROM m x JOIN m h ON least(h."HomeTeam", h."AwayTeam") = least(x."HomeTeam", x."AwayTeam") AND greatest(h."HomeTeam", h."AwayTeam") = greatest(x."HomeTeam", x."AwayTeam") AND h."Date" < x."Date"),
s AS (SELECT m.match_seq, count(hg) AS n, coalesce(sum((hg > ag)::INT), 0) AS w, coalesce(sum((hg < ag)::INT), 0) AS l, coalesce(sum((hg = ag)::INT), 0) AS d, coalesce(sum(hg), 0) AS hg, coalesce(sum(ag), 0) AS ag
  FROM m LEFT JOIN past ON past.match_seq = m.match_seq AND rn <= 5 GROUP BY m.match_seq)"""
_H2H_COLS = f"""w::DOUBLE AS home_h2h_wins, l::DOUBLE AS away_h2h_wins, d::DOUBLE AS h2h_draws, {_R("w")} AS home_h2h_win_rate, {_R("l")} AS away_h2h_win_rate, {_R("d")} AS h2h_draw_rate,
  hg::DOUBLE AS home_h2h_goals, ag::DOUBLE AS away_h2h_goals, {_R("(hg + ag)")} AS h2h_average_goals, (hg - ag)::DOUBLE AS recent_h2h_goal_difference, n::DOUBLE AS h2h_matches_played"""
_REST = f"""{_L}, days AS (SELECT team, "Date", coalesce(date_sub('day', lag("Date") OVER (PARTITION BY team ORDER BY "Date"), "Date"), 0)::DOUBLE AS r FROM (SELECT DISTINCT team, "Date" FROM l)),
s AS (SELECT match_seq, is_home, r FROM l JOIN days USING (team, "Date")),
b AS (SELECT match_seq, max(CASE WHEN is_home THEN r END) AS h, max(CASE WHEN NOT is_home THEN r END) AS a FROM s GROUP BY match_seq)"""
_REST_COLS = """h AS home_rest_days, a AS away_rest_days, h - a AS rest_day_difference, (h > 0 AND h <= 4)::INT::DOUBLE AS home_congested_schedule, (a > 0 AND a <= 4)::INT::DOUBLE AS away_congested_schedule,
  (h >= 14 OR a >= 14)::INT::DOUBLE AS long_break_flag"""


# ---------------------------------------------------------------- features
def _feature(name: str, sql: str):
    query(f"feat_{name}", sql)(lambda spark, d: G.REGISTRY.get(name)().generate(matches(spark, d)))


_PLAIN = {
    "goal_difference": _both(_strict(), _GD),
    "team_performance": _both(_strict(), _RATE),
    "home_advantage": _both(_strict(True), _RATE, lambda side, c: f"{side}_{side}_{c}"),
    "head_to_head": f"WITH {_H2H} SELECT match_seq, {_H2H_COLS} FROM s",
    "rest_days": f"WITH {_REST} SELECT match_seq, {_REST_COLS} FROM b",
    "recent_form": _both(_RUN, _FORM),
}
for _n, _s in _PLAIN.items():
    _feature(_n, _s)
query("feat_rolling_stats", _both(_RUN, _ROLL, lambda side, c: f"{side.title()} {c}"))(lambda spark, d: G.rolling_statistics(matches(spark, d)))


@query("feat_all_prefixed", None)
def _all(spark, d):
    return G.run_features(matches(spark, d)).drop("Date", "HomeTeam", "AwayTeam", "FTHG", "FTAG", "FTR")


def _prefixed_sql() -> str:
    """All generators joined; names are those of their own SQL."""
    names = {"goal_difference": [f"{s}_{c}" for c in _GD for s in ("home", "away")], "team_performance": [f"{s}_{c}" for c in _RATE for s in ("home", "away")], "home_advantage": [f"{s}_{s}_{c}" for c in _RATE for s in ("home", "away")], "recent_form": [f"{s}_{c}" for c in _FORM for s in ("home", "away")]}
    names |= {"head_to_head": re.findall(r" AS (\w+)", _H2H_COLS), "rest_days": re.findall(r" AS (\w+)", _REST_COLS)}
    order = sorted(names)
    cols = ", ".join(f'{g}."{c}" AS "{g}::{c}"' for g in order for c in names[g])
    first, *rest = order
    return f"SELECT {first}.match_seq, {cols} FROM ({_PLAIN[first]}) {first} " + " ".join(f"JOIN ({_PLAIN[g]}) {g} ON {g}.match_seq = {first}.match_seq" for g in rest)


SQL["feat_all_prefixed"] = _prefixed_sql()

_STATS_SQL = f"""n::DOUBLE AS matches, n::DOUBLE AS matches_played, w::DOUBLE AS wins, d::DOUBLE AS draws, lo::DOUBLE AS losses, gf::DOUBLE AS goals_for, ga::DOUBLE AS goals_against,
  (gf - ga)::DOUBLE AS goal_difference, p::DOUBLE AS points, cs::DOUBLE AS clean_sheets, fs::DOUBLE AS failed_to_score, {", ".join(f"{x} AS {c}" for c, x in _RATE.items())}"""
query("hist_team_stats")(lambda spark, d: H.team_statistics(matches(spark, d)))
SQL["hist_team_stats"] = f"WITH {_strict()}, t AS (SELECT match_seq, is_home, team FROM l) SELECT match_seq, is_home, team, {_STATS_SQL} FROM s JOIN t USING (match_seq, is_home)"
query("hist_team_stats_home_venue", f"""WITH {_L}, past AS (
  SELECT x.match_seq, x.is_home, h.gf, h.ga, h.p, row_number() OVER (PARTITION BY x.match_seq, x.is_home ORDER BY h."Date" DESC, h.match_seq DESC) AS rn
  FROM l x JOIN l h ON h.team = x.team AND h."Date" < x."Date" AND h.is_home),
s AS (SELECT x.match_seq, x.is_home, x.team, {_SUMS.replace('(p', '(past.p').replace('(gf', '(past.gf').replace('(ga', '(past.ga')}
  FROM l x LEFT JOIN past ON past.match_seq = x.match_seq AND past.is_home = x.is_home AND past.rn <= 3 GROUP BY x.match_seq, x.is_home, x.team)
SELECT match_seq, is_home, team, {_STATS_SQL} FROM s""")(lambda spark, d: H.team_statistics(matches(spark, d), 3, "home"))
query("hist_team_stats_unlimited", f"""WITH {_L}, s AS (SELECT x.match_seq, x.is_home, x.team, {_SUMS.replace('(p', '(h.p').replace('(gf', '(h.gf').replace('(ga', '(h.ga')}
  FROM l x LEFT JOIN l h ON h.team = x.team AND h."Date" < x."Date" GROUP BY x.match_seq, x.is_home, x.team)
SELECT match_seq, is_home, team, {_STATS_SQL} FROM s""")(lambda spark, d: H.team_statistics(matches(spark, d), None))
query("hist_h2h_stats", f"WITH {_H2H} SELECT match_seq, n AS matches, w AS home_wins, l AS away_wins, d AS draws, hg AS home_goals, ag AS away_goals FROM s")(lambda spark, d: H.pair_statistics(matches(spark, d)))

# ---------------------------------------------------------------- look-ups
_ROW = 'match_seq, "Date", "HomeTeam", "AwayTeam", "FTHG", "FTAG", "FTR"'
_OF = lambda t: f"(\"HomeTeam\" = '{t}' OR \"AwayTeam\" = '{t}')"
_DAY, _NEW = "1998-01-01", 'ORDER BY "Date" DESC, match_seq DESC'
query("hist_get_matches", f"""WITH {_M} SELECT {_ROW} FROM m WHERE {_OF("TEAM_3")} AND "Date" >= TIMESTAMP '1996-01-01' AND "Date" <= TIMESTAMP '1997-12-31' AND "Date" < TIMESTAMP '1997-06-01' ORDER BY "Date", match_seq LIMIT 200""")(
    lambda spark, d: H.get_matches(matches(spark, d), team="TEAM_3", start="1996-01-01", end="1997-12-31", before="1997-06-01", limit=200, league="none")
)
query("hist_get_matches_all", f"""WITH {_M} SELECT {_ROW} FROM m WHERE {_OF("TEAM_3")} AND "Date" >= TIMESTAMP '1996-01-01' AND "Date" <= TIMESTAMP '1997-12-31' AND "Date" < TIMESTAMP '1997-06-01' ORDER BY "Date", match_seq""")(
    lambda spark, d: H.get_matches(matches(spark, d), team="TEAM_3", start="1996-01-01", end="1997-12-31", before="1997-06-01", league="none")
)
query("hist_matches_on_date", f"""WITH {_M} SELECT {_ROW} FROM m WHERE "Date" = TIMESTAMP '1996-01-02'""")(lambda spark, d: H.get_matches(matches(spark, d), date="1996-01-02", before="1990-01-01"))
for _v, _w in (("matches", _OF("TEAM_7")), ("home", "\"HomeTeam\" = 'TEAM_7'"), ("away", "\"AwayTeam\" = 'TEAM_7'")):
    query(f"hist_last_{_v}", f"WITH {_M} SELECT {_ROW} FROM m WHERE {_w} AND \"Date\" < TIMESTAMP '{_DAY}' {_NEW} LIMIT 5")(
        lambda spark, d, v=_v: H.last_matches(matches(spark, d), "TEAM_7", _DAY, 5, "overall" if v == "matches" else v)
    )
_THERE, _BACK = "(\"HomeTeam\" = 'TEAM_1' AND \"AwayTeam\" = 'TEAM_2')", "(\"HomeTeam\" = 'TEAM_2' AND \"AwayTeam\" = 'TEAM_1')"
for _v, _w in (("overall", f"({_THERE} OR {_BACK})"), ("home_only", _THERE), ("away_only", _BACK)):
    query(f"hist_h2h_{_v}", f"WITH {_M} SELECT {_ROW} FROM m WHERE {_w} AND \"Date\" < TIMESTAMP '{_DAY}' {_NEW} LIMIT 10")(
        lambda spark, d, v=_v: H.meetings(matches(spark, d), "TEAM_1", "TEAM_2", _DAY, 10, v)
    )
query("hist_team_stats_at", f"WITH {_L}, s AS (SELECT {_SUMS} FROM l WHERE team = 'TEAM_4' AND \"Date\" < TIMESTAMP '{_DAY}') SELECT {_STATS_SQL} FROM s")(lambda spark, d: H.team_statistics_at(matches(spark, d), "TEAM_4", _DAY))
query("hist_h2h_stats_at", f"""WITH {_M}, x AS (SELECT CASE WHEN "HomeTeam" = 'TEAM_1' THEN "FTHG" ELSE "FTAG" END AS a, CASE WHEN "HomeTeam" = 'TEAM_1' THEN "FTAG" ELSE "FTHG" END AS b FROM m WHERE ({_THERE} OR {_BACK}) AND "Date" < TIMESTAMP '{_DAY}')
SELECT count(*)::DOUBLE AS matches, coalesce(sum((a > b)::INT), 0)::DOUBLE AS home_wins, coalesce(sum((a < b)::INT), 0)::DOUBLE AS away_wins, coalesce(sum((a = b)::INT), 0)::DOUBLE AS draws, coalesce(sum(a), 0)::DOUBLE AS home_goals, coalesce(sum(b), 0)::DOUBLE AS away_goals,
  CASE WHEN count(*) > 0 THEN (sum(a) + sum(b))::DOUBLE / count(*) ELSE 0 END AS average_goals, (coalesce(sum(a), 0) - coalesce(sum(b), 0))::DOUBLE AS goal_difference FROM x""")(lambda spark, d: H.pair_statistics_at(matches(spark, d), "TEAM_1", "TEAM_2", _DAY))

# ---------------------------------------------------------------- cleaning
_REST_COUNTS = COUNTS[2:]
_DIRTY = f"""{_M}, d0 AS (SELECT match_seq, CASE WHEN match_seq % 53 <> 0 THEN strftime("Date", '%Y-%m-%d') END AS "Date", CASE WHEN match_seq % 7 = 0 THEN '  ' || "HomeTeam" || ' ' ELSE "HomeTeam" END AS "HomeTeam", "AwayTeam",
  CASE WHEN match_seq % 101 = 0 THEN 'x' ELSE CAST("FTHG" AS VARCHAR) END AS "FTHG", CAST("FTAG" AS VARCHAR) AS "FTAG", "FTR", {", ".join(f'CAST((match_seq + {3 * i}) % {7 + i} AS VARCHAR) AS "{c}"' for i, c in enumerate(_REST_COUNTS))} FROM m),
d AS (SELECT * FROM d0 UNION ALL SELECT match_seq + 1000000000, * EXCLUDE (match_seq) FROM d0 WHERE match_seq % 97 = 0)"""
_ALL = ["Date", "HomeTeam", "AwayTeam", "FTHG", "FTAG", "FTR", *_REST_COUNTS]
_LIST = ", ".join(f'"{c}"' for c in _ALL)
_DEDUP = f"{_DIRTY}, e AS (SELECT min(match_seq) AS match_seq, {_LIST} FROM d GROUP BY {_LIST})"
_INT = lambda c: f'CAST(trunc(coalesce(TRY_CAST("{c}" AS DOUBLE), 0)) AS BIGINT) AS "{c}"'
_TYPED = ", ".join(_INT(c) for c in COUNTS)
query("clean_dedup", f"WITH {_DEDUP} SELECT match_seq, {_LIST} FROM e")(lambda spark, d: C.remove_duplicates(dirty_matches(spark, d)))
query("clean_types", f"""WITH {_DIRTY} SELECT match_seq, CAST("Date" AS TIMESTAMP) AS "Date", "HomeTeam", "AwayTeam", "FTR", {_TYPED} FROM d""")(lambda spark, d: _ntz(C.convert_types(dirty_matches(spark, d))))
query("clean_full", f"""WITH {_DEDUP} SELECT match_seq, CAST("Date" AS TIMESTAMP) AS "Date", trim("HomeTeam") AS "HomeTeam", trim("AwayTeam") AS "AwayTeam", "FTR", {_TYPED} FROM e WHERE "Date" IS NOT NULL""")(lambda spark, d: _ntz(C.clean(dirty_matches(spark, d))))
_WRITTEN = f"""{_M}, w AS (SELECT match_seq, "HomeTeam", "AwayTeam", match_seq % 10 AS form, "Date" + INTERVAL 1 SECOND * (match_seq % 86400) AS t FROM m),
  g AS (SELECT *, CASE WHEN form IN (0, 5, 6, 9) THEN date_trunc('day', t) WHEN form = 2 THEN t + INTERVAL 250 MILLISECOND WHEN form = 4 THEN t + INTERVAL 125 MICROSECOND WHEN form IN (1, 3) THEN t END AS d FROM w)"""


def _written(spark, d):
    """Dates as text in eight forms, one that is no date, and null, by match_seq % 10."""
    t, seq = F.col("Date").cast("timestamp") + F.make_dt_interval(secs=F.col(SEQ) % 86400), F.col(SEQ)
    form = lambda p: F.date_format(t, p)
    forms = [form("yyyy-MM-dd"), form("yyyy-MM-dd HH:mm:ss"), F.concat(form("yyyy-MM-dd HH:mm:ss"), F.lit(".25")), form("yyyy-MM-dd'T'HH:mm:ss"), F.concat(form("yyyy-MM-dd'T'HH:mm:ss"), F.lit(".000125")), F.concat(F.lit("\t"), form("M/d/yyyy"), F.lit(" ")), form("d MMM yyyy"), F.lit("some day"), F.lit(None).cast("string"), form("yyyy/M/d")]
    text = F.lit(None).cast("string")
    for i, x in enumerate(forms):
        text = F.when(seq % 10 == i, x).otherwise(text)
    return matches(spark, d).withColumn("Date", text)


query("clean_dates", f"""WITH {_WRITTEN} SELECT match_seq, d AS "Date" FROM g""")(lambda spark, d: C.convert_dates(_written(spark, d)).select(SEQ, F.col("Date").cast("timestamp_ntz").alias("Date")))
query("validate_dates", f"""WITH {_WRITTEN} SELECT sum((form = 7)::INT)::BIGINT AS bad_dates, sum((form = 8)::INT)::BIGINT AS "nulls_Date" FROM g""")(lambda spark, d: V.validation_counts(_written(spark, d)).select("bad_dates", "nulls_Date"))
query("prof_infinite", f"""WITH {_M} SELECT 'a' AS feature, sum((match_seq % 7 = 0)::INT)::BIGINT AS missing, sum((match_seq % 7 <> 0 AND match_seq % 11 = 0)::INT)::BIGINT AS infinite FROM m
  UNION ALL SELECT 'b', sum((match_seq % 13 = 0)::INT)::BIGINT, 0::BIGINT FROM m""")(
    lambda spark, d: Q.missing(matches(spark, d).select(F.when(F.col(SEQ) % 7 == 0, float("nan")).when(F.col(SEQ) % 11 == 0, float("-inf")).otherwise(F.col("FTHG").cast("double")).alias("a"), F.when(F.col(SEQ) % 13 != 0, F.col("FTAG")).alias("b")))
)
query("clean_alias_map", f"""WITH {_M} SELECT match_seq, CASE "HomeTeam" WHEN 'TEAM_1' THEN 'One' WHEN 'TEAM_2' THEN 'Two' ELSE "HomeTeam" END AS "HomeTeam", CASE "AwayTeam" WHEN 'TEAM_1' THEN 'One' WHEN 'TEAM_2' THEN 'Two' ELSE "AwayTeam" END AS "AwayTeam" FROM m""")(
    lambda spark, d: C.apply_aliases(matches(spark, d), {"TEAM_1": "One", "TEAM_2": "Two"}).select(SEQ, "HomeTeam", "AwayTeam")
)


def _ntz(df):
    """Dates without a zone, as the driver's tables have them."""
    return df.withColumn("Date", F.col("Date").cast("timestamp_ntz"))


# ---------------------------------------------------------------- checks
query("validate_counts", f"""WITH {_DIRTY} SELECT {", ".join(f'sum(("{c}" IS NULL)::INT)::BIGINT AS "nulls_{c}"' for c in _ALL)}, 0::BIGINT AS bad_dates, sum((NOT regexp_full_match("FTHG", '[0-9]+'))::INT)::BIGINT AS bad_scores,
  sum((NOT regexp_full_match(trim("HomeTeam"), '[a-zA-Z0-9 .&''-]+'))::INT + (NOT regexp_full_match("AwayTeam", '[a-zA-Z0-9 .&''-]+'))::INT)::BIGINT AS bad_names FROM d""")(lambda spark, d: V.validation_counts(dirty_matches(spark, d)))
query("validate_duplicates", f"WITH {_DIRTY} SELECT count(*)::BIGINT - (SELECT count(*) FROM (SELECT DISTINCT {_LIST} FROM d))::BIGINT AS duplicates FROM d")(lambda spark, d: V.duplicate_rows(dirty_matches(spark, d)))
query("contract_violations", f"""WITH {_DIRTY}, x AS (SELECT *, TRY_CAST("FTHG" AS DOUBLE) AS h, TRY_CAST("FTAG" AS DOUBLE) AS a FROM d)
SELECT sum(("Date" IS NULL)::INT)::BIGINT AS invalid_dates, coalesce(sum((CAST("Date" AS TIMESTAMP) > TIMESTAMP '2001-01-01')::INT), 0)::BIGINT AS future_dates, coalesce(sum((h < 0 OR a < 0)::INT), 0)::BIGINT AS negative_goals, 0::BIGINT AS bad_labels,
  coalesce(sum(("FTR" <> CASE WHEN h > a THEN 'H' WHEN h < a THEN 'A' ELSE 'D' END AND h IS NOT NULL)::INT), 0)::BIGINT AS wrong_labels, sum((h IS NULL)::INT)::BIGINT AS bad_integers,
  (SELECT coalesce(sum(n), 0)::BIGINT FROM (SELECT count(*) AS n FROM d GROUP BY "Date", "HomeTeam", "AwayTeam" HAVING count(*) > 1)) AS repeated_keys FROM x""")(lambda spark, d: V.contract_counts(dirty_matches(spark, d), F.lit("2001-01-01").cast("timestamp")))

# ---------------------------------------------------------------- profile
_PF = ["gf", "ga", "total", "flag", "odd"]
_PSQL = f"""{_M}, f AS (SELECT match_seq, "FTHG"::DOUBLE AS gf, "FTAG"::DOUBLE AS ga, ("FTHG" + "FTAG")::DOUBLE AS total, 1::DOUBLE AS flag, CASE WHEN match_seq % 11 <> 0 THEN (match_seq % 13)::DOUBLE END AS odd, "FTR" AS result FROM m)"""


def _profiled(spark, d):
    x = lambda c: c.cast("double")
    return matches(spark, d).select(SEQ, x(F.col("FTHG")).alias("gf"), x(F.col("FTAG")).alias("ga"), x(F.col("FTHG") + F.col("FTAG")).alias("total"), F.lit(1.0).alias("flag"), F.when(F.col(SEQ) % 11 != 0, x(F.col(SEQ) % 13)).alias("odd"), F.col("FTR").alias("result"))


_EACH = lambda cols, body: " UNION ALL ".join(f"SELECT '{c}' AS feature, {body(c)} FROM f" for c in cols)
query("prof_missing", f"WITH {_PSQL} {_EACH([*_PF, 'result'], lambda c: f'sum(({c} IS NULL)::INT)::BIGINT AS missing, 0::BIGINT AS infinite')}")(lambda spark, d: Q.missing(_profiled(spark, d)))
query("prof_describe", f"WITH {_PSQL} " + _EACH(_PF, lambda c: f"count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75, max({c}) AS max, count(*) - count({c}) AS missing"))(lambda spark, d: Q.describe(_profiled(spark, d)))
_DIST = lambda c: f"(count(DISTINCT {c}) + max(({c} IS NULL)::INT))::BIGINT"
query("prof_constant", f"WITH {_PSQL} " + _EACH(_PF, lambda c: f"{_DIST(c)} AS \"distinct\", {_DIST(c)} <= 1 AS is_constant, {_DIST(c)} > 1 AND {_DIST(c)}::DOUBLE / count(*) <= 0.01 AS is_near_constant, round({_DIST(c)}::DOUBLE / count(*), 6) AS ratio"))(lambda spark, d: Q.constants(_profiled(spark, d)))
_PAIRS = [(a, b) for i, a in enumerate(_PF) for b in _PF[i + 1 :]]
_CORR = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, NULL::DOUBLE AS corr" if "flag" in (a, b) else f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM f" for a, b in _PAIRS)
query("prof_corr_pairs", f"WITH {_PSQL} SELECT * FROM ({_CORR})")(lambda spark, d: Q.correlations(_profiled(spark, d)))
query("prof_high_corr", f"""WITH {_PSQL}, c AS ({" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM f" for a, b in _PAIRS if "flag" not in (a, b))}) SELECT * FROM c WHERE abs(corr) >= 0.5 ORDER BY abs(corr) DESC, a, b LIMIT 20""")(lambda spark, d: Q.highly_correlated(_profiled(spark, d), 0.5))
query("prof_target_dist", f"WITH {_PSQL} SELECT result AS value, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM f), 6) AS ratio FROM f GROUP BY result")(lambda spark, d: Q.target_distribution(_profiled(spark, d), "result"))
query("prof_summary", f"WITH {_PSQL} " + _EACH(_PF, lambda c: f"count({c}) AS count, {_DIST(c)} AS \"distinct\", count(*) - count({c}) AS missing, min({c}) AS min, max({c}) AS max, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, 'double' AS dtype"))(lambda spark, d: Q.summary(_profiled(spark, d)))

# ---------------------------------------------------------------- datasets and splits
_LABEL = "CASE WHEN \"FTHG\" > \"FTAG\" THEN 'HOME_WIN' WHEN \"FTHG\" < \"FTAG\" THEN 'AWAY_WIN' ELSE 'DRAW' END"
query("ds_build_from_result", f"""WITH {_U} SELECT match_seq, {_LABEL} AS target_label FROM u""")(lambda spark, d: D.build_dataset(unique_matches(spark, d)).select(SEQ, "target_label"))
query("ds_build_from_scores", f"""WITH {_U} SELECT match_seq, {_LABEL} AS target_label FROM u""")(lambda spark, d: D.build_dataset(unique_matches(spark, d).drop("FTR")).select(SEQ, "target_label"))
_POS = f"""{_U}, p AS (SELECT match_seq, "Date", row_number() OVER (ORDER BY "Date", match_seq) - 1 AS position, count(*) OVER () AS n FROM u),
z AS (SELECT match_seq, "Date", position, CASE WHEN position < CAST(floor(n * 0.7::DOUBLE) AS BIGINT) THEN 'train' WHEN position < CAST(floor(n * 0.7::DOUBLE) AS BIGINT) + CAST(floor(n * 0.15::DOUBLE) AS BIGINT) THEN 'validation' ELSE 'test' END AS split FROM p)"""
query("split_chrono_assign", f"WITH {_POS} SELECT match_seq, position, split FROM z")(lambda spark, d: D.split_chronological(unique_matches(spark, d)).select(SEQ, "position", "split"))
query("split_metadata", f'WITH {_POS} SELECT split, count(*) AS n, min("Date") AS first, max("Date") AS last FROM z GROUP BY split')(lambda spark, d: D.split_metadata(D.split_chronological(unique_matches(spark, d))))
def _random_sql(stratum: str) -> str:
    """MD5 order, quotas rounded, by stratum."""
    return f"""r AS (SELECT *, row_number() OVER (PARTITION BY {stratum} ORDER BY md5('42:' || match_seq), match_seq) - 1 AS r, count(*) OVER (PARTITION BY {stratum}) AS n FROM m),
  s AS (SELECT *, CASE WHEN r < round(n * 0.1) THEN 'validation' WHEN r < round(n * 0.1) + round(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM r)"""


query("split_random", f"WITH {_M}, {_random_sql('1')} SELECT match_seq, split FROM s")(lambda spark, d: D.split_random(matches(spark, d), 0.2, 0.1).select(SEQ, "split"))
query("split_stratified", f"""WITH {_M}, {_random_sql('"FTR"')} SELECT match_seq, "FTR", split FROM s""")(lambda spark, d: D.split_random(matches(spark, d), 0.2, 0.1, stratify="FTR").select(SEQ, "FTR", "split"))

# ---------------------------------------------------------------- preprocessing
for _k, _f in (("mean", "avg(odd)"), ("median", "median(odd)"), ("mode", "(SELECT odd FROM f WHERE odd IS NOT NULL GROUP BY odd ORDER BY count(*) DESC, odd LIMIT 1)")):
    query(f"prep_impute_{_k}", f"WITH {_PSQL} SELECT match_seq, round(coalesce(odd, (SELECT {_f} FROM f LIMIT 1)), 6) AS odd FROM f" if _k != "mode" else f"WITH {_PSQL} SELECT match_seq, round(coalesce(odd, {_f}), 6) AS odd FROM f")(
        lambda spark, d, k=_k: P.impute(df := _profiled(spark, d), P.imputation(df, ["odd"], [], k)).select(SEQ, F.round("odd", 6).alias("odd"))
    )
query("prep_label_encode")(lambda spark, d: P.label_encode(df := _profiled(spark, d), P.categories(df, ["result"])).select(SEQ, "result"))
SQL["prep_label_encode"] = f"WITH {_PSQL} SELECT match_seq, dense_rank() OVER (ORDER BY result) - 1 AS result FROM f"
query("prep_onehot", f"WITH {_PSQL} SELECT match_seq, (result = 'A')::BIGINT AS \"result_A\", (result = 'D')::BIGINT AS \"result_D\", (result = 'H')::BIGINT AS \"result_H\" FROM f")(lambda spark, d: P.one_hot(df := _profiled(spark, d), P.categories(df, ["result"])).select(SEQ, "result_A", "result_D", "result_H"))
for _k, _e in (("standard", "({c} - (SELECT avg({c}) FROM f)) / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END FROM f)"), ("minmax", "({c} - (SELECT min({c}) FROM f)) / (SELECT CASE WHEN max({c}) = min({c}) THEN 1 ELSE max({c}) - min({c}) END FROM f)")):
    query(f"prep_{_k}_scale", f"WITH {_PSQL} SELECT match_seq, {', '.join(f'round({_e.format(c=c)}, 6) + 0.0 AS {c}' for c in ('gf', 'total', 'flag'))} FROM f")(
        lambda spark, d, k=_k: P.scale(df := _profiled(spark, d), P.scaling(df, ["gf", "total", "flag"], k)).select(SEQ, *[(F.round(c, 6) + 0.0).alias(c) for c in ("gf", "total", "flag")])
    )

# ---------------------------------------------------------------- evaluation
def _scored(spark, d):
    """Labels with a made-up probability, and its prediction at one half."""
    rows = spark.read.parquet(f"{d.rstrip('/')}/labels.parquet").where("quality IS NOT NULL AND toxic IS NOT NULL")
    p = ((F.col("doc_id") * 37 + F.col("quality") * 25) % 101 + 1) / 103.0
    return rows.select("doc_id", F.col("quality").alias("label"), p.alias("probability"), (p >= 0.5).cast("int").alias("prediction"))


_S = """s AS (SELECT doc_id, quality AS label, ((doc_id * 37 + quality * 25) % 101 + 1) / 103.0::DOUBLE AS probability FROM labels WHERE quality IS NOT NULL AND toxic IS NOT NULL),
e AS (SELECT *, (probability >= 0.5)::INT AS prediction FROM s)"""
query("eval_confusion", f"WITH {_S} SELECT label::BIGINT AS label, prediction::BIGINT AS prediction, count(*) AS n FROM e GROUP BY ALL")(lambda spark, d: E.confusion(_scored(spark, d)))
query("eval_metrics", f"""WITH {_S}, c AS (SELECT count(*) AS n, sum((label = 1 AND prediction = 1)::INT)::BIGINT AS tp, sum((label = 0 AND prediction = 1)::INT)::BIGINT AS fp, sum((label = 1 AND prediction = 0)::INT)::BIGINT AS fn, sum((label = 0 AND prediction = 0)::INT)::BIGINT AS tn FROM e)
SELECT n, {_R("(tp + tn)")} AS accuracy, {_R("tp", "(tp + fp)")} AS precision, {_R("tp", "(tp + fn)")} AS recall, {_R("(2 * tp)", "(2 * tp + fp + fn)")} AS f1, tp, fp, fn, tn FROM c""")(lambda spark, d: E.metrics(_scored(spark, d)))
query("eval_auc", f"""WITH {_S}, r AS (SELECT label, rank() OVER (ORDER BY probability) + (count(*) OVER (PARTITION BY probability) - 1) / 2.0::DOUBLE AS k FROM e)
SELECT round((sum(CASE WHEN label = 1 THEN k ELSE 0 END) - sum(label) * (sum(label) + 1) / 2.0) / (sum(label) * (count(*) - sum(label))), 6)::DOUBLE AS auc FROM r""")(lambda spark, d: E.roc_auc(_scored(spark, d)).select(F.round("auc", 6).alias("auc")))
query("eval_logloss", f"WITH {_S} SELECT round(-avg(CASE WHEN label = 1 THEN ln(probability) ELSE ln(1 - probability) END), 6) AS log_loss FROM e")(lambda spark, d: E.log_loss(_scored(spark, d)).select(F.round("log_loss", 6).alias("log_loss")))


def _features(spark, d):
    rows = G.combine(unique_matches(spark, d), G.REGISTRY.get("goal_difference")().generate(unique_matches(spark, d)))
    return rows.withColumn("label", (F.col("FTR") == "H").cast("int"))


_X = ["home_goals_for", "away_goals_for", "home_goal_difference", "away_goal_difference"]


@query("ml_cross_validate")
def _cv(spark, d):
    from .ml import models as M

    r = M.cross_validate(_features(spark, d), _X, algorithm="decision_tree", k=3)
    return spark.createDataFrame([(k, float(v)) for k, v in r.items()], "metric string, value double")


@query("ml_select_predict")
def _select(spark, d):
    from .ml import models as M

    split = D.split_chronological(_features(spark, d))
    best, ranking, _ = M.select(split.where("split = 'train'"), split.where("split = 'validation'"), _X)
    return M.predict(best, split.where("split = 'test'")).select(SEQ, "prediction", "confidence", F.lit(ranking[0][0]).alias("model"))

