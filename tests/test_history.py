from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pitchline.errors import FeatureError
from pitchline.operators import history as H
from pitchline.plans import features as G

SCHEMA = "match_seq long, Date timestamp_ntz, HomeTeam string, AwayTeam string, FTHG long, FTAG long, FTR string"


def table(spark, rows):
    day = lambda s: datetime.fromisoformat(s)
    return spark.createDataFrame([(i, day(d), h, a, x, y, "H" if x > y else "A" if x < y else "D") for i, (d, h, a, x, y) in enumerate(rows)], SCHEMA)


LEAGUE = [("2024-01-01", "A", "B", 2, 1), ("2024-01-08", "C", "A", 0, 0), ("2024-01-08", "B", "D", 1, 3), ("2024-01-15", "A", "D", 3, 1), ("2024-01-15", "A", "C", 1, 1), ("2024-01-22", "B", "A", 0, 2), ("2024-02-20", "A", "B", 0, 1)]


def by_seq(df):
    return {r.match_seq: r for r in df.collect()}


def test_goal_difference_is_strictly_before_the_day(spark):
    r = by_seq(G.GoalDifference().generate(table(spark, LEAGUE)))
    assert (r[0].home_goals_for, r[0].away_goals_for) == (0.0, 0.0)
    assert (r[3].home_goals_for, r[3].home_goals_against) == (2.0, 1.0)
    assert r[4].home_goals_for == 2.0  # the other match of that day is not history
    assert r[5].away_average_goal_difference == (2 + 0 + 3 + 1 - 1 - 0 - 1 - 1) / 4


def test_window_keeps_the_later_row_of_a_day(spark):
    r = by_seq(G.GoalDifference({"window": 1}).generate(table(spark, LEAGUE)))
    assert (r[5].away_goals_for, r[5].away_goals_against) == (1.0, 1.0)
    with pytest.raises(ValueError):
        G.GoalDifference({"window": 0})


def test_head_to_head_turns_to_the_home_team(spark):
    r = by_seq(G.HeadToHead().generate(table(spark, LEAGUE)))
    assert (r[5].home_h2h_wins, r[5].away_h2h_wins, r[5].home_h2h_goals) == (0.0, 1.0, 1.0)
    assert (r[6].home_h2h_wins, r[6].h2h_matches_played, r[6].h2h_average_goals) == (2.0, 2.0, 2.5)


def test_rest_days_floor_elapsed_time(spark):
    rows = [("2024-01-01T20:00:00", "A", "B", 1, 0), ("2024-01-04T12:00:00", "A", "C", 1, 0), ("2024-01-30T12:00:00", "C", "A", 0, 0)]
    r = by_seq(G.RestDays().generate(table(spark, rows)))
    assert (r[1].home_rest_days, r[1].home_congested_schedule, r[1].away_rest_days) == (2.0, 1.0, 0.0)
    assert r[2].long_break_flag == 1.0


def test_recent_form_and_rolling_count_earlier_rows_of_a_day(spark):
    r = by_seq(G.RecentForm().generate(table(spark, LEAGUE)))
    assert r[4].home_form_points_last5 == 3 + 1 + 3
    x = by_seq(G.rolling_statistics(table(spark, LEAGUE), 2))
    assert x[4]["Home Team Form"] == 4.0 and x[0]["Home Team Form"] == 0.0


@pytest.mark.parametrize("venue", ["overall", "home", "away"])
@pytest.mark.parametrize("limit", [1, 2, None])
def test_team_statistics_equal_a_loop(spark, venue, limit):
    m = table(spark, LEAGUE)
    view = [r.asDict() for r in H.team_view(m).collect()]
    for r in H.team_statistics(m, limit, venue).collect():
        day = next(x["Date"] for x in view if x["match_seq"] == r.match_seq)
        past = sorted((x for x in view if x["team"] == r.team and x["Date"] < day and (venue == "overall" or x["is_home"] == (venue == "home"))), key=lambda x: (x["Date"], x["match_seq"]))
        past = past if limit is None else past[-limit:]
        assert (r.matches, r.goals_for, r.points) == (len(past), sum(x["goals_for"] for x in past), sum(x["points"] for x in past))


def test_later_scores_change_nothing_before(spark):
    m = table(spark, LEAGUE)
    cut = F.lit(datetime(2024, 1, 15))
    changed = m.withColumn("FTHG", F.when(F.col("Date") >= cut, F.col("FTHG") + 5).otherwise(F.col("FTHG")))
    for g in (G.GoalDifference(), G.TeamPerformance(), G.HomeAdvantage(), G.HeadToHead(), G.RestDays()):
        keep = m.where(F.col("Date") <= cut).select("match_seq")
        a, b = (by_seq(g.generate(x).join(keep, "match_seq")) for x in (m, changed))
        assert a == b


def test_lookups(spark):
    m = table(spark, LEAGUE)
    assert [r.match_seq for r in H.last_matches(m, "A", limit=2).collect()] == [6, 5]
    assert [r.match_seq for r in H.last_matches(m, "A", "2024-01-22", 5, "away").collect()] == [1]
    assert [r.match_seq for r in H.meetings(m, "A", "B", mode="away_only").collect()] == [5]
    assert H.get_matches(m, limit=0).count() == 0 and H.get_matches(m, league="x").count() == 7
    with pytest.raises(ValueError):
        H.get_matches(m, limit=-1)
    assert H.team_statistics_at(m, "nobody").first().matches == 0.0


def test_empty_table(spark):
    for g in G.REGISTRY.instances():
        assert g.generate(table(spark, LEAGUE).limit(0)).count() == 0


def test_registry_and_conflicts(spark):
    assert G.REGISTRY.names() == sorted(G.REGISTRY.names()) and len(G.REGISTRY.names()) == 6
    reg = G.Registry()
    reg.register(G.RestDays)
    with pytest.raises(FeatureError):
        reg.register(G.RestDays)
    with pytest.raises(TypeError):
        reg.register(int)
    m = table(spark, LEAGUE)
    with pytest.raises(FeatureError):
        G.combine(m, m)
    out = G.run_features(m.drop("FTHG", "FTAG", "FTR"))
    assert "rest_days::home_rest_days" in out.columns and not [c for c in out.columns if c.startswith("goal")]


def test_integration_reports(spark, tmp_path):
    from pitchline.plans.ingest import integrate

    whole, reports = integrate(table(spark, LEAGUE), out=f"file://{tmp_path}")
    assert whole.count() == len(LEAGUE) and len(reports["manifest"]) == 6 and all(reports["time_integrity"].values())
    assert (tmp_path / "manifest.json").exists()
