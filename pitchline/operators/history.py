"""Point-in-time history: what a team, or a pair of teams, had done before a match.

Three kinds of "previous N" (see README): strict (days before the match's day alone), running (rows before in order of
date and match_seq) and shifted rolling. All are windows by team or pair; none joins a match to its past, and strict and running share one
exchange and one sort: what is strictly before a day is what runs up to the day's first row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import points, ratio
from ..schema import SEQ

FACTS = ("matches", "wins", "draws", "losses", "goals_for", "goals_against", "points", "clean_sheets", "failed_to_score")
RATES = {"goals_per_match": "goals_for", "goals_against_per_match": "goals_against", "points_per_match": "points", "win_rate": "wins", "draw_rate": "draws", "loss_rate": "losses", "clean_sheet_rate": "clean_sheets", "failed_to_score_rate": "failed_to_score"}
STATS = ("matches", "matches_played", "wins", "draws", "losses", "goals_for", "goals_against", "goal_difference", "points", "clean_sheets", "failed_to_score", *RATES)


def team_view(matches: DataFrame) -> DataFrame:
    """Two rows a match, one a team, with the team's facts; one scan, no union."""
    has_score, has_result = "FTHG" in matches.columns, "FTR" in matches.columns
    goals = lambda c: F.col(c) if has_score else F.lit(None).cast("long")
    side = lambda home: F.struct(F.col("HomeTeam" if home else "AwayTeam").alias("team"), F.lit(home).alias("is_home"), goals("FTHG" if home else "FTAG").alias("gf"), goals("FTAG" if home else "FTHG").alias("ga"))
    rows = matches.select(SEQ, "Date", (F.col("FTR") if has_result else F.lit(None).cast("string")).alias("FTR"), F.explode(F.array(side(True), side(False))).alias("t"))
    rows = rows.select(SEQ, "Date", "t.*", points(F.col("FTR"), F.col("t.is_home")).alias("points"))
    one = lambda c: c.cast("long")
    return rows.select(
        SEQ, "Date", "team", "is_home",
        F.lit(1).cast("long").alias("matches"),
        one(F.col("points") == 3).alias("wins"), one(F.col("points") == 1).alias("draws"), one(F.col("points") == 0).alias("losses"),
        F.col("gf").cast("long").alias("goals_for"), F.col("ga").cast("long").alias("goals_against"), F.col("points").cast("long").alias("points"),
        one(F.col("ga") == 0).alias("clean_sheets"), one(F.col("gf") == 0).alias("failed_to_score"),
    )


def with_running(view: DataFrame, keys: list[str], facts, limit: int | None, prefix: str = "") -> DataFrame:
    """Adds prefix + fact: sums over the last `limit` rows (all, if None) of the keys by (Date, match_seq), the row itself excluded."""
    if limit is not None and limit < 1:
        raise ValueError("the window must be at least 1")
    w = Window.partitionBy(*keys).orderBy("Date", SEQ).rowsBetween(Window.unboundedPreceding if limit is None else -limit, -1)
    return view.withColumns({prefix + f: F.coalesce(F.sum(f).over(w), F.lit(0)) for f in facts})


def at_day_start(view: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    """Adds new: old's value in the first row of the same keys and Date, by match_seq. The order is that of with_running, so nothing moves."""
    day = Window.partitionBy(*keys, "Date").orderBy(SEQ)
    return view.withColumns({new: F.first(old).over(day) for new, old in columns.items()})


def with_strict(view: DataFrame, keys: list[str], facts, limit: int | None = 5, prefix: str = "past_") -> DataFrame:
    """Adds prefix + fact: sums over the keys' last `limit` rows of earlier Dates (later match_seq preferred within a day); all rows stay."""
    run = with_running(view, keys, facts, limit, "_run_")
    return at_day_start(run, keys, {prefix + f: f"_run_{f}" for f in facts}).drop(*[f"_run_{f}" for f in facts])


def with_halo(view: DataFrame, rows: int, period: str) -> DataFrame:
    """The team view cut by calendar period (date_trunc's units), so that one team's rows are many tasks' work: adds _period and _ghost.

    Into each period of a team come, as ghosts, its last `rows` rows at home and its last `rows` away before it. Each period offers its own last
    `rows` rows of either kind; those of the `rows` latest periods that have any are gathered. Windows by (team, _period) over at most
    `rows` rows are then those by team; leave the ghosts out afterwards.
    """
    cols, by = view.columns, Window.partitionBy("team", "is_home")
    view = view.withColumn("_period", F.date_trunc(period, "Date"))
    back = F.row_number().over(Window.partitionBy("team", "is_home", "_period").orderBy(F.desc("Date"), F.desc(SEQ)))
    row = F.struct("Date", SEQ, *[c for c in cols if c not in ("Date", SEQ)])
    packs = view.withColumn("_back", back).where(F.col("_back") <= rows).groupBy("team", "is_home", "_period").agg(F.sort_array(F.collect_list(row)).alias("_pack"))
    grid = view.select("team", "_period").distinct().select("team", "_period", F.explode(F.array(F.lit(True), F.lit(False))).alias("is_home"))
    packs = grid.join(packs, ["team", "is_home", "_period"], "left").withColumn("_n", F.sum(F.col("_pack").isNotNull().cast("long")).over(by.orderBy("_period")))
    packs = packs.withColumn("_past", F.collect_list("_pack").over(by.orderBy("_n").rangeBetween(-rows, Window.currentRow)))
    past = F.flatten(F.when(F.col("_pack").isNull(), F.col("_past")).otherwise(F.slice("_past", 1, F.size("_past") - 1)))  # a period's own pack is its last
    ghosts = packs.withColumn("_past", past).select("_period", F.explode(F.slice("_past", F.greatest(F.lit(1), F.size("_past") - rows + 1), rows)).alias("_row"))
    return view.withColumn("_ghost", F.lit(False)).unionByName(ghosts.select("_period", *[F.col(f"_row.`{c}`").alias(c) for c in cols], F.lit(True).alias("_ghost")))


def strict_of(view: DataFrame, keys: list[str], facts, limit: int | None, only: Column) -> DataFrame:
    """(keys, Date, facts): sums over the last `limit` rows of earlier Dates for which `only` holds, for every (keys, Date) of the view.

    Rows are gathered by (keys, Date), keeping the last `limit` of a day; the last `limit` rows before a day lie within
    its `limit` preceding days that have rows, so the window holds a bounded number of arrays. Without a limit the days' sums are accumulated.
    """
    if limit is not None and limit < 1:
        raise ValueError("the window must be at least 1")
    day = Window.partitionBy(*keys).orderBy("Date")
    if limit is None:
        days = view.groupBy(*keys, "Date").agg(*[F.sum(F.when(only, F.col(f))).alias(f) for f in facts])
        before = day.rowsBetween(Window.unboundedPreceding, -1)
        return days.select(*keys, "Date", *[F.coalesce(F.sum(f).over(before), F.lit(0)).alias(f) for f in facts])
    last = F.slice(F.reverse(F.sort_array(F.collect_list(F.when(only, F.struct(F.col(SEQ).alias("_seq"), *facts))))), 1, limit)
    days = view.groupBy(*keys, "Date").agg(last.alias("_rows"))
    # days without such rows would use up the window's places
    days = days.withColumn("_n", F.sum((F.size("_rows") > 0).cast("long")).over(day))
    past = F.collect_list(F.when(F.size("_rows") > 0, F.col("_rows"))).over(Window.partitionBy(*keys).orderBy("_n").rangeBetween(-limit, Window.currentRow))
    days = days.withColumn("_past", past)
    # a day's own rows are at the end if it has any: drop them
    days = days.withColumn("_past", F.when(F.size("_rows") > 0, F.slice("_past", 1, F.size("_past") - 1)).otherwise(F.col("_past")))
    days = days.withColumn("_past", F.slice(F.flatten(F.reverse("_past")), 1, limit))
    total = lambda f: F.aggregate("_past", F.lit(0).cast("long"), lambda s, x: s + x[f])
    return days.select(*keys, "Date", *[total(f).alias(f) for f in facts])


def statistics(prefix: str = "") -> list[Column]:
    """All STATS as doubles from the FACTS' columns, which have the prefix."""
    n = F.col(prefix + "matches")
    base = {f: F.col(prefix + f).cast("double") for f in FACTS}
    base |= {"matches_played": base["matches"], "goal_difference": base["goals_for"] - base["goals_against"]}
    base |= {r: ratio(F.col(prefix + f), n) for r, f in RATES.items()}
    return [base[s].alias(s) for s in STATS]


def team_statistics(matches: DataFrame, limit: int | None = 5, venue: str = "overall") -> DataFrame:
    """(match_seq, is_home, team, STATS): each team's strict history before each of its matches.

    venue: overall; home or away counts the team's games at that venue alone, whatever the match's own venue.
    """
    view = team_view(matches)
    if venue == "overall":
        return with_strict(view, ["team"], FACTS, limit).select(SEQ, "is_home", "team", *statistics("past_"))
    past = strict_of(view, ["team"], FACTS, limit, F.col("is_home") == (venue == "home"))
    return view.select(SEQ, "Date", "team", "is_home").join(past, ["team", "Date"]).select(SEQ, "is_home", "team", *statistics())


def home_and_away(rows: DataFrame, columns, names=None) -> DataFrame:
    """One row a match from two rows (match_seq, is_home, columns): home_* and away_* of the names, by conditional aggregation."""
    pick = lambda c, home: F.max(F.when(F.col("is_home") == home, F.col(c)))
    return rows.groupBy(SEQ).agg(*[pick(c, h).alias(("home_" if h else "away_") + n) for c, n in zip(columns, names or columns) for h in (True, False)])


def pair_statistics(matches: DataFrame, limit: int | None = 5) -> DataFrame:
    """(match_seq, matches, home_wins, away_wins, draws, home_goals, away_goals): the two teams' earlier meetings.

    Oriented to this match's home team; who won is told by the scores.
    """
    a, b = F.least("HomeTeam", "AwayTeam"), F.greatest("HomeTeam", "AwayTeam")
    straight = F.col("HomeTeam") == a
    x, y = F.when(straight, F.col("FTHG")).otherwise(F.col("FTAG")), F.when(straight, F.col("FTAG")).otherwise(F.col("FTHG"))
    facts = {"matches": F.lit(1), "a_wins": (x > y).cast("long"), "b_wins": (x < y).cast("long"), "draws": (x == y).cast("long"), "a_goals": x, "b_goals": y}
    view = matches.select(SEQ, "Date", a.alias("a"), b.alias("b"), straight.alias("straight"), *[c.cast("long").alias(n) for n, c in facts.items()])
    rows = with_strict(view, ["a", "b"], list(facts), limit).select(SEQ, "straight", *[F.col(f"past_{f}").alias(f) for f in facts])
    turn = lambda p, q, n: F.when(F.col("straight"), F.col(p)).otherwise(F.col(q)).alias(n)
    return rows.select(SEQ, "matches", turn("a_wins", "b_wins", "home_wins"), turn("b_wins", "a_wins", "away_wins"), "draws", turn("a_goals", "b_goals", "home_goals"), turn("b_goals", "a_goals", "away_goals"))


def get_matches(matches: DataFrame, team=None, date=None, start=None, end=None, before=None, limit: int | None = None, ascending: bool = True, **dims) -> DataFrame:
    """Filtered matches in order of (Date, match_seq). date wins over start/end (inclusive) and before (exclusive).

    dims: league, season, competition, country; one that is no column (in either case) is ignored.
    """
    if limit is not None and limit < 0:
        raise ValueError("limit must not be negative")
    out = matches
    if team is not None:
        out = out.where((F.col("HomeTeam") == team) | (F.col("AwayTeam") == team))
    for k, v in dims.items():
        found = [c for c in matches.columns if c.lower() == k.lower()]
        if v is not None and found:
            out = out.where(F.col(found[0]) == v)
    day = lambda v: F.lit(v).cast(matches.schema["Date"].dataType)
    if date is not None:
        out = out.where(F.col("Date") == day(date))
    else:
        for v, test in ((start, lambda d: F.col("Date") >= d), (end, lambda d: F.col("Date") <= d), (before, lambda d: F.col("Date") < d)):
            if v is not None:
                out = out.where(test(day(v)))
    order = [F.col("Date"), F.col(SEQ)]
    out = out.orderBy(*(order if ascending else [c.desc() for c in order]))
    return out if limit is None else out.limit(limit)


def last_matches(matches: DataFrame, team, before=None, limit: int | None = 5, venue: str = "overall", **dims) -> DataFrame:
    """A team's latest matches, newest first; the venue is chosen before the limit."""
    if venue != "overall":
        matches = matches.where(F.col("HomeTeam" if venue == "home" else "AwayTeam") == team)
    return get_matches(matches, team=team, before=before, limit=limit, ascending=False, **dims)


def meetings(matches: DataFrame, home, away, before=None, limit: int | None = 5, mode: str = "overall") -> DataFrame:
    """Earlier meetings of two teams, newest first: overall, home_only (home at home) or away_only (home away)."""
    there = (F.col("HomeTeam") == home) & (F.col("AwayTeam") == away)
    back = (F.col("HomeTeam") == away) & (F.col("AwayTeam") == home)
    keep = {"overall": there | back, "home_only": there, "away_only": back}
    if mode not in keep:
        raise ValueError(f"mode must be one of {', '.join(keep)}")
    return get_matches(matches.where(keep[mode]), before=before, limit=limit, ascending=False)


def team_statistics_at(matches: DataFrame, team, before=None, limit: int | None = None, venue: str = "overall", **dims) -> DataFrame:
    """One row of STATS for one team before a date; zeros without matches."""
    view = team_view(last_matches(matches, team, before, limit, venue, **dims)).where(F.col("team") == team)
    return view.agg(*[F.coalesce(F.sum(f), F.lit(0)).alias(f) for f in FACTS]).select(*statistics())


def pair_statistics_at(matches: DataFrame, home, away, before=None, limit: int | None = None) -> DataFrame:
    """One row for two teams' meetings before a date, oriented to home."""
    m = meetings(matches, home, away, before, limit)
    straight = F.col("HomeTeam") == home
    x, y = F.when(straight, F.col("FTHG")).otherwise(F.col("FTAG")), F.when(straight, F.col("FTAG")).otherwise(F.col("FTHG"))
    s = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0)).cast("double")
    n = m.agg(F.count("*").cast("double").alias("matches"), s(x > y).alias("home_wins"), s(x < y).alias("away_wins"), s(x == y).alias("draws"), s(x).alias("home_goals"), s(y).alias("away_goals"))
    return n.select("*", ratio(F.col("home_goals") + F.col("away_goals"), F.col("matches")).alias("average_goals"), (F.col("home_goals") - F.col("away_goals")).alias("goal_difference"))
