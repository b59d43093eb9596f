"""Feature generators: plug-ins that turn matches into (match_seq, their columns), a registry and a run of several.

A TeamGenerator says which history of a team it needs and how its columns come of it; all of them that run together share one pass over the team view:
one exchange by team, one aggregation by match.
"""

from __future__ import annotations

import warnings
from abc import ABC, abstractmethod

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import FeatureError, MissingColumnError
from ..functions.expr import ratio
from ..operators import history as H
from ..schema import SEQ

_SCORED = ("Date", "HomeTeam", "AwayTeam", "FTHG", "FTAG")
RATES = ("goals_per_match", "goals_against_per_match", "points_per_match", "win_rate", "draw_rate", "loss_rate", "clean_sheet_rate", "failed_to_score_rate")


class FeatureGenerator(ABC):
    name = ""
    required: tuple[str, ...] = ()
    dependencies: tuple[str, ...] = ()
    window = running_window = 5

    def __init__(self, config: dict | None = None):
        self.config = dict(config or {})
        self.window = int(self.config.get("window", type(self).window))
        if self.window < 1:
            raise ValueError(f"{self.name}: the window must be at least 1")

    def supports(self, matches: DataFrame) -> bool:
        return set(self.required) <= set(matches.columns)

    def check(self, matches: DataFrame) -> None:
        missing = [c for c in self.required if c not in matches.columns]
        if missing:
            raise MissingColumnError(missing)

    @abstractmethod
    def generate(self, matches: DataFrame) -> DataFrame:
        """(match_seq, output columns as doubles), one row a match."""

    def __repr__(self):
        return f"{self.name}(window={self.window}, needs {', '.join(self.required)})"


class TeamGenerator(FeatureGenerator):
    """needs: kinds of history, "strict" (overall), "venue" (the team's games at the match's venue), "running" or "rest" (see shared_view)."""

    needs: tuple[str, ...] = ()

    @abstractmethod
    def side(self, of) -> dict[str, Column]:
        """A team's columns by name; of(kind, fact) is the column of a fact in a kind of history."""

    def finish(self, home, away) -> dict[str, Column]:
        """The match's columns, in order; home(c) and away(c) are the two teams' columns c."""
        return {f"{s}_{c}": x(c) for c in self.side(lambda kind, fact: F.lit(0)) for s, x in (("home", home), ("away", away))}

    def generate(self, matches):
        f, columns = team_features(matches, [self])
        return f.select(SEQ, *[F.col(f"`{new}`").alias(c) for c, new in columns[self.name].items()])


def shared_view(matches: DataFrame, kinds: set[tuple[str, int]], period: str | None = None) -> DataFrame:
    """The team view with columns kind_window_fact for each (kind, window): all from one exchange by team, or by team and period (see history.with_halo)."""
    scored = any(k != "rest" for k, _ in kinds)
    view, cut = H.team_view(matches if scored else matches.select(SEQ, "Date", "HomeTeam", "AwayTeam")), []
    if period:
        view, cut = H.with_halo(view, max(1, *(w for _, w in kinds)), period), ["_period"]
    for window in sorted({w for k, w in kinds if k in ("strict", "running")}):
        view = H.with_running(view, ["team", *cut], H.FACTS, window, f"running_{window}_")
        if ("strict", window) in kinds:
            view = H.at_day_start(view, ["team", *cut], {f"strict_{window}_{f}": f"running_{window}_{f}" for f in H.FACTS})
    if any(k == "rest" for k, _ in kinds):
        view = view.withColumn("_last", F.lag("Date").over(Window.partitionBy("team", *cut).orderBy("Date", SEQ)))
        view = H.at_day_start(view, ["team", *cut], {"rest_0_before": "_last"})
    for window in sorted({w for k, w in kinds if k == "venue"}):
        view = H.with_strict(view, ["team", *cut, "is_home"], H.FACTS, window, f"venue_{window}_")
    return view.where(~F.col("_ghost")) if period else view


def team_features(matches: DataFrame, generators: list[TeamGenerator], period: str | None = None) -> tuple[DataFrame, dict[str, dict[str, str]]]:
    """((match_seq, generator::column ...), each generator's columns and their names there) by one pass over the team view."""
    span = lambda g, kind: {"rest": 0, "running": g.running_window}.get(kind, g.window)
    view = shared_view(matches, {(k, span(g, k)) for g in generators for k in g.needs}, period)
    sides = {}
    for i, g in enumerate(generators):
        for c, x in g.side(lambda kind, fact: F.col(f"{kind}_{span(g, kind)}_{fact}")).items():  # noqa: B023
            sides[f"{i}:{c}"] = x
    both = H.home_and_away(view.select(SEQ, "is_home", *[x.alias(c) for c, x in sides.items()]), [f"`{c}`" for c in sides], list(sides))
    out, names = [], {}
    for i, g in enumerate(generators):
        cols = g.finish(lambda c: F.col(f"`home_{i}:{c}`"), lambda c: F.col(f"`away_{i}:{c}`"))  # noqa: B023
        names[g.name] = {c: f"{g.name}::{c}" for c in cols}
        out += [x.alias(f"{g.name}::{c}") for c, x in cols.items()]
    return both.select(SEQ, *out), names


class Registry:
    def __init__(self):
        self._known: dict[str, type[FeatureGenerator]] = {}

    def register(self, cls):
        if not (isinstance(cls, type) and issubclass(cls, FeatureGenerator)):
            raise TypeError("only FeatureGenerator classes can be registered")
        if cls.name in self._known:
            raise FeatureError(f"{cls.name} is registered twice")
        self._known[cls.name] = cls
        return cls

    def get(self, name: str) -> type[FeatureGenerator]:
        if name not in self._known:
            raise FeatureError(f"no generator {name}")
        return self._known[name]

    def names(self) -> list[str]:
        return sorted(self._known)

    def discover(self, module) -> list[str]:
        """Register the concrete generators that a module defines and that aren't registered yet; their names."""
        found = [x for x in vars(module).values() if isinstance(x, type) and issubclass(x, FeatureGenerator) and x.name and x.__module__ == module.__name__ and not getattr(x, "__abstractmethods__", None)]
        return [self.register(x).name for x in found if x.name not in self._known]

    def reset(self) -> None:
        self._known.clear()

    def instances(self, configs: dict | None = None, order=None) -> list[FeatureGenerator]:
        """In the given or alphabetical order, each after what it depends on."""
        out: list[str] = []

        def add(name, path=()):
            if name in path:
                raise FeatureError(f"generators depend on each other: {', '.join(path)}")
            if name not in out:
                for d in self.get(name).dependencies:
                    add(d, (*path, name))
                out.append(name)

        for name in order or self.names():
            add(name)
        return [self.get(n)((configs or {}).get(n)) for n in out]


REGISTRY = Registry()


def _rates(of, kind: str) -> dict[str, Column]:
    return {r: ratio(of(kind, H.RATES[r]).cast("double"), of(kind, "matches")) for r in RATES}


@REGISTRY.register
class GoalDifference(TeamGenerator):
    name, required, needs = "goal_difference", (*_SCORED, "FTR"), ("strict",)

    def side(self, of):
        f, a, n = (of("strict", c) for c in ("goals_for", "goals_against", "matches"))
        d = lambda c: c.cast("double")
        return {"goals_for": d(f), "goals_against": d(a), "goal_difference": d(f) - d(a), "average_goal_difference": ratio(d(f) - d(a), n)}


@REGISTRY.register
class TeamPerformance(TeamGenerator):
    name, required, needs = "team_performance", (*_SCORED, "FTR"), ("strict",)

    def side(self, of):
        return _rates(of, "strict")


@REGISTRY.register
class HomeAdvantage(TeamGenerator):
    """The home team's home games and the away team's away games, each by its own venue."""

    name, required, needs = "home_advantage", (*_SCORED, "FTR"), ("venue",)

    def side(self, of):
        return _rates(of, "venue")

    def finish(self, home, away):
        return {f"{s}_{s}_{r}": x(r) for r in RATES for s, x in (("home", home), ("away", away))}


@REGISTRY.register
class HeadToHead(FeatureGenerator):
    name, required = "head_to_head", _SCORED

    def generate(self, matches):
        s, n = H.pair_statistics(matches, self.window), F.col("matches")
        d = lambda c: F.col(c).cast("double")
        return s.select(
            SEQ,
            d("home_wins").alias("home_h2h_wins"), d("away_wins").alias("away_h2h_wins"), d("draws").alias("h2h_draws"),
            ratio(F.col("home_wins"), n).alias("home_h2h_win_rate"), ratio(F.col("away_wins"), n).alias("away_h2h_win_rate"), ratio(F.col("draws"), n).alias("h2h_draw_rate"),
            d("home_goals").alias("home_h2h_goals"), d("away_goals").alias("away_h2h_goals"),
            ratio(F.col("home_goals") + F.col("away_goals"), n).alias("h2h_average_goals"),
            (d("home_goals") - d("away_goals")).alias("recent_h2h_goal_difference"), d("matches").alias("h2h_matches_played"),
        )


@REGISTRY.register
class RestDays(TeamGenerator):
    """Whole days since a team's previous day with a match; thresholds congested_days (4) and long_break_days (14)."""

    name, required, needs = "rest_days", _SCORED[:3], ("rest",)

    def __init__(self, config=None):
        super().__init__(config)
        self.congested, self.long = int(self.config.get("congested_days", 4)), int(self.config.get("long_break_days", 14))
        if self.congested < 0 or self.long < 0:
            raise ValueError("day thresholds must not be negative")

    def side(self, of):
        return {"rest_days": F.coalesce(F.timestamp_diff("DAY", of("rest", "before"), F.col("Date")), F.lit(0)).cast("double")}

    def finish(self, home, away):
        h, a = home("rest_days"), away("rest_days")
        tight = lambda d: ((d > 0) & (d <= self.congested)).cast("double")
        return {"home_rest_days": h, "away_rest_days": a, "rest_day_difference": h - a, "home_congested_schedule": tight(h), "away_congested_schedule": tight(a), "long_break_flag": ((h >= self.long) | (a >= self.long)).cast("double")}


@REGISTRY.register
class RecentForm(TeamGenerator):
    """The last five rows before a match in order of date and match_seq, same-day ones included."""

    name, required, needs, running_window = "recent_form", (*_SCORED, "FTR"), ("running",), 5

    def side(self, of):
        d = lambda c: of("running", c).cast("double")
        return {"form_points_last5": d("points"), "wins_last5": d("wins"), "draws_last5": d("draws"), "losses_last5": d("losses"), "goals_scored_last5": d("goals_for"), "goals_conceded_last5": d("goals_against"), "goal_difference_last5": d("goals_for") - d("goals_against"), "points_per_match": ratio(d("points"), of("running", "matches"))}


#: Output names of the rolling statistics.
ROLLING = {"Team Form": "points", "Goals Average": "goals_for", "Goals Conceded Average": "goals_against", "Win Percentage": "wins", "Clean Sheet Percentage": "clean_sheets", "Goal Difference": None}


def rolling_statistics(matches: DataFrame, window: int = 5) -> DataFrame:
    """(match_seq, 12 columns): per team by (Date, match_seq), shifted by one match; the first match has 0."""
    if window < 1:
        raise ValueError("the window must be at least 1")
    missing = [c for c in (*_SCORED, "FTR") if c not in matches.columns]
    if missing:
        raise MissingColumnError(missing)
    r = H.with_running(H.team_view(matches), ["team"], H.FACTS, window, "_")
    cols = {k: F.col("_points").cast("double") if k == "Team Form" else ratio(F.col(f"_{f}") if f else F.col("_goals_for") - F.col("_goals_against"), F.col("_matches")) for k, f in ROLLING.items()}
    both = H.home_and_away(r.select(SEQ, "is_home", *[c.alias(k) for k, c in cols.items()]), cols)
    return both.select(SEQ, *[F.col(f"{side.lower()}_{k}").alias(f"{side} {k}") for k in cols for side in ("Home", "Away")])


def describe(generators=None, matches: DataFrame | None = None) -> list[dict]:
    """Each generator's name, needs, window and, for given matches, columns; nothing is run."""
    out = []
    for g in generators if generators is not None else REGISTRY.instances():
        row = {"name": g.name, "required": list(g.required), "dependencies": list(g.dependencies), "window": g.window}
        if matches is not None and g.supports(matches):
            row["columns"] = [c for c in g.generate(matches).columns if c != SEQ]
        out.append(row)
    return out


def combine(base: DataFrame, features: DataFrame) -> DataFrame:
    """Left join on match_seq; names that clash are refused."""
    clash = (set(base.columns) & set(features.columns)) - {SEQ}
    if clash:
        raise FeatureError(f"columns clash: {', '.join(sorted(clash))}")
    return base.join(features, SEQ, "left") if len(features.columns) > 1 else base


def run_features(matches: DataFrame, generators=None, prefix: bool = True, period: str | None = None) -> DataFrame:
    """All generators' columns beside the matches, in their order; prefixed `generator::column` so that equal names stay apart.

    A generator whose columns are missing is left out with a warning, as `supports` says. TeamGenerators share one pass; each other one has its own.
    period: a calendar unit ("year", "month", "day") by which a team's rows are dealt over tasks, for teams with too many rows for one.
    """
    given = generators if generators is not None else REGISTRY.instances()
    able = [g for g in given if g.supports(matches)]
    for g in (g for g in given if g not in able):
        warnings.warn(f"{g.name} is left out: {', '.join(c for c in g.required if c not in matches.columns)} missing", stacklevel=2)
    teams = [g for g in able if isinstance(g, TeamGenerator) and type(g).generate is TeamGenerator.generate]
    out, order = matches, []
    shared, names = team_features(matches, teams, period) if teams else (None, {})
    if shared is not None:
        out = combine(out, shared)
    for g in able:
        if g not in teams:
            f = g.generate(matches)
            names[g.name] = {c: f"{g.name}::{c}" for c in f.columns if c != SEQ}
            out = combine(out, f.select(SEQ, *[F.col(f"`{c}`").alias(n) for c, n in names[g.name].items()]))
        order += [(c, n) for c, n in names[g.name].items()]
    if not prefix and (clash := {c for c, _ in order if [x for x, _ in order].count(c) > 1 or c in matches.columns}):
        raise FeatureError(f"columns clash: {', '.join(sorted(clash))}")
    return out.select(*[F.col(f"`{c}`") for c in matches.columns], *[F.col(f"`{n}`").alias(n if prefix else c) for c, n in order])
