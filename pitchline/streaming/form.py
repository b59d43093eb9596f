"""Running form over a stream of matches: each team's last rows are kept as state."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.history import team_view
from ..schema import SEQ

_OUT = f"{SEQ} long, is_home boolean, team string, matches long, points long, goals_for long, goals_against long"


def running_form(matches: DataFrame, limit: int = 5) -> DataFrame:
    """A row for each team and match: sums over the team's last `limit` earlier matches as they arrived.

    Within a batch rows are taken in order of (Date, match_seq); a match older than the state counts as it arrives.
    State: limit rows a team.
    """

    def step(key, batches, state: GroupState):
        past = [tuple(r) for r in state.get[0]] if state.exists else []
        rows = pd.concat(list(batches)).sort_values(["Date", SEQ])
        out = []
        for r in rows.itertuples():
            n, p, gf, ga = len(past), *(sum(x[i] for x in past) for i in range(3))
            out.append((getattr(r, SEQ), r.is_home, key[0], n, p, gf, ga))
            past = [*past, (int(r.points), int(r.goals_for), int(r.goals_against))][-limit:]
        state.update((past,))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in _OUT.split(", ")])

    view = team_view(matches).select(SEQ, "Date", "team", "is_home", "points", "goals_for", "goals_against")
    return view.groupBy("team").applyInPandasWithState(step, _OUT, "past array<struct<p: long, gf: long, ga: long>>", "append", GroupStateTimeout.NoTimeout)
