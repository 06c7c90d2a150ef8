"""A leased work queue as a stream of events: claim, complete, release and tick, with expiry by event clock.

An item is in one active lease at most. A claim of an item that is leased and not past its expiry
is refused; completion and release need the holder; a completed item never goes back. A tick, or
any later event of the item, lets an expired lease go.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = "status string, worker string, expires long, attempts long"
OUT = "item string, event_id long, action string, worker string, outcome string, status string, attempts long"


def step(state: tuple, action: str, worker: str | None, ts: int, ttl: int) -> tuple[tuple, str]:
    """The state after an event, and what became of the event."""
    status, holder, expires, attempts = state
    if status == "leased" and expires <= ts:
        status, holder, expires = "open", None, 0
    if action == "claim":
        if status == "open":
            return ("leased", worker, ts + ttl, attempts + 1), "granted"
        return (status, holder, expires, attempts), "refused"
    if action in ("complete", "release"):
        if status == "completed" and action == "complete":
            return (status, holder, expires, attempts), "repeated"
        if status == "leased" and holder == worker:
            return ("completed" if action == "complete" else "open", worker if action == "complete" else None, 0, attempts), "done"
        return (status, holder, expires, attempts), "refused"
    return (status, holder, expires, attempts), "seen"


def _replay(item: str, rows: pd.DataFrame, state: tuple) -> tuple[pd.DataFrame, tuple]:
    out = []
    for r in rows.sort_values(["ts", "event_id"]).itertuples():
        state, outcome = step(state, r.action, r.worker, int(r.ts), int(r.ttl))
        out.append((item, r.event_id, r.action, r.worker, outcome, state[0], state[3]))
    return pd.DataFrame(out, columns=[c.split()[0] for c in OUT.split(", ")]), state


FRESH = ("open", None, 0, 0)


def replay(events: DataFrame) -> DataFrame:
    """Outcomes of a table of events (item, event_id, ts in seconds, action, worker, ttl); an item's events are one group."""
    return events.groupBy("item").applyInPandas(lambda key, rows: _replay(key[0], rows, FRESH)[0], OUT)


def stream(events: DataFrame) -> DataFrame:
    """The same over a stream; state is kept by item."""

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        out, now = _replay(key[0], pd.concat(list(parts)), state.get if state.exists else FRESH)
        state.update(now)
        yield out

    return events.groupBy("item").applyInPandasWithState(run, OUT, STATE, "append", GroupStateTimeout.NoTimeout)
