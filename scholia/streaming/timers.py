"""Keyed state with timers: work on what changed, retries of what is blocked for a while, leases that end by themselves.

Time is processing time, so timers fire without new events; state and timers are in the checkpoint
and go on after a restart, for which a clock runs beside the events. Sessions need a state store that has timers: `use_store`.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .leases import FRESH, STATE, step

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Reasons that may go away by themselves; a reason's name is what stands before its first colon.
DYNAMIC = ("active_lease", "pending_overlay_or_draft", "reading_checkpoint_present")
LEAST_RETRY_S, RETRY_INTERVALS = 900, 3
WEEK_MS = 7 * 24 * 3600 * 1000

WORK = "id string, fingerprint string, cause string"
TURN = "item string, event_id long, action string, worker string, outcome string, status string, attempts long"


def use_store(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


def retry_delay_ms(interval_s: float, least_s: float = LEAST_RETRY_S) -> int:
    """A blocked item is tried again after 15 minutes, or three polls if that is longer."""
    return int(1000 * max(least_s, RETRY_INTERVALS * interval_s))


def ticking(events: DataFrame) -> DataFrame:
    """The same stream with a clock that has no rows but makes a batch at every trigger.

    Timers fire in batches, and after a restart the first batch would wait for new events.
    """
    clock = events.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load().where("value < 0")
    return events.unionByName(clock.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema]))


class _Work(StatefulProcessor):
    """State of an id: the fingerprint that was last given out, and whether it is blocked for a while."""

    def __init__(self, delay_ms: int, dynamic: tuple[str, ...], ttl_ms: int):
        self.delay_ms, self.dynamic, self.ttl_ms = delay_ms, dynamic, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", "fingerprint string, retry boolean", self.ttl_ms)

    def _no_timers(self) -> None:
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        out = []
        for r in pd.concat(list(rows)).sort_values("seq").itertuples():
            known = self.known.get() if self.known.exists() else (None, False)
            if r.event == "seen":
                if r.fingerprint != known[0]:
                    self._no_timers()
                    self.known.update((r.fingerprint, False))
                    out.append((key[0], r.fingerprint, "changed"))
            elif r.event == "blocked":
                if r.fingerprint == known[0]:
                    again = any(str(reason).split(":", 1)[0] in self.dynamic for reason in (r.reasons if r.reasons is not None else ()))
                    self._no_timers()
                    self.known.update((r.fingerprint, again))
                    if again:
                        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.delay_ms)
            elif r.event == "done" and r.fingerprint == known[0]:
                self._no_timers()
                self.known.update((r.fingerprint, False))
        yield pd.DataFrame(out, columns=["id", "fingerprint", "cause"])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        known = self.known.get() if self.known.exists() else (None, False)
        if known[1]:
            self.known.update((known[0], False))
            yield pd.DataFrame({"id": [key[0]], "fingerprint": [known[0]], "cause": ["retry"]})

    def close(self) -> None:
        pass


def work(events: DataFrame, interval_s: float, least_s: float = LEAST_RETRY_S, dynamic: tuple[str, ...] = DYNAMIC, ttl_ms: int = WEEK_MS) -> DataFrame:
    """What is to be worked on, from a stream of (id, seq, event, fingerprint, reasons).

    `seen` gives an item out if its fingerprint isn't the one that was given out last. `blocked` with a
    dynamic reason gives it out again after a delay, once for each such event, unless a change or `done`
    comes first; with other reasons it waits for a change. What isn't heard of for `ttl_ms` is forgotten.
    """
    return ticking(events).groupBy("id").transformWithStateInPandas(_Work(retry_delay_ms(interval_s, least_s), dynamic, ttl_ms), WORK, "Append", "ProcessingTime")


class _Leases(StatefulProcessor):
    """State of an item as in `leases.step`; the expiry of a lease is a timer."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.item = handle.getValueState("item", STATE, self.ttl_ms)

    def _timer(self, expires: int | None) -> None:
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        if expires is not None:
            self.handle.registerTimer(expires)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now, out = timerValues.getCurrentProcessingTimeInMs(), []
        state = tuple(self.item.get()) if self.item.exists() else FRESH
        for r in pd.concat(list(rows)).sort_values("event_id").itertuples():
            state, outcome = step(state, r.action, r.worker, now, int(r.ttl) * 1000)
            out.append((key[0], r.event_id, r.action, r.worker, outcome, state[0], state[3]))
        self.item.update(state)
        self._timer(state[2] if state[0] == "leased" else None)
        yield pd.DataFrame(out, columns=[c.split()[0] for c in TURN.split(", ")])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        state = tuple(self.item.get()) if self.item.exists() else FRESH
        if state[0] == "leased" and state[2] <= timerValues.getCurrentProcessingTimeInMs():
            self.item.update(("open", None, 0, state[3]))
            row = (key[0], None, "expire", state[1], "released", "open", state[3])
            yield pd.DataFrame([row], columns=[c.split()[0] for c in TURN.split(", ")]).astype({"event_id": "Int64"})

    def close(self) -> None:
        pass


def leased(events: DataFrame, ttl_ms: int = WEEK_MS) -> DataFrame:
    """Outcomes of a stream of (item, event_id, action, worker, ttl in seconds), and a row when a lease expires.

    Claims, completion and release follow `leases.step` by the clock of the batch. An expired lease is
    let go by its timer, without an event of its item; a completed item never opens again
    within `ttl_ms` of the last event, after which it is forgotten.
    """
    return ticking(events).groupBy("item").transformWithStateInPandas(_Leases(ttl_ms), TURN, "Append", "ProcessingTime")
