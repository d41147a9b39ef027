"""A watchdog that stops machines which nobody uses, on a stream of their signals.

Each machine has a timer, which fires without a signal of it: when it was idle or was up for too long. What is
then given out is a request to stop; the record of it is part of the same commit, before anyone can act on it,
so a stop is asked for once, whatever fails in between. If the machine can't be stopped, or doesn't say that it has, the record
is taken back and the timer runs again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .alerts import needs_rocksdb

#: Signals: use of a machine (a request, a new output), progress of a batch, its start and end, and the
#: answers to a request to stop.
ACTIVITY, HEARTBEAT, STARTED, DONE, STOPPED, REFUSED = "activity", "heartbeat", "batch_started", "batch_done", "stopped", "refused"
_SHAPE = "machine string, at long, event string, reason string"
_STATE = "first long, active long, beat long, running boolean, asked long, over boolean"


@dataclass(frozen=True)
class Limits:
    """Milliseconds: without use or heartbeat; since the first signal; for the answer to a request."""

    idle: int
    park: int
    answer: int


@dataclass(frozen=True)
class Machine:
    """What is known of a machine; times in milliseconds. ``asked``: when a stop was asked for that is not answered."""

    first: int
    active: int
    beat: int | None = None
    running: bool = False
    asked: int | None = None
    over: bool = False

    def due(self, limits: Limits) -> tuple[int, str] | None:
        """When the timer fires next, and what for. A batch that has begun and not ended, and a fresh heartbeat, keep a machine up; for
        longer than the park limit nothing does."""
        if self.over:
            return None
        if self.asked is not None:
            return self.asked + limits.answer, "alarm"
        park = (self.first + limits.park, "parked")
        return park if self.running else min((max(self.active, self.beat or 0) + limits.idle, "idle"), park)

    def fired(self, at: int, what: str) -> tuple[Machine, tuple[str, str]]:
        if what == "alarm":  # nobody answered: the record is taken back
            return replace(self, asked=None, first=at, active=at), ("alarm", "no answer")
        return replace(self, asked=at), ("stop", what)

    def told(self, at: int, kind: str) -> tuple[Machine, list[tuple[str, str]]]:
        """After a signal. One from a machine that had stopped means that it was started again."""
        if kind == STOPPED:
            return replace(self, asked=None, over=True), [] if self.over else [("stopped", "confirmed")]
        if self.over:
            return Machine(at, at).told(at, kind)[0], [("started", kind)]
        if kind == REFUSED:
            return (replace(self, asked=None, first=at, active=at), [("resumed", kind)]) if self.asked is not None else (self, [])
        if kind == HEARTBEAT:
            return replace(self, beat=max(at, self.beat or at)), []
        running = {STARTED: True, DONE: False}.get(kind, self.running)
        return replace(self, active=max(at, self.active), running=running), []


class _Watchdog(StatefulProcessor):
    def __init__(self, limits: Limits, by_event: bool) -> None:
        self.limits, self.by_event = limits, by_event

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("machine", _STATE)

    def _upto(self, m: Machine, at: int, name: str, out: list[tuple]) -> Machine:
        """All that the timer has to say up to a time."""
        while (due := m.due(self.limits)) and due[0] <= at:
            m, event = m.fired(*due)
            out.append((name, due[0], *event))
        return m

    def _keep(self, m: Machine) -> None:
        self.state.update((m.first, m.active, m.beat, m.running, m.asked, m.over))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if due := m.due(self.limits):
            self.handle.registerTimer(due[0])

    def _known(self) -> Machine | None:
        row = self.state.get()
        return Machine(*(None if v is None or v != v else v for v in row)) if row else None

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        m, out = self._known(), []
        now = None if self.by_event else int(timerValues.getCurrentProcessingTimeInMs())
        for signal in pd.concat(rows).sort_values(["ms", "kind"]).itertuples(index=False):
            at = int(signal.ms) if now is None else now
            m = self._upto(m or Machine(at, at), at, key[0], out)
            m, events = m.told(at, signal.kind)
            out += [(key[0], at, *e) for e in events]
        self._keep(m)
        yield pd.DataFrame(out, columns=["machine", "at", "event", "reason"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        m, out = self._known(), []
        if m:
            # one timer may bring about the next, which is due as well
            now = timerValues.getCurrentWatermarkInMs() if self.by_event else timerValues.getCurrentProcessingTimeInMs()
            m = self._upto(m, max(int(now), int(expiredTimerInfo.getExpiryTimeInMs())), key[0], out)
            self._keep(m)
        yield pd.DataFrame(out, columns=["machine", "at", "event", "reason"])

    def close(self) -> None:
        pass


def watched(signals: DataFrame, idle_s: float = 2700, park_s: float = 43_200, answer_s: float = 75, late: str | None = "1 minute") -> DataFrame:
    """machine, at (milliseconds since 1970), event and reason of a stream of signals (machine, ts, kind): ``stop`` (idle or parked), ``stopped``
    (confirmed), ``resumed`` (the stop was refused), ``alarm`` (no answer) and ``started`` (again).

    Timers go by event time, up to the watermark (``late`` behind the newest signal of any machine), so a replay gives what
    the stream gave; with ``late`` None they go by the clock, and a signal counts when it comes. Rows without machine, time or kind
    are left out; a kind that isn't known counts as activity."""
    needs_rocksdb(signals)
    rows = signals.where("machine IS NOT NULL AND ts IS NOT NULL AND kind IS NOT NULL")
    rows = rows.withWatermark("ts", late) if late else rows
    limits = Limits(*(int(s * 1000) for s in (idle_s, park_s, answer_s)))
    told = rows.select("machine", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"), "kind", "ts")
    return told.groupBy("machine").transformWithStateInPandas(_Watchdog(limits, bool(late)), _SHAPE, "Append", "EventTime" if late else "ProcessingTime")
