"""Rate alerts, quotas and their cooldown on streams.

Requests are counted by slices of time first, by Spark's own windows: a slice is complete once the watermark has
passed it, and slices come in order. What follows keeps state by key over slices, not requests, so neither a
window's state nor an alert depends on how many requests there are, and the scope of all keys is fed
by partial counts. The state is in ``transformWithStateInPandas``, which needs the RocksDB provider
(``STATE_STORE``) as the session's state store. Times are microseconds since 1970.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.levels import pacific_day

PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Shares of a daily limit that are told, and their names, lowest first.
SHARES = ((0.80, "quota_warn"), (0.95, "quota_critical"), (1.0, "quota_exhausted"))


def needs_rocksdb(df: DataFrame) -> None:
    if not df.sparkSession.conf.get(PROVIDER_CONF, "").endswith("RocksDBStateStoreProvider"):
        raise ValueError(f"set {PROVIDER_CONF} to {STATE_STORE}")


def window_counts(requests: DataFrame, key: str = "api_key", time: str = "ts", width: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Requests by key and window; rows later than the watermark are left out."""
    w = F.window(time, width)
    return requests.withWatermark(time, late).groupBy(w, key).agg(F.count(F.lit(1)).alias("n_requests")).select(F.col("window.start").alias("start"), key, "n_requests")


def daily_counts(requests: DataFrame, key: str = "api_key", time: str = "ts", late: str = "1 day") -> DataFrame:
    """Requests by key and Pacific day; a new day starts at 0."""
    day = requests.withWatermark(time, late).withColumn("day", pacific_day(F.col(time)))
    return day.groupBy(key, "day").agg(F.count(F.lit(1)).alias("n_requests"))


def slices(requests: DataFrame, scope: Column, slice_s: float = 1.0, time: str = "ts", late: str = "10 minutes") -> DataFrame:
    """scope, at (the slice's start), day (Pacific, in days since 1970), n and event (the slice's event time): requests by scope and
    slice of time. In a stream, a slice comes when the watermark has passed it; later requests are left out."""
    w = F.window(time, f"{int(slice_s * 1e6)} microseconds")
    marked = requests.withWatermark(time, late) if requests.isStreaming else requests
    n = marked.groupBy(w, scope.cast("string").alias("scope")).agg(F.count(F.lit(1)).alias("n"))
    start = F.col("window.start")
    return n.select("scope", F.unix_micros(start.cast("timestamp")).alias("at"), F.unix_date(pacific_day(start.cast("timestamp"))).cast("long").alias("day"), "n", F.window_time("window").alias("event"))


class _Spikes(StatefulProcessor):
    """State of a scope: the counts of the slices in the window, and the time of the last alert. It
    goes when the scope was silent for a window and a cooldown."""

    def __init__(self, limit: int, width: int, cooldown: int) -> None:
        self.limit, self.width, self.cooldown = limit, width, cooldown

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "at long", "n long")
        self.last = handle.getValueState("last", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(rows).sort_values("at")
        kept = {int(k[0]): int(v[0]) for k, v in self.counts.iterator()}
        total, last, out = sum(kept.values()), self.last.get(), []
        last = int(last[0]) if last else None
        for at, n in zip(new["at"].tolist(), new["n"].tolist(), strict=True):
            for old in [t for t in kept if t <= at - self.width]:
                total -= kept.pop(old)
                if self.counts.containsKey((old,)):
                    self.counts.removeKey((old,))
            kept[at] = kept.get(at, 0) + n
            total += n
            if total >= self.limit and (last is None or at - last >= self.cooldown):
                last = at
                out.append((key[0], at, total))
        for at, n in kept.items():
            self.counts.updateValue((at,), (n,))
        if last is not None:
            self.last.update((last,))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer((int(new["at"].max()) + self.width + self.cooldown) // 1000 + 1)
        yield pd.DataFrame(out, columns=["scope", "ts", "n_requests"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.counts.clear()
        self.last.clear()
        yield pd.DataFrame([], columns=["scope", "ts", "n_requests"])

    def close(self) -> None:
        pass


def spikes(requests: DataFrame, limit: int, window_s: float = 60.0, cooldown_s: float = 120.0, per_key: bool = False, slice_s: float = 1.0, late: str = "10 minutes") -> DataFrame:
    """Alerts (scope, ts, n_requests) of a stream of requests (api_key, ts): slices with which the last ``window_s``
    seconds hold ``limit`` requests or more; for ``cooldown_s`` after an alert there is no other. The
    window is that of all keys (scope ``all``), or of each with ``per_key``. As operators.alerts.sliced_spikes says in batch."""
    needs_rocksdb(requests)
    counts = slices(requests, F.col("api_key") if per_key else F.lit("all"), slice_s, late=late)
    state = _Spikes(limit, int(window_s * 1e6), int(cooldown_s * 1e6))
    return counts.groupBy("scope").transformWithStateInPandas(state, "scope string, ts long, n_requests long", "Append", "EventTime")


class _Crossings(StatefulProcessor):
    """State of a key: its day and the requests of that so far."""

    def __init__(self, limit: int) -> None:
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.used = handle.getValueState("used", "day long, n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new, used, out = pd.concat(rows).sort_values("at"), self.used.get(), []
        day, n = (int(used[0]), int(used[1])) if used else (None, 0)
        for at, today, more in zip(new["at"].tolist(), new["day"].tolist(), new["n"].tolist(), strict=True):
            if today != day:
                day, n = today, 0
            told = set()
            for share, kind in SHARES:
                part = int(self.limit * share)
                if n < part <= n + more and part not in told:
                    out.append((key[0], at, part, kind))
                told.add(part)
            n += more
        self.used.update((day, n))
        yield pd.DataFrame(out, columns=["api_key", "ts", "n", "kind"])

    def close(self) -> None:
        pass


def crossings(requests: DataFrame, limit: int, slice_s: float = 1.0, late: str = "10 minutes") -> DataFrame:
    """api_key, ts (start of a slice), n and kind of the slices of a stream of requests (api_key, ts) in which a key's count of
    the Pacific day meets a share (SHARES) of ``limit``; of shares that are equal the lowest is told. As
    operators.alerts.crossings in batch, with the request's slice for its time."""
    needs_rocksdb(requests)
    return slices(requests, F.col("api_key"), slice_s, late=late).groupBy("scope").transformWithStateInPandas(_Crossings(limit), "api_key string, ts long, n long, kind string", "Append", "None")


class _Cooled(StatefulProcessor):
    """State of a kind: the time of the last alert given."""

    def __init__(self, cooldown: int) -> None:
        self.cooldown = cooldown

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new, last, out = pd.concat(rows).sort_values(["ts", "api_key"]), self.last.get(), []
        last = int(last[0]) if last else None
        for row in new.itertuples(index=False):
            if last is None or row.ts - last >= self.cooldown:
                last = int(row.ts)
                out.append((row.kind, row.ts, row.api_key))
        if last is not None:
            self.last.update((last,))
        yield pd.DataFrame(out, columns=["kind", "ts", "api_key"])

    def close(self) -> None:
        pass


def cooled(alerts: DataFrame, cooldown_s: float = 120.0) -> DataFrame:
    """kind, ts, api_key of a stream of alerts (kind, ts in microseconds, api_key): those with no other given of their kind, of whatever
    key, in the ``cooldown_s`` before. Alerts have to come in order, but for those of a batch, which are put in order."""
    needs_rocksdb(alerts)
    return alerts.select("kind", "ts", "api_key").groupBy("kind").transformWithStateInPandas(_Cooled(int(cooldown_s * 1e6)), "kind string, ts long, api_key string", "Append", "None")
