"""Rates, daily counters, threshold crossings and alerts with a cooldown, in batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.levels import pacific_day


def _micros(time: str) -> Column:
    return F.unix_micros(F.col(time).cast("timestamp"))


#: Rows of a slice of time, about.
SLICE_ROWS = 200_000


def _with_neighbours(rows: DataFrame, micros: int) -> DataFrame:
    """``rows`` (with _t) in slices of time (_b), each with a copy of what of the slice before is at most ``micros`` older
    than its start (_own false): what a row looks back on lies in its slice, so a slice is a task's work. Slices are
    as long as their rows make SLICE_ROWS on average, ``micros`` at least, so that few rows are copied."""
    n, lo, hi = rows.agg(F.count("_t"), F.min("_t"), F.max("_t")).first()
    length = max(micros, ((hi or 0) - (lo or 0)) // max(1, n // SLICE_ROWS) + 1)
    b = F.floor(F.col("_t") / length)
    late = rows.where((b + 1) * length - F.col("_t") <= micros)
    return rows.withColumns({"_b": b, "_own": F.lit(True)}).unionByName(late.withColumns({"_b": b + 1, "_own": F.lit(False)}))


def sliding_count(rows: DataFrame, time: str, seconds: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` with ``n``: how many rows lie in the ``seconds`` up to each one, both ends included;
    over all rows, or by ``keys``."""
    span = seconds * 1_000_000
    both = _with_neighbours(rows.withColumn("_t", _micros(time)), span)
    w = Window.partitionBy(*keys, "_b").orderBy("_t").rangeBetween(-span, 0)
    return both.withColumn("n", F.count(F.lit(1)).over(w)).where("_own").drop("_t", "_b", "_own")


def sliced_spikes(requests: DataFrame, limit: int, window_s: float = 60.0, cooldown_s: float = 120.0, per_key: bool = False, slice_s: float = 1.0) -> DataFrame:
    """Alerts (scope, ts, n_requests) of requests (api_key, ts), as streaming.alerts.spikes gives them: slices of time (ts is a slice's start
    in microseconds) with which the last ``window_s`` seconds hold ``limit`` requests or more, but for those within ``cooldown_s`` of one given."""
    step, width = int(slice_s * 1e6), int(window_s * 1e6)
    scope = F.col("api_key").cast("string") if per_key else F.lit("all")
    n = requests.where("ts IS NOT NULL").groupBy(scope.alias("scope"), (F.floor(_micros("ts") / step) * step).alias("_t")).agg(F.count(F.lit(1)).alias("n"))
    both = _with_neighbours(n, width)
    w = Window.partitionBy("scope", "_b").orderBy("_t").rangeBetween(1 - width, 0)
    hits = both.withColumn("n_requests", F.sum("n").over(w)).where("_own").where(F.col("n_requests") >= limit)
    hits = hits.select("scope", F.col("_t").alias("ts"), "n_requests", F.timestamp_micros("_t").alias("_at"))
    return cooled(hits, "scope", "_at", "ts", int(cooldown_s)).select("scope", "ts", "n_requests")


def crossings(rows: DataFrame, key: str, time: str, order: str, limit: Column) -> DataFrame:
    """The rows with which a key's count of the Pacific day meets 80 %, 95 % or all of ``limit``: with
    ``n`` and ``kind``. Of thresholds that are equal the lowest counts."""
    day = rows.withColumn("_day", pacific_day(F.col(time)))
    n = day.withColumn("n", F.row_number().over(Window.partitionBy(key, "_day").orderBy(time, order)))
    part = lambda share: (limit * share).cast("int")
    kind = F.when(F.col("n") == part(0.80), "quota_warn").when(F.col("n") == part(0.95), "quota_critical").when(F.col("n") == limit, "quota_exhausted")
    return n.withColumn("kind", kind).where("kind is not null").drop("_day")


def cooled(rows: DataFrame, kind: str, time: str, order: str, seconds: int) -> DataFrame:
    """The alerts that are given: one is left out if the last one given of its kind is less than
    ``seconds`` old.

    Slices of time are worked on apart, twice. First each tells, for every alert with which giving may begin in it, the last one that is
    then given there; later beginnings never have earlier ends, so equal ends are one step of a list. These lists, of which many alerts
    share a step, are followed from slice to slice in order, and then each slice is walked from where it is entered."""
    span = seconds * 1_000_000
    timed = rows.select(kind, order, _micros(time).alias("_t")).where(F.col(kind).isNotNull() & F.col("_t").isNotNull())
    if span <= 0:
        return rows.join(timed.select(kind, order), [kind, order], "left_semi")
    n, lo, hi = timed.agg(F.count("_t"), F.min("_t"), F.max("_t")).first()
    # a slice takes several times the span, as what may begin in it lies within its first one
    length = max(8 * span, ((hi or 0) - (lo or 0)) // max(1, n // SLICE_ROWS) + 1)
    own = timed.withColumn("_b", F.floor(F.col("_t") / length)).repartition(kind, "_b").groupBy(kind, "_b", "_t").agg(F.min(order).alias(order))
    shapes = {f.name: f.dataType.simpleString() for f in timed.schema.fields}

    def times(slice_: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The times in order, the rows that they stand in, and for each time the place of the first that is ``span`` later."""
        t = slice_["_t"].to_numpy()
        at = np.argsort(t)
        return t[at], at, np.searchsorted(t[at], t[at] + span)

    def steps(slice_: pa.Table) -> pa.Table:
        t, _, after = times(slice_)
        end = np.where(after < len(t), after, np.arange(len(t)))
        while (further := end[end] != end).any():
            end = np.where(further, end[end], end)
        begin = slice_["_b"][0].as_py() * length + span
        to = t[end[: np.searchsorted(t, begin) + 1]]
        last = np.append(to[1:] != to[:-1], True)
        row = lambda x: pa.array([x[last]], pa.list_(pa.int64()))
        return pa.table({kind: slice_[kind].slice(0, 1), "_b": slice_["_b"].slice(0, 1), "_upto": row(t[: len(to)]), "_to": row(to)})

    def entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = given = None
        for batch in batches:
            entries = []
            for i, k in enumerate(batch[kind].to_pylist()):
                of, given = k, given if k == of else None
                entries.append(given)
                upto = batch["_upto"][i].values.to_numpy()
                at = 0 if given is None else int(np.searchsorted(upto, given + span))
                given = batch["_to"][i].values[at].as_py() if at < len(upto) else given
            yield pa.RecordBatch.from_arrays([batch[kind], batch["_b"], pa.array(entries, pa.int64())], names=[kind, "_b", "_given"])

    def walked(slice_: pa.Table) -> pa.Table:
        t, at, after = times(slice_)
        given = slice_["_given"][0].as_py()
        i, found, after = 0 if given is None else int(np.searchsorted(t, given + span)), [], after.tolist()
        while i < len(t):
            found.append(i)
            i = after[i]
        return slice_.select([kind, order]).take(pa.array(at[found], pa.int64()))

    told = own.groupBy(kind, "_b").applyInArrow(steps, f"`{kind}` {shapes[kind]}, _b bigint, _upto array<bigint>, _to array<bigint>")
    entries = told.repartition(kind).sortWithinPartitions(kind, "_b").mapInArrow(entered, f"`{kind}` {shapes[kind]}, _b bigint, _given bigint")
    found = own.join(entries, [kind, "_b"]).groupBy(kind, "_b").applyInArrow(walked, f"`{kind}` {shapes[kind]}, `{order}` {shapes[order]}")
    return rows.join(found, [kind, order], "left_semi")
