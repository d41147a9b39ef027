"""Interval algebra on rows with a key, a start and an end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union(rows: DataFrame, keys: list[str], start: str = "start", end: str = "end", tolerance: float = 0.0) -> DataFrame:
    """Overlapping or touching intervals merged: keys, start, end. Empty and reversed ones go."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    r = rows.where(F.col(end) > F.col(start)).withColumn("_new", F.coalesce(F.col(start) > before + tolerance, F.lit(True)).cast("int"))
    r = r.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return r.groupBy(*keys, "_run").agg(F.min(start).alias("start"), F.max(end).alias("end")).drop("_run")


def complement(merged: DataFrame, spans: DataFrame, keys: list[str]) -> DataFrame:
    """The parts of ``spans`` (keys, lo, hi) that disjoint ``merged`` intervals leave: keys, start, end."""
    inside = merged.join(spans, keys).select(*keys, F.greatest("start", "lo").alias("s"), F.least("end", "hi").alias("e")).where("e > s")
    edges = inside.unionByName(spans.select(*keys, F.col("lo").alias("s"), F.col("lo").alias("e"))).unionByName(spans.select(*keys, F.col("hi").alias("s"), F.col("hi").alias("e")))
    w = Window.partitionBy(*keys).orderBy("s", "e")
    return edges.select(*keys, F.lag("e").over(w).alias("start"), F.col("s").alias("end")).where("end > start")


def kept_segments(cuts: DataFrame, spans: DataFrame, keys: list[str]) -> DataFrame:
    """What is left of ``spans`` (keys, lo, hi) after cuts (start, end; no end: to the span's): keys, start,
    end. A span of which nothing is left is kept whole."""
    ended = cuts.join(spans, keys).select(*keys, "start", F.least(F.coalesce("end", "hi"), F.col("hi")).alias("end"))
    free = complement(union(ended, keys, tolerance=1e-6), spans, keys)
    whole = spans.join(free.select(*keys).distinct(), keys, "left_anti").select(*keys, F.col("lo").alias("start"), F.col("hi").alias("end"))
    return free.unionByName(whole)


def with_gaps(rows: DataFrame, keys: list[str], least: float, start: str = "start", end: str = "end", duration: str | None = None) -> DataFrame:
    """The gaps longer than ``least``: before the first interval, between an interval and the next one,
    and after the last one up to ``duration`` (a column of rows): keys, start, end."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    last = F.col(duration) if duration else F.lit(None).cast("double")
    r = rows.select(*keys, F.col(start).cast("double").alias("_s"), F.col(end).cast("double").alias("_e"), F.lead(start).over(w).alias("_next"), F.lag(start).over(w).alias("_before"), last.cast("double").alias("_d"))
    gap = lambda a, b: F.struct(a.cast("double").alias("start"), b.cast("double").alias("end"))
    # a row has the gap after it, and the first one that before it
    after = gap(F.col("_e"), F.coalesce("_next", "_d"))
    gaps = F.when(F.col("_before").isNull(), F.array(gap(F.lit(0.0), F.col("_s")), after)).otherwise(F.array(after))
    return r.select(*keys, F.explode(gaps).alias("g")).select(*keys, "g.start", "g.end").where(F.col("end") - F.col("start") > least)


def kept_length(cuts: DataFrame, keys: list[str], duration: str) -> DataFrame:
    """keys, kept: a duration less the lengths of its cuts (start, end; no end: to the duration's), to
    three places. What two cuts share is taken off twice, as the lengths are summed."""
    length = F.greatest(F.lit(0.0), F.least(F.coalesce("end", duration), F.col(duration)) - F.col("start"))
    return cuts.groupBy(*keys).agg(F.bround(F.greatest(F.lit(0.0), F.max(duration) - F.sum(length)), 3).alias("kept"))


def cut_frames(cuts: DataFrame, keys: list[str], fps: Column, frames: str) -> DataFrame:
    """keys, frame: the numbers of the frames that cuts remove, each once; ends are rounded half to even,
    and no number passes the last frame's."""
    a, b = F.bround(F.col("start") * fps).cast("long"), F.least(F.bround(F.col("end") * fps).cast("long"), F.col(frames))
    r = cuts.select(*keys, a.alias("_a"), b.alias("_b")).where("_b > _a")
    return r.select(*keys, F.explode(F.sequence("_a", F.col("_b") - 1)).alias("frame")).distinct()


def runs(rows: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Run-length encoding: keys, run, value, first, last, n."""
    w = Window.partitionBy(*keys).orderBy(order)
    new = F.coalesce(~F.col(value).eqNullSafe(F.lag(value).over(w)) | F.lag(order).over(w).isNull(), F.lit(True)).cast("int")
    r = rows.withColumn("_new", new).withColumn("run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return r.groupBy(*keys, "run").agg(F.first(value).alias("value"), F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("n"))


def paired(events: DataFrame, keys: list[str], order: str, time: str, starts: Column, ends: Column, length: DataFrame, eof: str) -> DataFrame:
    """keys, start, end and ``eof``: each start with the end that follows it. Of starts in a row the last counts, and ends without a start
    none; a start that stays open ends with its file, of which ``length`` (keys, eof) has the length. Other events don't count."""
    w = Window.partitionBy(*keys).orderBy(order)
    marks = events.withColumns({"_start": F.coalesce(starts, F.lit(False)), "_end": F.coalesce(ends, F.lit(False))}).where("_start OR _end")
    marks = marks.withColumns({"_next": F.lead("_end").over(w), "_to": F.lead(time).over(w)}).where("_start AND coalesce(_next, true)")
    found = marks.join(length.select(*keys, eof), keys)
    return found.select(*keys, F.col(time).alias("start"), F.when(F.col("_next"), F.col("_to")).otherwise(F.col(eof)).alias("end"), eof)
