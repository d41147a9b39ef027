"""First-come-first-served queues with one server each and a time-out.

A job waits until it has arrived and the one before it has ended. So the end of a job is, as a function
of the end before it, ``e -> max(arrival + work, e + work)``. These functions compose to one of their own
kind, ``e -> max(a, e + s)``: work adds up, and of the latest arrivals the one counts that leaves most to
do. That makes ends two running aggregates (the sum of work and the greatest backlog), which slices of
a queue find apart from each other; a slice's total function carries the end over to the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def served(jobs: DataFrame, queue: str, job: str, arrival: str, work: Column, timeout: int, slice_us: int = 3_600_000_000) -> DataFrame:
    """queue, job, arrived, started, ended, waited (all in microseconds) and status of each job: ``error`` where
    it was stopped after ``timeout``, else ``done``.

    ``arrival`` is a timestamp, ``work`` the microseconds that a job takes by itself; null and negative work
    count as 0. Jobs that arrive together go by ``job``, then by work; rows without an arrival are left out. A slice is
    ``slice_us`` of arrivals of a queue; of a slice one row is passed on."""
    rows = jobs.select(F.col(queue).alias("queue"), F.col(job).alias("job"), F.unix_micros(F.col(arrival).cast("timestamp")).alias("arrived"), F.greatest(F.coalesce(work.cast("long"), F.lit(0)), F.lit(0)).alias("work"))
    rows = rows.where("arrived IS NOT NULL").withColumns({"s": F.least("work", F.lit(timeout)), "slice": F.floor(F.col("arrived") / slice_us)})
    upto = Window.partitionBy("queue", "slice").orderBy("arrived", "job", "work").rowsBetween(Window.unboundedPreceding, 0)
    # the end of a job whose slice nothing precedes, and the work of its slice so far
    summed = rows.withColumn("c", F.sum("s").over(upto))
    own = summed.withColumn("a", F.max(F.col("arrived") - F.col("c") + F.col("s")).over(upto) + F.col("c"))
    slices = own.groupBy("queue", "slice").agg(F.max("a").alias("a"), F.sum("s").alias("s"))
    earlier = Window.partitionBy("queue").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    total = slices.withColumn("c", F.sum("s").over(earlier))
    total = total.withColumn("end", F.max(F.col("a") - F.col("c")).over(earlier) + F.col("c"))
    before = total.select("queue", "slice", F.lag("end").over(Window.partitionBy("queue").orderBy("slice")).alias("before"))
    both = own.join(before, (own["queue"].eqNullSafe(before["queue"])) & (own["slice"] == before["slice"])).drop(before["queue"], before["slice"])
    ended = F.greatest("a", F.col("before") + F.col("c"))
    status = F.when(F.col("work") > timeout, "error").otherwise("done")
    out = both.select("queue", "job", "arrived", (ended - F.col("s")).alias("started"), ended.alias("ended"), status.alias("status"))
    return out.withColumn("waited", F.col("started") - F.col("arrived"))


def transitions(jobs: DataFrame) -> DataFrame:
    """The log of served jobs: queue, job, seq, status (queued, running, then done or error) and at."""
    entry = lambda seq, status, at: F.struct(F.lit(seq).alias("seq"), status.alias("status"), F.col(at).alias("at"))
    log = F.array(entry(0, F.lit("queued"), "arrived"), entry(1, F.lit("running"), "started"), entry(2, F.col("status"), "ended"))
    return jobs.select("queue", "job", F.explode(log).alias("e")).select("queue", "job", "e.*")


def ahead(jobs: DataFrame) -> DataFrame:
    """queue, job and n_ahead of served jobs: how many of its queue had arrived before a job and not ended when it
    arrived. Ends grow in the order of service, so that is the difference of two counts at its
    arrival, made by one pass over arrivals and ends."""
    # a job that is over as it arrives stands before nobody
    weight = (F.col("ended") > F.col("arrived")).cast("long")
    mark = lambda at, arrives: F.struct(F.col(at).alias("at"), F.lit(arrives).alias("arrives"), ((2 * arrives - 1) * weight).alias("w"))
    both = jobs.select("queue", "job", "started", F.explode(F.array(mark("ended", 0), mark("arrived", 1))).alias("m")).select("queue", "job", "started", "m.*")
    day = F.floor(F.col("at") / 86_400_000_000)
    sums = both.groupBy("queue", day.alias("day")).agg(F.sum("w").alias("w"))
    earlier = Window.partitionBy("queue").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(F.col("queue").alias("q"), F.col("day").alias("d"), F.coalesce(F.sum("w").over(earlier), F.lit(0)).alias("base"))
    # of what arrives together the earlier served stands ahead; what ends at an arrival is gone
    upto = Window.partitionBy("queue", day).orderBy("at", "arrives", "started", "job").rowsBetween(Window.unboundedPreceding, 0)
    here = both.withColumns({"n": F.sum("w").over(upto), "day": day}).where("arrives = 1")
    return here.join(base, here["queue"].eqNullSafe(base["q"]) & (here["day"] == base["d"])).select("queue", "job", (F.col("base") + F.col("n") - F.col("w")).alias("n_ahead"))
