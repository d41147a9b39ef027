"""Queries over job queues: three machines that serve the requests of events one after the other."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import register
from ..operators import queues
from ..session import table

TIMEOUT_S = 7200
_WALK = f"""WITH RECURSIVE j AS (SELECT user_id % 3 AS queue, event_id AS job, epoch_us(ts) AS arrived, CAST(floor(value * 60) AS BIGINT) * 1000000 AS work FROM events),
  o AS (SELECT *, least(work, {TIMEOUT_S}000000) AS s, row_number() OVER (PARTITION BY queue ORDER BY arrived, job) AS rn FROM j),
  w(queue, job, rn, arrived, started, ended, work) AS (SELECT queue, job, rn, arrived, arrived, arrived + s, work FROM o WHERE rn = 1
    UNION ALL SELECT o.queue, o.job, o.rn, o.arrived, greatest(o.arrived, w.ended), greatest(o.arrived, w.ended) + o.s, o.work FROM w JOIN o ON o.queue = w.queue AND o.rn = w.rn + 1),
  served AS (SELECT queue, job, arrived, started, ended, CASE WHEN work > {TIMEOUT_S}000000 THEN 'error' ELSE 'done' END AS status, started - arrived AS waited FROM w)"""


def _served(spark, sf_dir):
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 3).alias("queue"), "event_id", "ts", F.floor(F.col("value") * 60).alias("seconds"))
    return queues.served(e, "queue", "event_id", "ts", F.col("seconds") * 1_000_000, TIMEOUT_S * 1_000_000, 86_400_000_000)


@register("queue_times", f"{_WALK} SELECT * FROM served")
def queue_times(spark, sf_dir):
    """When each job starts and ends on its machine, and whether it ran into the time-out."""
    return _served(spark, sf_dir)


@register("queue_log", f"{_WALK} SELECT queue, job, seq, status, \"at\" FROM (SELECT queue, job, 0 AS seq, 'queued' AS status, arrived AS \"at\" FROM served UNION ALL SELECT queue, job, 1, 'running', started FROM served UNION ALL SELECT queue, job, 2, status, ended FROM served)")
def queue_log(spark, sf_dir):
    """The statuses that jobs go through."""
    return queues.transitions(_served(spark, sf_dir))


@register("queue_places", f"{_WALK} SELECT a.queue, a.job, count(b.job) AS n_ahead FROM served a LEFT JOIN served b ON b.queue = a.queue AND (b.arrived, b.job) < (a.arrived, a.job) AND b.ended > a.arrived GROUP BY 1, 2")
def queue_places(spark, sf_dir):
    """How many jobs stand before each one when it arrives."""
    return queues.ahead(_served(spark, sf_dir))
