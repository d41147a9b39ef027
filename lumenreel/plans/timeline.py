"""Ordered analytics and joins on time: evictions, pages, runs, nearest samples, ranges, fan-out."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..catalog import register
from ..functions.levels import pacific_day
from ..operators import intervals, numbering
from ..session import table


@register(
    "lru_evict",
    """SELECT o_orderkey, o_custkey FROM (
      SELECT o_orderkey, o_custkey, sum(s) OVER (PARTITION BY o_custkey) AS total,
        coalesce(sum(s) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS freed
      FROM (SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS s FROM orders)) WHERE total > 1000000 AND total - freed > 800000""",
)
def lru_evict(spark, sf_dir):
    """Files dropped, oldest first, until a cache above its cap is at 80 % of it."""
    w = Window.partitionBy("o_custkey")
    freed = F.coalesce(F.sum("s").over(w.orderBy("o_orderdate", "o_orderkey").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    o = table(spark, sf_dir, "orders").withColumn("s", F.floor("o_totalprice").cast("bigint"))
    o = o.select("o_orderkey", "o_custkey", F.sum("s").over(w).alias("total"), freed.alias("freed"))
    return o.where((F.col("total") > 1_000_000) & (F.col("total") - F.col("freed") > 800_000)).select("o_orderkey", "o_custkey")


@register(
    "lru_count",
    "SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn <= 5",
)
def lru_count(spark, sf_dir):
    """The five entries of each user that were used last."""
    w = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))
    return table(spark, sf_dir, "events").select("user_id", "event_id", F.row_number().over(w).alias("rn")).where("rn <= 5").drop("rn")


@register(
    "page_assign",
    "SELECT l_orderkey, l_linenumber, CAST((row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1) // 3 AS BIGINT) AS page FROM lineitem",
)
def page_assign(spark, sf_dir):
    """Three items to a sheet, in order."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.floor((F.row_number().over(w) - 1) / 3).cast("bigint").alias("page"))


@register(
    "event_pairs",
    """WITH m AS (SELECT user_id, event_id, event_type, lead(event_type) OVER w AS t2, lead(event_id) OVER w AS e2
        FROM events WHERE event_type IN ('view', 'purchase') WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
      SELECT user_id, event_id AS "first", CASE WHEN t2 = 'purchase' THEN e2 END AS "last" FROM m WHERE event_type = 'view' AND (t2 IS NULL OR t2 = 'purchase')""",
)
def event_pairs(spark, sf_dir):
    """Starts with their ends: of starts in a row the last counts; one that stays open has no end."""
    w = Window.partitionBy("user_id").orderBy("event_id")
    m = table(spark, sf_dir, "events").where(F.col("event_type").isin("view", "purchase"))
    m = m.select("user_id", "event_id", "event_type", F.lead("event_type").over(w).alias("t2"), F.lead("event_id").over(w).alias("e2"))
    m = m.where((F.col("event_type") == "view") & (F.col("t2").isNull() | (F.col("t2") == "purchase")))
    return m.select("user_id", F.col("event_id").alias("first"), F.when(F.col("t2") == "purchase", F.col("e2")).alias("last"))


_SPANS = """m AS (SELECT user_id, event_id, event_type, epoch_us(ts) AS t, lead(event_type) OVER w AS t2, lead(epoch_us(ts)) OVER w AS e2 FROM events WHERE event_type IN ('view', 'purchase') WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
      length AS (SELECT user_id, max(epoch_us(ts)) AS eof FROM events GROUP BY 1), span AS (SELECT user_id, t AS "start", CASE WHEN t2 = 'purchase' THEN e2 ELSE eof END AS "end", eof FROM m JOIN length USING (user_id) WHERE event_type = 'view' AND (t2 IS NULL OR t2 = 'purchase'))"""


def _spans(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    length = e.groupBy("user_id").agg(F.max("t").alias("eof"))
    return intervals.paired(e, ["user_id"], "event_id", "t", F.col("event_type") == "view", F.col("event_type") == "purchase", length, "eof")


@register("event_spans", f'WITH {_SPANS} SELECT user_id, "start", "end" FROM span')
def event_spans(spark, sf_dir):
    """Starts with their ends, the last open one up to the end of the file."""
    return _spans(spark, sf_dir).select("user_id", "start", "end")


@register("closing_spans", f'WITH {_SPANS} SELECT user_id, min("start") AS "start" FROM span WHERE "end" >= eof - 86400000000 GROUP BY 1')
def closing_spans(spark, sf_dir):
    """Where the block begins that reaches the end, or nearly."""
    return _spans(spark, sf_dir).where(F.col("end") >= F.col("eof") - 86_400_000_000).groupBy("user_id").agg(F.min("start").alias("start"))


@register(
    "prefix_run",
    """WITH n AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS pos, value < 60 AS ok FROM events)
      SELECT user_id, count(*) AS n, coalesce(min(pos) FILTER (NOT ok) - 1, count(*)) AS run FROM n GROUP BY 1""",
)
def prefix_run(spark, sf_dir):
    """How many of each user's samples hold from the start until the first miss."""
    w = Window.partitionBy("user_id").orderBy("event_id")
    n = table(spark, sf_dir, "events").select("user_id", F.row_number().over(w).cast("bigint").alias("pos"), (F.col("value") < 60).alias("ok"))
    count = F.count(F.lit(1))
    return n.groupBy("user_id").agg(count.alias("n"), F.coalesce(F.min(F.when(~F.col("ok"), F.col("pos"))) - 1, count).alias("run"))


@register("last_seen", "SELECT user_id, max(event_id) FILTER (value > 100) AS last_id, count(*) AS n FROM events GROUP BY 1")
def last_seen(spark, sf_dir):
    """The last sample in which the subject is seen."""
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.max(F.when(F.col("value") > 100, F.col("event_id"))).alias("last_id"), F.count(F.lit(1)).alias("n"))


@register(
    "nearest_sample",
    """SELECT a.event_id, min_by(b.event_id, (abs(date_diff('microsecond', a.ts, b.ts)), b.event_id)) AS near_id
    FROM events a JOIN events b ON a.user_id = b.user_id AND b.event_type = 'click' WHERE a.event_type = 'error' GROUP BY 1""",
)
def nearest_sample(spark, sf_dir):
    """For each error the click of the same user nearest in time; ties go to the lower id. The last
    click before and the first one after are carried along the ordered events: no pairs are made."""
    e = table(spark, sf_dir, "events").where(F.col("event_type").isin("error", "click"))
    e = e.withColumns({"t": F.unix_micros(F.col("ts").cast("timestamp")), "is_click": F.col("event_type") == "click"})
    click = F.when(F.col("is_click"), F.struct("t", "event_id"))
    # clicks of one instant: the lowest id stands for them
    first = F.when(F.col("is_click"), F.struct("t", F.min(F.when(F.col("is_click"), F.col("event_id"))).over(Window.partitionBy("user_id", "t")).alias("event_id")))
    e = e.withColumn("c", F.when(click.isNotNull(), first))
    w = Window.partitionBy("user_id").orderBy("t")
    e = e.withColumns({"p": F.max("c").over(w.rangeBetween(Window.unboundedPreceding, 0)), "q": F.min("c").over(w.rangeBetween(0, Window.unboundedFollowing))})
    far = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.abs(F.col(c)["t"] - F.col("t")).alias("far"), F.col(c)["event_id"].alias("id")))
    e = e.where(~F.col("is_click")).select("event_id", F.array_min(F.array_compact(F.array(far("p"), far("q"))))["id"].alias("near_id"))
    return e.where(F.col("near_id").isNotNull())


@register(
    "language_fanout",
    """SELECT doc_id, t.lang AS target FROM documents d, (VALUES ('en'), ('de'), ('fr'), ('es')) t(lang) WHERE d.lang IS DISTINCT FROM t.lang""",
)
def language_fanout(spark, sf_dir):
    """A job for each document and target language but its own; the targets are a fixed list."""
    targets = F.explode(F.array(*map(F.lit, ("en", "de", "fr", "es"))))
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", targets.alias("target"))
    return d.where(~F.col("lang").eqNullSafe(F.col("target"))).select("doc_id", "target")


@register(
    "collision_suffix",
    """SELECT p_partkey, CASE WHEN rn = 1 THEN p_brand ELSE p_brand || '_dup' || (rn - 1) END AS name
    FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rn FROM part)""",
)
def collision_suffix(spark, sf_dir):
    """The first of a name keeps it; others are numbered."""
    p = numbering.numbered(table(spark, sf_dir, "part"), ["p_brand"], ["p_partkey"])
    name = F.when(F.col("place") == 1, F.col("p_brand")).otherwise(F.concat("p_brand", F.lit("_dup"), (F.col("place") - 1).cast("string")))
    return p.select("p_partkey", name.alias("name"))


@register(
    "daily_counter",
    """SELECT user_id, strftime(day, '%Y-%m-%d') AS day, count(*) AS n, count(*) >= 2 AS warn FROM (SELECT user_id, CAST(ts - INTERVAL 8 HOUR AS DATE) AS day FROM events) GROUP BY 1, 2""",
)
def daily_counter(spark, sf_dir):
    """Requests of each key and Pacific day, with a warning at the threshold. (The table's days are in winter.)"""
    n = F.count(F.lit(1))
    day = pacific_day(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").groupBy("user_id", F.date_format(day, "yyyy-MM-dd").alias("day")).agg(n.alias("n"), (n >= 2).alias("warn"))


@register(
    "carried_headers",
    """SELECT user_id, event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS header FROM events""",
)
def carried_headers(spark, sf_dir):
    """Each line with the last header before it."""
    w = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)
    header = F.last(F.when(F.col("event_type") == "signup", F.col("event_id")), ignorenulls=True).over(w)
    return table(spark, sf_dir, "events").select("user_id", "event_id", header.alias("header"))


@register(
    "majority_region",
    """WITH c AS (SELECT s_nationkey % 7 AS pack, n_regionkey, count(*) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2)
      SELECT CAST(pack AS BIGINT) AS pack, CAST(arg_max(n_regionkey, (n, -n_regionkey)) AS BIGINT) AS region FROM c GROUP BY 1""",
)
def majority_region(spark, sf_dir):
    """The commonest region of each pack; the first of equals."""
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    c = s.groupBy((F.col("s_nationkey") % 7).cast("bigint").alias("pack"), "n_regionkey").agg(F.count(F.lit(1)).alias("n"))
    return c.groupBy("pack").agg(F.max_by("n_regionkey", F.struct("n", -F.col("n_regionkey"))).cast("bigint").alias("region"))
