"""Timed-text and track queries. Segments stand for line items: the clip is the order, times in
whole seconds come from quantities; samples stand for events of a user."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..catalog import register
from ..functions import text as X
from ..operators import intervals, joins, numbering
from ..session import table

SEGMENTS = """segment AS (
  SELECT l_orderkey AS clip_id, l_linenumber AS seg_id, CAST(l_partkey % 200 AS DOUBLE) AS start,
         CAST(l_partkey % 200 + l_quantity AS DOUBLE) AS "end", -l_discount * 10 AS avg_logprob, l_shipdate AS at
  FROM lineitem)"""


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("clip_id"),
        F.col("l_linenumber").alias("seg_id"),
        (F.col("l_partkey") % 200).cast("double").alias("start"),
        (F.col("l_partkey") % 200 + F.col("l_quantity")).cast("double").alias("end"),
        (-F.col("l_discount") * 10).alias("avg_logprob"),
    )


@register(
    "srt_times",
    """WITH t AS (SELECT l_orderkey AS clip_id, l_linenumber AS seg_id, CAST(round_even(l_extendedprice / 7.3::DOUBLE * 1000, 0) AS BIGINT) AS ms FROM lineitem)
    SELECT clip_id, seg_id, printf('%02d:%02d:%02d,%03d', ms // 3600000, ms // 60000 % 60, ms // 1000 % 60, ms % 1000) AS start_text FROM t""",
)
def srt_times(spark, sf_dir):
    """Times to the millisecond, over hours."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("clip_id"), F.col("l_linenumber").alias("seg_id"), X.srt_time(F.col("l_extendedprice") / 7.3).alias("start_text"))


@register(
    "speech_gate",
    f"""WITH {SEGMENTS}, good AS (SELECT * FROM segment WHERE avg_logprob > -0.5)
    SELECT c.clip_id, coalesce(sum(g."end" - g.start), 0) AS speech, coalesce(sum(g."end" - g.start), 0) >= greatest(1.5, 0.05 * max(c.duration)) AS has_voice
    FROM (SELECT clip_id, max("end") AS duration FROM segment GROUP BY 1) c LEFT JOIN good g USING (clip_id) GROUP BY 1""",
)
def speech_gate(spark, sf_dir):
    s = segments(spark, sf_dir)
    speech = F.coalesce(F.sum(F.when(F.col("avg_logprob") > -0.5, F.col("end") - F.col("start"))), F.lit(0.0))
    g = s.groupBy("clip_id").agg(speech.alias("speech"), F.max("end").alias("duration"))
    return g.select("clip_id", "speech", (F.col("speech") >= F.greatest(F.lit(1.5), 0.05 * F.col("duration"))).alias("has_voice"))


_UNION = f"""WITH {SEGMENTS}, m AS (
      SELECT *, coalesce(start > max("end") OVER (PARTITION BY clip_id ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS fresh
      FROM segment WHERE "end" > start),
    r AS (SELECT *, sum(CAST(fresh AS INT)) OVER (PARTITION BY clip_id ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS run FROM m),
    u AS (SELECT clip_id, min(start) AS start, max("end") AS "end" FROM r GROUP BY clip_id, run)"""


@register("interval_union", _UNION + ' SELECT clip_id, start, "end" FROM u')
def interval_union(spark, sf_dir):
    return intervals.union(segments(spark, sf_dir), ["clip_id"])


@register(
    "interval_complement",
    _UNION
    + """, e AS (SELECT clip_id, greatest(start, 0) AS s, least("end", 250) AS e FROM u UNION ALL SELECT DISTINCT clip_id, 0, 0 FROM u UNION ALL SELECT DISTINCT clip_id, 250, 250 FROM u)
    SELECT * FROM (SELECT clip_id, lag(e) OVER (PARTITION BY clip_id ORDER BY s, e) AS start, s AS "end" FROM e) WHERE "end" > start""",
)
def interval_complement(spark, sf_dir):
    u = intervals.union(segments(spark, sf_dir), ["clip_id"])
    return intervals.complement(u, u.select("clip_id").distinct().select("clip_id", F.lit(0.0).alias("lo"), F.lit(250.0).alias("hi")), ["clip_id"])


@register(
    "silence_gaps",
    f"""WITH {SEGMENTS}, g AS (SELECT clip_id, "end" AS start, coalesce(lead(start) OVER (PARTITION BY clip_id ORDER BY start, "end"), 260) AS "end" FROM segment
      UNION ALL SELECT clip_id, 0, min(start) FROM segment GROUP BY 1)
    SELECT * FROM g WHERE "end" - start > 0.01""",
)
def silence_gaps(spark, sf_dir):
    """Silence before the first segment, between segments, and to the end of the clip."""
    return intervals.with_gaps(segments(spark, sf_dir).withColumn("d", F.lit(260.0)), ["clip_id"], 0.01, duration="d")


@register(
    "state_runs",
    """WITH m AS (SELECT user_id, event_id, event_type, CAST(event_type IS DISTINCT FROM lag(event_type) OVER w OR lag(event_id) OVER w IS NULL AS INT) AS fresh
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
      r AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS run FROM m)
    SELECT user_id, CAST(run AS BIGINT) AS run, min(event_type) AS value, min(event_id) AS "first", max(event_id) AS "last", count(*) AS n FROM r GROUP BY 1, 2""",
)
def state_runs(spark, sf_dir):
    return intervals.runs(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id", "event_type")


@register(
    "sequence_numbers",
    """SELECT o_orderkey, CAST(row_number() OVER w AS BIGINT) AS seq,
      o_orderstatus || '_' || strftime(o_orderdate, '%d%m') || lpad(CAST(row_number() OVER w AS VARCHAR), CASE WHEN count(*) OVER p <= 99 THEN 2 ELSE greatest(3, length(CAST(count(*) OVER p AS VARCHAR))) END::INT, '0') AS name
    FROM orders WINDOW w AS (PARTITION BY strftime(o_orderdate, '%d%m') ORDER BY o_orderkey), p AS (PARTITION BY strftime(o_orderdate, '%d%m'))""",
)
def sequence_numbers(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("day", F.date_format("o_orderdate", "ddMM"))
    n = numbering.sequence_names(o, ["day"], ["o_orderkey"], F.col("o_orderstatus"), F.col("day"))
    return n.select("o_orderkey", F.col("seq").cast("bigint").alias("seq"), "name")


@register(
    "copy_rotation",
    "SELECT c_custkey, c_nationkey, CAST((row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) % 5 AS BIGINT) AS slot FROM customer",
)
def copy_rotation(spark, sf_dir):
    r = numbering.rotation(table(spark, sf_dir, "customer"), ["c_nationkey"], ["c_custkey"], 5)
    return r.select("c_custkey", "c_nationkey", F.col("slot").cast("bigint").alias("slot"))


@register(
    "translation_batches",
    """WITH r AS (SELECT conv_id, text, row_number() OVER w AS rn FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, text)),
      b AS (SELECT conv_id, CAST((rn - 1) // 2 AS BIGINT) AS batch, min(rn) AS lo, max(rn) AS hi, string_agg(text, '|' ORDER BY rn) AS texts FROM r GROUP BY 1, 2)
    SELECT b.conv_id, b.batch, b.texts, coalesce(string_agg(r.text, '|' ORDER BY r.rn) FILTER (r.rn < b.lo), '') AS before, coalesce(string_agg(r.text, '|' ORDER BY r.rn) FILTER (r.rn > b.hi), '') AS after
    FROM b JOIN r ON r.conv_id = b.conv_id AND r.rn BETWEEN b.lo - 2 AND b.hi + 2 GROUP BY ALL""",
)
def translation_batches(spark, sf_dir):
    """Batches of segments, with up to two before and after each batch for context."""
    b = numbering.batches(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn", "text"], 2, "text")
    return b.select("conv_id", "batch", *[F.array_join(c, "|").alias(c) for c in ("texts", "before", "after")])


@register(
    "exact_duplicates",
    """SELECT doc_id, md5(text) AS digest, min(doc_id) OVER p AS first_key, count(*) OVER p AS n_copies FROM documents WINDOW p AS (PARTITION BY md5(text))""",
)
def exact_duplicates(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("digest"))
    return joins.exact_copies(d, "doc_id", "digest").select("doc_id", "digest", "first_key", "n_copies")


@register(
    "latest_view",
    """SELECT e.event_id, e.user_id, (SELECT max_by(v.event_id, v.ts) FROM events v WHERE v.user_id = e.user_id AND v.event_type = 'view' AND v.ts <= e.ts) AS view_id
    FROM events e WHERE e.event_type = 'purchase'""",
)
def latest_view(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    views = e.where("event_type = 'view'").groupBy("user_id", "ts").agg(F.max("event_id").alias("view_id"))
    asked = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return joins.latest_before(asked, views, ["user_id"], "ts", "view_id").select("event_id", "user_id", "view_id")


@register(
    "text_shape",
    r"""SELECT conv_id, turn, length(text) AS n_chars, len(regexp_extract_all(text, '[\p{L}\p{M}\p{Nd}\p{Pc}'']+')) AS n_words, regexp_replace(regexp_replace(text, '[^\p{L}\p{M}\p{Nd}\p{Pc}\s\-/]', '', 'g'), '[/ ]', '_', 'g') AS slug,
      CASE WHEN length(trim(regexp_replace(text, '\s+', ' ', 'g'))) > 40 THEN substr(trim(regexp_replace(text, '\s+', ' ', 'g')), 1, 37) || '...' ELSE trim(regexp_replace(text, '\s+', ' ', 'g')) END AS short_text FROM conversations""",
)
def text_shape(spark, sf_dir):
    """Length, words, slug and short form of texts."""
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", F.length("text").cast("bigint").alias("n_chars"), X.word_count(F.col("text")).cast("bigint").alias("n_words"), X.slug(F.col("text")).alias("slug"), X.compact(F.col("text"), 40).alias("short_text"))


@register(
    "box_overlap",
    """WITH b AS (SELECT p_partkey, p_size * 1.0 AS x, p_size * 2.0 AS y FROM part), i AS (
      SELECT p_partkey, greatest(0, least(x + 10, y + 10) - greatest(x, y)) * 10.0 AS shared FROM b)
    SELECT p_partkey, round(CAST(shared AS DOUBLE) / (200 - CAST(shared AS DOUBLE)), 6) AS iou FROM i""",
)
def box_overlap(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumns({"x": F.col("p_size") * 1.0, "y": F.col("p_size") * 2.0})
    a = F.array(F.col("x"), F.lit(0.0), F.col("x") + 10, F.lit(10.0))
    b = F.array(F.col("y"), F.lit(0.0), F.col("y") + 10, F.lit(10.0))
    return p.select("p_partkey", F.round(X.iou(a, b), 6).alias("iou"))


@register(
    "aspect_classes",
    """SELECT p_partkey, CASE WHEN abs(r - 0.5625) <= 0.02 THEN 'OK' WHEN r < 0.5625 THEN 'taller' ELSE 'WIDE' END AS aspect
    FROM (SELECT p_partkey, round((p_size + 20.0) / 80.0, 3) AS r FROM part)""",
)
def aspect_classes(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", X.aspect_class(F.col("p_size") + 20.0, F.lit(80.0)).alias("aspect"))


@register(
    "longest_segments",
    f"""WITH {SEGMENTS} SELECT clip_id, seg_id, CAST(rank AS BIGINT) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY "end" - start DESC, seg_id) AS rank FROM segment) WHERE rank <= 2""",
)
def longest_segments(spark, sf_dir):
    s = segments(spark, sf_dir)
    return numbering.top_per_group(s, ["clip_id"], [(F.col("end") - F.col("start")).desc(), "seg_id"], 2).select("clip_id", "seg_id", F.col("rank").cast("bigint").alias("rank"))


@register(
    "frame_delta",
    """SELECT event_id, user_id, CASE WHEN abs(value - coalesce(lag(value) OVER w, value)) > 25 THEN 'cut' ELSE 'same' END AS scene FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)""",
)
def frame_delta(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("event_id")
    diff = F.abs(F.col("value") - F.coalesce(F.lag("value").over(w), F.col("value")))
    return table(spark, sf_dir, "events").select("event_id", "user_id", F.when(diff > 25, "cut").otherwise("same").alias("scene"))
