"""Queries of joins: twins, merges, interpolation, ranges, labels, positions, catalogs, sets of names."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..catalog import register
from ..operators import intervals, joins, manifests
from ..session import table


def signatures(spark, sf_dir):
    """Eight hashes for each vector: 63 bits each tell where neighbouring values rise; six are the same."""
    bits = F.aggregate(F.sequence(F.lit(1), F.lit(63)), F.lit(0).cast("long"), lambda a, i: F.shiftleft(a, 1) + F.when(F.get("embedding", i - 1) < F.get("embedding", i), 1).otherwise(0))
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding").withColumn("h", bits)
    return e.withColumn("hashes", F.array(F.col("h"), F.shiftright("h", 8), *[F.col("label").cast("long")] * 6))


_SIGNED = """signed AS (SELECT vec_id, label, embedding, list_reduce(range(1, 64), lambda a, i: (a * 2 + CASE WHEN embedding[i] < embedding[i + 1] THEN 1 ELSE 0 END)::BIGINT, 0::BIGINT) AS h FROM embeddings)"""


@register(
    "exact_twins",
    "SELECT a, b FROM (SELECT doc_id AS a, lead(doc_id) OVER (PARTITION BY md5(text) ORDER BY doc_id) AS b FROM documents WHERE text IS NOT NULL) WHERE b IS NOT NULL",
)
def exact_twins(spark, sf_dir):
    """Each text with the next equal one: all copies are connected, without all pairs of them."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("digest"))
    return joins.twin_pairs(d, "doc_id", "digest")


@register(
    "near_twins",
    f"""WITH {_SIGNED}, one AS (SELECT h, label, min(vec_id) AS vec_id FROM signed GROUP BY 1, 2), p AS (SELECT a.vec_id AS a, b.vec_id AS b,
        CAST(bit_count(xor(a.h, b.h)) + bit_count(xor(a.h >> 8, b.h >> 8)) + 6 * bit_count(xor(CAST(a.label AS BIGINT), CAST(b.label AS BIGINT))) AS INT) AS distance FROM one a JOIN one b ON a.vec_id < b.vec_id)
      SELECT * FROM p WHERE distance <= 56""",
)
def near_twins(spark, sf_dir):
    """Pairs of clips whose signatures differ in few bits."""
    return joins.near_frames(signatures(spark, sf_dir).select("vec_id", "hashes"), "vec_id", "hashes", most=56)


@register(
    "verified_twins",
    f"""WITH {_SIGNED}, one AS (SELECT h, label, min(vec_id) AS vec_id FROM signed GROUP BY 1, 2), p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM one a JOIN one b ON a.vec_id < b.vec_id
        WHERE bit_count(xor(a.h, b.h)) + bit_count(xor(a.h >> 8, b.h >> 8)) + 6 * bit_count(xor(CAST(a.label AS BIGINT), CAST(b.label AS BIGINT))) <= 56),
      m AS (SELECT a, b, list_sum(list_transform(range(1, 65), lambda i: abs(CAST(x.embedding[i] AS DOUBLE) - CAST(y.embedding[i] AS DOUBLE)))) / 64 AS mad FROM p JOIN embeddings x ON x.vec_id = a JOIN embeddings y ON y.vec_id = b)
      SELECT a, b, round(mad, 6) AS mad FROM m WHERE mad <= 0.15""",
)
def verified_twins(spark, sf_dir):
    """Near twins whose frames differ little at the same times, nearest first."""
    s = signatures(spark, sf_dir)
    pairs = joins.near_frames(s.select("vec_id", "hashes", "embedding"), "vec_id", "hashes", most=56, values="embedding", far=0.15)
    # whole millionths are sorted, which pack better
    apart = pairs.select("a", "b", F.round(F.round("mad", 6) * 1_000_000).cast("int").alias("m"))
    return apart.orderBy("m", "a", "b").select("a", "b", (F.col("m") / 1_000_000).alias("mad"))


@register(
    "rescanned_manifest",
    """WITH old AS (SELECT c_custkey, c_name AS name, CASE c_custkey % 3 WHEN 0 THEN c_mktsegment WHEN 1 THEN '' END AS angle, CASE WHEN c_custkey % 4 = 0 THEN 0.0 ELSE c_acctbal END AS cut, CASE WHEN c_custkey % 5 > 0 THEN 'out' || c_custkey END AS output FROM customer WHERE c_custkey % 2 = 0),
      new AS (SELECT c_custkey, c_name || '!' AS name, CASE WHEN c_custkey % 7 = 0 THEN 'fresh' END AS output FROM customer WHERE c_custkey % 3 < 2)
      SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, CASE WHEN n.c_custkey IS NOT NULL THEN n.name ELSE o.name END AS name, CASE WHEN n.c_custkey IS NULL THEN o.angle WHEN coalesce(o.angle, '') <> '' THEN o.angle END AS angle,
        CASE WHEN n.c_custkey IS NULL THEN o.cut WHEN o.cut <> 0 THEN o.cut END AS cut, CASE WHEN n.c_custkey IS NULL THEN o.output WHEN coalesce(n.output, '') <> '' OR o.output IS NULL THEN n.output ELSE o.output END AS output
      FROM old o FULL JOIN new n USING (c_custkey)""",
)
def rescanned_manifest(spark, sf_dir):
    """A new scan that keeps what people filled in and earlier outputs."""
    k, c = F.col("c_custkey"), table(spark, sf_dir, "customer")
    old = c.where(k % 2 == 0).select("c_custkey", F.col("c_name").alias("name"), F.when(k % 3 == 0, F.col("c_mktsegment")).when(k % 3 == 1, "").alias("angle"), F.when(k % 4 == 0, 0.0).otherwise(F.col("c_acctbal")).alias("cut"), F.when(k % 5 > 0, F.concat(F.lit("out"), k.cast("string"))).alias("output"))
    new = c.where(k % 3 < 2).select("c_custkey", F.concat("c_name", F.lit("!")).alias("name"), F.when(k % 7 == 0, "fresh").alias("output"))
    return manifests.rescanned(old, new, "c_custkey", ["angle", "cut"], ["output"])


@register(
    "merged_outputs",
    """WITH m AS (SELECT c_custkey, 'en' AS a, CASE WHEN c_custkey % 3 = 0 THEN 'new-en' ELSE 'old-en' END AS en, CASE WHEN c_custkey % 3 = 0 THEN 'new-de' END AS de, CASE WHEN c_custkey % 6 = 0 THEN c_name || '+' ELSE c_name END AS name FROM customer)
      SELECT c_custkey, en, de, name FROM m""",
)
def merged_outputs(spark, sf_dir):
    """Outputs of a run merged into a manifest: maps united, others replaced where given."""
    k, c = F.col("c_custkey"), table(spark, sf_dir, "customer")
    old = c.select("c_custkey", F.create_map(F.lit("en"), F.lit("old-en")).alias("outputs"), F.col("c_name").alias("name"))
    new = c.where(k % 3 == 0).select("c_custkey", F.create_map(F.lit("en"), F.lit("new-en"), F.lit("de"), F.lit("new-de")).alias("outputs"), F.when(k % 6 == 0, F.concat("c_name", F.lit("+"))).alias("name"))
    new = new.unionByName(new.limit(0)).unionByName(spark.createDataFrame([(-1, {"xx": "lost"}, "nobody")], new.schema))
    out = joins.upsert(old, new, "c_custkey", ["outputs", "name"], ("outputs",))
    part = lambda x: F.try_element_at("outputs", F.lit(x)).alias(x)
    return out.select("c_custkey", part("en"), part("de"), "name")


@register(
    "interpolated_boxes",
    """WITH k AS (SELECT user_id, event_id AS t, CAST(trunc(value * 10) AS INT) AS v FROM events WHERE event_type = 'view'), a AS (SELECT user_id, event_id AS t FROM events WHERE event_type <> 'view'),
      n AS (SELECT a.user_id, a.t, (SELECT max(k.t) FROM k WHERE k.user_id = a.user_id AND k.t <= a.t) AS lo, (SELECT min(k.t) FROM k WHERE k.user_id = a.user_id AND k.t >= a.t) AS hi FROM a)
      SELECT n.user_id, n.t, CASE WHEN lo IS NULL THEN h.v WHEN hi IS NULL THEN l.v ELSE CAST(trunc(l.v + (n.t - lo) / (hi - lo) * (h.v - l.v)) AS INT) END AS x, CASE WHEN lo IS NULL THEN -h.v WHEN hi IS NULL THEN -l.v ELSE CAST(trunc(-l.v + (n.t - lo) / (hi - lo) * (-h.v + l.v)) AS INT) END AS y
      FROM n LEFT JOIN k l ON l.user_id = n.user_id AND l.t = lo LEFT JOIN k h ON h.user_id = n.user_id AND h.t = hi""",
)
def interpolated_boxes(spark, sf_dir):
    """Boxes between their key frames; outside of these the nearest one's."""
    e = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("t"), "event_type", (F.col("value") * 10).cast("int").alias("v"))
    knots = e.where("event_type = 'view'").select("user_id", "t", F.array("v", -F.col("v")).alias("box"))
    out = joins.interpolated(e.where("event_type <> 'view'").select("user_id", "t"), knots, ["user_id"], "t", "box")
    return out.select("user_id", "t", F.col("box")[0].alias("x"), F.col("box")[1].alias("y"))


@register(
    "cut_samples",
    """WITH c AS (SELECT user_id, event_id AS a, event_id + value * 3 AS b FROM events WHERE event_type = 'error')
      SELECT e.event_id, EXISTS (SELECT 1 FROM c WHERE c.user_id = e.user_id AND c.a <= e.event_id AND e.event_id < c.b) AS cut, EXISTS (SELECT 1 FROM c WHERE c.user_id = e.user_id AND c.a <= e.event_id AND e.event_id <= floor(c.b)) AS shown FROM events e""",
)
def cut_samples(spark, sf_dir):
    """Whether samples are inside a cut (its end doesn't belong to it) or a window of frames (its end does)."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    b = F.col("event_id") + F.col("value") * 3
    spans = e.where("event_type = 'error'").select("user_id", F.col("event_id").alias("start"), b.alias("end"))
    cut = joins.in_spans(e.select("user_id", "event_id"), spans, ["user_id"], "event_id").withColumnRenamed("inside", "cut")
    windows = spans.withColumn("end", F.floor("end") + 0.5)
    return joins.in_spans(cut, windows, ["user_id"], "event_id", closed=True).select("event_id", "cut", F.col("inside").alias("shown"))


@register(
    "kept_lengths",
    """SELECT user_id, round_even(greatest(0, 9000 - sum(greatest(0, least(coalesce(CASE WHEN event_id % 97 > 0 THEN event_id % 2500 + value END, 9000), 9000) - event_id % 2500))), 3) AS kept FROM events GROUP BY 1""",
)
def kept_lengths(spark, sf_dir):
    """Durations less their cuts."""
    k = F.col("event_id")
    c = table(spark, sf_dir, "events").select("user_id", (k % 2500).cast("double").alias("start"), F.when(k % 97 > 0, k % 2500 + F.col("value")).alias("end"), F.lit(9000.0).alias("d"))
    return intervals.kept_length(c, ["user_id"], "d")


@register(
    "kept_segments",
    """WITH c AS (SELECT user_id, event_id % 100 * 1.0 AS s, least(CASE WHEN event_id % 97 > 0 THEN event_id % 100 + value / 15 END, 100.0) AS e FROM events), d AS (SELECT user_id, s, coalesce(e, 100.0) AS e FROM c),
      m AS (SELECT *, coalesce(s > max(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1e-6, true) AS fresh FROM d WHERE e > s),
      r AS (SELECT *, sum(CAST(fresh AS INT)) OVER (PARTITION BY user_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS run FROM m), u AS (SELECT user_id, min(s) AS s, max(e) AS e FROM r GROUP BY user_id, run),
      x AS (SELECT user_id, s, e FROM u UNION ALL SELECT DISTINCT user_id, 0, 0 FROM events UNION ALL SELECT DISTINCT user_id, 100, 100 FROM events),
      f AS (SELECT user_id, lag(e) OVER (PARTITION BY user_id ORDER BY s, e) AS a, s AS b FROM x), g AS (SELECT * FROM f WHERE b > a)
      SELECT user_id, round(CAST(a AS DOUBLE), 6) AS start, round(CAST(b AS DOUBLE), 6) AS "end" FROM g UNION ALL SELECT DISTINCT user_id, 0, 100 FROM events WHERE user_id NOT IN (SELECT user_id FROM g)""",
)
def kept_segments(spark, sf_dir):
    """What cuts leave of clips; a clip cut away altogether is kept whole."""
    k = F.col("event_id")
    e = table(spark, sf_dir, "events")
    cuts = e.select("user_id", (k % 100).cast("double").alias("start"), F.when(k % 97 > 0, k % 100 + F.col("value") / 15).alias("end"))
    spans = e.select("user_id").distinct().select("user_id", F.lit(0.0).alias("lo"), F.lit(100.0).alias("hi"))
    return intervals.kept_segments(cuts, spans, ["user_id"]).select("user_id", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"))


@register(
    "cut_frame_counts",
    """WITH c AS (SELECT user_id, CAST(round_even(event_id % 50 * 2.5, 0) AS BIGINT) AS a, least(CAST(round_even((event_id % 50 + value / 50) * 2.5, 0) AS BIGINT), 120) AS b FROM events WHERE event_type = 'view'),
      f AS (SELECT DISTINCT user_id, unnest(range(a, b)) AS frame FROM c WHERE b > a) SELECT user_id, count(*) AS n, CAST(sum(frame) AS BIGINT) AS total FROM f GROUP BY 1""",
)
def cut_frame_counts(spark, sf_dir):
    """The frames that a clip's cuts remove."""
    k = F.col("event_id")
    c = table(spark, sf_dir, "events").where("event_type = 'view'").select("user_id", (k % 50).cast("double").alias("start"), (k % 50 + F.col("value") / 50).alias("end"), F.lit(120).cast("long").alias("frames"))
    return intervals.cut_frames(c, ["user_id"], F.lit(2.5), "frames").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("frame").alias("total"))


@register(
    "merged_windows",
    """WITH w AS (SELECT l_orderkey, CAST(l_partkey % 60 AS DOUBLE) AS s, l_partkey % 60 + l_quantity / 20 AS e FROM lineitem), m AS (SELECT *, coalesce(s > max(e) OVER (PARTITION BY l_orderkey ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 0.6, true) AS fresh FROM w),
      r AS (SELECT *, sum(CAST(fresh AS INT)) OVER (PARTITION BY l_orderkey ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS run FROM m) SELECT l_orderkey, min(s) AS start, round(max(e), 4) AS "end" FROM r GROUP BY l_orderkey, run""",
)
def merged_windows(spark, sf_dir):
    """Windows less than a beat apart, as one."""
    s = (F.col("l_partkey") % 60).cast("double")
    w = table(spark, sf_dir, "lineitem").select("l_orderkey", s.alias("start"), (s + F.col("l_quantity") / 20).alias("end"))
    return intervals.union(w, ["l_orderkey"], tolerance=0.6).select("l_orderkey", "start", F.round("end", 4).alias("end"))


@register(
    "master_output_qa",
    """SELECT p_partkey, s_acctbal AS mix, round(s_acctbal - p_retailprice, 4) AS bed FROM part LEFT JOIN supplier ON s_suppkey = p_partkey""",
)
def master_output_qa(spark, sf_dir):
    """Masters with the measures of their outputs; null where there is no output."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("p_partkey"), F.nanvl("s_acctbal", F.lit(None).cast("double")).alias("mix"))
    return table(spark, sf_dir, "part").join(s, "p_partkey", "left").select("p_partkey", "mix", F.round(F.col("mix") - F.col("p_retailprice"), 4).alias("bed"))


@register(
    "label_map",
    """SELECT o_orderkey, coalesce(m.c, trim(raw)) AS label, m.c IS NULL AS unmapped FROM (SELECT o_orderkey, ' ' || o_orderpriority || ' ' AS raw FROM orders) LEFT JOIN (VALUES ('1-URGENT', 'now'), ('2-HIGH', 'now'), ('5-LOW', 'later')) m(r, c) ON trim(raw) = m.r""",
)
def label_map(spark, sf_dir):
    """Raw labels by their canonical ones; others stay."""
    m = spark.createDataFrame([("1-URGENT", "now"), ("2-HIGH", "now"), ("5-LOW", "later")], "raw string, label string")
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.trim("o_orderpriority").alias("raw"))
    j = o.join(F.broadcast(m), "raw", "left")  # three literal rows
    return j.select("o_orderkey", F.coalesce("label", "raw").alias("label"), F.col("label").isNull().alias("unmapped"))


@register(
    "unmapped_angles",
    "SELECT source, count(*) FILTER (lang NOT IN ('en', 'fr')) AS n_unmapped, count(*) FILTER (lang = 'en') AS n_north, count(*) FILTER (lang = 'fr') AS n_south FROM documents GROUP BY 1",
)
def unmapped_angles(spark, sf_dir):
    """Clips by campaign, and those whose angle belongs to none."""
    m = spark.createDataFrame([("en", "north"), ("fr", "south")], "lang string, campaign string")
    d = table(spark, sf_dir, "documents").select("source", "lang").join(F.broadcast(m), "lang", "left")
    return d.groupBy("source").agg(F.count_if(F.col("campaign").isNull()).alias("n_unmapped"), F.count_if(F.col("campaign") == "north").alias("n_north"), F.count_if(F.col("campaign") == "south").alias("n_south"))


@register(
    "riding_boxes",
    """SELECT l_orderkey, l_linenumber, abs(l_quantity + 5 - 25) <= 2.5 * 4 AND abs(l_partkey % 100 + 2 - 41) <= 2.5 * 4 AS on_phone FROM lineitem""",
)
def riding_boxes(spark, sf_dir):
    """Text boxes so near the phone that they ride with it."""
    box = F.array(F.col("l_quantity"), (F.col("l_partkey") % 100).cast("double"), F.lit(10.0), F.lit(4.0))
    phone = F.array(*map(F.lit, (23.0, 39.5, 4.0, 3.0)))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", joins.near_box(box, phone).alias("on_phone"))


@register(
    "zipped_translations",
    """WITH s AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) - 1 AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations),
      a AS (SELECT conv_id, list('t' || turn ORDER BY turn) FILTER (turn < 3) AS items FROM conversations WHERE conv_id % 5 > 0 GROUP BY 1)
      SELECT s.conv_id, s.turn, coalesce(items[i + 1], '') AS item, coalesce(len(items), 0) = n AS matched FROM s LEFT JOIN a USING (conv_id)""",
)
def zipped_translations(spark, sf_dir):
    """Segments with the translation at their position."""
    c = table(spark, sf_dir, "conversations")
    few = c.where((F.col("conv_id") % 5 > 0) & (F.col("turn") < 3)).withColumn("item", F.concat(F.lit("t"), F.col("turn").cast("string")))
    arrays = few.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "item"))), lambda x: x["item"]).alias("items"))
    return manifests.zipped(c.select("conv_id", "turn"), arrays, "conv_id", "turn", "items").select("conv_id", "turn", "item", "matched")


@register(
    "catalog_check",
    """WITH cat AS (SELECT DISTINCT p_brand || '-' || p_size AS voice FROM part WHERE p_size <= 25), conf AS (SELECT DISTINCT p_brand || '-' || p_size AS voice, p_brand AS locale FROM part WHERE p_size >= 20),
      alt AS (SELECT locale, voice, row_number() OVER (PARTITION BY locale ORDER BY voice) AS rn FROM (SELECT DISTINCT split_part(voice, '-', 1) AS locale, voice FROM cat))
      SELECT c.voice, coalesce(string_agg(alt.voice, ',' ORDER BY alt.voice), '') AS others FROM conf c LEFT JOIN alt ON alt.locale = c.locale AND rn <= 3 WHERE c.voice NOT IN (SELECT voice FROM cat) GROUP BY 1""",
)
def catalog_check(spark, sf_dir):
    """Configured voices that the catalog lacks, with the first three of the same locale."""
    voice = F.concat("p_brand", F.lit("-"), F.col("p_size").cast("string")).alias("voice")
    p = table(spark, sf_dir, "part")
    catalog = p.where("p_size <= 25").select(F.col("p_brand").alias("locale"), voice).distinct()
    missing = p.where("p_size >= 20").select(voice, F.col("p_brand").alias("locale")).distinct().join(catalog, "voice", "left_anti")
    first = catalog.withColumn("rn", F.row_number().over(Window.partitionBy("locale").orderBy("voice"))).where("rn <= 3")
    first = first.groupBy("locale").agg(F.array_join(F.array_sort(F.collect_list("voice")), ",").alias("others"))
    return missing.join(first, "locale", "left").select("voice", F.coalesce("others", F.lit("")).alias("others"))


@register(
    "resumed_files",
    "SELECT o_orderkey FROM orders WHERE o_orderkey % 3 > 0 AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 5)",
)
def resumed_files(spark, sf_dir):
    """Files of a list that exist and aren't in the log of those done."""
    done = table(spark, sf_dir, "lineitem").where("l_linenumber = 5").select(F.col("l_orderkey").alias("o_orderkey"))
    there = table(spark, sf_dir, "orders").where("o_orderkey % 3 > 0").select("o_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey").join(there, "o_orderkey", "left_semi").join(done, "o_orderkey", "left_anti")


@register(
    "folder_merges",
    "SELECT c_custkey, c_name AS name, c_custkey % 1000 NOT IN (SELECT s_suppkey FROM supplier) AS moved FROM customer WHERE c_custkey % 2 = 0",
)
def folder_merges(spark, sf_dir):
    """Files moved into another folder; those whose name is there stay."""
    source = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select("c_custkey", F.col("c_name").alias("name"), (F.col("c_custkey") % 1000).alias("k"))
    return manifests.folder_merge(source, table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k")), "k").select("c_custkey", "name", "moved")


@register(
    "clip_settings",
    """SELECT d.doc_id, round(CAST(coalesce(l.quality * 5.0, d.n_chars) AS DOUBLE), 2) AS keep, round(CAST(least(1.6, coalesce(l.quality * 5.0, d.n_chars) * 0.1) AS DOUBLE), 4) AS early, b.item_id AS box FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN benchmark b ON b.item_id = d.doc_id""",
)
def clip_settings(spark, sf_dir):
    """Clips with their cut, else their duration, and their boxes where they have some."""
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    d = d.join(table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), F.col("item_id").alias("box")), "doc_id", "left")
    keep = F.coalesce(F.col("quality") * 5.0, F.col("n_chars").cast("double"))
    return d.select("doc_id", F.round(keep, 2).alias("keep"), F.round(F.least(F.lit(1.6), keep * 0.1), 4).alias("early"), "box")


@register("ledger_state", "SELECT event_type || user_id % 20 AS key, arg_max(val, event_id) AS val, CASE WHEN arg_max(val, event_id) IN ('true', 'false') THEN arg_max(val, event_id) = 'true' END AS flag FROM (SELECT *, CASE event_id % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE 'v' || event_id END AS val FROM events) GROUP BY 1")
def ledger_state(spark, sf_dir):
    """The last value of each key."""
    k = F.col("event_id")
    val = F.when(k % 3 == 0, "true").when(k % 3 == 1, "false").otherwise(F.concat(F.lit("v"), k.cast("string")))
    w = table(spark, sf_dir, "events").select(F.concat("event_type", (F.col("user_id") % 20).cast("string")).alias("key"), val.alias("val"), "event_id")
    return manifests.ledger(w, "key", "val", "event_id")


@register("job_states", "SELECT user_id, arg_max(event_type, (ts, event_id)) AS status, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS ts FROM events GROUP BY 1")
def job_states(spark, sf_dir):
    """The last status of each job."""
    s = manifests.last_status(table(spark, sf_dir, "events"), "user_id", "event_type", "ts", "event_id")
    return s.select("user_id", F.col("event_type").alias("status"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))


@register("expired_jobs", "SELECT event_id FROM events WHERE event_type NOT IN ('view', 'click') AND ts < (SELECT max(ts) FROM events) - INTERVAL 86400 SECOND")
def expired_jobs(spark, sf_dir):
    """Jobs a day old that neither wait nor run."""
    e = table(spark, sf_dir, "events")
    now = e.agg(F.max("ts").cast("timestamp"))
    status = F.when(F.col("event_type") == "view", "queued").when(F.col("event_type") == "click", "running").otherwise("done")
    j = e.withColumns({"status": status, "ts": F.col("ts").cast("timestamp")}).withColumn("now", now.scalar())
    return manifests.expired(j, "status", "ts", F.col("now"), 86400).select("event_id")


@register("cached_results", "SELECT user_id, count(*) AS n, max(event_id) AS last FROM events WHERE event_type <> 'error' GROUP BY 1")
def cached_results(spark, sf_dir):
    """What is cached of results: errors are tried again."""
    return table(spark, sf_dir, "events").where("event_type <> 'error'").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last"))


@register("stage_timings", "SELECT user_id, event_type AS stage, round(sum(value), 3) AS seconds, count(*) AS n FROM events GROUP BY 1, 2")
def stage_timings(spark, sf_dir):
    """Seconds of each stage of a job."""
    return table(spark, sf_dir, "events").groupBy("user_id", F.col("event_type").alias("stage")).agg(F.round(F.sum("value"), 3).alias("seconds"), F.count(F.lit(1)).alias("n"))


@register("new_files", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 0)")
def new_files(spark, sf_dir):
    """Files of a scan that are still to be transcribed."""
    return manifests.todo(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id", F.col("toxic") == 0)


@register(
    "nearest_frames",
    """WITH t AS (SELECT user_id, event_id AS k, unix AS x FROM (SELECT *, epoch_us(ts) AS unix FROM events) WHERE event_type = 'error'), f AS (SELECT user_id, event_id, epoch_us(ts) AS x FROM events WHERE event_type = 'click')
      SELECT k, arg_min(f.x, (abs(f.x - t.x), f.x)) AS at FROM t JOIN f USING (user_id) GROUP BY 1""",
)
def nearest_frames(spark, sf_dir):
    """The frame nearest in time; the earlier one of equals."""
    e = table(spark, sf_dir, "events").where(F.col("event_type").isin("error", "click")).select("user_id", "event_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("x"))
    frame = F.when(F.col("event_type") == "click", F.col("x"))
    w = Window.partitionBy("user_id").orderBy("x")
    e = e.withColumns({"lo": F.max(frame).over(w.rangeBetween(Window.unboundedPreceding, 0)), "hi": F.min(frame).over(w.rangeBetween(0, Window.unboundedFollowing))})
    at = F.when(F.col("lo").isNull() | (F.col("hi") - F.col("x") < F.col("x") - F.col("lo")), F.col("hi")).otherwise(F.col("lo"))
    return e.where("event_type = 'error'").select(F.col("event_id").alias("k"), at.alias("at")).where("at is not null")


@register(
    "dub_jobs",
    """WITH t AS (SELECT doc_id, lang, n_chars, unnest(['en', 'de', 'fr', 'es']) AS target FROM documents)
      SELECT doc_id, target, CASE WHEN lang IS NOT DISTINCT FROM target THEN 'source' WHEN target = 'fr' AND doc_id % 2 = 0 OR target = 'es' THEN 'untranslated' WHEN target = 'de' AND n_chars * 100 > 100000 THEN 'exists' ELSE 'queued' END AS state FROM t""",
)
def dub_jobs(spark, sf_dir):
    """What is to be done for each clip and target language."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    complete = F.create_map(F.lit("en"), F.lit(True), F.lit("de"), F.lit(True), F.lit("fr"), F.col("doc_id") % 2 == 1)
    existing = d.select("doc_id", F.lit("de").alias("target"), (F.col("n_chars") * 100).alias("size"))
    return manifests.fan_out(d, "doc_id", ["en", "de", "fr", "es"], F.col("lang"), complete, existing)
