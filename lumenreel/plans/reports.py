"""Reports, gates, joins with dimensions and rule engines over the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..catalog import register
from ..functions import text as X
from ..session import table


@register("frequency", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, 1")
def frequency(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "o_orderpriority")


@register(
    "campaign_tree",
    """SELECT r_name, n_name, count(*) AS n_ads, sum(count(*)) OVER (PARTITION BY r_name) AS n_campaign
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
)
def campaign_tree(spark, sf_dir):
    c = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n_ads"))
    t = c.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    t = t.groupBy("r_name", "n_name").agg(F.sum("n_ads").alias("n_ads"))
    return t.withColumn("n_campaign", F.sum("n_ads").over(Window.partitionBy("r_name")))


@register(
    "status_rollup",
    """SELECT o_orderstatus, count(*) AS n, count(*) FILTER (o_totalprice > 200000) AS n_large, count(DISTINCT o_custkey) AS n_customers,
      string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) FILTER (rn <= 12) AS first_keys
    FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS rn FROM orders) GROUP BY 1""",
)
def status_rollup(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    counts = o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_totalprice") > 200000).alias("n_large"), F.countDistinct("o_custkey").alias("n_customers"))
    w = Window.partitionBy("o_orderstatus").orderBy("o_orderkey")
    few = o.withColumn("rn", F.row_number().over(w)).where("rn <= 12").groupBy("o_orderstatus")
    names = few.agg(F.array_join(F.array_sort(F.collect_list("o_orderkey")).cast("array<string>"), ",").alias("first_keys"))
    return counts.join(names, "o_orderstatus")


@register(
    "strict_gate",
    """SELECT count(*) AS n, count(*) FILTER (text IS NULL OR trim(text) = '') AS n_blank, count(*) FILTER (n_chars < 20) AS n_short,
      CASE WHEN count(*) FILTER (text IS NULL OR trim(text) = '') + count(*) FILTER (n_chars < 20) > 0 THEN 'BLOCKED' ELSE 'READY' END AS verdict FROM documents""",
)
def strict_gate(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    blank, short = F.count_if(X.blank(F.col("text"))), F.count_if(F.col("n_chars") < 20)
    return d.agg(F.count(F.lit(1)).alias("n"), blank.alias("n_blank"), short.alias("n_short"), F.when(blank + short > 0, "BLOCKED").otherwise("READY").alias("verdict"))


@register("todo", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def todo(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left_anti")


@register("selected", "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def selected(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels").where("quality = 1"), "doc_id", "left_semi")


@register(
    "pinned_first",
    "SELECT n_nationkey, n_name, CAST(row_number() OVER (ORDER BY CASE n_name WHEN 'VIETNAM' THEN 0 WHEN 'UNITED KINGDOM' THEN 1 ELSE 2 END, n_name) AS BIGINT) AS place FROM nation",
)
def pinned_first(spark, sf_dir):
    pin = F.when(F.col("n_name") == "VIETNAM", 0).when(F.col("n_name") == "UNITED KINGDOM", 1).otherwise(2)
    # the dimension has a row for each nation; one task is enough
    return table(spark, sf_dir, "nation").select("n_nationkey", "n_name", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(pin, "n_name")).cast("bigint").alias("place"))


@register("newest_first", "SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 20")
def newest_first(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "ts", "event_type").orderBy(F.desc("ts"), F.desc("event_id")).limit(20)


@register(
    "first_match_rules",
    """SELECT p_partkey, CASE WHEN p_size > 40 THEN 'high' WHEN p_retailprice > 1500 THEN 'pricey' WHEN p_brand LIKE '%1' THEN 'one' ELSE 'calm' END AS bucket FROM part""",
)
def first_match_rules(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", F.when(F.col("p_size") > 40, "high").when(F.col("p_retailprice") > 1500, "pricey").when(F.col("p_brand").like("%1"), "one").otherwise("calm").alias("bucket"))


@register(
    "top3_coverage",
    """WITH c AS (SELECT source, lang, count(*) AS n, row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, lang) AS rn FROM documents GROUP BY 1, 2)
    SELECT source, sum(n) FILTER (rn <= 3) * 1.0 / sum(n) >= 0.55 AS flat FROM c GROUP BY 1""",
)
def top3_coverage(spark, sf_dir):
    c = table(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"))
    ranked = c.groupBy("source").agg(F.sort_array(F.collect_list("n"), asc=False).alias("ns"))  # a row for each language
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)
    return ranked.select("source", (total(F.slice("ns", 1, 3)) / total(F.col("ns")) >= 0.55).alias("flat"))


@register(
    "distinct_enrich",
    """SELECT conv_id, turn, coalesce(upper(m.role), 'NONE') AS label FROM conversations c LEFT JOIN (SELECT DISTINCT role FROM conversations) m ON c.role = m.role""",
)
def distinct_enrich(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    m = c.select("role").distinct().withColumn("label", F.upper("role"))
    return c.join(m, "role", "left").select("conv_id", "turn", F.coalesce("label", F.lit("NONE")).alias("label"))
