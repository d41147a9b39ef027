"""Queries of loudness, speed, time estimates, capacity and quotas."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import dims
from ..catalog import register
from ..functions import levels as L
from ..functions import text as X
from ..operators import alerts
from ..session import table

_LIMITS = "model(name, rpm, tpm, rpd) AS (VALUES " + ", ".join(f"('{k}', {r}, {t}, {d})" for k, (r, t, d) in dims.MODEL_LIMITS.items()) + ")"


@register(
    "window_levels",
    """WITH s AS (SELECT user_id, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 4 AS win, value / 200 AS x FROM events)
      SELECT user_id, CAST(win AS BIGINT) AS win, round(20 * log10(sqrt(avg(x * x)) + 1e-12), 4) AS level, round(20 * log10(max(abs(x)) + 1e-12), 4) AS peak FROM s GROUP BY 1, 2""",
)
def window_levels(spark, sf_dir):
    """Mean and peak level of each window of samples."""
    n = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    s = table(spark, sf_dir, "events").select("user_id", F.floor(n / 4).cast("bigint").alias("win"), (F.col("value") / 200).alias("x"))
    return s.groupBy("user_id", "win").agg(F.round(L.decibel(F.avg(F.col("x") * F.col("x"))), 4).alias("level"), F.round(20 * F.log10(F.max(F.abs("x")) + 1e-12), 4).alias("peak"))


_STEMS = "stem AS (SELECT l_orderkey, l_linenumber, -l_quantity - 5 AS v, -l_discount * 700 AS b, 4 + l_linenumber * 2.0 AS margin, 0.2 + l_linenumber * 0.2 AS vv, 0.1 + l_tax * 10 AS bv FROM lineitem)"


def stems(spark, sf_dir):
    n = F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (-F.col("l_quantity") - 5).alias("v"), (-F.col("l_discount") * 700).alias("b"), (4 + n * 2.0).alias("margin"), (0.2 + n * 0.2).alias("vv"), (0.1 + F.col("l_tax") * 10).alias("bv")
    )


@register(
    "mix_gains",
    f"""WITH {_STEMS}, m AS (SELECT *, (v + 20 * log10(vv)) - (b + 20 * log10(bv)) AS have FROM stem)
      SELECT l_orderkey, l_linenumber, round(CASE WHEN v <= -45 THEN 0.0 ELSE greatest(-12.0, least(20.0, -16.0 - v)) END, 4) AS voice_gain,
        round(CASE WHEN v <= -45 THEN greatest(-40.0, least(20.0, -16.0 - b)) ELSE greatest(-40.0, least(20.0, -16.0 - margin - b)) END, 4) AS bed_gain, CASE WHEN v <= -45 THEN 'NOVOICE_FALLBACK' ELSE 'MEASURED' END AS verdict,
        round(CASE WHEN v > -50 AND b > -60 AND have < 8 THEN bv / pow(10.0, (8 - have) / 20) ELSE bv END, 6) AS bed_volume FROM m""",
)
def mix_gains(spark, sf_dir):
    """Gains that bring voice and music to their targets, and the music's volume under its guard."""
    s = stems(spark, sf_dir)
    voice, bed, verdict = L.mix_gains(F.col("v"), F.col("b"), F.col("margin"))
    guarded = L.guarded_bed(F.col("v"), F.col("b"), F.col("vv"), F.col("bv"))
    return s.select("l_orderkey", "l_linenumber", F.round(voice, 4).alias("voice_gain"), F.round(bed, 4).alias("bed_gain"), verdict.alias("verdict"), F.round(guarded, 6).alias("bed_volume"))


@register(
    "tempo_chains",
    """WITH r AS (SELECT p_partkey, p_size / 4.0::DOUBLE AS ratio FROM part), k AS (SELECT *, greatest(0, CAST(ceil(log2(ratio)) AS INT) - 1) AS twos FROM r)
      SELECT p_partkey, CASE WHEN ratio > 1 THEN twos + 1 ELSE 0 END AS n, CASE WHEN ratio > 1 THEN round_even(ratio / pow(2, twos), 4) END AS last FROM k""",
)
def tempo_chains(spark, sf_dir):
    """Speed-ups in steps of at most two."""
    chain = L.tempo_chain(F.col("p_size") / 4.0)
    return table(spark, sf_dir, "part").select("p_partkey", F.size(chain).alias("n"), F.try_element_at(chain, F.lit(-1)).alias("last"))


_JOBS = """job AS (SELECT p_partkey, p_size * 3.0 AS d, p_size % 7 = 0 AS convert_only, p_size % 2 = 0 AS conv, p_size % 3 = 0 AS dub, p_size % 5 < 3 AS music, p_size % 4 = 1 AS ocr, p_partkey % 3 = 0 AS large, p_partkey % 5 > 0 AS gpu,
    CAST(p_partkey % 6 AS INT) AS n FROM part)"""


@register(
    "eta_model",
    f"""WITH {_JOBS}, e AS (SELECT *, CASE WHEN gpu THEN CAST(1 AS DOUBLE) ELSE 6 END AS slow, greatest(d, 1.0)::DOUBLE AS vd FROM job),
      p AS (SELECT *, vd * 0.35::DOUBLE * CASE WHEN large THEN 3.0::DOUBLE ELSE 1 END + CASE WHEN dub AND music THEN vd * 0.6::DOUBLE ELSE 0 END + CASE WHEN conv THEN vd * 0.3::DOUBLE ELSE 0 END AS shared,
        (vd * 0.25::DOUBLE + CASE WHEN dub THEN vd * 0.4::DOUBLE ELSE 0 END) * CASE WHEN ocr THEN 1.3::DOUBLE ELSE 1 END AS each FROM e)
      SELECT p_partkey, CASE WHEN convert_only THEN greatest(15, CAST(trunc(vd * 0.3::DOUBLE * slow) AS INT)) ELSE greatest(30, CAST(trunc((shared + each * n) * slow) AS INT)) END AS seconds,
        CASE WHEN convert_only THEN 1 ELSE 2 + CAST(conv AS INT) + CAST(dub AND music AS INT) + n * (3 + CAST(ocr AS INT) + 2 * CAST(dub AS INT)) END AS steps FROM p""",
)
def eta_model(spark, sf_dir):
    """Expected seconds and steps of jobs."""
    s, k = F.col("p_size"), F.col("p_partkey")
    convert, dub, music, ocr, n = s % 2 == 0, s % 3 == 0, s % 5 < 3, s % 4 == 1, (k % 6).cast("int")
    seconds = L.eta_seconds(s * 3.0, s % 7 == 0, convert, dub, music, ocr, k % 3 == 0, k % 5 > 0, n)
    return table(spark, sf_dir, "part").select("p_partkey", seconds.alias("seconds"), L.steps(s % 7 == 0, convert, dub, music, ocr, n).alias("steps"))


@register(
    "capacity_plan",
    f"""WITH {_LIMITS}, w AS (SELECT p_partkey, p_size AS videos, CAST(p_partkey % 4 + 1 AS INT) AS langs, CAST(p_partkey % 90 AS INT) AS segments, CASE p_partkey % 5 WHEN 0 THEN 'gemini-2.5-flash' WHEN 1 THEN 'gemini-2.5-pro' WHEN 2 THEN 'gemini-2.0-flash' WHEN 3 THEN 'other' ELSE 'gemini-2.5-flash-lite' END AS name FROM part),
      l AS (SELECT w.*, m.rpm, m.rpd FROM w JOIN model m ON m.name = CASE WHEN w.name = 'other' THEN 'gemini-2.5-flash-lite' ELSE w.name END),
      c AS (SELECT *, greatest(1, CAST(ceil(segments / 20) AS INT)) * langs AS calls FROM l),
      k AS (SELECT *, greatest(1, CAST(ceil(calls / rpm) AS INT)) AS by_minute, CASE WHEN rpd > 0 THEN greatest(1, CAST(ceil(calls * videos / nullif(rpd, 0)) AS INT)) END AS by_day FROM c)
      SELECT p_partkey, calls AS calls_per_video, calls * videos AS total_calls, by_minute AS keys_for_rpm, by_day AS keys_for_rpd, CASE WHEN rpd > 0 THEN greatest(by_minute, by_day) + 1 END AS keys, greatest(1, CAST(trunc(rpm * 0.9) AS INT)) AS alert_at FROM k""",
)
def capacity_plan(spark, sf_dir):
    """Calls and keys of workloads, and from which rate on an alert fires."""
    k = F.col("p_partkey")
    model = F.when(k % 5 == 0, "gemini-2.5-flash").when(k % 5 == 1, "gemini-2.5-pro").when(k % 5 == 2, "gemini-2.0-flash").when(k % 5 == 3, "other").otherwise("gemini-2.5-flash-lite")
    found = L.capacity(F.col("p_size"), (k % 4 + 1).cast("int"), (k % 90).cast("int"), F.lit(20), model)
    return table(spark, sf_dir, "part").select("p_partkey", *[c.alias(n) for n, c in found.items()], L.spike_threshold(L.limits(model)["rpm"]).alias("alert_at"))


@register(
    "capacity_texts",
    f"""WITH {_LIMITS}, w AS (SELECT p_partkey, p_size AS v, CAST(p_partkey % 4 + 1 AS INT) AS l, CAST(p_partkey % 90 AS INT) AS s, CASE p_partkey % 2 WHEN 0 THEN 'gemini-2.5-flash' ELSE 'gemini-2.5-pro' END AS name FROM part),
      c AS (SELECT *, greatest(1, CAST(ceil(s / 20) AS INT)) * l AS calls FROM w JOIN model USING (name))
      SELECT p_partkey, 'Workload: ' || v || ' videos x ' || l || ' langs, ~' || s || ' segments/video, batch_size=20' || chr(10) || 'Model: ' || name || '  (free-tier per-project caps: ' || rpm || ' RPM, ' || rpd || ' RPD)' || chr(10) || 'Total calls for batch: ' || (calls * v) || chr(10)
        || 'Keys needed by RPM: ceil(' || calls || '/' || rpm || ') = ' || greatest(1, CAST(ceil(calls / rpm) AS INT)) || chr(10) || 'Keys needed by RPD: ceil(' || (calls * v) || '/' || rpd || ') = ' || greatest(1, CAST(ceil(calls * v / rpd) AS INT)) || chr(10)
        || '=> Recommended: ' || (greatest(1, CAST(ceil(calls / rpm) AS INT), CAST(ceil(calls * v / rpd) AS INT)) + 1) || ' keys (max + 1 for retry headroom)' AS plan FROM c""",
)
def capacity_texts(spark, sf_dir):
    """Plans of workloads in words."""
    k = F.col("p_partkey")
    model = F.when(k % 2 == 0, "gemini-2.5-flash").otherwise("gemini-2.5-pro")
    return table(spark, sf_dir, "part").select("p_partkey", L.capacity_text(F.col("p_size"), (k % 4 + 1).cast("int"), (k % 90).cast("int"), F.lit(20), model).alias("plan"))


_PACIFIC = """(ts - INTERVAL 8 HOUR + CASE WHEN ts >= make_timestamp(year(ts), 3, 8, 10, 0, 0) + INTERVAL 1 DAY * ((7 - isodow(make_date(year(ts), 3, 8))) % 7)
    AND ts < make_timestamp(year(ts), 11, 1, 9, 0, 0) + INTERVAL 1 DAY * ((7 - isodow(make_date(year(ts), 11, 1))) % 7) THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END)"""


@register(
    "pacific_days",
    f"""WITH o AS (SELECT o_orderkey, o_orderdate + INTERVAL 1 MINUTE * (o_orderkey % 1440) AS ts FROM orders), d AS (SELECT o_orderkey, ts, CAST({_PACIFIC} AS DATE) AS day FROM o)
      SELECT o_orderkey, strftime(day, '%Y-%m-%d') AS day FROM d""",
)
def pacific_days(spark, sf_dir):
    """The day by which quotas are counted."""
    ts = F.timestamp_micros(F.unix_micros(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") % 1440 * 60_000_000)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_format(L.pacific_day(ts), "yyyy-MM-dd").alias("day"))


@register(
    "quota_resets",
    f"""WITH e AS (SELECT event_id, ts, {_PACIFIC} AS pt FROM events), d AS (SELECT *, CAST(pt AS DATE) + INTERVAL 1 DAY - (pt - ts) AS reset FROM e)
      SELECT event_id, strftime(reset, '%Y-%m-%d %H:%M') AS reset, round((epoch(reset) - epoch(ts)) / 3600, 2) AS hours FROM d""",
)
def quota_resets(spark, sf_dir):
    """When a quota is renewed, and how long that is from each request."""
    e = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts")).withColumn("r", L.next_reset(F.col("ts")))
    hours = F.round((F.unix_micros("r") - F.unix_micros("ts")) / 3_600_000_000, 2)
    return e.select("event_id", F.date_format("r", "yyyy-MM-dd HH:mm").alias("reset"), hours.alias("hours"))


@register(
    "reset_texts",
    f"""WITH e AS (SELECT event_id, ts, CAST({_PACIFIC} AS DATE) + INTERVAL 1 DAY - ({_PACIFIC} - ts) AS reset FROM events)
      SELECT event_id, strftime(reset, '%H:%M %d/%m/%Y') || ' UTC | 00:00 PT | ~' || printf('%.1f', (epoch(reset) - epoch(ts)) / 3600 + 1e-7) || 'h' AS text FROM e""",
)
def reset_texts(spark, sf_dir):
    """When quotas are renewed, in words."""
    return table(spark, sf_dir, "events").select("event_id", L.reset_text(F.col("ts").cast("timestamp")).alias("text"))


_RATE = "rate AS (SELECT event_id, ts, user_id, count(*) OVER (ORDER BY ts RANGE BETWEEN INTERVAL 600 SECOND PRECEDING AND CURRENT ROW) AS n FROM events)"


@register("sliding_rate", f"WITH {_RATE} SELECT event_id, n, n >= 5 AS spike FROM rate")
def sliding_rate(spark, sf_dir):
    """At each request how many there were in the ten minutes before, over all keys."""
    return alerts.sliding_count(table(spark, sf_dir, "events").select("event_id", "ts"), "ts", 600).select("event_id", "n", (F.col("n") >= 5).alias("spike"))


_DAILY = f"""daily AS (SELECT event_id, user_id % 10 AS key, ts, CAST({_PACIFIC} AS DATE) AS day FROM events), ranked AS (SELECT *, row_number() OVER (PARTITION BY key, day ORDER BY ts, event_id) AS n FROM daily),
    crossing AS (SELECT *, CASE n WHEN CAST(trunc(20 * 0.8) AS INT) THEN 'quota_warn' WHEN CAST(trunc(20 * 0.95) AS INT) THEN 'quota_critical' WHEN 20 THEN 'quota_exhausted' END AS kind FROM ranked)"""


@register("threshold_crossings", f"WITH {_DAILY} SELECT event_id, key, n, kind FROM crossing WHERE kind IS NOT NULL")
def threshold_crossings(spark, sf_dir):
    """The requests with which a key's daily count meets a threshold."""
    e = table(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 10).alias("key"), F.col("ts").cast("timestamp").alias("ts"))
    return alerts.crossings(e, "key", "ts", "event_id", F.lit(20)).select("event_id", "key", F.col("n").cast("bigint").alias("n"), "kind")


@register(
    "cooled_alerts",
    f"""WITH RECURSIVE {_RATE}, raised AS (SELECT event_id, ts, 'spike' AS kind FROM rate WHERE n >= 3 UNION ALL SELECT event_id, ts, event_type FROM events WHERE event_type = 'error'),
      ordered AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY ts, event_id) AS rn FROM raised),
      walk AS (SELECT event_id, kind, rn, ts AS last, true AS fired FROM ordered WHERE rn = 1 UNION ALL
        SELECT o.event_id, o.kind, o.rn, CASE WHEN o.ts - w.last >= INTERVAL 7200 SECOND THEN o.ts ELSE w.last END, o.ts - w.last >= INTERVAL 7200 SECOND FROM walk w JOIN ordered o ON o.kind = w.kind AND o.rn = w.rn + 1)
      SELECT event_id, kind FROM walk WHERE fired""",
)
def cooled_alerts(spark, sf_dir):
    """Alerts of which none of the same type, of whatever key, was given in the time before."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    rate = alerts.sliding_count(e.select("event_id", "ts"), "ts", 600).where("n >= 3").select("event_id", "ts", F.lit("spike").alias("kind"))
    raised = rate.unionByName(e.where("event_type = 'error'").select("event_id", "ts", F.col("event_type").alias("kind")))
    return alerts.cooled(raised, "kind", "ts", "event_id", 7200).select("event_id", "kind")


@register(
    "quota_summary",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS used, greatest(count(DISTINCT user_id), 1) AS n_keys, greatest(count(DISTINCT user_id), 1) * 250 AS capacity, '...' || right('key-' || (1000000 + max(user_id)), 6) AS last_key FROM events GROUP BY 1""",
)
def quota_summary(spark, sf_dir):
    """Requests, keys and what the keys allow."""
    keys = F.greatest(F.countDistinct("user_id"), F.lit(1))
    last = X.masked(F.concat(F.lit("key-"), (1_000_000 + F.max("user_id")).cast("string")))
    return table(spark, sf_dir, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("used"), keys.alias("n_keys"), (keys * 250).alias("capacity"), last.alias("last_key"))


@register(
    "tiers",
    """WITH k AS (SELECT c_nationkey, c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'gemini' WHEN 'MACHINERY' THEN 'openai' WHEN 'FURNITURE' THEN 'new' ELSE NULL END AS provider FROM customer WHERE c_nationkey % 5 = 0 OR c_mktsegment = ['BUILDING', 'MACHINERY', 'AUTOMOBILE', 'FURNITURE'][c_nationkey % 5]),
      c AS (SELECT c_nationkey, provider, count(*) AS n FROM k WHERE provider IS NOT NULL GROUP BY 1, 2),
      t AS (SELECT c_nationkey, coalesce(sum(n) FILTER (provider = 'gemini'), 0) AS free, coalesce(sum(n) FILTER (provider <> 'gemini'), 0) AS paid, string_agg(provider || '=' || n, ',' ORDER BY provider) AS by_provider FROM c GROUP BY 1)
      SELECT n_nationkey, CAST(coalesce(free, 0) AS BIGINT) AS free, CAST(coalesce(paid, 0) AS BIGINT) AS paid, coalesce(by_provider, '') AS by_provider,
        CASE WHEN coalesce(free, 0) + coalesce(paid, 0) = 0 THEN 'empty' WHEN coalesce(paid, 0) = 0 THEN 'free' WHEN coalesce(free, 0) = 0 THEN 'paid' ELSE 'mixed' END AS tier FROM nation LEFT JOIN t ON c_nationkey = n_nationkey""",
)
def tiers(spark, sf_dir):
    """Keys by provider; one that isn't known counts as paid."""
    seg = F.col("c_mktsegment")
    provider = F.when(seg == "BUILDING", "gemini").when(seg == "MACHINERY", "openai").when(seg == "FURNITURE", "new")
    k = table(spark, sf_dir, "customer").where((F.col("c_nationkey") % 5 == 0) | (seg == F.get(F.array(*map(F.lit, ("", "BUILDING", "MACHINERY", "AUTOMOBILE", "FURNITURE"))), F.col("c_nationkey") % 5))).select("c_nationkey", provider.alias("provider")).where("provider is not null")
    c = k.groupBy("c_nationkey", "provider").agg(F.count(F.lit(1)).alias("n"))
    is_free = F.col("provider") == "gemini"
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("provider", "n"))), lambda x: F.concat(x["provider"], F.lit("="), x["n"].cast("string"))), ",")
    t = c.groupBy("c_nationkey").agg(F.sum(F.when(is_free, F.col("n")).otherwise(0)).alias("free"), F.sum(F.when(is_free, 0).otherwise(F.col("n"))).alias("paid"), listed.alias("by_provider"))
    t = table(spark, sf_dir, "nation").join(t, F.col("c_nationkey") == F.col("n_nationkey"), "left").na.fill(0, ["free", "paid"])
    tier = F.when(F.col("free") + F.col("paid") == 0, "empty").when(F.col("paid") == 0, "free").when(F.col("free") == 0, "paid").otherwise("mixed")
    return t.select("n_nationkey", "free", "paid", F.coalesce("by_provider", F.lit("")).alias("by_provider"), tier.alias("tier"))
