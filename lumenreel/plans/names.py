"""Names of files and languages: parsing, numbering, lookups, signatures, cache keys."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import dims
from ..catalog import register
from ..functions import names as N
from ..operators import numbering
from ..session import table


def _quoted(rows) -> str:
    return ", ".join("(" + ", ".join("'" + x.replace("'", "''") + "'" for x in r) + ")" for r in rows)


LANGUAGE_SQL = f"language(code, native, english) AS (VALUES {_quoted((c, n, e) for c, n, e, _ in dims.languages())})"
ALIAS_SQL = f"alias(name, native) AS (VALUES {_quoted(dims.aliases().items())})"

#: File names of four kinds: with a time, with an impossible time, renamed before, and plain.
_FILES = """file AS (SELECT o_orderkey, o_orderdate, o_custkey,
    CASE o_orderkey % 4 WHEN 0 THEN 'clip_' || strftime(o_orderdate, '%Y%m%d') || 'T' || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || '3015'
      WHEN 1 THEN 'clip_20241399T101010'
      WHEN 2 THEN 'EN_' || strftime(o_orderdate, '%d%m') || lpad(CAST(o_orderkey % 130 AS VARCHAR), greatest(2, length(CAST(o_orderkey % 130 AS VARCHAR)))::INT, '0')
      ELSE 'holiday' || o_orderkey END AS stem FROM orders)"""


def files(spark, sf_dir):
    k = F.col("o_orderkey")
    pad = lambda n: F.lpad((k % n).cast("string"), 2, "0")
    n = F.when(k % 130 > 99, (k % 130).cast("string")).otherwise(pad(130))
    stem = F.when(k % 4 == 0, F.concat(F.lit("clip_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("T"), pad(24), F.lit("3015")))
    stem = stem.when(k % 4 == 1, "clip_20241399T101010").when(k % 4 == 2, F.concat(F.lit("EN_"), F.date_format("o_orderdate", "ddMM"), n)).otherwise(F.concat(F.lit("holiday"), k.cast("string")))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey", stem.alias("stem"))


@register(
    "name_times",
    f"""WITH {_FILES},
      t AS (SELECT *, coalesce(try_strptime(regexp_extract(stem, '_([0-9]{{8}}T[0-9]{{6}})', 1), '%Y%m%dT%H%M%S'), o_orderdate) AS ts FROM file)
      SELECT o_orderkey, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, strftime(ts, '%d%m') AS bucket FROM t""",
)
def name_times(spark, sf_dir):
    """The time in a name, else the file's own, and its day-and-month bucket."""
    f = files(spark, sf_dir)
    f = f.withColumn("t", N.stamp(F.col("stem"), F.col("o_orderdate").cast("timestamp")))
    return f.select("o_orderkey", F.date_format("t", "yyyy-MM-dd HH:mm:ss").alias("ts"), N.bucket(F.col("t")).alias("bucket"))


@register(
    "renamed_numbers",
    f"""WITH {_FILES}, p AS (SELECT *, CASE WHEN o_orderkey % 5 = 0 THEN strftime(o_orderdate, '%m%d') ELSE strftime(o_orderdate, '%d%m') END AS day,
        regexp_extract(stem, '^([A-Z]{{2,3}})_([0-9]{{6,}})$', 1) AS c, regexp_extract(stem, '^([A-Z]{{2,3}})_([0-9]{{6,}})$', 2) AS d FROM file)
      SELECT o_orderkey, CASE WHEN c = 'EN' AND starts_with(d, day) THEN TRY_CAST(substr(d, 5) AS INT) END AS number,
        'ES_' || regexp_replace(stem, '^[A-Za-z]+_(.+)$', '\\1') || '.mp4' AS target FROM p""",
)
def renamed_numbers(spark, sf_dir):
    """Numbers of names that were given before, and the names of their Spanish versions."""
    f = files(spark, sf_dir)
    day = F.when(F.col("o_orderkey") % 5 == 0, F.date_format("o_orderdate", "MMdd")).otherwise(F.date_format("o_orderdate", "ddMM"))
    return f.select("o_orderkey", N.own_number(F.col("stem"), F.lit("EN"), day).alias("number"), N.with_code(F.col("stem"), F.lit("ES")).alias("target"))


_CODES = """coded AS (SELECT c_custkey, CASE WHEN c_custkey % 60 = 50 THEN NULL WHEN c_custkey % 60 = 51 THEN '' WHEN c_custkey % 60 > 51 THEN 'x' || (c_custkey % 60)
    ELSE (SELECT code FROM (SELECT code, row_number() OVER () - 1 AS i FROM language) WHERE i = c_custkey % 60) END AS code FROM customer)"""


def coded(spark, sf_dir):
    k = F.col("c_custkey") % 60
    code = F.get(F.array(*[F.lit(c) for c, _, _, _ in dims.languages()]), k.cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", F.when(k == 50, F.lit(None)).when(k == 51, "").when(k > 51, F.concat(F.lit("x"), k.cast("string"))).otherwise(code).alias("code"))


@register(
    "language_names",
    f"""WITH {LANGUAGE_SQL}, {_CODES}, f AS (SELECT c_custkey, code, CASE WHEN coalesce(code, '') = '' THEN 'Unknown' ELSE coalesce(native, 'Other_' || code) END AS folder,
        CASE WHEN coalesce(code, '') = '' THEN 'Unknown' ELSE coalesce(english, 'Other_' || code) END AS english FROM coded LEFT JOIN language USING (code))
      SELECT c_custkey, f.folder, f.english, CASE WHEN l.code IS NOT NULL THEN upper(l.code) WHEN starts_with(f.folder, 'Other_') THEN upper(substr(f.folder, 7)) END AS short
      FROM f LEFT JOIN language l ON l.native = f.folder""",
)
def language_names(spark, sf_dir):
    """Folder, English name and file code of a language code, and their fallbacks."""
    c = coded(spark, sf_dir).select("c_custkey", N.folder_of(F.col("code")).alias("folder"), N.english_of(F.col("code")).alias("english"))
    return c.withColumn("short", N.code_of(F.col("folder")))


@register(
    "language_aliases",
    f"""WITH {LANGUAGE_SQL}, {ALIAS_SQL}, {_CODES}, n AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN upper(code) WHEN 1 THEN 'Other_' || code ELSE upper(english) END AS folder FROM coded LEFT JOIN language USING (code))
      SELECT c_custkey, alias.native AS canonical FROM n LEFT JOIN alias ON lower(n.folder) = alias.name""",
)
def language_aliases(spark, sf_dir):
    """The native folder that a folder's name stands for."""
    english = N.found({c: e for c, _, e, _ in dims.languages()}, F.col("code"))
    k = F.col("c_custkey") % 3
    name = F.when(k == 0, F.upper("code")).when(k == 1, F.concat(F.lit("Other_"), "code")).otherwise(F.upper(english))
    return coded(spark, sf_dir).select("c_custkey", N.canonical(name).alias("canonical"))


@register(
    "source_languages",
    f"""WITH {LANGUAGE_SQL}, {_CODES}, v AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN coalesce((SELECT native FROM language l WHERE l.code = coded.code), 'Other_zz') END AS folder,
        CASE WHEN c_custkey % 3 = 0 THEN upper(code) END AS code, CASE c_custkey % 5 WHEN 0 THEN 'EN' WHEN 1 THEN 'english' WHEN 2 THEN '' END AS lang, CASE WHEN c_custkey % 7 > 0 THEN 'DE' END AS heard FROM coded)
      SELECT c_custkey, coalesce(l.code, k.code, CASE WHEN length(lang) BETWEEN 1 AND 3 THEN lower(lang) END, lower(coalesce(heard, ''))) AS source
      FROM v LEFT JOIN language l ON l.native = v.folder LEFT JOIN language k ON k.code = lower(v.code)""",
)
def source_languages(spark, sf_dir):
    """A clip's language by the most reliable of four fields."""
    k, code = F.col("c_custkey"), F.col("code")
    native = N.found({c: n for c, n, _, _ in dims.languages()}, code)
    folder = F.when(k % 2 == 0, F.coalesce(native, F.lit("Other_zz")))
    lang = F.when(k % 5 == 0, "EN").when(k % 5 == 1, "english").when(k % 5 == 2, "")
    return coded(spark, sf_dir).select("c_custkey", N.source_language(folder, F.when(k % 3 == 0, F.upper(code)), lang, F.when(k % 7 > 0, "DE")).alias("source"))


@register(
    "gap_numbers",
    """WITH r AS (SELECT o_custkey, o_orderkey, CASE WHEN rn % 3 = 0 THEN rn + o_orderkey % 3 * n END AS kept, n FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)),
      taken AS (SELECT DISTINCT o_custkey, kept FROM r WHERE kept IS NOT NULL),
      free AS (SELECT o_custkey, i, row_number() OVER (PARTITION BY o_custkey ORDER BY i) AS k FROM (
        SELECT o_custkey, unnest(range(1, 2 * n + 1)) AS i FROM (SELECT o_custkey, max(n) AS n FROM r GROUP BY 1)) f WHERE NOT EXISTS (SELECT 1 FROM taken t WHERE t.o_custkey = f.o_custkey AND t.kept = f.i)),
      new AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM r WHERE kept IS NULL),
      widths AS (SELECT o_custkey, CASE WHEN max(kept) >= 100 AND max(n) <= 99 OR max(kept) >= 1000 THEN greatest(CASE WHEN max(n) <= 99 THEN 2 ELSE 3 END, length(CAST(max(kept) AS VARCHAR))) WHEN max(n) <= 99 THEN 2 ELSE 3 END AS width FROM r GROUP BY 1)
      SELECT o_orderkey, CAST(number AS BIGINT) AS number, lpad(CAST(number AS VARCHAR), greatest(width, length(CAST(number AS VARCHAR)))::INT, '0') AS padded FROM (
        SELECT o_custkey, o_orderkey, kept AS number FROM r WHERE kept IS NOT NULL UNION ALL SELECT new.o_custkey, o_orderkey, i FROM new JOIN free USING (o_custkey, k)) JOIN widths USING (o_custkey)""",
)
def gap_numbers(spark, sf_dir):
    """Numbers that were given stay; the rest take the least free ones in order."""
    w = Window.partitionBy("o_custkey")
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.row_number().over(w.orderBy("o_orderkey")).cast("bigint").alias("rn"), F.count(F.lit(1)).over(w).alias("n"))
    o = o.select("o_custkey", "o_orderkey", F.when(F.col("rn") % 3 == 0, F.col("rn") + F.col("o_orderkey") % 3 * F.col("n")).alias("kept"))
    return numbering.gap_filled(o, ["o_custkey"], ["o_orderkey"], "kept").select("o_orderkey", "number", "padded")


@register(
    "first_name_kept",
    """SELECT o_orderkey, CASE WHEN row_number() OVER (PARTITION BY o_custkey, name ORDER BY o_orderdate, o_orderkey) = 1 THEN name ELSE o_orderkey || '_' || name END AS name
      FROM (SELECT *, o_orderpriority || '.mp4' AS name FROM orders)""",
)
def first_name_kept(spark, sf_dir):
    """Of equal names in a bundle the first is kept; later ones get their job's id in front."""
    o = table(spark, sf_dir, "orders").withColumn("name", F.concat("o_orderpriority", F.lit(".mp4")))
    first = F.row_number().over(Window.partitionBy("o_custkey", "name").orderBy("o_orderdate", "o_orderkey")) == 1
    return o.select("o_orderkey", F.when(first, F.col("name")).otherwise(F.concat(F.col("o_orderkey").cast("string"), F.lit("_"), "name")).alias("name"))


@register(
    "signatures",
    """WITH s AS (SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'Demo' WHEN 1 THEN ' app_processed ' ELSE '' END AS app, CASE WHEN p_size % 2 = 0 THEN 'b' || p_size ELSE '' END AS batch,
        CASE p_size % 4 WHEN 0 THEN '|k=v|flag' WHEN 1 THEN 'x = y=z' ELSE '' END AS extra FROM part),
      t AS (SELECT *, concat_ws('|', CASE WHEN trim(app) = '' THEN 'META_ADS_PROCESSED' WHEN ends_with(upper(trim(app)), 'PROCESSED') THEN trim(app) ELSE trim(app) || '_PROCESSED' END,
        CASE WHEN batch <> '' THEN 'batch=' || batch END, 'brandpassed=yes', 'tool=lumenreel', 'date=2026-01-02', CASE WHEN extra <> '' THEN ltrim(extra, '|') END) AS comment FROM s)
      SELECT p_partkey, comment, split_part(comment, '|', 1) AS marker, CASE WHEN batch <> '' THEN batch END AS batch, CASE p_size % 4 WHEN 1 THEN 'y=z' END AS x, contains(comment, 'Demo_PROCESSED') AS processed
      FROM t JOIN part USING (p_partkey)""",
)
def signatures(spark, sf_dir):
    """Signatures built, read back, and looked for."""
    s = F.col("p_size")
    p = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(s % 3 == 0, "Demo").when(s % 3 == 1, " app_processed ").otherwise("").alias("app"),
        F.when(s % 2 == 0, F.concat(F.lit("b"), s.cast("string"))).otherwise("").alias("batch"),
        F.when(s % 4 == 0, "|k=v|flag").when(s % 4 == 1, "x = y=z").otherwise("").alias("extra"),
    )
    p = p.select("p_partkey", N.signature(F.col("app"), F.col("batch"), F.lit("2026-01-02"), "lumenreel", F.col("extra")).alias("comment"))
    p = p.withColumn("m", N.parsed_signature(F.col("comment")))
    part = lambda k: F.try_element_at("m", F.lit(k))
    return p.select("p_partkey", "comment", part("marker").alias("marker"), part("batch").alias("batch"), part("x").alias("x"), F.contains("comment", F.lit("Demo_PROCESSED")).alias("processed"))


@register(
    "content_keys",
    """SELECT c_custkey, substr(sha256(c_name || '|' || c_nationkey || '|' || c_custkey), 1, 24) AS file_key, substr(sha256(c_mktsegment || ':' || c_name), 1, 16) AS speech_key, md5(c_name) AS digest FROM customer""",
)
def content_keys(spark, sf_dir):
    """Cache keys of files, of spoken texts and of contents."""
    keys = N.content_keys(F.col("c_name"), F.col("c_nationkey"), F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_name"), F.col("c_name"))
    return table(spark, sf_dir, "customer").select("c_custkey", *[c.alias(k) for k, c in keys.items()])
