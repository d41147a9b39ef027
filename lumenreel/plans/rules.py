"""Queries of rule engines, aggregates of reports, and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import dims as D
from ..catalog import register
from ..functions import geometry as G
from ..functions import rules as R
from ..operators import manifests, numbering
from ..session import table

CLASSES = [("space", ["the", "small", "tiny"]), ("tips", ["th", "on"]), ("magic", ["er", "is", "ing", "ed"])]


def _vote_sql(classes, column: str) -> str:
    scores = ", ".join("(" + " + ".join(f"CAST(contains(lower({column}), '{w}') AS INT)" for w in words) + f") AS s{i}" for i, (_, words) in enumerate(classes))
    best = " ".join(f"WHEN s{i} = greatest({', '.join(f's{k}' for k in range(len(classes)))}) AND s{i} > 0 THEN '{name}'" for i, (name, _) in enumerate(classes))
    return f"SELECT conv_id, turn, CASE {best} ELSE 'other' END AS angle FROM (SELECT conv_id, turn, {scores} FROM conversations)"


@register("angle_votes", _vote_sql(CLASSES, "text"))
def angle_votes(spark, sf_dir):
    """The angle with the most keywords, of any number of classes."""
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", R.vote(F.col("text"), CLASSES, "other").alias("angle"))


_ANGLE = "CASE p_size % 7 WHEN 0 THEN 'Myth of ' || p_brand WHEN 1 THEN 'transform' WHEN 2 THEN 'Feature demo' WHEN 3 THEN 'stop the demo' ELSE 'care' END"
_LANG = "CASE p_partkey % 8 WHEN 0 THEN 'de' WHEN 1 THEN 'ES' WHEN 2 THEN 'ko' WHEN 3 THEN 'xx' WHEN 4 THEN NULL WHEN 5 THEN 'vi' WHEN 6 THEN 'ar' ELSE 'sv' END"


def _angle():
    s = F.col("p_size") % 7
    return F.when(s == 0, F.concat(F.lit("Myth of "), "p_brand")).when(s == 1, "transform").when(s == 2, "Feature demo").when(s == 3, "stop the demo").otherwise("care")


def _lang():
    k, out = F.col("p_partkey") % 8, F.lit("sv")
    for i, x in enumerate(("de", "ES", "ko", "xx", None, "vi", "ar")):
        out = F.when(k == i, F.lit(x)).otherwise(out)
    return out


@register(
    "music_suggestions",
    f"""WITH p AS (SELECT p_partkey, p_size, lower({_ANGLE}) AS a, lower({_LANG}) AS l FROM part),
      e AS (SELECT *, CASE WHEN regexp_matches(a, 'myth|authority|mistake|wrong|stop') THEN 'tension' WHEN regexp_matches(a, 'transform|testimonial|diagnos|rescue|revive|before') THEN 'uplift' WHEN regexp_matches(a, 'feature|demo|rules|showcase|benefit') THEN 'modern' ELSE 'calm' END AS energy,
        CASE l WHEN 'de' THEN 'west_eu' WHEN 'es' THEN 'south_eu' WHEN 'ko' THEN 'east_asia' WHEN 'vi' THEN 'sea' WHEN 'ar' THEN 'mena' WHEN 'sv' THEN 'nordics' ELSE 'anglo' END AS region FROM p),
      q AS (SELECT *, CASE region WHEN 'west_eu' THEN 'minimal acoustic' WHEN 'south_eu' THEN 'mediterranean acoustic' WHEN 'east_asia' THEN 'kawaii cute' WHEN 'sea' THEN 'tropical pop happy' WHEN 'mena' THEN 'arabic ambient calm' WHEN 'nordics' THEN 'airy indie folk' ELSE 'lofi chill' END AS seed,
        CASE energy WHEN 'tension' THEN 'curious minimal' WHEN 'uplift' THEN 'uplifting acoustic' WHEN 'modern' THEN 'positive corporate' ELSE 'lofi chill' END AS anchor FROM e)
      SELECT p_partkey, region, energy, CASE energy WHEN 'tension' THEN 'A_calm_nature' WHEN 'uplift' THEN 'B_uplifting' WHEN 'modern' THEN 'D_corporate' ELSE 'C_lofi_chill' END AS cluster,
        concat_ws('|', seed, CASE WHEN anchor <> seed THEN anchor END, CASE WHEN p_size % 2 = 0 THEN 'instrumental background' END) AS queries FROM q""",
)
def music_suggestions(spark, sf_dir):
    """Music for clips by region, energy and voice."""
    found = R.suggestion(_lang(), _angle(), F.col("p_size") % 2 == 0)
    found["queries"] = F.array_join(found["queries"], "|")
    return table(spark, sf_dir, "part").select("p_partkey", *[c.alias(n) for n, c in found.items()])


def _values(rows: list[tuple]) -> str:
    """Rows as SQL's VALUES."""
    one = lambda x: "[" + ", ".join(map(one, x)) + "]" if isinstance(x, list) else "'" + x.replace("'", "''") + "'"
    return "(VALUES " + ", ".join("(" + ", ".join(map(one, r)) + ")" for r in rows) + ")"


_PLACES = ["us", " Germany", "BRAZIL ", "xx", "Saudi Arabia", "jp", "Mexico", "fr", "", "VN", "Poland"]
_MUSIC = f"""country(c, r) AS {_values(D.COUNTRY_REGIONS)}, spoken(l, r) AS {_values(D.LANGUAGE_REGIONS)}, style(r, label, seeds, trend) AS {_values(D.REGION_MUSIC)}, en(e, cluster, mood, bpm, anchor) AS {_values(D.ENERGY_MUSIC)}"""


@register(
    "music_advice",
    f"""WITH {_MUSIC}, p AS (SELECT p_partkey, p_size % 2 = 0 AS voice, lower({_ANGLE}) AS a, lower({_LANG}) AS l, [{", ".join(f"'{x}'" for x in _PLACES)}] AS places FROM part),
      c AS (SELECT p_partkey, upper(trim(unnest([places[p_partkey % 11 + 1], places[p_partkey // 11 % 11 + 1], places[p_partkey // 7 % 11 + 1]]))) AS c FROM p WHERE p_partkey % 4 > 0),
      n AS (SELECT p_partkey, r, count(*) AS n FROM c JOIN country USING (c) GROUP BY 1, 2), t AS (SELECT p_partkey, arg_min(r, (-n, r)) AS top FROM n GROUP BY 1),
      o AS (SELECT p_partkey, top, string_agg(r, ', ' ORDER BY r) FILTER (r <> top) AS others FROM t JOIN n USING (p_partkey) GROUP BY 1, 2),
      f AS (SELECT p.*, coalesce(o.top, spoken.r, '{D.DEFAULT_REGION}') AS region, CASE WHEN o.top IS NOT NULL THEN 'countries' WHEN spoken.r IS NOT NULL THEN 'language' ELSE 'default' END AS reason, others,
        CASE WHEN regexp_matches(a, 'myth|authority|mistake|wrong|stop') THEN 'tension' WHEN regexp_matches(a, 'transform|testimonial|diagnos|rescue|revive|before') THEN 'uplift' WHEN regexp_matches(a, 'feature|demo|rules|showcase|benefit') THEN 'modern' ELSE 'calm' END AS energy
        FROM p LEFT JOIN o USING (p_partkey) LEFT JOIN spoken ON spoken.l = p.l),
      q AS (SELECT *, seeds[1:4] || CASE WHEN NOT list_contains(seeds[1:4], anchor) THEN [anchor] ELSE [] END || CASE WHEN voice THEN ['instrumental background'] ELSE [] END AS qs FROM f JOIN style ON style.r = region JOIN en ON en.e = energy)
      SELECT p_partkey, region, reason, label, energy, cluster, mood, bpm, array_to_string(qs[1:5], '|') AS queries, CASE WHEN voice THEN '{D.VOICED.replace("'", "''")}' ELSE '{D.UNVOICED}' END AS voice_note,
        trend || CASE WHEN others IS NOT NULL THEN '  (mixed markets: also ' || others || ' — pick neutral tracks.)' ELSE '' END AS trend_note FROM q""",
)
def music_advice(spark, sf_dir):
    """Music for clips by their countries, language, angle and voice, with all queries and notes."""
    k, places = F.col("p_partkey"), F.array(*map(F.lit, _PLACES))
    place = lambda n: F.get(places, (n % 11).cast("int"))
    countries = F.when(k % 4 > 0, F.array(place(k), place(F.floor(k / 11)), place(F.floor(k / 7))))
    found = R.music(_lang(), _angle(), F.col("p_size") % 2 == 0, countries)
    found["queries"] = F.array_join(found["queries"], "|")
    return table(spark, sf_dir, "part").select("p_partkey", *[c.alias(n) for n, c in found.items()])


@register(
    "market_regions",
    f"""WITH country(c, r) AS {_values(D.COUNTRY_REGIONS)}, n AS (SELECT s_nationkey % 7 AS pack, r, count(*) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN country ON c = upper(trim(n_name)) GROUP BY 1, 2),
      t AS (SELECT pack, arg_min(r, (-n, r)) AS top FROM n GROUP BY 1), o AS (SELECT pack, top, coalesce(string_agg(r, ',' ORDER BY r) FILTER (r <> top), '') AS others FROM t JOIN n USING (pack) GROUP BY 1, 2)
      SELECT DISTINCT CAST(s_nationkey % 7 AS INT) AS pack, top AS region, coalesce(others, '') AS others FROM supplier LEFT JOIN o ON o.pack = s_nationkey % 7""",
)
def market_regions(spark, sf_dir):
    """The region of most of a pack's countries, which are names, and the other regions."""
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    n = s.groupBy((F.col("s_nationkey") % 7).cast("int").alias("pack"), R.country_region(F.col("n_name")).alias("r")).agg(F.count(F.lit(1)).alias("n"))
    known = F.col("r").isNotNull()
    m = n.groupBy("pack").agg(F.min(F.when(known, F.struct((-F.col("n")).alias("n"), "r")))["r"].alias("region"), F.array_sort(F.collect_set("r")).alias("all"))
    return m.select("pack", "region", F.array_join(F.filter("all", lambda r: r != F.col("region")), ",").alias("others"))


@register(
    "shopping_list",
    """SELECT p_brand, p_size % 3 AS region, string_agg(DISTINCT q, ',' ORDER BY q) AS queries, count(DISTINCT q) AS n FROM (SELECT p_brand, p_size, unnest([p_type, split_part(p_type, ' ', 1)]) AS q FROM part) GROUP BY 1, 2""",
)
def shopping_list(spark, sf_dir):
    """The queries of each cluster and region, each once."""
    q = F.explode(F.array("p_type", F.split_part("p_type", F.lit(" "), F.lit(1))))
    p = table(spark, sf_dir, "part").select("p_brand", (F.col("p_size") % 3).alias("region"), q.alias("q"))
    return p.groupBy("p_brand", "region").agg(F.array_join(F.array_sort(F.collect_set("q")), ",").alias("queries"), F.count_distinct("q").alias("n"))


@register(
    "routed_outros",
    """SELECT p_partkey, CASE WHEN v = 'man' THEN 'man.mp4' WHEN v IN ('woman', 'women', 'female') AND p_partkey % 2 = 0 THEN 'woman.mp4' ELSE 'any.mp4' END AS outro,
      CASE WHEN p_size >= 22 AND p_partkey % 3 > 0 THEN 'long' ELSE CASE WHEN p_partkey % 5 > 0 THEN 'short' ELSE '' END END AS script, CASE WHEN p_partkey % 4 = 0 THEN p_brand ELSE 'Voice-' || p_size % 3 END AS voice, CASE WHEN p_size % 2 = 0 THEN 1 ELSE 5 END AS beam, CASE WHEN p_size % 3 = 0 THEN 'feature' WHEN p_partkey % 2 = 0 THEN 'care' END AS block
      FROM (SELECT *, CASE p_size % 5 WHEN 0 THEN 'man' WHEN 1 THEN 'woman' WHEN 2 THEN 'female' ELSE '' END AS v FROM part)""",
)
def routed_outros(spark, sf_dir):
    """End cards, scripts, voices and beams by their rules."""
    k, s = F.col("p_partkey"), F.col("p_size")
    v = F.when(s % 5 == 0, "Man").when(s % 5 == 1, "woman").when(s % 5 == 2, "Female")
    out = R.outro(v, F.lit("man.mp4"), F.when(k % 2 == 0, "woman.mp4").otherwise(""), F.lit("any.mp4"))
    script = R.script_tier(s, F.when(k % 3 > 0, "long"), F.when(k % 5 > 0, "short"))
    voice = R.voice(F.when(k % 4 == 0, F.col("p_brand")), F.concat(F.lit("Voice-"), (s % 3).cast("string")))
    scripts = F.when(k % 2 == 0, F.create_map(*map(F.lit, ("care-hack", "care", "demo", "feature")))).otherwise(F.create_map(*map(F.lit, ("demo", "feature"))))
    block = R.script_block(scripts, F.when(s % 3 == 0, "demo").when(s % 3 == 1, "unknown"))
    return table(spark, sf_dir, "part").select("p_partkey", out.alias("outro"), F.coalesce(script, F.lit("")).alias("script"), voice.alias("voice"), R.beam_size(F.when(s % 2 == 0, "tiny").otherwise("medium")).alias("beam"), block.alias("block"))


@register(
    "picked_tracks",
    """WITH pools AS (SELECT n_regionkey, list(n_name ORDER BY n_name) AS pool FROM nation WHERE n_regionkey < 4 GROUP BY 1), every AS (SELECT list(n_name ORDER BY n_name) AS names FROM nation),
      c AS (SELECT c_custkey, n_regionkey, CAST('0x' || substr(md5(c_custkey || '|7'), 1, 8) AS BIGINT) AS h FROM customer JOIN nation ON n_nationkey = c_nationkey)
      SELECT c_custkey, coalesce(pool, names)[h % len(coalesce(pool, names)) + 1] AS track FROM c LEFT JOIN pools USING (n_regionkey), every""",
)
def picked_tracks(spark, sf_dir):
    """A track for each clip out of its cluster's pool, or out of all; the choice is a digest's."""
    nation = table(spark, sf_dir, "nation")
    names = F.array_sort(F.collect_list("n_name"))  # 25 nations
    pools = nation.where("n_regionkey < 4").groupBy("n_regionkey").agg(names.alias("pool"))
    every = nation.agg(names)
    c = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(pools, "n_regionkey", "left").withColumn("names", every.scalar())
    return c.select("c_custkey", R.picked(F.col("pool"), F.col("names"), F.col("c_custkey"), 7).alias("track"))


@register(
    "taxonomy_block",
    """SELECT n_regionkey, string_agg('- ' || n_name || ': nation ' || n_nationkey || ' (keywords: ' || lower(n_name) || ', x)', chr(10) ORDER BY n_nationkey) AS block FROM nation GROUP BY 1""",
)
def taxonomy_block(spark, sf_dir):
    """Lines that list angles for a model."""
    angle = F.struct("n_nationkey", F.col("n_name").alias("name"), F.concat(F.lit("nation "), F.col("n_nationkey").cast("string")).alias("description"), F.array(F.lower("n_name"), F.lit("x")).alias("keywords"))
    return table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(R.taxonomy(F.array_sort(F.collect_list(angle))).alias("block"))


@register(
    "script_languages",
    """SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN 'ar' WHEN 1 THEN 'ko' WHEN 2 THEN 'ja' WHEN 3 THEN 'zh' WHEN 4 THEN 'ru' WHEN 5 THEN 'th' ELSE CASE WHEN regexp_matches(text, '[đơưạảấầẩẫậắằẳẵặẹẻẽếềểễệ]') THEN 'vi' WHEN regexp_matches(text, '[ñ¿¡]') THEN 'es' WHEN regexp_matches(text, '[ãõ]') THEN 'pt'
      WHEN regexp_matches(text, '[äöüß]') THEN 'de' WHEN regexp_matches(text, '[àâçèêëîïôùûœ]') THEN 'fr' ELSE 'en' END END AS language FROM documents""",
)
def script_languages(spark, sf_dir):
    """Languages told by script, else by accents."""
    k, t = F.col("doc_id") % 8, F.lit("")
    for i, x in enumerate(("م", "한", "のア漢", "漢", "я", "ไ")):
        t = F.when(k == i, x).otherwise(t)
    return table(spark, sf_dir, "documents").select("doc_id", R.script_language(F.concat("text", t)).alias("language"))


@register(
    "campaign_decisions",
    """WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, avg(value) AS cpa, count(*) AS n FROM events GROUP BY 1, 2), h AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day) AS rn FROM d WHERE cpa > 25 * 1.25),
      r AS (SELECT user_id, date_diff('day', DATE '2000-01-01', day) - rn AS island, count(*) AS days FROM h GROUP BY 1, 2), m AS (SELECT user_id, max(days) AS streak FROM r GROUP BY 1)
      SELECT u.user_id, coalesce(m.streak, 0) >= 3 AS kill, CAST(u.a AS INT) + CAST(u.b AS INT) + CAST(u.c AS INT) + CAST(u.d AS INT) >= 2 AS tired FROM (SELECT user_id, count(*) > 70 AS a, avg(value) > 50 AS b, max(value) > 300 AS c, min(value) < 1 AS d FROM events GROUP BY 1) u LEFT JOIN m USING (user_id)""",
)
def campaign_decisions(spark, sf_dir):
    """Campaigns that cost too much for three days in a row, and those with two signs of fatigue."""
    e = table(spark, sf_dir, "events")
    d = e.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.avg("value").alias("cpa")).where(F.col("cpa") > 25 * 1.25)
    island = F.datediff("day", F.lit("2000-01-01").cast("date")) - F.row_number().over(Window.partitionBy("user_id").orderBy("day"))
    streak = d.withColumn("island", island).groupBy("user_id", "island").agg(F.count(F.lit(1)).alias("days")).groupBy("user_id").agg(F.max("days").alias("streak"))
    tired = R.fatigue(F.count(F.lit(1)) > 70, F.avg("value") > 50, F.max("value") > 300, F.min("value") < 1)
    return e.groupBy("user_id").agg(tired.alias("tired")).join(streak, "user_id", "left").select("user_id", (F.coalesce("streak", F.lit(0)) >= 3).alias("kill"), "tired")


@register("voice_counts", "SELECT source, CASE WHEN lang = 'en' THEN 'VO:en' ELSE 'BGM-only' END AS voice, count(*) AS n FROM documents GROUP BY 1, 2")
def voice_counts(spark, sf_dir):
    """Clips by angle and kind of voice."""
    voice = F.when(F.col("lang") == "en", "VO:en").otherwise("BGM-only")
    return table(spark, sf_dir, "documents").groupBy("source", voice.alias("voice")).agg(F.count(F.lit(1)).alias("n"))


@register("done_counters", "SELECT count(*) AS n, count(*) FILTER (quality = 1) AS ok, count(*) FILTER (quality = 0) AS err, count(DISTINCT md5(text)) AS unique_md5 FROM documents LEFT JOIN labels USING (doc_id)")
def done_counters(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("m")).join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return d.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("quality") == 1).alias("ok"), F.count_if(F.col("quality") == 0).alias("err"), F.count_distinct("m").alias("unique_md5"))


@register(
    "majority_canvases",
    "SELECT source, arg_max(lang, (n, lang)) AS canvas, max(n) AS n FROM (SELECT source, lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY 1, 2) GROUP BY 1",
)
def majority_canvases(spark, sf_dir):
    """The commonest value of each group; of equals the greatest."""
    c = table(spark, sf_dir, "documents").where("lang is not null").groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"))
    return c.groupBy("source").agg(F.max_by("lang", F.struct("n", "lang")).alias("canvas"), F.max("n").alias("n"))


@register(
    "majority_markets",
    """WITH c AS (SELECT s_nationkey % 7 AS pack, n_regionkey AS r, count(*) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2), t AS (SELECT pack, arg_max(r, (n, -r)) AS top FROM c GROUP BY 1)
      SELECT CAST(t.pack AS INT) AS pack, t.top AS region, coalesce(string_agg(CAST(c.r AS VARCHAR), ',' ORDER BY c.r) FILTER (c.r <> t.top), '') AS others FROM t JOIN c USING (pack) GROUP BY 1, 2""",
)
def majority_markets(spark, sf_dir):
    """The commonest region of each pack, and the others in order."""
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    c = s.groupBy((F.col("s_nationkey") % 7).alias("pack"), F.col("n_regionkey").alias("r")).agg(F.count(F.lit(1)).alias("n"))
    t = c.groupBy("pack").agg(F.max_by("r", F.struct("n", -F.col("r"))).alias("region"), F.array_sort(F.collect_set("r")).alias("all"))
    return t.select("pack", "region", F.array_join(F.array_remove("all", F.col("region")).cast("array<string>"), ",").alias("others"))


_STYLE = """style AS (SELECT user_id, event_id AS pos, '#' || upper(substr(md5(CAST(user_id * 7 + event_id % 3 AS VARCHAR)), 1, 6)) AS color, CAST(value AS INT) % 60 AS h, CAST(event_id % 100 AS DOUBLE) / 100 AS op FROM events)"""


@register(
    "resolved_styles",
    f"""WITH {_STYLE}, q AS (SELECT *, '#' || array_to_string(list_transform([2, 4, 6], lambda i: lpad(upper(to_hex(CAST('0x' || substr(color, i, 2) AS INT) // 32 * 32)), 2, '0')), '') AS bucket FROM style),
      b AS (SELECT user_id, bucket, count(*) AS n, min(pos) AS first, arg_min(color, pos) AS color FROM q GROUP BY 1, 2), m AS (SELECT user_id, arg_min(color, (-n, first)) AS color FROM b GROUP BY 1)
      SELECT user_id, color, CAST(trunc(quantile_cont(h, 0.5)) AS INT) AS height, round_even(avg(op), 2) AS opacity, CAST(trunc(quantile_cont(pos % 50, 0.5)) AS INT) AS x FROM style JOIN m USING (user_id) GROUP BY 1, color, m.color""".replace("SELECT user_id, color, CAST(trunc(quantile_cont(h", "SELECT user_id, m.color, CAST(trunc(quantile_cont(h").replace("GROUP BY 1, color, m.color", "GROUP BY 1, 2"),
)
def resolved_styles(spark, sf_dir):
    """One style out of many samples: the first colour of the commonest bucket, median height, mean opacity."""
    k = F.col("event_id")
    color = F.concat(F.lit("#"), F.upper(F.left(F.md5((F.col("user_id") * 7 + k % 3).cast("string")), F.lit(6))))
    s = table(spark, sf_dir, "events").select("user_id", k.alias("pos"), color.alias("color"), (F.bround("value").cast("int") % 60).alias("h"), ((k % 100) / 100).alias("op"))
    b = s.groupBy("user_id", G.quantized(F.col("color")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first"), F.min_by("color", "pos").alias("color"))
    m = b.groupBy("user_id").agg(F.min_by("color", F.struct(-F.col("n"), F.col("first"))).alias("color"))
    half = lambda c: F.percentile(c, 0.5).cast("int")
    return s.groupBy("user_id").agg(half("h").alias("height"), F.bround(F.avg("op"), 2).alias("opacity"), half(F.col("pos") % 50).alias("x")).join(m, "user_id").select("user_id", "color", "height", "opacity", "x")


@register(
    "flat_cards",
    """WITH c AS (SELECT user_id, CAST(floor(value / 28) AS BIGINT) AS q, count(*) AS n FROM events GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, q) AS rn FROM c)
      SELECT user_id, round(sum(n) FILTER (rn <= 3) / sum(n), 3) AS coverage, sum(n) FILTER (rn <= 3) / sum(n) >= 0.8 AS card FROM r GROUP BY 1""",
)
def flat_cards(spark, sf_dir):
    """Frames of which three colours cover most."""
    c = table(spark, sf_dir, "events").groupBy("user_id", F.floor(F.col("value") / 28).alias("q")).agg(F.count(F.lit(1)).alias("n"))
    top = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("n"), "q")) <= 3
    r = c.withColumn("top", top).groupBy("user_id").agg((F.sum(F.when(F.col("top"), F.col("n"))) / F.sum("n")).alias("c"))
    return r.select("user_id", F.round("c", 3).alias("coverage"), (F.col("c") >= 0.8).alias("card"))


@register("band_means", "SELECT user_id, i * 8 // n AS band, round(avg(value), 6) AS mean FROM (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events) GROUP BY 1, 2")
def band_means(spark, sf_dir):
    """A profile in eight bands."""
    w = Window.partitionBy("user_id")
    e = table(spark, sf_dir, "events").select("user_id", "value", (F.row_number().over(w.orderBy("event_id")) - 1).alias("i"), F.count(F.lit(1)).over(w).alias("n"))
    return e.groupBy("user_id", F.floor(F.col("i") * 8 / F.col("n")).alias("band")).agg(F.round(F.avg("value"), 6).alias("mean"))


@register("angle_matrix", "SELECT * FROM (SELECT coalesce(source, 'TOTAL') AS angle, count(*) FILTER (lang = 'de') AS de, count(*) FILTER (lang = 'en') AS en, count(*) FILTER (lang = 'es') AS es, count(*) FILTER (lang = 'fr') AS fr, count(*) AS total FROM documents GROUP BY GROUPING SETS ((source), ()))")
def angle_matrix(spark, sf_dir):
    """Counts by angle and language with totals; the columns are the table's languages, in order."""
    d = table(spark, sf_dir, "documents").select("source", "lang")
    langs = [r["lang"] for r in d.where("lang is not null").select("lang").distinct().orderBy("lang").collect()]  # the columns of a report
    cells = [F.count_if(F.col("lang") == x).alias(x) for x in langs]
    g = d.groupingSets([[F.col("source")], []], "source").agg(F.grouping("source").alias("_g"), *cells, F.count(F.lit(1)).alias("total"))
    return g.withColumn("angle", F.when(F.col("_g") == 1, "TOTAL").otherwise(F.col("source"))).select("angle", *langs, "total")


@register("ad_names", "SELECT c_custkey, 'N' || c_nationkey || '_ad' || lpad(CAST(rn AS VARCHAR), greatest(2, length(CAST(rn AS VARCHAR)))::INT, '0') AS ad_name, ['one', 'two', 'three'][(rn - 1) % 3 + 1] AS text FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rn FROM customer)")
def ad_names(spark, sf_dir):
    """Ads by number, with texts in rotation."""
    c = numbering.rotation(table(spark, sf_dir, "customer"), ["c_nationkey"], ["c_custkey"], 3)
    return c.select("c_custkey", numbering.ad_name(F.concat(F.lit("N"), F.col("c_nationkey").cast("string")), F.col("place")).alias("ad_name"), F.get(F.array(*map(F.lit, ("one", "two", "three"))), F.col("slot")).alias("text"))


@register(
    "refresh_pools",
    "SELECT p_brand, string_agg(CAST(p_partkey AS VARCHAR), ',' ORDER BY p_name, p_partkey) FILTER (rn <= 12) AS ads, count(*) FILTER (rn > 12) AS pooled FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_name, p_partkey) AS rn FROM part) GROUP BY 1",
)
def refresh_pools(spark, sf_dir):
    """The first twelve of each campaign, and how many are left to refresh it."""
    p = table(spark, sf_dir, "part").withColumn("rn", F.row_number().over(Window.partitionBy("p_brand").orderBy("p_name", "p_partkey")))
    ads = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("rn") <= 12, F.struct("rn", "p_partkey")))), lambda x: x["p_partkey"].cast("string")), ",")
    return p.groupBy("p_brand").agg(ads.alias("ads"), F.count_if(F.col("rn") > 12).alias("pooled"))


@register("stratified_sample", "SELECT lang, doc_id FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id || '|3'), doc_id) AS rn FROM documents) WHERE rn <= 6")
def stratified_sample(spark, sf_dir):
    """Six of each group, chosen by a digest."""
    return numbering.sampled(table(spark, sf_dir, "documents"), ["lang"], "doc_id", 6, 3).select("lang", "doc_id")


@register("progress", "SELECT user_id, event_id, round(rn * 2.5 / rn * (n - rn), 4) AS eta, round(value * 0.7771237::DOUBLE / rn * (n - rn), 4) AS left_s FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn, count(*) OVER (PARTITION BY user_id) AS n FROM events)")
def progress(spark, sf_dir):
    """What is left of a run by what is done."""
    w = Window.partitionBy("user_id")
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "value", F.row_number().over(w.orderBy("event_id")).alias("rn"), F.count(F.lit(1)).over(w).alias("n"))
    left = lambda spent: F.round(spent / F.col("rn") * (F.col("n") - F.col("rn")), 4)
    return e.select("user_id", "event_id", left(F.col("rn") * 2.5).alias("eta"), left(F.col("value") * 0.7771237).alias("left_s"))


@register("onsets", "SELECT user_id, event_id FROM (SELECT *, value - lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS jump FROM events) WHERE jump >= 20")
def onsets(spark, sf_dir):
    """Samples well above the one before."""
    jump = F.col("value") - F.lag("value").over(Window.partitionBy("user_id").orderBy("event_id"))
    return table(spark, sf_dir, "events").select("user_id", "event_id", jump.alias("jump")).where("jump >= 20").drop("jump")


@register("by_folder_and_name", "SELECT s_suppkey, CAST(row_number() OVER (ORDER BY s_nationkey, s_name) AS BIGINT) AS place FROM supplier")
def by_folder_and_name(spark, sf_dir):
    """Places in the order of folder and name."""
    return numbering.ranked(table(spark, sf_dir, "supplier"), ["s_nationkey", "s_name"]).select("s_suppkey", "place")


@register("previews", "SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ', ' ORDER BY l_linenumber, l_partkey) FILTER (rn <= 3) || CASE WHEN count(*) > 3 THEN ' ...' ELSE '' END AS preview FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS rn FROM lineitem) GROUP BY 1")
def previews(spark, sf_dir):
    """The first few of a list."""
    p = table(spark, sf_dir, "lineitem").withColumn("rn", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey")))
    few = F.transform(F.array_sort(F.collect_list(F.when(F.col("rn") <= 3, F.struct("l_linenumber", "l_partkey")))), lambda x: x["l_partkey"].cast("string"))
    return p.groupBy("l_orderkey").agg(F.concat(F.array_join(few, ", "), F.when(F.count(F.lit(1)) > 3, " ...").otherwise("")).alias("preview"))


@register("best_candidates", "SELECT user_id, arg_max(event_id, (value, -event_id)) AS best FROM events GROUP BY 1")
def best_candidates(spark, sf_dir):
    """The candidate with the greatest score, the first of equals."""
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.max_by("event_id", F.struct("value", -F.col("event_id"))).alias("best"))


@register("all_jobs", "SELECT o_orderkey AS id, 'dub' AS kind FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT c_custkey, 'music' FROM customer UNION ALL SELECT s_suppkey, 'flat' FROM supplier")
def all_jobs(spark, sf_dir):
    """Jobs of all kinds."""
    one = lambda name, key, kind: table(spark, sf_dir, name).select(F.col(key).alias("id"), F.lit(kind).alias("kind"))
    return one("orders", "o_orderkey", "dub").join(table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id")), "id", "left_semi").unionByName(one("customer", "c_custkey", "music")).unionByName(one("supplier", "s_suppkey", "flat"))


@register("unmarked", "SELECT n_nationkey FROM nation EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 3000")
def unmarked(spark, sf_dir):
    """All but those that are marked."""
    return table(spark, sf_dir, "nation").select("n_nationkey").subtract(table(spark, sf_dir, "supplier").where("s_acctbal > 3000").select("s_nationkey"))


@register("packs_present", "SELECT n_nationkey FROM nation INTERSECT SELECT s_nationkey FROM supplier")
def packs_present(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey").intersect(table(spark, sf_dir, "supplier").select("s_nationkey"))


@register(
    "target_countries",
    """SELECT r_regionkey, string_agg(n, ',' ORDER BY k, n) AS countries FROM (SELECT r_regionkey, n_name AS n, 0 AS k FROM region JOIN nation ON n_regionkey = 0 UNION ALL SELECT r_regionkey, n_name, 1 FROM region JOIN nation ON n_regionkey = r_regionkey AND r_regionkey > 0 UNION ALL SELECT r_regionkey, 'EXTRA', 2 FROM region) GROUP BY 1""",
)
def target_countries(spark, sf_dir):
    """A core list, the region's own, and extras that aren't there yet."""
    names = F.array_sort(F.collect_list("n_name"))  # 25 nations
    by = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(names.alias("own"))
    core = by.where("n_regionkey = 0").select("own")
    r = table(spark, sf_dir, "region").join(by, F.col("r_regionkey") == F.col("n_regionkey")).withColumn("core", core.scalar())
    extra = F.array(F.lit("EXTRA"), F.get("core", F.lit(0)))
    return r.select("r_regionkey", F.array_join(F.array_union(F.array_union("core", "own"), extra), ",").alias("countries"))


@register("distinct_labels", "SELECT lang, string_agg(DISTINCT source, ',' ORDER BY source) FILTER (source NOT IN ('', 'ERROR', 'src0')) AS labels FROM documents GROUP BY 1")
def distinct_labels(spark, sf_dir):
    """Labels in order, without blanks and errors."""
    good = F.when(~F.col("source").isin("", "ERROR", "src0"), F.col("source"))
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.nullif(F.array_join(F.array_sort(F.collect_set(good)), ","), F.lit("")).alias("labels"))


@register(
    "loaded_keys",
    """SELECT p_partkey, concat_ws(',', a, b) AS keys FROM (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'k1,k2' WHEN p_size % 3 = 1 THEN 'single' END AS a, CASE WHEN p_size % 2 = 0 THEN 'g' || p_size ELSE 'last' END AS b FROM part)""",
)
def loaded_keys(spark, sf_dir):
    """Keys of several providers in order: the list's, else the single one; none at all is an error."""
    s = F.col("p_size")
    a = manifests.keys_of(F.when(s % 3 == 0, " k1,, k2").otherwise(""), F.when(s % 3 == 1, " single ").otherwise(""))
    b = manifests.keys_of(F.when(s % 2 == 0, F.concat(F.lit("g"), s.cast("string"))), F.lit("last"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(manifests.all_keys(a, b), ",").alias("keys"))


@register(
    "campaign_report",
    """WITH a AS (SELECT CASE WHEN c_nationkey % 5 = 0 THEN 'BGM_' || c_nationkey ELSE 'VOICED_' || c_nationkey END AS campaign, c_mktsegment AS adset FROM customer), s AS (SELECT campaign, adset, count(*) AS n FROM a GROUP BY 1, 2),
      c AS (SELECT campaign, '[' || campaign || ']  (' || CAST(sum(n) AS BIGINT) || ' ads)  ->  ' || regexp_replace(campaign, '^VOICED_', '') || chr(10) || string_agg('    ' || rpad(adset, 18, ' ') || ' ' || n, chr(10) ORDER BY n DESC, adset) || chr(10) AS block FROM s GROUP BY 1)
      SELECT string_agg(block, chr(10) ORDER BY NOT starts_with(campaign, 'BGM'), campaign) AS report FROM c""",
)
def campaign_report(spark, sf_dir):
    """The tree of campaigns and ad sets as a text."""
    from ..sources.writers import campaign_report as report

    k = F.col("c_nationkey")
    campaign = F.concat(F.when(k % 5 == 0, "BGM_").otherwise("VOICED_"), k.cast("string"))
    return report(table(spark, sf_dir, "customer").select(campaign.alias("campaign"), F.col("c_mktsegment").alias("adset")))
