"""Queries of gates: filters, verdicts, completeness, counts by pack."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..catalog import register
from ..functions import gates as G
from ..operators import numbering
from ..session import table

_SPEECH = """s AS (SELECT conv_id AS clip, turn, CASE WHEN turn % 5 = 4 THEN ' ' ELSE text END AS text, turn * 4.0::DOUBLE AS a, turn * 4.0::DOUBLE + (length(text) % 50) / 10 AS b, -(length(text) % 10) / 10 AS logprob FROM conversations)"""


def speech(spark, sf_dir):
    t, n = F.col("turn"), F.length("text")
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("clip"), "turn", F.when(t % 5 == 4, " ").otherwise(F.col("text")).alias("text"), (t * 4.0).alias("a"), (t * 4.0 + (n % 50) / 10).alias("b"), (-(n % 10) / 10).alias("logprob")
    )


@register(
    "speech_transcripts",
    f"""WITH {_SPEECH}, g AS (SELECT * FROM s WHERE trim(text) <> '' AND logprob > -0.5)
      SELECT c.clip, round(coalesce(sum(b - a), 0), 4) AS speech, coalesce(sum(b - a), 0) >= greatest(1.5, 0.05 * max(c.total)) AS has_voice, coalesce(string_agg(trim(text), ' ' ORDER BY turn, text), '') AS transcript,
        CASE WHEN coalesce(sum(b - a), 0) >= greatest(1.5, 0.05 * 45) THEN 'en' ELSE 'none' END AS vo_lang
      FROM (SELECT clip, max(b) AS total FROM s GROUP BY 1) c LEFT JOIN g USING (clip) GROUP BY 1""",
)
def speech_transcripts(spark, sf_dir):
    """Speech by clip: what is said, whether that is enough of the clip, and of a sample of 45 seconds."""
    s = speech(spark, sf_dir)
    good = (F.trim("text") != "") & (F.col("logprob") > -0.5)
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(good, F.struct("turn", "text")))), lambda x: F.trim(x["text"])), " ")
    g = s.groupBy("clip").agg(F.coalesce(F.sum(F.when(good, F.col("b") - F.col("a"))), F.lit(0.0)).alias("speech"), F.max("b").alias("total"), said.alias("transcript"))
    voice = F.col("speech") >= F.greatest(F.lit(1.5), 0.05 * F.col("total"))
    vo = F.when(F.col("speech") >= max(1.5, 0.05 * 45), "en").otherwise("none")
    return g.select("clip", F.round("speech", 4).alias("speech"), voice.alias("has_voice"), "transcript", vo.alias("vo_lang"))


@register(
    "ocr_detections",
    """SELECT l_orderkey, l_linenumber, CAST(least(l_partkey % 500, l_partkey % 500 + l_quantity, l_suppkey) AS INT) AS x1, CAST(greatest(l_partkey % 500, l_partkey % 500 + l_quantity, l_suppkey) AS INT) AS x2, trim(t) AS text FROM (
      SELECT *, CASE l_linenumber % 3 WHEN 0 THEN ' ' || l_returnflag || ' ' WHEN 1 THEN l_shipdate::DATE || ' ' ELSE l_linestatus || l_returnflag || '-' END AS t FROM lineitem) WHERE 0.5 + l_tax * 2 >= 0.6 AND length(trim(t)) >= 3""",
)
def ocr_detections(spark, sf_dir):
    """Detections that are sure and long enough, with the box around their corners."""
    n = F.col("l_linenumber") % 3
    t = F.when(n == 0, F.concat(F.lit(" "), "l_returnflag", F.lit(" "))).when(n == 1, F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit(" "))).otherwise(F.concat("l_linestatus", "l_returnflag", F.lit("-")))
    x = (F.col("l_partkey") % 500).cast("double")
    corners = F.array(F.struct(x.alias("x")), F.struct((x + F.col("l_quantity")).alias("x")), F.struct(F.col("l_suppkey").cast("double").alias("x")))
    d = table(spark, sf_dir, "lineitem").withColumns({"t": t, "c": corners}).where((0.5 + F.col("l_tax") * 2 >= 0.6) & (F.length(F.trim("t")) >= 3))
    side = lambda f: f(F.transform("c", lambda p: p["x"])).cast("int")
    return d.select("l_orderkey", "l_linenumber", side(F.array_min).alias("x1"), side(F.array_max).alias("x2"), F.trim("t").alias("text"))


@register(
    "persistent_groups",
    "SELECT user_id, event_type, count(*) AS n, round(max(value) - min(value) + 2.5, 4) AS span FROM events GROUP BY 1, 2 HAVING max(value) - min(value) + 2.5 >= 30 AND count(*) >= 6",
)
def persistent_groups(spark, sf_dir):
    """Groups that last long enough and are seen often enough."""
    span = F.max("value") - F.min("value") + 2.5
    g = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"), span.alias("span"))
    return g.where("span >= 30 AND n >= 6").withColumn("span", F.round("span", 4))


@register(
    "unprocessed",
    "SELECT o_orderkey FROM orders WHERE NOT (contains('x_PROCESSED|' || o_orderpriority, '1-URGENT') OR contains(o_orderpriority, 'LOW'))",
)
def unprocessed(spark, sf_dir):
    """Files without a mark of an earlier run."""
    c = F.concat(F.lit("x_PROCESSED|"), "o_orderpriority")
    return table(spark, sf_dir, "orders").where(~(F.contains(c, F.lit("1-URGENT")) | F.contains(c, F.lit("LOW")))).select("o_orderkey")


_CLIP = "clip AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic, CASE WHEN d.doc_id % 11 = 0 THEN 'skip' WHEN d.doc_id % 2 = 0 THEN 'hair' ELSE 'home' END AS vertical FROM documents d LEFT JOIN labels l USING (doc_id))"


def clips(spark, sf_dir):
    k = F.col("doc_id")
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return d.withColumn("vertical", F.when(k % 11 == 0, "skip").when(k % 2 == 0, "hair").otherwise("home"))


@register("work_set", f"WITH {_CLIP} SELECT doc_id, vertical FROM clip WHERE vertical <> 'skip' AND vertical = 'hair' AND quality = 1 AND lang IN ('en', 'de')")
def work_set(spark, sf_dir):
    """The clips of one app that have a voice, in the languages asked for."""
    return clips(spark, sf_dir).where((F.col("vertical") != "skip") & (F.col("vertical") == "hair") & (F.col("quality") == 1) & F.col("lang").isin("en", "de")).select("doc_id", "vertical")


@register(
    "bundle_files",
    """WITH f AS (SELECT o_orderkey, o_orderstatus, unnest(['en', 'de', NULL]) AS lang, unnest(['video', 'srt', 'log']) AS kind FROM orders) SELECT o_orderkey, kind FROM f WHERE o_orderstatus = 'F' AND lang = 'de'""",
)
def bundle_files(spark, sf_dir):
    """Files of the finished jobs in one language."""
    from ..operators import manifests

    files = F.array(*[F.struct(F.lit(lang).cast("string").alias("lang"), F.lit(kind).alias("kind")) for lang, kind in (("en", "video"), ("de", "srt"), (None, "log"))])
    jobs = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "done").otherwise("running").alias("status"), files.alias("files"))
    return manifests.bundle(jobs, lang="de").select("o_orderkey", "kind")


@register(
    "complete_translations",
    """WITH s AS (SELECT conv_id, turn, CASE WHEN conv_id % 3 = 0 AND turn = 2 THEN ' ' WHEN conv_id % 4 = 0 AND turn = 1 THEN NULL ELSE text END AS de, CASE WHEN conv_id % 5 > 0 THEN text END AS fr FROM conversations WHERE conv_id % 7 > 0)
      SELECT c.conv_id, count(s.turn) > 0 AND count(*) FILTER (trim(coalesce(de, '')) = '') = 0 AND (c.conv_id % 6 = 0 OR count(*) FILTER (trim(coalesce(fr, '')) = '') = 0) AS complete
      FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN s USING (conv_id) GROUP BY 1""",
)
def complete_translations(spark, sf_dir):
    """Whether each segment of a clip is translated into each language but its own."""
    k, t = F.col("conv_id"), F.col("turn")
    de = F.when((k % 3 == 0) & (t == 2), " ").when((k % 4 == 0) & (t == 1), F.lit(None)).otherwise(F.col("text"))
    fr = F.when(k % 5 > 0, F.col("text"))
    seg = F.when(k % 7 > 0, F.struct("turn", F.create_map(F.lit("de"), de, F.lit("fr"), fr).alias("translations")))
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_list(seg).alias("segments"))
    source = F.when(k % 6 == 0, "fr").otherwise("en")
    return c.select("conv_id", G.complete(F.col("segments"), F.array(F.lit("de"), F.lit("fr")), source).alias("complete"))


@register("low_confidence", "SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE coalesce(quality * 0.7 - toxic * 0.2, 0) < 0.6")
def low_confidence(spark, sf_dir):
    c = clips(spark, sf_dir)
    return c.where(F.coalesce(F.col("quality") * 0.7 - F.col("toxic") * 0.2, F.lit(0)) < 0.6).select("doc_id")


_SPEC = """spec AS (SELECT l_orderkey, l_linenumber, l_quantity AS a, l_quantity + l_discount * 100 - 3 AS b, l_tax * 14 AS x, l_discount * 8 AS w, l_partkey % 5 AS id, 40 + l_linenumber AS d FROM lineitem)"""


@register(
    "spec_problems",
    f"""WITH {_SPEC}, n AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey, id) AS same FROM spec)
      SELECT l_orderkey, l_linenumber, concat_ws(',', CASE WHEN abs(d - 43) > 0.15 THEN 'duration' END, CASE WHEN same > 1 THEN 'duplicate id' END, CASE WHEN NOT (0 <= a AND a < b AND b <= d + 0.05) THEN 'cut' END,
        CASE WHEN x < 0 OR x > 1 THEN 'x' END, CASE WHEN w < 0 OR w > 1 THEN 'w' END, CASE WHEN x + w > 1.001 THEN 'edge' END, CASE WHEN greatest(1, least(720, round_even(w * 720, 0))) < 12 THEN 'small' END) AS problems FROM n""",
)
def spec_problems(spark, sf_dir):
    """What is wrong with an edit: durations, ids, cuts, boxes."""
    q = F.col("l_quantity")
    s = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", q.alias("a"), (q + F.col("l_discount") * 100 - 3).alias("b"), (F.col("l_tax") * 14).alias("x"), (F.col("l_discount") * 8).alias("w"), (F.col("l_partkey") % 5).alias("id"), (40 + F.col("l_linenumber")).alias("d")
    )
    same = F.count(F.lit(1)).over(Window.partitionBy("l_orderkey", "id")) > 1
    x, w, a, b, d = (F.col(c) for c in "xwabd")
    found = G.findings(
        F.when(F.abs(d - 43) > 0.15, "duration"), F.when(same, "duplicate id"), F.when(~((a >= 0) & (a < b) & (b <= d + 0.05)), "cut"), F.when(~x.between(0, 1), "x"), F.when(~w.between(0, 1), "w"),
        F.when(x + w > 1.001, "edge"), F.when(F.greatest(F.lit(1), F.least(F.lit(720), F.bround(w * 720).cast("int"))) < 12, "small"),
    )
    return s.select("l_orderkey", "l_linenumber", F.array_join(found, ",").alias("problems"))


_BOX = f"""box AS (SELECT l_orderkey, l_linenumber, CASE l_partkey % 5 WHEN 4 THEN 'other' ELSE [{', '.join(f"'{x}'" for x in G.FILLS)}][l_partkey % 4 + 1] END AS fill, l_tax * 14 AS x, l_discount * 8 AS y, l_discount * 9 AS w, l_tax * 9 AS h, l_quantity / 2 AS a,
    l_quantity / 2 + l_discount * 50 - 1 AS b, 24 + l_suppkey % 3 AS d, l_quantity / 2 + 1 AS seed, 1080 + l_suppkey % 30 AS pw, l_linenumber % 3 = 0 AS cut FROM lineitem)"""


@register(
    "box_problems",
    f"""WITH {_BOX} SELECT l_orderkey, l_linenumber, concat_ws(',', CASE WHEN abs(1080 / 1920::DOUBLE - pw / 1920::DOUBLE) > 0.01 THEN 'aspect' END, CASE WHEN fill = 'other' THEN 'fill' END, CASE WHEN x < 0 OR x > 1 THEN 'x' END, CASE WHEN y < 0 OR y > 1 THEN 'y' END,
      CASE WHEN w < 0 OR w > 1 THEN 'w' END, CASE WHEN h < 0 OR h > 1 THEN 'h' END, CASE WHEN x + w > 1.001 OR y + h > 1.001 THEN 'edge' END, CASE WHEN NOT (0 <= a AND a < b AND b <= d + 0.05) THEN 'time' END,
      CASE WHEN seed < a OR seed > b THEN 'seed' END, CASE WHEN cut THEN 'seed in a cut' END, CASE WHEN w * 720 < 12 OR h * 1280 < 12 THEN 'small' END) AS problems FROM box""",
)
def box_problems(spark, sf_dir):
    """What is wrong with the boxes of an edit: shape of the frame, fill, place, time, seed, size."""
    q, n, s = F.col("l_quantity"), F.col("l_linenumber"), F.col("l_suppkey")
    fill = F.when(F.col("l_partkey") % 5 == 4, "other").otherwise(F.get(F.array(*map(F.lit, G.FILLS)), (F.col("l_partkey") % 4).cast("int")))
    x, y, w, h = F.col("l_tax") * 14, F.col("l_discount") * 8, F.col("l_discount") * 9, F.col("l_tax") * 9
    a, b = q / 2, q / 2 + F.col("l_discount") * 50 - 1
    found = G.findings(
        G.aspect_finding(F.lit(1080), F.lit(1920), 1080 + s % 30, F.lit(1920)), *G.box_findings(x, y, w, h, a, b, fill, 24 + s % 3),
        *G.seed_findings(q / 2 + 1, a, b, n % 3 == 0, w * 720, h * 1280),
    )
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.array_join(found, ",").alias("problems"))


_PROBE = """probe AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 = 0 THEN 1078 ELSE 1080 - CAST(l_quantity AS INT) % 4 END AS w, 1920 - CAST(l_tax * 100 AS INT) % 5 AS h, CASE l_linenumber % 4 WHEN 0 THEN 'hevc' WHEN 1 THEN '' ELSE 'h264' END AS codec,
    l_extendedprice / 150.7::DOUBLE AS mb, l_discount > 0 AS audio, l_quantity / 10 AS d, l_partkey % 20 > 0 AS there FROM lineitem)"""


def probes(spark, sf_dir):
    n, q = F.col("l_linenumber"), F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(n % 3 == 0, 1078).otherwise(1080 - q.cast("int") % 4).alias("w"), (1920 - F.bround(F.col("l_tax") * 100).cast("int") % 5).alias("h"), F.when(n % 4 == 0, "hevc").when(n % 4 == 1, "").otherwise("h264").alias("codec"),
        (F.col("l_extendedprice") / 150.7).alias("mb"), (F.col("l_discount") > 0).alias("audio"), (q / 10).alias("d"), (F.col("l_partkey") % 20 > 0).alias("there"),
    )


@register(
    "output_issues",
    f"""WITH {_PROBE} SELECT l_orderkey, l_linenumber, CASE WHEN NOT there THEN 'missing' ELSE concat_ws(';', CASE WHEN abs(w - 1080) > 2 THEN 'width ' || w END, CASE WHEN abs(h - 1920) > 2 THEN 'height ' || h END,
      CASE WHEN codec NOT IN ('', 'h264', 'avc1') THEN 'codec ' || codec END, CASE WHEN mb > 500 THEN 'size ' || printf('%.1f', mb) || ' MB' END) END AS issues,
      CASE WHEN NOT there THEN 'MISSING' WHEN w = 1080 AND h = 1920 AND audio AND d > 1 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM probe""",
)
def output_issues(spark, sf_dir):
    """What of an output breaks its rules, and the verdict on it."""
    p = probes(spark, sf_dir)
    c = {k: F.col(k) for k in p.columns}
    issues = G.output_issues(c["there"], c["w"], c["h"], c["codec"], c["mb"])
    return p.select("l_orderkey", "l_linenumber", F.array_join(issues, ";").alias("issues"), G.output_verdict(c["there"], c["w"], c["h"], c["audio"], c["d"]).alias("verdict"))


@register(
    "loudness_verdicts",
    """SELECT l_orderkey, l_linenumber, CASE WHEN v IS NULL THEN 'NO-AUDIO' ELSE coalesce(nullif(concat_ws(',', CASE WHEN v < -20 OR v > -11 THEN 'LUFS-WARN' END, CASE WHEN -l_discount * 10 > -0.3 THEN 'CLIP-WARN' END, CASE WHEN l_partkey % 6 = 0 THEN 'NO-SPEECH' END), ''), 'PASS') END AS verdict
      FROM (SELECT *, CASE WHEN l_linenumber < 7 THEN -l_quantity END AS v FROM lineitem)""",
)
def loudness_verdicts(spark, sf_dir):
    """All warnings on a mix; none can be had where nothing was measured."""
    v = F.when(F.col("l_linenumber") < 7, -F.col("l_quantity"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", G.loudness_verdict(v, -F.col("l_discount") * 10, F.col("l_partkey") % 6).alias("verdict"))


@register(
    "padding_verdicts",
    """WITH p AS (SELECT l_orderkey, l_linenumber, l_discount * 100 > 8 AS le, l_tax * 110 > 8 AS pi, l_quantity / 4 > 8 AS fl, l_partkey % 13 > 8 AS bl FROM lineitem)
      SELECT l_orderkey, l_linenumber, concat_ws(' ', CASE WHEN le THEN 'LETTERBOX' END, CASE WHEN pi THEN 'PILLARBOX' END, CASE WHEN fl AND NOT le AND NOT pi THEN 'flat-bands?' END, CASE WHEN bl AND NOT pi THEN 'blur-sides?' END) AS verdict FROM p""",
)
def padding_verdicts(spark, sf_dir):
    z = F.lit(0.0)
    dark = [F.col("l_discount") * 100, z, F.col("l_tax") * 110, z]
    flat = [F.col("l_quantity") / 4, z, F.col("l_partkey") % 13, z]
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", G.padding_verdict(dark, flat).alias("verdict"))


@register(
    "render_issues",
    f"""WITH {_PROBE}, m AS (SELECT * FROM (SELECT w || 'x' || h AS dims, row_number() OVER (ORDER BY count(*) DESC, w || 'x' || h) AS rn FROM probe GROUP BY 1) WHERE rn = 1),
      r AS (SELECT p.*, m.dims AS want, CASE WHEN l_linenumber % 5 = 0 THEN d - 3.5 + l_linenumber % 2 END AS cut, CASE WHEN l_linenumber % 2 = 0 THEN d - 2.5 END AS drift FROM probe p, m)
      SELECT l_orderkey, l_linenumber, concat_ws(';', CASE WHEN w || 'x' || h <> want THEN 'dims ' || w || 'x' || h END, CASE WHEN l_linenumber = 6 THEN 'sar 4:3' END, CASE WHEN l_linenumber = 7 THEN 'pix yuv444p' END, CASE WHEN NOT audio THEN 'NO AUDIO' END,
        CASE WHEN cut > 0 AND abs(d - (cut + 3)) > 0.35 THEN 'duration' END, CASE WHEN abs(drift) > 1 THEN 're-levelled' END, CASE WHEN -d * 15 < -60 THEN 'SILENT tail' END, CASE WHEN -mb / 8 < -45 THEN 'body near-silent' END) AS issues FROM r""",
)
def render_issues(spark, sf_dir):
    """What is wrong with renders; the commonest size is the one expected."""
    p = probes(spark, sf_dir).withColumn("dims", F.concat(F.col("w").cast("string"), F.lit("x"), F.col("h").cast("string")))
    want = p.groupBy("dims").agg(F.count(F.lit(1)).alias("n")).agg(F.min_by("dims", F.struct(-F.col("n"), "dims")).alias("want"))
    n, d = F.col("l_linenumber"), F.col("d")
    p = p.withColumn("want", want.scalar())
    issues = G.render_issues(
        F.col("dims"), F.col("want"), F.when(n == 6, "4:3").otherwise("1:1"), F.when(n == 7, "yuv444p").otherwise("yuv420p"), F.col("audio"), F.lit(""), d, F.when(n % 5 == 0, d - 3.5 + n % 2), 3.0, F.when(n % 2 == 0, d - 2.5), -d * 15, -F.col("mb") / 8
    )
    return p.select("l_orderkey", "l_linenumber", F.array_join(issues, ";").alias("issues"))


@register(
    "squeezed_pictures",
    """WITH p AS (SELECT l_orderkey, l_linenumber, l_quantity * 2 AS c, l_discount * 3 AS l, l_tax * 3 AS r, l_partkey % 20 / 100.0 AS e FROM lineitem)
      SELECT l_orderkey, l_linenumber FROM p WHERE c >= 40 AND l >= 0.08 AND r >= 0.08 AND l <= 0.42 AND r <= 0.42 AND abs(l - r) / greatest(l, r, 1e-9) <= 0.4001 AND greatest(l, r) > e + 0.0201""",
)
def squeezed_pictures(spark, sf_dir):
    p = table(spark, sf_dir, "lineitem")
    flag = G.squeezed(F.col("l_quantity") * 2, F.col("l_discount") * 3, F.col("l_tax") * 3, F.col("l_partkey") % 20 / 100.0, asymmetry=0.4001, margin=0.0201)
    return p.where(flag).select("l_orderkey", "l_linenumber")


@register(
    "preflight",
    "SELECT p_partkey, concat_ws(', ', CASE WHEN p_size < 5 THEN 'disk' END, CASE WHEN p_retailprice < 910 THEN 'memory' END, CASE WHEN p_brand LIKE '%5' THEN 'codec' END) AS failures, NOT (p_size < 5 OR p_retailprice < 910 OR p_brand LIKE '%5') AS ready FROM part",
)
def preflight(spark, sf_dir):
    """All failed checks of a machine, and whether it may start."""
    found = G.findings(F.when(F.col("p_size") < 5, "disk"), F.when(F.col("p_retailprice") < 910, "memory"), F.when(F.col("p_brand").like("%5"), "codec"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(found, ", ").alias("failures"), (F.size(found) == 0).alias("ready"))


@register(
    "limited_work",
    "SELECT p_brand, p_partkey, CASE WHEN rn <= 3 THEN 'work' ELSE 'aside' END AS place FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_name, p_partkey) AS rn FROM part WHERE regexp_matches(p_type, 'A.*E'))",
)
def limited_work(spark, sf_dir):
    """Names of a pattern, in order: the first are worked on, the rest put aside."""
    p = table(spark, sf_dir, "part").where(F.col("p_type").rlike("A.*E"))
    rn = F.row_number().over(Window.partitionBy("p_brand").orderBy("p_name", "p_partkey"))
    return p.select("p_brand", "p_partkey", F.when(rn <= 3, "work").otherwise("aside").alias("place"))


@register(
    "music_folders",
    "SELECT p_partkey, regexp_matches(path, '(?i)(^|/)bgm') AS music FROM (SELECT p_partkey, '/out/' || CASE p_size % 4 WHEN 0 THEN 'Bgm_x' WHEN 1 THEN 'VOICED' WHEN 2 THEN 'my_BGM' ELSE 'BGM' END || '/' || p_brand AS path FROM part)",
)
def music_folders(spark, sf_dir):
    s = F.col("p_size") % 4
    path = F.concat(F.lit("/out/"), F.when(s == 0, "Bgm_x").when(s == 1, "VOICED").when(s == 2, "my_BGM").otherwise("BGM"), F.lit("/"), "p_brand")
    return table(spark, sf_dir, "part").select("p_partkey", G.music_only(path).alias("music"))


@register(
    "pack_tallies",
    """WITH f AS (SELECT n_chars, doc_id, source, doc_id % 3 > 0 AS hit FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY source, hit ORDER BY doc_id) AS rn FROM f)
      SELECT source, count(*) AS total, count(*) FILTER (hit) AS hits, round(count(*) FILTER (hit) / count(*), 3) AS share, coalesce(string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) FILTER (NOT hit AND rn <= 5), '') AS suspects FROM r GROUP BY 1""",
)
def pack_tallies(spark, sf_dir):
    """Hits by pack, and the first few that are none."""
    f = table(spark, sf_dir, "documents").select("source", "doc_id", (F.col("doc_id") % 3 > 0).alias("hit"))
    counts = f.groupBy("source").agg(F.count(F.lit(1)).alias("total"), F.count_if("hit").alias("hits"))
    few = numbering.top_per_group(f.where("not hit"), ["source"], ["doc_id"], 5).groupBy("source").agg(F.array_join(F.array_sort(F.collect_list("doc_id")).cast("array<string>"), ",").alias("suspects"))
    return counts.join(few, "source", "left").select("source", "total", "hits", F.round(F.col("hits") / F.col("total"), 3).alias("share"), F.coalesce("suspects", F.lit("")).alias("suspects"))


@register(
    "batch_counts",
    """SELECT p_brand, count(*) FILTER (kind = 'mp4') AS n, count(*) FILTER (kind = 'tmp') AS n_tmp, count(*) FILTER (kind = 'mp4') >= coalesce(CASE WHEN p_brand = 'Brand#11' THEN 75 END, 1) AND count(*) FILTER (kind = 'tmp') = 0 AS ok
      FROM (SELECT p_brand, CASE WHEN p_partkey % 97 = 0 THEN 'tmp' WHEN p_size % 9 = 0 THEN 'bak' ELSE 'mp4' END AS kind FROM part) GROUP BY 1""",
)
def batch_counts(spark, sf_dir):
    """Outputs by pack against what is expected, and leftovers."""
    kind = F.when(F.col("p_partkey") % 97 == 0, "tmp").when(F.col("p_size") % 9 == 0, "bak").otherwise("mp4")
    n, tmp = F.count_if(F.col("kind") == "mp4"), F.count_if(F.col("kind") == "tmp")
    floor = F.coalesce(F.when(F.col("p_brand") == "Brand#11", 75), F.lit(1))
    return table(spark, sf_dir, "part").withColumn("kind", kind).groupBy("p_brand").agg(n.alias("n"), tmp.alias("n_tmp"), ((n >= F.max(floor)) & (tmp == 0)).alias("ok"))


@register(
    "voice_manifest",
    "SELECT conv_id, turn, CASE WHEN trim(t) <> '' THEN 'yes' ELSE 'no' END AS has_voice, CAST(length(t) AS BIGINT) AS speech_chars, substr(t, 1, 300) AS transcript FROM (SELECT *, CASE WHEN turn % 4 = 3 THEN ' ' ELSE text END AS t FROM conversations)",
)
def voice_manifest(spark, sf_dir):
    """Whether something is said, how much, and how it begins (the report shows 300 characters)."""
    t = F.when(F.col("turn") % 4 == 3, " ").otherwise(F.col("text"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.trim(t) != "", "yes").otherwise("no").alias("has_voice"), F.length(t).cast("bigint").alias("speech_chars"), F.left(t, F.lit(300)).alias("transcript"))


@register(
    "idle_machines",
    """SELECT p_partkey, p_size * 60 > 900 AND coalesce(CASE WHEN p_partkey % 3 > 0 THEN p_size * 40 >= 900 END, true) AND NOT (p_partkey % 4 = 0 AND NOT p_partkey % 8 = 0) AS stop,
      p_size * 60 >= 2800 OR (coalesce(CASE WHEN p_partkey % 3 > 0 THEN p_size * 40 > 900 END, true) AND p_partkey % 2000 > 900) AS run_out FROM part""",
)
def idle_machines(spark, sf_dir):
    k, s = F.col("p_partkey"), F.col("p_size")
    now = F.lit(100_000)
    return table(spark, sf_dir, "part").select("p_partkey", G.idle(now, now - s * 60, F.when(k % 3 > 0, now - s * 40), k % 4 == 0, k % 8 == 0, 900).alias("stop"), G.run_out(now, now - s * 60, F.when(k % 3 > 0, now - s * 40), now - k % 2000, 2800, 900).alias("run_out"))
