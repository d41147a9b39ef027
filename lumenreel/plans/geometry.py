"""Queries of boxes, canvases, verdicts on pictures and filter strings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import register
from ..functions import geometry as G
from ..functions import text as X
from ..session import table


@register(
    "colours",
    """WITH c AS (SELECT p_partkey, '#' || upper(substr(md5(p_name), 1, 6)) AS color FROM part), b AS (SELECT *, list_transform([2, 4, 6], lambda i: CAST('0x' || substr(color, i, 2) AS INT)) AS ch FROM c)
      SELECT p_partkey, '#' || array_to_string(list_transform(ch, lambda x: lpad(upper(to_hex(x // 32 * 32)), 2, '0')), '') AS bucket,
        CASE WHEN p_partkey % 9 = 0 THEN '255,255,255,128' ELSE array_to_string(ch, ',') || ',128' END AS rgba FROM b""",
)
def colours(spark, sf_dir):
    """Colours in coarse buckets, and as red, green, blue and alpha."""
    c = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("#"), F.upper(F.left(F.md5("p_name"), F.lit(6)))).alias("color"))
    given = F.when(F.col("p_partkey") % 9 == 0, F.lit("#FFF")).otherwise(F.col("color"))
    return c.select("p_partkey", G.quantized(F.col("color")).alias("bucket"), F.array_join(G.rgba(given, F.lit(128)).cast("array<string>"), ",").alias("rgba"))


_BOX = "box AS (SELECT l_orderkey, l_linenumber, l_discount * 12 - 0.1 AS x, l_tax * 15 AS y, l_quantity / 50 AS w, l_discount * 5 AS h FROM lineitem)"


@register(
    "boxes",
    f"""WITH {_BOX}, p AS (SELECT *, greatest(0, least(719, CAST(round_even(x * 720, 0) AS INT))) AS px, greatest(0, least(1279, CAST(round_even(y * 1280, 0) AS INT))) AS py,
        greatest(0.0, x - w * 0.25) AS gx, greatest(0.0, y - h * 0.25) AS gy FROM box)
      SELECT l_orderkey, l_linenumber, px, py, greatest(1, least(720 - px, CAST(round_even(w * 720, 0) AS INT))) AS pw, greatest(1, least(1280 - py, CAST(round_even(h * 1280, 0) AS INT))) AS ph,
        round(gx, 6) AS gx, round(gy, 6) AS gy, round(least(1.0 - gx, w + 2 * w * 0.25), 6) AS gw, round(least(1.0 - gy, h + 2 * h * 0.25), 6) AS gh FROM p""",
)
def boxes(spark, sf_dir):
    """Normalised boxes in pixels, and grown by a quarter."""
    d = F.col("l_discount")
    b = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (d * 12 - 0.1).alias("x"), (F.col("l_tax") * 15).alias("y"), (F.col("l_quantity") / 50).alias("w"), (d * 5).alias("h"))
    box = [F.col(c) for c in "xywh"]
    return b.select("l_orderkey", "l_linenumber", *[c.alias(n) for c, n in zip(G.pixels(*box, 720, 1280), ("px", "py", "pw", "ph"), strict=True)], *[F.round(c, 6).alias(n) for c, n in zip(G.padded(*box, 0.25), ("gx", "gy", "gw", "gh"), strict=True)])


_SIZES = "size AS (SELECT p_partkey, CAST(200 + p_size * 37 AS INT) AS w, CAST(300 + p_partkey % 40 * 41 AS INT) AS h, p_size FROM part)"


def sizes(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", (200 + F.col("p_size") * 37).cast("int").alias("w"), (300 + F.col("p_partkey") % 40 * 41).cast("int").alias("h"), "p_size")


_FITTED = f"""WITH {_SIZES}, r AS (SELECT *, w / h AS ratio, 1080 / 1920 AS target FROM size),
      f AS (SELECT *, CASE WHEN ratio > target THEN 1080 ELSE CAST(round_even(1920 * ratio, 0) AS INT) END AS a, CASE WHEN ratio > target THEN CAST(round_even(1080 / ratio, 0) AS INT) ELSE 1920 END AS b, abs(ratio - target) / target < 0.02 AS near FROM r),
      g AS (SELECT *, CASE WHEN near THEN 1080 ELSE a - a % 2 END AS fw, CASE WHEN near THEN 1920 ELSE b - b % 2 END AS fh FROM f)"""


@register("fitted_sizes", _FITTED + " SELECT p_partkey, CAST(fw AS INT) AS fw, CAST(fh AS INT) AS fh, CAST((1080 - fw) // 2 AS INT) AS x, CAST((1920 - fh) // 2 AS INT) AS y FROM g")
def fitted_sizes(spark, sf_dir):
    """Pictures fitted to a canvas."""
    return sizes(spark, sf_dir).select("p_partkey", *[c.cast("int").alias(n) for c, n in zip(G.fitted(F.col("w"), F.col("h")), ("fw", "fh", "x", "y"), strict=True)])


@register(
    "canvas_filters",
    _FITTED
    + """ SELECT p_partkey, CASE WHEN near THEN '[0:v]scale=1080:1920[vout]' WHEN p_size % 2 = 0 THEN '[0:v]scale=1080:1920:force_original_aspect_ratio=increase,crop=1080:1920[vout]'
        ELSE '[0:v]scale=1080:1920:force_original_aspect_ratio=increase,crop=1080:1920,boxblur=20:5[bg];[0:v]scale=' || CAST(fw AS INT) || ':' || CAST(fh AS INT) || '[fg];[bg][fg]overlay=' || CAST((1080 - fw) // 2 AS INT) || ':' || CAST((1920 - fh) // 2 AS INT) || '[vout]' END AS chain FROM g""",
)
def canvas_filters(spark, sf_dir):
    mode = F.when(F.col("p_size") % 2 == 0, "cover").otherwise("blur")
    return sizes(spark, sf_dir).select("p_partkey", G.canvas_filter(F.col("w"), F.col("h"), mode).alias("chain"))


@register(
    "displayed_sizes",
    f"""WITH {_SIZES}, s AS (SELECT *, CASE p_size % 5 WHEN 0 THEN '40:33' WHEN 1 THEN '0:1' WHEN 2 THEN 'N/A' WHEN 3 THEN NULL ELSE '1:1' END AS sar, CASE p_size % 4 WHEN 0 THEN -90 WHEN 1 THEN 180 WHEN 2 THEN 270 ELSE 0 END AS rot FROM size),
      n AS (SELECT *, CASE WHEN sar = '40:33' THEN 40 ELSE 1 END AS sn, CASE WHEN sar = '40:33' THEN 33 ELSE 1 END AS sd, rot IN (-90, 270) AS turned FROM s),
      d AS (SELECT *, CAST(CASE WHEN turned THEN h * sd // sn ELSE w * sn // sd END AS INT) AS dw, CASE WHEN turned THEN w ELSE h END AS dh FROM n)
      SELECT p_partkey, dw, dh, abs(dw / dh - CAST(9 AS DOUBLE) / 16) <= CAST(0.05 AS DOUBLE) * (CAST(9 AS DOUBLE) / 16) AS portrait, abs(dw / dh - CAST(1080 AS DOUBLE) / 1920) <= CAST(0.05 AS DOUBLE) AS target, CAST(greatest(2, dw - dw % 2) AS INT) AS even_w, CAST(greatest(2, dh - dh % 2) AS INT) AS even_h FROM d""",
)
def displayed_sizes(spark, sf_dir):
    """Sizes as shown, and two tests of their ratio."""
    s = F.col("p_size")
    sar = F.when(s % 5 == 0, "40:33").when(s % 5 == 1, "0:1").when(s % 5 == 2, "N/A").when(s % 5 == 4, "1:1")
    rot = F.when(s % 4 == 0, -90).when(s % 4 == 1, 180).when(s % 4 == 2, 270).otherwise(0)
    dw, dh = G.displayed(F.col("w"), F.col("h"), sar, rot)
    even_w, even_h = G.even_displayed(F.col("w"), F.col("h"), sar, rot)
    d = sizes(spark, sf_dir).select("p_partkey", dw.alias("dw"), dh.alias("dh"), even_w.alias("even_w"), even_h.alias("even_h"))
    return d.withColumns({"portrait": G.is_portrait(F.col("dw"), F.col("dh")), "target": G.is_target(F.col("dw"), F.col("dh"))})


@register(
    "pad_bands",
    f"""WITH {_SIZES}, s AS (SELECT *, least(CAST(1080 AS DOUBLE) / w, CAST(1920 AS DOUBLE) / h) AS scale FROM size),
      d AS (SELECT *, CAST(trunc(w * scale) AS INT) - CAST(trunc(w * scale) AS INT) % 2 AS dw, CAST(trunc(h * scale) AS INT) - CAST(trunc(h * scale) AS INT) % 2 AS dh FROM s)
      SELECT p_partkey, dw, dh, CAST((1920 - dh) // 2 AS INT) AS top, CAST(1920 - dh - (1920 - dh) // 2 AS INT) AS bottom, CAST((1080 - dw) // 2 AS INT) AS side FROM d""",
)
def pad_bands(spark, sf_dir):
    return sizes(spark, sf_dir).select("p_partkey", *[c.alias(n) for c, n in zip(G.bands(F.col("w"), F.col("h")), ("dw", "dh", "top", "bottom", "side"), strict=True)])


@register(
    "sample_times",
    """SELECT p_partkey, round(greatest(CAST(0.5 AS DOUBLE), p_size * CAST(0.1 AS DOUBLE)), 6) AS first, round(greatest(CAST(0.5 AS DOUBLE), p_size * CAST(0.9 AS DOUBLE)), 6) AS last,
      array_to_string(list_transform([0, 1, 2, 3, 4], lambda i: CAST(round(p_size * (CAST(0.05 AS DOUBLE) + CAST(0.9 AS DOUBLE) * i / 4), 3) AS VARCHAR)), ' ') AS spread,
      round(greatest(0.0, p_size - 7) + (p_size - CAST(0.06 AS DOUBLE) - greatest(0.0, p_size - 7)) * 2 / 3, 6) AS late FROM part""",
)
def sample_times(spark, sf_dir):
    """Times at which clips are looked at."""
    d = F.col("p_size").cast("double")
    t = G.sample_times(d, [0.1, 0.5, 0.9])
    spread = F.array_join(F.transform(G.even_times(d, 5), lambda x: F.round(x, 3).cast("string")), " ")
    return table(spark, sf_dir, "part").select("p_partkey", F.round(t[0], 6).alias("first"), F.round(t[2], 6).alias("last"), spread.alias("spread"), F.round(G.tail_times(d, 4)[2], 6).alias("late"))


@register(
    "overlay_filters",
    r"""WITH g AS (SELECT conv_id, turn, text, CAST(10 + turn * 3 AS INT) AS x1, CAST(20 + turn * 5 AS INT) AS y1, CAST(210 + turn * 3 AS INT) AS x2, CAST(60 + turn * 25 AS INT) AS y2, turn * 4.0 AS t0, turn * 4.0 + 2.5 AS t1,
        replace(replace(replace(replace(nfc_normalize(text), '\', '\\'), '''', '’'), ':', '\:'), '%', '%%') AS e FROM conversations),
      f AS (SELECT *, greatest(14, CAST(trunc((y2 - y1) * 0.75) AS INT)) AS s, length(text) AS n FROM g),
      z AS (SELECT *, CASE WHEN n > 0 AND n * s * CAST(0.55 AS DOUBLE) > x2 - x1 THEN greatest(14, CAST(trunc((x2 - x1) / (n * CAST(0.55 AS DOUBLE))) AS INT)) ELSE s END AS size FROM f)
      SELECT conv_id, string_agg('drawbox=x=' || (x1 - 4) || ':y=' || (y1 - 4) || ':w=' || (x2 - x1 + 8) || ':h=' || (y2 - y1 + 8) || ':color=0x000000@0.85:t=fill:enable=''between(t,' || printf('%.2f', t0) || ',' || printf('%.2f', t1) || ')'','
        || 'drawtext=text=''' || e || ''':fontfile=font.ttf:x=' || x1 || '+(' || (x2 - x1) || '-text_w)/2:y=' || y1 || '+(' || (y2 - y1) || '-text_h)/2:fontsize=' || size || ':fontcolor=0xFFFFFF:enable=''between(t,' || printf('%.2f', t0) || ',' || printf('%.2f', t1) || ')''', ','
        ORDER BY turn, text) AS chain FROM z GROUP BY 1""",
)
def overlay_filters(spark, sf_dir):
    """For each clip the filters that cover its texts and draw their translations, in order."""
    t = F.col("turn")
    box = F.array(*[c.cast("int") for c in (10 + t * 3, 20 + t * 5, 210 + t * 3, 60 + t * 25)])
    g = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text", box.alias("box"), (t * 4.0).cast("double").alias("t0"), (t * 4.0 + 2.5).cast("double").alias("t1"), X.drawtext(F.col("text")).alias("e"))
    size = G.font_size(F.col("box")[2] - F.col("box")[0], F.col("box")[3] - F.col("box")[1], F.col("text"))
    span = (F.col("t0"), F.col("t1"))
    pair = F.concat_ws(",", G.cover_filter(F.col("box"), F.lit("#000000"), F.lit(0.85), *span), G.text_filter(F.col("box"), F.col("e"), size, F.lit("#FFFFFF"), *span, "font.ttf"))
    chain = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text", pair.alias("f")))), lambda x: x["f"]), ",")
    return g.groupBy("conv_id").agg(chain.alias("chain"))
