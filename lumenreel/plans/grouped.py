"""Queries of order-dependent grouping: each decision rests on those before it, which SQL can't say in
one pass; the tests hold them against models. Styles of groups have SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import register
from ..operators import grouping, joins
from ..session import table


def detections(spark, sf_dir):
    """Texts of a clip: the segments of an order, at places and times by its parts."""
    k, q = F.col("l_partkey"), F.col("l_quantity").cast("int")
    x, y = (k % 4) * 40, (k % 3) * 30
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("clip"), (F.col("l_linenumber") % 3 * 2.0).alias("time"), F.col("l_linenumber").alias("pos"), F.concat("l_returnflag", "l_linestatus", F.lit(" sale")).alias("text"),
        x.cast("int").alias("x1"), y.cast("int").alias("y1"), (x + 60 + q).cast("int").alias("x2"), (y + 40).cast("int").alias("y2"),
    )


def _rounded(df):
    return df.select("clip", "text", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"), "n", "x1", "y1", "x2", "y2")


@register("greedy_groups")
def greedy_groups(spark, sf_dir):
    """Texts that persist on screen, without twins."""
    return _rounded(grouping.persistent(detections(spark, sf_dir)))


@register("tracked_groups")
def tracked_groups(spark, sf_dir):
    """Texts that persist while they move."""
    return _rounded(grouping.tracked(detections(spark, sf_dir)))


@register("plateau_cards")
def plateau_cards(spark, sf_dir):
    """Where the cards at a clip's end begin: the values of a user's events are frames of four numbers."""
    v = F.col("value")
    frames = table(spark, sf_dir, "events").select(F.col("user_id").alias("clip"), F.col("event_id").alias("n"), F.array(*[F.floor(v / 40) * 30 + i for i in range(4)]).alias("v"))
    return grouping.plateaus(frames, 4.0)


@register("tracked_boxes")
def tracked_boxes(spark, sf_dir):
    """Where each group that is tracked is half a second after each of its sightings: between two sightings on the line from box to box."""
    seen = grouping.sightings(detections(spark, sf_dir)).select("clip", "group", "time", F.array("x1", "y1", "x2", "y2").alias("box"))
    asked = seen.select("clip", "group", (F.col("time") + 0.5).alias("time"))
    return joins.interpolated(asked, seen, ["clip", "group"], "time", "box")


_SHADE = "[CAST('0x' || substr({c}, 2, 2) AS INT) // 32, CAST('0x' || substr({c}, 4, 2) AS INT) // 32, CAST('0x' || substr({c}, 6, 2) AS INT) // 32]"


def _top_sql(c: str) -> str:
    seen = f"SELECT k, {_SHADE.format(c=c)} AS s, count(*) AS n, min(pos) AS pos, arg_min({c}, pos) AS v FROM f GROUP BY 1, 2"
    return f"SELECT k, v FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n DESC, pos) AS top FROM ({seen})) WHERE top = 1"


@register(
    "group_styles",
    f"""WITH s AS (SELECT l_orderkey AS k, row(l_linenumber, l_partkey, l_suppkey, l_quantity) AS pos, CASE WHEN l_quantity < 40 THEN printf('#%02X%02X%02X', CAST(l_quantity * 5 AS INT), l_partkey % 64, 200 + l_suppkey % 4) END AS fg, CASE WHEN l_linenumber < 5 THEN printf('#0000%02X', l_partkey % 256) END AS bg,
      CASE WHEN l_quantity > 5 THEN CAST(l_quantity AS INT) END AS height, CASE WHEN l_orderkey % 5 > 0 THEN (l_suppkey % 8) / 8.0 END AS opacity FROM lineitem),
    f AS (SELECT k, pos, coalesce(fg, '#FFFFFF') AS fg, coalesce(bg, '#000000') AS bg, coalesce(height, 24) AS height, coalesce(opacity, 0.85) AS opacity FROM s)
    SELECT r.k, a.v AS fg, b.v AS bg, r.height, r.opacity FROM (SELECT k, CAST(trunc(median(height)) AS INT) AS height, round_even(avg(opacity), 2) AS opacity FROM f GROUP BY 1) r
    JOIN ({_top_sql('fg')}) a USING (k) JOIN ({_top_sql('bg')}) b USING (k)""",
)
def group_styles(spark, sf_dir):
    """Both colours, height and opacity of groups whose samples lack some of them."""
    q, p = F.col("l_quantity"), F.col("l_partkey")
    fg = F.when(q < 40, F.format_string("#%02X%02X%02X", (q * 5).cast("int"), (p % 64).cast("int"), (200 + F.col("l_suppkey") % 4).cast("int")))
    bg = F.when(F.col("l_linenumber") < 5, F.format_string("#0000%02X", (p % 256).cast("int")))
    height, opacity = F.when(q > 5, q.cast("int")), F.when(F.col("l_orderkey") % 5 > 0, (F.col("l_suppkey") % 8) / 8.0)
    samples = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity").alias("at"), fg.alias("fg"), bg.alias("bg"), height.alias("height"), opacity.alias("opacity"))
    return grouping.styled(samples, ["k"], ["at"])
