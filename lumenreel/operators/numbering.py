"""Deterministic numbering, batching and rotation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Rows of a group that one task numbers; larger groups are cut into slices of about half as many.
PLAIN = 2_000_000


def _null_safe(a: str, b: str, names: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{g}").eqNullSafe(F.col(f"{b}.{g}")) for g in names], F.lit(True))


def numbered(rows: DataFrame, group: list[str], order: list[str], key: Column | None = None) -> DataFrame:
    """``rows`` with ``place``, the number of each in its group from 1, and ``total``, the group's rows.

    The groups are counted first. If none has more than PLAIN rows, a window numbers them. Else those that have are
    dealt by ``key``, a number that grows with the order (by default its first column), into
    slices of equal width, which are numbered each for itself and then moved up by the rows of
    the slices before. No task has to see a whole large group, unless its keys are all alike. Only the large groups' ends are
    broadcast: at most the rows over PLAIN of them."""
    k = (key if key is not None else F.col(order[0])).cast("double")
    large = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.min(k).alias("_lo"), F.max(k).alias("_hi")).where(F.col("_n") > PLAIN)
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    if large.isEmpty():
        return rows.withColumns({"place": F.row_number().over(whole.orderBy(*order)).cast("long"), "total": F.count(F.lit(1)).over(whole)})
    r = rows.withColumn("_k", k).alias("r").join(F.broadcast(large).alias("s"), _null_safe("r", "s", group), "left").select("r.*", "_n", "_lo", "_hi")
    slices = F.ceil(2 * F.col("_n") / PLAIN)
    wide = F.greatest(F.col("_hi") - F.col("_lo"), F.lit(1e-300))
    part = F.when(F.col("_n").isNull(), 0).otherwise(F.coalesce(F.least(F.floor((F.col("_k") - F.col("_lo")) / wide * slices), slices - 1), F.lit(-1))).cast("int")
    r = r.withColumn("_part", part)
    place = F.row_number().over(Window.partitionBy(*group, "_part").orderBy(*order))
    sizes = r.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.withColumns({"_before": F.sum("_n").over(whole.orderBy("_part")) - F.col("_n"), "total": F.sum("_n").over(whole)})
    r = r.withColumn("_place", place).alias("r").join(sizes.alias("s"), _null_safe("r", "s", [*group, "_part"]))
    return r.select(*[F.col(f"r.{c}") for c in rows.columns], (F.col("_before") + F.col("_place")).cast("long").alias("place"), F.col("total"))


def sequence_names(rows: DataFrame, group: list[str], order: list[str], code: Column, day: Column) -> DataFrame:
    """``seq`` and ``name`` (CODE_ddMM and the padded number) by group; two digits up to 99."""
    n = numbered(rows, group, order).withColumnRenamed("place", "seq")
    width = F.when(F.col("total") <= 99, 2).otherwise(F.greatest(F.lit(3), F.length(F.col("total").cast("string"))))
    return n.withColumn("name", F.concat(code, F.lit("_"), day, F.lpad(F.col("seq").cast("string"), width, F.lit("0")))).drop("total")


def rotation(rows: DataFrame, group: list[str], order: list[str], size: int) -> DataFrame:
    """``place`` in the group, from 1, and ``slot``, that in a rotation of ``size``."""
    return numbered(rows, group, order).drop("total").withColumn("slot", ((F.col("place") - 1) % size).cast("int"))


def ad_name(campaign: Column, place: Column) -> Column:
    """campaign_adNN, two digits at least."""
    n = place.cast("string")
    return F.concat(campaign, F.lit("_ad"), F.lpad(n, F.greatest(F.lit(2), F.length(n)), F.lit("0")))


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``place`` among all rows, from 1."""
    return numbered(rows, [], order).drop("total")


def sampled(rows: DataFrame, group: list[str], key: str, n: int, seed: int) -> DataFrame:
    """``n`` rows of each group, the least by a digest of key and seed."""
    w = Window.partitionBy(*group).orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}"))), key)
    return rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def batches(rows: DataFrame, group: list[str], order: list[str], size: int, text: str, context: int = 2) -> DataFrame:
    """One row per batch of ``size`` rows: ``batch``, ``texts`` in order, and the texts of up to
    ``context`` rows ``before`` and ``after`` the batch."""
    w = Window.partitionBy(*group).orderBy(*order)
    near = lambda f: F.array_compact(F.array(*[f(text, k).over(w) for k in (range(context, 0, -1) if f is F.lag else range(1, context + 1))]))
    r = rows.withColumns({"_rn": F.row_number().over(w) - 1, "_before": near(F.lag), "_after": near(F.lead)})
    r = r.withColumn("batch", F.floor(F.col("_rn") / size).cast("bigint"))
    sorted_texts = F.transform(F.array_sort(F.collect_list(F.struct("_rn", F.col(text).alias("t")))), lambda x: x["t"])
    return r.groupBy(*group, "batch").agg(sorted_texts.alias("texts"), F.min_by("_before", "_rn").alias("before"), F.max_by("_after", "_rn").alias("after"))


def top_per_group(rows: DataFrame, group: list[str], order: list, k: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= k)


def gap_filled(rows: DataFrame, group: list[str], order: list[str], kept: str) -> DataFrame:
    """``rows`` with ``number`` and ``padded``: the ``kept`` numbers (from 1) stay, the other rows take the least
    numbers of their group that are free, in order. Numbers are padded to two digits up to 99 rows, else
    three, and wider if a kept one is. Kept numbers below 1 take none.

    Before the i-th kept number k lie k - i free ones. So if the new rows, by their rank, and the kept numbers, by
    k - i, are put into one order (new ones first where even), a new row's place in it is its rank and the
    kept numbers below its own: its number. Ranks and places are numbered(), which cuts large groups."""
    new = numbered(rows.where(F.col(kept).isNull()), group, order).drop("total").withColumnRenamed("place", "_v")
    taken = rows.where(F.col(kept) >= 1).select(*group, F.col(kept).cast("bigint").alias("_kept")).distinct()
    below = numbered(taken, group, ["_kept"]).select(*group, (F.col("_kept") - F.col("place")).alias("_v"))
    merged = new.withColumn("_new", F.lit(0)).unionByName(below.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    filled = numbered(merged, group, ["_v", "_new"]).where("_new = 0").withColumnRenamed("place", "number").drop("_v", "_new", "total")
    out = filled.unionByName(rows.where(F.col(kept).isNotNull()).withColumn("number", F.col(kept).cast("bigint")))
    n = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.max(kept).alias("_most"))
    wide = n.select(*group, F.greatest(F.when(F.col("_n") <= 99, 2).otherwise(3), F.coalesce(F.length(F.col("_most").cast("string")), F.lit(0))).alias("_width"))
    text = F.col("number").cast("string")
    return out.join(wide, group).withColumn("padded", F.lpad(text, F.greatest("_width", F.length(text)), F.lit("0"))).drop("_width")
