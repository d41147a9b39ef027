"""Quality rules with robust multivariate outliers; DataFrame functions only.

For every document the base statistics are counted in its row (no shuffle): the words of a text
are hashed in windows of five; only where two windows agree are they sorted to find the words that
stand in repeated windows. Then, for every language and source, location and scatter of transformed
statistics are estimated by the minimum covariance determinant. Several starts (medians and median
deviations; a few rows chosen by a hash) take two concentration steps each: the ``SHARE`` of rows nearest
by Mahalanobis distance are kept, location and scatter estimated anew. The start with the least
determinant goes on until its determinant falls no more in any group. A document whose distance
passes ``cutoff`` is rejected.

A group of fewer than ``MIN_GROUP`` rows is judged by the estimate of all rows of its first key
(language), and where these are too few by that of all rows.

All estimates are sums by group with map-side combination, and the cut of a step comes from a histogram
of distances, so that a group with a third of all rows is no burden for a task. Estimates are joined
to rows by broadcast up to ``BROADCAST_GROUPS`` groups, beyond that by a salted join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, stored

SPACE = "\t\n\x0b\x0c\r "
SPLIT = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Share of a group that the estimates rest on, and the factor that makes the scatter of the
#: nearest 75 % of four-dimensional normal data that of all of them.
SHARE, CONSISTENT = 0.75, 1.486
#: Least variances. Most texts have no symbol and no repetition at all; the floors keep the
#: scatter regular and say what differences in a statistic are never of note.
FLOORS = {"x_len": 0.25, "x_sym": 0.0025, "x_dup": 0.0025, "x_rep": 0.0025}
STATS = list(FLOORS)
#: Largest squared distance that is kept: the 0.99999 quantile of chi-square with a degree of freedom
#: for each statistic. On sf0.1 it parts the labels: of those from 9.49 (0.95) up to it none of 76 has
#: quality 0, from it to 60 129 of 174, and above 60 166 of 232.
CUTOFF = 28.473


OWN = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
#: Least rows for an estimate of a group's own, and of all rows.
MIN_GROUP, MIN_ALL = 30, 6
#: Rows of a start, starts, bins to an octave of distances, most steps, and the fall that ends them.
FEW, STARTS, BINS, FALL = 12, 3, 64, 1e-3
BROADCAST_GROUPS, SALTS = 50_000, 16


def base_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines in place
    of columns of these names. Null counts as a text without words."""
    d = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    words = F.filter(F.split("t", SPLIT), lambda w: w != "")
    lines = F.filter(F.split("t", "\n"), lambda x: F.translate(x, SPACE, "") != "")
    d = d.withColumns({"w": words, "l": lines, "dense": F.translate("t", SPACE, "")})
    hashes = "transform(sequence(0, size(w) - 5), i -> xxhash64(w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]))"
    d = d.withColumn("h", F.expr(f"CASE WHEN size(w) >= {WINDOW} THEN {hashes} ELSE cast(array() as array<bigint>) END"))
    d = d.withColumn("again", F.expr("size(h) > size(array_distinct(h))"))
    # windows by hash and position; one that equals a neighbour, word for word, is repeated
    # (slice() would copy the whole array for each pair)
    alike = " AND ".join(f"w[s[i].p + {k}] = w[s[{{0}}].p + {k}]" for k in range(WINDOW))
    same = f"(s[i].h = s[{{0}}].h AND {alike})"
    found = f"""
        CASE WHEN again THEN
          flatten(transform(array(sort_array(transform(h, (h, p) -> named_struct('h', h, 'p', p)))), s ->
            transform(filter(sequence(0, size(s) - 1), i -> (i > 0 AND {same.format("i - 1")}) OR (i < size(s) - 1 AND {same.format("i + 1")})), i -> s[i].p)))
        ELSE cast(array() as array<int>) END"""
    d = d.withColumn("p", F.sort_array(F.expr(found)))
    covered = "aggregate(transform(p, (q, k) -> CASE WHEN k = size(p) - 1 THEN 5 ELSE least(5, p[k + 1] - q) END), 0L, (a, x) -> a + x)"
    stats = {
        "n_words": F.size("w"),
        "word_chars": F.length("dense"),
        "n_symbols": F.length("dense") - F.length(F.translate("dense", SYMBOLS, "")),
        "n_dup_lines": F.size("l") - F.size(F.array_distinct("l")),
        "n_repeat_words": F.when(F.size("p") == 0, F.lit(0)).otherwise(F.expr(covered)),
        "n_lines": F.size("l"),
    }
    d = d.select("row", *[c.cast("long").alias(n) for n, c in stats.items()])
    return d.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in OWN], *OWN)


def transformed(stats: DataFrame) -> DataFrame:
    """With the vector that the estimates are of: mean length of words, and the square roots of the
    shares of symbols, repeated lines and repeated words."""
    ratio = lambda a, b: F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)))
    return stats.withColumns(
        {
            "x_len": F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)),
            "x_sym": ratio("n_symbols", "word_chars"),
            "x_dup": ratio("n_dup_lines", "n_lines"),
            "x_rep": ratio("n_repeat_words", "n_words"),
        }
    )


def _cholesky(est: Column) -> tuple[dict[tuple[int, int], Column], Column]:
    """The triangular factor of an estimate's scatter, written out, and its determinant."""
    chol: dict[tuple[int, int], Column] = {}
    for i in range(len(STATS)):
        for j in range(i + 1):
            rest = reduce(lambda a, b: a - b, [chol[i, k] * chol[j, k] for k in range(j)], est[f"c_{i}_{j}"])
            chol[i, j] = F.sqrt(F.greatest(rest, F.lit(FLOORS[STATS[i]]))) if i == j else rest / chol[j, j]
    return chol, reduce(lambda a, b: a * b, [chol[i, i] * chol[i, i] for i in range(len(STATS))])


def _with_factor(est: DataFrame) -> DataFrame:
    """cell, est with the inverse diagonal and the rest of the factor (l_i_j), and its determinant."""
    chol, det = _cholesky(F.col("est"))
    factor = [(1 / c if i == j else c).alias(f"l_{i}_{j}") for (i, j), c in chol.items()]
    return est.select("cell", F.struct(*[F.col("est")[f"m_{i}"].alias(f"m_{i}") for i in range(len(STATS))], *factor).alias("est"), det.alias("det"))


def _distance(est: Column) -> Column:
    """Squared Mahalanobis distance of the statistics, by forward substitution."""
    solved: list[Column] = []
    for i, x in enumerate(STATS):
        less = reduce(lambda a, b: a - b, [est[f"l_{i}_{k}"] * solved[k] for k in range(i)], F.col(x) - est[f"m_{i}"])
        solved.append(less * est[f"l_{i}_{i}"])
    return reduce(lambda a, b: a + b, [z * z for z in solved])


def _scatter(name: str, keep: Column | None = None, factor: float = 1.0) -> Column:
    """Means and covariances, of the rows to ``keep``, with the floors added to the variances, as a struct."""
    only = lambda x: F.when(keep, F.col(x)) if keep is not None else F.col(x)
    parts = [F.avg(only(x)).alias(f"m_{i}") for i, x in enumerate(STATS)]
    for i, x in enumerate(STATS):
        for j in range(i + 1):
            floor = FLOORS[x] if i == j else 0.0
            parts.append((F.lit(factor) * F.coalesce(F.covar_pop(only(x), only(STATS[j])), F.lit(0.0)) + floor).alias(f"c_{i}_{j}"))
    return F.struct(*parts).alias(name)


def _met(rows: DataFrame, by_cell: DataFrame, keys: list[str], n: int) -> DataFrame:
    """``rows`` with the columns of a table that has a row for each of n groups."""
    if n <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(by_cell), keys)
    salt = F.pmod(F.xxhash64(*STATS), F.lit(SALTS))
    return rows.withColumn("salt", salt).join(by_cell.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), [*keys, "salt"]).drop("salt")


def _bin(d2: Column) -> Column:
    return F.floor(F.log2(F.greatest(d2, F.lit(1e-12))) * BINS)


def _concentrated(rows: DataFrame, ests: DataFrame, names: list[str], n: int) -> DataFrame:
    """A step of each of the estimates ``names`` (cell, a struct each): the SHARE of a cell's rows with
    the least distance, to a bin, and the estimate of these."""
    far = _met(rows, ests, ["cell"], n).select("cell", *STATS, *[_bin(_distance(F.col(x))).alias(f"b_{x}") for x in names])
    bins = far.select("cell", F.explode(F.array(*[F.struct(F.lit(x).alias("name"), F.col(f"b_{x}").alias("bin")) for x in names])).alias("z")).groupBy("cell", "z.name", "z.bin").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy("cell", "name")
    upto = F.sum("c").over(w.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    cut = bins.withColumns({"upto": upto, "all": F.sum("c").over(w)}).where(F.col("upto") >= SHARE * F.col("all")).groupBy("cell", "name").agg(F.min("bin").alias("cut"))
    cuts = cut.groupBy("cell").agg(*[F.max(F.when(F.col("name") == x, F.col("cut"))).alias(f"t_{x}") for x in names])
    near = _met(far, cuts, ["cell"], n)
    return near.groupBy("cell").agg(*[_scatter(x, F.col(f"b_{x}") <= F.col(f"t_{x}"), CONSISTENT) for x in names])


def _starts(rows: DataFrame, n: int) -> tuple[DataFrame, list[str]]:
    """cell and an estimate for each start."""
    mid = rows.groupBy("cell").agg(*[F.percentile_approx(x, 0.5, 1000).alias(f"m_{i}") for i, x in enumerate(STATS)])
    dev = _met(rows, mid, ["cell"], n).groupBy("cell").agg(
        *[F.max(f"m_{i}").alias(f"m_{i}") for i in range(len(STATS))], *[F.percentile_approx(F.abs(F.col(x) - F.col(f"m_{i}")), 0.5, 1000).alias(f"d_{i}") for i, x in enumerate(STATS)]
    )
    parts = [F.col(f"m_{i}") for i in range(len(STATS))]
    parts += [(F.pow(1.4826 * F.col(f"d_{i}"), F.lit(2)) + FLOORS[x] if i == j else F.lit(0.0)).alias(f"c_{i}_{j}") for i, x in enumerate(STATS) for j in range(i + 1)]
    out = dev.select("cell", F.struct(*parts).alias("s0"))
    for k in range(1, STARTS):
        few = rows.withColumn("rn", F.row_number().over(Window.partitionBy("cell").orderBy(F.xxhash64(*STATS, F.lit(k)), *STATS))).where(F.col("rn") <= FEW)
        out = out.join(few.groupBy("cell").agg(_scatter(f"s{k}")), "cell")
    return out, [f"s{k}" for k in range(STARTS)]


def robust_estimates(rows: DataFrame) -> DataFrame:
    """cell and est, the minimum covariance determinant estimate of each cell of rows (cell and the
    statistics)."""
    cells = rows.select("cell").distinct().count()
    ests, names = _starts(rows, cells)

    def factored(df: DataFrame, names: list[str]) -> DataFrame:
        out = [_with_factor(df.select("cell", F.col(x).alias("est"))).select("cell", F.struct("est", "det").alias(x)) for x in names]
        return reduce(lambda a, b: a.join(b, "cell"), out)

    def flat(df: DataFrame, names: list[str]) -> DataFrame:
        return df.select("cell", *[F.col(f"{x}.est").alias(x) for x in names], *[F.col(f"{x}.det").alias(f"det_{x}") for x in names])

    ests = stored(ests, "starts")
    for _ in range(2):
        old, ests = ests, stored(_concentrated(rows, flat(factored(ests, names), names), names, cells), "scatter")
        discard(old)
    best = flat(factored(ests, names), names)
    least = F.least(*[F.col(f"det_{x}") for x in names])
    pick = F.coalesce(*[F.when(F.col(f"det_{x}") == least, F.col(x)) for x in names])
    now = stored(best.select("cell", pick.alias("est"), least.alias("det"), F.lit(True).alias("falls")), "best")
    discard(ests)
    # every determinant that is stepped on falls by a share and has a floor, so this ends; cells whose determinant
    # no longer falls are done, and their rows are left out
    while not (live := now.where("falls")).isEmpty():
        part = rows.join(F.broadcast(live.select("cell")) if cells <= BROADCAST_GROUPS else live.select("cell"), "cell", "left_semi")
        step = _concentrated(part, live.select("cell", "est"), ["est"], cells)
        new = _with_factor(step).join(live.select("cell", F.col("est").alias("old"), F.col("det").alias("was")), "cell")
        falls = F.col("det") < F.col("was") * (1 - FALL)
        new = new.select("cell", F.when(falls, F.col("est")).otherwise(F.col("old")).alias("est"), F.when(falls, F.col("det")).otherwise(F.col("was")).alias("det"), falls.alias("falls"))
        old, now = now, stored(new.unionByName(now.where("NOT falls")), "scatter")
        discard(old)
    return now.select("cell", "est", "det")


def judge(docs: DataFrame, text: str = "text", by: tuple[str, ...] = ("lang", "source"), cutoff: float = CUTOFF, min_group: int = MIN_GROUP) -> DataFrame:
    """``docs`` without the text, with the base statistics, base_failed, distance and kept, in place of
    columns of these names.

    base_failed: fewer than 10 words, or more than a fifth of the words in repeated windows. kept:
    not base_failed, and the squared distance is at most ``cutoff``. The estimates are of rows
    that pass the base rules; groups with fewer than ``min_group`` of them share an estimate (with fewer
    than MIN_ALL rows in all there is none: the distance is null). Nulls in ``by`` form groups of their
    own; repeated rows count each; an empty table gives no rows."""
    names = [*OWN, "base_failed", "distance", "kept"]
    rest = [c for c in docs.columns if c != text and c not in names]
    by = by or (F.lit(""),)
    given = docs.select(F.struct(*rest, F.lit(True).alias("_")).alias("row"), F.col(text).alias("text"), *[F.coalesce(F.concat(F.lit("+"), (F.col(c) if isinstance(c, str) else c).cast("string")), F.lit("-")).alias(f"k{i}") for i, c in enumerate(by)])
    stats = transformed(base_statistics(given)).drop("text")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = stored(stats.withColumn("base_failed", failed), "stats")
    keys = [f"k{i}" for i in range(len(by))]
    passed = rows.where(~F.col("base_failed"))
    sizes = stored(passed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "sizes")
    total, least = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    own = sizes.where(F.col("n") >= min_group).select(*keys, F.concat_ws("|", F.lit("own"), *keys).alias("own"))
    first = sizes.groupBy("k0").agg(F.sum("n").alias("n")).where(F.col("n") >= min_group).select("k0", F.concat_ws("|", F.lit("first"), "k0").alias("first"))

    def placed(df: DataFrame) -> DataFrame:
        """The group whose estimate judges a row."""
        found = df.join(F.broadcast(own) if least <= BROADCAST_GROUPS else own, keys, "left")
        found = found.join(F.broadcast(first) if least <= BROADCAST_GROUPS else first, "k0", "left")
        return found.withColumn("cell", F.coalesce("own", "first", F.lit("all"))).drop("own", "first")

    whole = placed(rows)
    asked = stored(whole.select("cell", *keys).where(~F.col("cell").startswith("own")).groupBy("cell").agg(F.max("k0").alias("k0")), "asked")
    some = [placed(passed).where(F.col("cell").startswith("own")).select("cell", *STATS)]
    if asked.where(F.col("cell").startswith("first")).count():
        some.append(passed.join(F.broadcast(asked.where(F.col("cell").startswith("first"))), "k0").select("cell", *STATS))
    if total >= MIN_ALL and asked.where("cell = 'all'").count():
        some.append(passed.select(F.lit("all").alias("cell"), *STATS))
    sample = stored(reduce(lambda a, b: a.unionByName(b), some), "sample")
    est = robust_estimates(sample)
    discard(sample, asked)
    judged = whole.join(F.broadcast(est) if least <= BROADCAST_GROUPS else est, "cell", "left").withColumn("distance", F.when(F.col("est").isNotNull(), _distance(F.col("est"))))
    kept = ~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= cutoff)
    return judged.withColumn("kept", kept).select(*[F.col("row")[c].alias(c) for c in rest], *names)
