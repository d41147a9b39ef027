"""Samples of a clip in order: gating, bridging, smoothing, reports, and tests at a clip's end.

Samples have ``clip``, ``n`` (their order), ``x``, ``y``, ``scale``, ``score`` and ``scene_diff``. All
operators are windows over a clip, or array functions over one of its runs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEFORE = (Window.unboundedPreceding, -1)
UPTO = (Window.unboundedPreceding, 0)


def gated(samples: DataFrame, accept: float = 0.72, hold: int = 6, scene: float = 25.0) -> DataFrame:
    """``samples`` with ``state``, and predicted positions where a hit is held.

    A score of ``accept`` or more is a ``hit``. A change of scene is ``off`` whatever the score, and
    forgets the last hit. Other samples are ``hold`` for up to ``hold`` of them after a hit: at its place,
    moved by its last step, damped by 0.8 for each; then ``off``."""
    clip = Window.partitionBy("clip").orderBy("n")
    kill = F.col("scene_diff") > scene
    s = samples.withColumns({"_rn": F.row_number().over(clip), "_kill": kill, "_hit": ~kill & (F.col("score") >= accept)})
    s = s.withColumn("_seg", F.sum(F.col("_kill").cast("int")).over(clip.rowsBetween(*UPTO)))
    here = Window.partitionBy("clip", "_seg").orderBy("n").rowsBetween(*BEFORE)
    last = F.last(F.when(F.col("_hit"), F.struct("_rn", "x", "y", "scale")), ignorenulls=True).over(here)
    s = s.withColumn("_last", last).withColumn("_k", F.col("_rn") - F.col("_last._rn"))
    step = F.when(F.col("_hit") & (F.col("_k") <= hold + 1), F.struct((F.col("x") - F.col("_last.x")).alias("x"), (F.col("y") - F.col("_last.y")).alias("y")))
    s = s.withColumn("_step", step).withColumn("_step", F.last("_step", ignorenulls=True).over(clip.rowsBetween(*UPTO)))
    held = ~F.col("_kill") & ~F.col("_hit") & (F.col("_k") <= hold)
    moved = lambda c: F.col(f"_last.{c}") + F.coalesce(F.col(f"_step.{c}"), F.lit(0.0)) * F.col("_k") * F.pow(F.lit(0.8), F.col("_k"))
    state = F.when(F.col("_hit"), "hit").when(F.coalesce(held, F.lit(False)), "hold").otherwise("off")
    out = s.withColumn("state", state).withColumns({c: F.when(F.col("state") == "hold", moved(c)).otherwise(F.col(c)) for c in ("x", "y")} | {"scale": F.when(F.col("state") == "hold", F.col("_last.scale")).otherwise(F.col("scale"))})
    return out.drop("_rn", "_kill", "_hit", "_seg", "_last", "_k", "_step")


def with_runs(samples: DataFrame) -> DataFrame:
    """With ``on`` (hit or hold) and ``run``, the number of the run of equal ``on`` in the clip."""
    w = Window.partitionBy("clip").orderBy("n")
    s = samples.withColumn("on", F.col("state") != "off")
    new = F.coalesce(F.col("on") != F.lag("on").over(w), F.lit(True))
    return s.withColumn("_new", new.cast("int")).withColumn("run", F.sum("_new").over(w.rowsBetween(*UPTO))).drop("_new")


def bridged(samples: DataFrame, most: int = 6) -> DataFrame:
    """Runs of at most ``most`` samples that are off between two that are on become ``hold``, in a
    straight line from the sample before to the one after."""
    w = Window.partitionBy("clip").orderBy("n")
    place = lambda: F.struct("x", "y", "scale")
    s = with_runs(samples).withColumns({"_rn": F.row_number().over(w), "_size": F.count(F.lit(1)).over(Window.partitionBy("clip", "run"))})
    s = s.withColumns({"_lo": F.last(F.when(F.col("on"), F.struct("_rn", place().alias("p"))), ignorenulls=True).over(w.rowsBetween(*BEFORE)), "_hi": F.first(F.when(F.col("on"), place()), ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))})
    fill = ~F.col("on") & F.col("_lo").isNotNull() & F.col("_hi").isNotNull() & (F.col("_size") <= most)
    f = (F.col("_rn") - F.col("_lo._rn")) / (F.col("_size") + 1)
    lerp = lambda c: F.col(f"_lo.p.{c}") + (F.col(f"_hi.{c}") - F.col(f"_lo.p.{c}")) * f
    s = s.withColumn("_fill", fill).withColumns({c: F.when(F.col("_fill"), lerp(c)).otherwise(F.col(c)) for c in ("x", "y", "scale")})
    return s.withColumn("state", F.when(F.col("_fill"), "hold").otherwise(F.col("state"))).drop("_rn", "_size", "_lo", "_hi", "_fill", "on", "run")


def without_short_runs(samples: DataFrame, least: int = 8) -> DataFrame:
    """Runs that are on with fewer than ``least`` hits are turned off; held samples don't count."""
    s = with_runs(samples).withColumn("_hits", F.count_if(F.col("state") == "hit").over(Window.partitionBy("clip", "run")))
    return s.withColumn("state", F.when(F.col("on") & (F.col("_hits") < least), "off").otherwise(F.col("state"))).drop("_hits", "on", "run")


def track(samples: DataFrame, accept: float = 0.72, hold: int = 6, scene: float = 25.0, least: int = 8) -> DataFrame:
    """Gate, bridge, drop: the states by which frames are composited."""
    return without_short_runs(bridged(gated(samples, accept, hold, scene), hold), least)


#: Values of a run that are smoothed one after the other; blocks of them are then carried on.
BLOCK = 32


def _averaged(runs: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``runs`` with the exponential mean, from the first value on, of its array columns (name: weight of a new value), as a
    scan: each block of values starts from zero (the first one from the first value), then the last mean of the block
    before is carried into all of its places, a power of the decay less by place. The work grows with the
    values; only the blocks' ends are appended to one list. Blocks and ends are columns, so that each is made once."""

    def within(c: str, alpha: float) -> Column:
        def block(b: Column) -> Column:
            start = F.when(b == 0, F.get(c, F.lit(0))).otherwise(F.lit(0.0))
            first = F.struct(start.alias("last"), F.array().cast("array<double>").alias("all"))

            def step(acc: Column, x: Column) -> Column:
                return F.transform(F.array(alpha * x + (1 - alpha) * acc["last"]), lambda y: F.struct(y.alias("last"), F.array_append(acc["all"], y).alias("all")))[0]

            return F.aggregate(F.slice(c, b * BLOCK + 1, BLOCK), first, step, lambda acc: acc["all"])

        return F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(c) - 1) / BLOCK).cast("int"))), block)

    def carried(c: str, alpha: float) -> Column:
        return F.aggregate(f"{c}_b", F.array(F.lit(0.0)), lambda acc, b: F.array_append(acc, F.get(b, F.size(b) - 1) + F.element_at(acc, -1) * F.pow(F.lit(1 - alpha), F.size(b))))

    def whole(c: str, alpha: float) -> Column:
        moved = lambda b, k: F.transform(b, lambda x, j: x + F.get(f"{c}_c", k) * F.pow(F.lit(1 - alpha), j + 1))
        return F.flatten(F.transform(f"{c}_b", moved))

    for suffix, made in (("_b", within), ("_c", carried), ("", whole)):
        runs = runs.withColumns({c + suffix: made(c, alpha) for c, alpha in weights.items()})
    return runs.drop(*[c + suffix for c in weights for suffix in ("_b", "_c")])


def smoothed(samples: DataFrame, window: int = 5, position: float = 0.35, scale: float = 0.15) -> DataFrame:
    """In each run of two or more samples that is on: rolling median (the ends repeated; shorter runs stay), then exponential mean;
    positions in whole pixels, rounded half to even."""
    s, half = with_runs(samples), window // 2
    w = Window.partitionBy("clip", "run").orderBy("n")
    size = F.count(F.lit(1)).over(Window.partitionBy("clip", "run"))

    def median(c: str) -> Column:
        near = [F.col(c)]
        for f in (F.lag, F.lead):  # beyond an end the last value there is
            beyond = F.col(c)
            for k in range(1, half + 1):
                beyond = F.coalesce(f(c, k).over(w), beyond)
                near.append(beyond)
        return F.when(F.col("_size") < window, F.col(c)).otherwise(F.array_sort(F.array(*near))[half])

    kept = F.struct(*samples.columns).alias("_row")
    live = s.select("clip", "run", "n", "on", kept, *[F.col(c).cast("double").alias(c) for c in ("x", "y", "scale")]).withColumn("_size", size)
    live = live.select("clip", "run", "n", "_row", (F.col("on") & (F.col("_size") > 1)).alias("_even"), *[median(c).alias(c) for c in ("x", "y", "scale")])
    # all runs go the same way, so that what comes before is worked out once
    runs = live.groupBy("clip", "run", "_even").agg(F.array_sort(F.collect_list(F.struct("n", "x", "y", "scale", "_row"))).alias("_all"))
    part = lambda c: F.when(F.col("_even"), F.col(f"_all.{c}")).otherwise(F.array().cast("array<double>"))
    runs = runs.select("_even", F.col("_all._row").alias("_rows"), part("x").alias("_x"), part("y").alias("_y"), part("scale").alias("_s"))
    runs = _averaged(runs, {"_x": position, "_y": position, "_s": scale})
    flat = runs.select(F.explode(F.arrays_zip("_rows", "_x", "_y", "_s")).alias("z")).select("z._rows.*", F.bround("z._x").alias("_x"), F.bround("z._y").alias("_y"), F.col("z._s").alias("_s"))
    return flat.withColumns({"x": F.coalesce("_x", "x"), "y": F.coalesce("_y", "y"), "scale": F.coalesce("_s", "scale")}).drop("_x", "_y", "_s")


def report(samples: DataFrame, width: int, height: int, scene: float = 25.0) -> DataFrame:
    """Figures of each clip's track; those of positions are over the samples that are on."""
    on = F.col("on")
    lag = Window.partitionBy("clip", "on").orderBy("n")
    s = with_runs(samples).withColumns({f"_{c}": F.abs(F.col(c) - F.lag(c).over(lag)) for c in ("x", "y", "scale")})
    when = lambda c: F.when(on, F.col(c))
    half = F.percentile(when("scale"), 0.5)
    whole = lambda c: c.cast("int").cast("string")
    return s.groupBy("clip").agg(
        F.count(F.lit(1)).alias("frames"),
        F.count_if(on).alias("on_frames"),
        F.round(100 * F.count_if(on) / F.count(F.lit(1)), 1).alias("on_pct"),
        F.round(F.percentile("score", 0.05), 3).alias("score_p05"),
        F.round(F.percentile("score", 0.5), 3).alias("score_med"),
        F.count_distinct(F.when(on, F.col("run"))).alias("on_runs"),
        F.count_if(F.col("state") == "hold").alias("hold_frames"),
        F.count_if(F.col("scene_diff") > scene).alias("scene_cuts"),
        (F.max(when("x")) - F.min(when("x"))).cast("int").alias("travel_x"),
        (F.max(when("y")) - F.min(when("y"))).cast("int").alias("travel_y"),
        F.round(F.min(when("scale")), 3).alias("scale_lo"),
        F.round(F.max(when("scale")), 3).alias("scale_hi"),
        F.concat(whole(width * half), F.lit("x"), whole(height * half)).alias("box_px"),
        F.round(F.greatest(F.max(F.when(on, F.col("_x"))), F.max(F.when(on, F.col("_y")))), 2).alias("max_dpos"),
        F.round(F.max(F.when(on, F.col("_scale"))), 4).alias("max_dscale"),
    )


def flagged(reports: DataFrame, verdict: str) -> DataFrame:
    """Reports that ask for a look: not passed, on for less than 85 %, more than two runs, or jumps of
    more than 8; missing figures count as 0."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return reports.where((F.col(verdict) != "PASS") | (zero("on_pct") < 85) | (zero("on_runs") > 2) | (zero("max_dpos") > 8))


def best_window(levels: DataFrame, horizon: int = 6, least: int = 16, near: float = 1.2, jump: float = 3.0) -> DataFrame:
    """For each clip where its music starts best: clip, offset (seconds, half a second a window), score.

    ``levels`` (clip, n, db). The mean level of the next ``horizon`` windows is the score; of those within
    ``near`` of the best, onsets (``jump`` above the window before) come first, then the earliest. Short
    clips, and offsets under a second, start at 0."""
    w = Window.partitionBy("clip").orderBy("n")
    ahead = w.rowsBetween(0, horizon - 1)
    s = levels.withColumns({"_i": F.row_number().over(w) - 1, "_all": F.count(F.lit(1)).over(Window.partitionBy("clip")), "_jump": F.col("db") - F.lag("db").over(w)})
    s = s.withColumn("score", F.when(F.count(F.lit(1)).over(ahead) == horizon, F.avg("db").over(ahead)))
    s = s.withColumn("_best", F.max("score").over(Window.partitionBy("clip")))
    good = (F.col("score") >= F.col("_best") - near) & (F.col("_all") >= least) & (F.col("_all") > horizon)
    pick = F.min(F.when(good, F.struct((F.coalesce(F.col("_jump"), F.lit(0.0)) < jump).alias("plain"), "_i", "score")))
    out = s.groupBy("clip").agg(pick.alias("p"))
    offset = F.col("p._i") * 0.5
    return out.select("clip", F.when(offset >= 1.0, offset).otherwise(F.lit(0.0)).alias("offset"), F.col("p.score").alias("score"))


def edge_runs(samples: DataFrame, hit: Column) -> DataFrame:
    """clip, samples, and the lengths of the runs of hits from either end, as per cents to one place."""
    w = Window.partitionBy("clip").orderBy("n")
    s = samples.withColumns({"_p": F.row_number().over(w), "_hit": F.coalesce(hit, F.lit(False))})
    n, miss = F.count(F.lit(1)), F.when(~F.col("_hit"), F.col("_p"))
    per = lambda k: F.round(100 * k / n, 1)
    return s.groupBy("clip").agg(n.alias("n"), per(F.coalesce(F.min(miss) - 1, n)).alias("head_pct"), per(F.coalesce(n - F.max(miss), n)).alias("tail_pct"))


def tail_cards(samples: DataFrame, is_card: Column, fps: float, gap: int = 3, shortest: float = 0.8, lead: float = 0.12) -> DataFrame:
    """clip, cut: where a card at the end begins. The last sample has to be a card; up to ``gap`` others
    in between are bridged. None if the card is too short, starts within a second, or takes over 62 %."""
    w = Window.partitionBy("clip").orderBy("n")
    s = samples.withColumns({"_i": F.row_number().over(w) - 1, "_card": F.coalesce(is_card, F.lit(False))})
    size = s.groupBy("clip").agg(F.count(F.lit(1)).alias("_size"))
    cards = s.where("_card")
    cards = cards.withColumn("_new", F.coalesce(F.col("_i") - F.lag("_i").over(w) > gap + 1, F.lit(True)).cast("int"))
    runs = cards.withColumn("_run", F.sum("_new").over(w.rowsBetween(*UPTO))).groupBy("clip", "_run").agg(F.min("_i").alias("_lo"), F.max("_i").alias("_hi"))
    last = runs.join(size, "clip").where(F.col("_hi") == F.col("_size") - 1)
    cut, total = F.col("_lo") / fps - lead, F.col("_size") / fps
    fine = ((F.col("_size") - F.col("_lo")) / fps >= shortest) & (cut >= 1.0) & (total - cut <= total * 0.62)
    return size.join(last.where(fine).select("clip", F.round(cut, 2).alias("cut")), "clip", "left").select("clip", "cut")


def crossing(samples: DataFrame, value: str, window: int, share: float = 0.3) -> DataFrame:
    """clip, left, right: the span in which a smoothed value is above a share of its most; null if it is
    narrower than a quarter of the clip or 92 % or more. Beyond the ends values count as 0."""
    w = Window.partitionBy("clip").orderBy("n")
    # an even window reaches one further back, as a centred convolution does
    s = samples.withColumns({"_i": F.row_number().over(w) - 1, "_smooth": F.sum(value).over(w.rowsBetween(-(window // 2), window - 1 - window // 2)) / window})
    s = s.withColumn("_above", F.col("_smooth") > share * F.max("_smooth").over(Window.partitionBy("clip")))
    at, n = F.when(F.col("_above"), F.col("_i")), F.count(F.lit(1))
    r = s.groupBy("clip").agg(F.min(at).alias("left"), (F.max(at) + 1).alias("right"), n.alias("n"))
    fine = ((F.col("right") - F.col("left")) >= 0.25 * F.col("n")) & ((F.col("right") - F.col("left")) < 0.92 * F.col("n"))
    return r.select("clip", *[F.when(fine, F.col(c)).alias(c) for c in ("left", "right")])


def left_for_good(samples: DataFrame, seen: Column, dark: Column, fps: float, walk: float = 1.2) -> DataFrame:
    """clip, cut, walked: two frames after the last one in which the subject is seen, and back from there
    over dark ones for up to ``walk`` seconds; null if it is never seen or is there to the end."""
    w = Window.partitionBy("clip").orderBy("n")
    s = samples.withColumns({"_i": F.row_number().over(w) - 1, "_seen": seen, "_dark": F.coalesce(dark, F.lit(False))})
    ends = s.groupBy("clip").agg(F.count(F.lit(1)).alias("_size"), F.max(F.when(F.col("_seen"), F.col("_i"))).alias("_body"))
    ends = ends.withColumn("_cut", F.least(F.col("_size"), F.col("_body") + 3))
    back = s.join(ends.where("_body is not null"), "clip").where((F.col("_i") < F.col("_cut")) & (F.col("_i") >= F.greatest(F.col("_cut") - math.ceil(walk * fps), F.lit(1))))
    light = back.groupBy("clip").agg(F.max(F.when(~F.col("_dark"), F.col("_i"))).alias("_light"), F.min("_i").alias("_first"))
    out = ends.join(light, "clip", "left").withColumn("_to", F.least(F.col("_cut"), F.coalesce(F.col("_light") + 1, F.col("_first"), F.col("_cut"))))
    fine = (F.col("_to") / fps < F.col("_size") / fps - 0.05) & F.col("_body").isNotNull()
    return out.select("clip", F.when(fine, F.round(F.col("_to") / fps, 2)).alias("cut"), F.when(fine, F.round((F.col("_cut") - F.col("_to")) / fps, 3)).alias("walked"))


def reconciled(frames: Column, subject: Column, share: Column) -> tuple[Column, Column]:
    """(cut, reason) of two detectors: the subject's where the other has none, or where it is earlier by
    more than 0.4 s and sure."""
    delta = frames - subject
    early = (delta > 0.4) & (share > 0.35)
    cut = F.when(subject.isNull(), frames).when(frames.isNull() | early, subject).otherwise(frames)
    reason = F.when(subject.isNull(), "no subject").when(frames.isNull(), "no card").when(early, "subject earlier").when(delta < -0.4, "subject later").otherwise("agree")
    return cut, reason


def tail_event(events: DataFrame, time: str, lo: Column, hi: Column) -> DataFrame:
    """clip, at: the earliest event between two times of the clip's own; null if there is none."""
    return events.groupBy("clip").agg(F.min(F.when(F.col(time).between(lo, hi), F.col(time))).alias("at"))


def trailing_segment(segments: DataFrame, duration: str, reach: float = 0.6, shortest: float = 0.3, most: float = 0.55) -> DataFrame:
    """clip, start: where the segments (start, end) that reach a clip's end begin; null if that is too
    short or more than ``most`` of it."""
    found = segments.groupBy("clip").agg(F.min(F.when(F.col("end") >= F.col(duration) - reach, F.col("start"))).alias("s"), F.max(duration).alias("d"))
    fine = (F.col("d") - F.col("s") >= shortest) & (F.col("d") - F.col("s") <= F.col("d") * most)
    return found.select("clip", F.when(fine, F.col("s")).alias("start"))


def still_share(samples: DataFrame, value: str, still: float = 1.0) -> DataFrame:
    """clip, still: share of neighbouring samples that differ by less; 1 for a single sample."""
    w = Window.partitionBy("clip").orderBy("n")
    d = samples.withColumn("_d", F.abs(F.col(value) - F.lag(value).over(w)))
    return d.groupBy("clip").agg(F.coalesce(F.avg((F.col("_d") < still).cast("double")), F.lit(1.0)).alias("still"))


def frozen_windows(samples: DataFrame, value: str, step: float, still: float, signature: Column, like: float, shortest: float = 1.0, gap: float = 0.6) -> DataFrame:
    """clip, start, end of the runs of samples that hardly differ from the one before, of ``shortest``
    seconds or more, whose mean ``signature`` is at most ``like``, widened by a step inside the clip and
    merged over gaps; the first five seconds if there is none."""
    from . import intervals

    w = Window.partitionBy("clip").orderBy("n")
    s = samples.withColumns({"_i": F.row_number().over(w) - 1, "_frozen": F.coalesce(F.abs(F.col(value) - F.lag(value).over(w)) < still, F.lit(False)), "_sig": signature})
    s = s.withColumn("_run", F.sum((~F.col("_frozen")).cast("int")).over(w.rowsBetween(*UPTO)))
    limit = s.groupBy("clip").agg((F.count(F.lit(1)) * step).alias("limit"))
    runs = s.where("_frozen").groupBy("clip", "_run").agg(F.min("_i").alias("lo"), F.max("_i").alias("hi"), F.avg("_sig").alias("sig"))
    runs = runs.where(((F.col("hi") - F.col("lo") + 1) * step >= shortest) & (F.col("sig") <= like)).join(limit, "clip")
    wide = runs.select("clip", F.bround(F.greatest(F.lit(0.0), (F.col("lo") - 1) * step), 2).alias("start"), F.bround(F.least("limit", (F.col("hi") + 1) * step), 2).alias("end"))
    merged = intervals.union(wide, ["clip"], tolerance=gap)
    none = limit.join(merged, "clip", "left_anti").select("clip", F.lit(0.0).alias("start"), F.least(F.lit(5.0), "limit").alias("end"))
    return merged.unionByName(none)
