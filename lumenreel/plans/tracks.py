"""Queries of tracks: gate, smoothing, reports, and tests at the ends of clips. Samples stand for the
events of a user."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import register
from ..operators import tracks as T
from ..session import table

_SAMPLE = """sample AS (SELECT user_id AS clip, event_id AS n, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn, value * 3 AS x, value * 2 AS y, 1 + value / 1000 AS scale,
      1 - least(value, 100) / 100 AS score, CASE WHEN event_type = 'error' AND event_id % 5 = 0 THEN 30.0 ELSE 5.0 END AS scene_diff FROM events)"""


def samples(spark, sf_dir):
    v = F.col("value")
    cut = F.when((F.col("event_type") == "error") & (F.col("event_id") % 5 == 0), 30.0).otherwise(5.0)
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("clip"), F.col("event_id").alias("n"), (v * 3).alias("x"), (v * 2).alias("y"), (1 + v / 1000).alias("scale"), (1 - F.least(v, F.lit(100)) / 100).alias("score"), cut.alias("scene_diff")
    )


_GATE = f"""{_SAMPLE}, k AS (SELECT *, scene_diff > 25 AS kill, scene_diff <= 25 AND score >= 0.72 AS hit FROM sample),
    s AS (SELECT *, sum(CAST(kill AS INT)) OVER (PARTITION BY clip ORDER BY n) AS seg FROM k),
    p AS (SELECT *, max(CASE WHEN hit THEN rn END) OVER (PARTITION BY clip, seg ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ph FROM s),
    q AS (SELECT p.*, l.x AS lx, l.y AS ly, l.scale AS ls, p.rn - p.ph AS gone, CASE WHEN p.hit AND p.rn - p.ph <= 7 THEN p.x - l.x END AS dx, CASE WHEN p.hit AND p.rn - p.ph <= 7 THEN p.y - l.y END AS dy
      FROM p LEFT JOIN sample l ON l.clip = p.clip AND l.rn = p.ph),
    v AS (SELECT *, coalesce(last_value(dx IGNORE NULLS) OVER w, 0) AS vx, coalesce(last_value(dy IGNORE NULLS) OVER w, 0) AS vy, CASE WHEN hit THEN 'hit' WHEN NOT kill AND gone <= 6 THEN 'hold' ELSE 'off' END AS state
      FROM q WINDOW w AS (PARTITION BY clip ORDER BY n ROWS UNBOUNDED PRECEDING)),
    gate AS (SELECT clip, n, rn, score, scene_diff, state, CASE WHEN state = 'hold' THEN lx + vx * gone * pow(0.8, gone) ELSE x END AS x, CASE WHEN state = 'hold' THEN ly + vy * gone * pow(0.8, gone) ELSE y END AS y,
      CASE WHEN state = 'hold' THEN ls ELSE scale END AS scale FROM v)"""


def _runs(name: str, source: str) -> str:
    return f"""{name}_new AS (SELECT *, state <> 'off' AS live, coalesce((state <> 'off') <> lag(state <> 'off') OVER (PARTITION BY clip ORDER BY n), true) AS fresh FROM {source}),
    {name} AS (SELECT *, sum(CAST(fresh AS INT)) OVER (PARTITION BY clip ORDER BY n ROWS UNBOUNDED PRECEDING) AS run FROM {name}_new)"""


_TRACK = f"""{_GATE}, {_runs("g_run", "gate")},
    around AS (SELECT *, count(*) OVER (PARTITION BY clip, run) AS size, max(CASE WHEN live THEN rn END) OVER (PARTITION BY clip ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lo,
      min(CASE WHEN live THEN rn END) OVER (PARTITION BY clip ORDER BY n ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS hi FROM g_run),
    bridge AS (SELECT a.clip, a.n, a.rn, a.score, a.scene_diff, NOT a.live AND a.lo IS NOT NULL AND a.hi IS NOT NULL AND a.size <= 6 AS fill, (a.rn - a.lo) / (a.size + 1) AS f, a.state, a.x, a.y, a.scale, l.x AS lx, l.y AS ly, l.scale AS ls, h.x AS hx, h.y AS hy, h.scale AS hs
      FROM around a LEFT JOIN gate l ON l.clip = a.clip AND l.rn = a.lo LEFT JOIN gate h ON h.clip = a.clip AND h.rn = a.hi),
    bridged AS (SELECT clip, n, rn, score, scene_diff, CASE WHEN fill THEN 'hold' ELSE state END AS state, CASE WHEN fill THEN lx + (hx - lx) * f ELSE x END AS x, CASE WHEN fill THEN ly + (hy - ly) * f ELSE y END AS y,
      CASE WHEN fill THEN ls + (hs - ls) * f ELSE scale END AS scale FROM bridge),
    {_runs("b_run", "bridged")}, counted AS (SELECT *, count(*) FILTER (state = 'hit') OVER (PARTITION BY clip, run) AS hits FROM b_run),
    track AS (SELECT clip, n, rn, score, scene_diff, CASE WHEN live AND hits < 8 THEN 'off' ELSE state END AS state, x, y, scale FROM counted)"""

_ROWS = "clip, n, state, round(x, 4) + 0 AS x, round(y, 4) + 0 AS y, round(scale + 3.14159e-8, 7) AS scale"


def rounded(df):
    return df.select("clip", "n", "state", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"), F.round(F.col("scale") + 3.14159e-8, 7).alias("scale"))


@register("hysteresis", f"WITH {_GATE} SELECT {_ROWS} FROM gate")
def hysteresis(spark, sf_dir):
    """Hits, held samples with their predicted place, and what is off."""
    return rounded(T.gated(samples(spark, sf_dir)))


def tracked(spark, sf_dir):
    return T.track(samples(spark, sf_dir))


@register("bridged_track", f"WITH {_TRACK} SELECT {_ROWS} FROM track")
def bridged_track(spark, sf_dir):
    """Short gaps bridged and short runs dropped."""
    return rounded(tracked(spark, sf_dir))


_SMOOTH = f"""{_TRACK}, {_runs("t_run", "track")}, lists AS (SELECT clip, run, list(n ORDER BY n) AS ns, list(x ORDER BY n) AS xs, list(y ORDER BY n) AS ys, list(scale ORDER BY n) AS ss FROM t_run WHERE live GROUP BY 1, 2 HAVING count(*) > 1),
    med AS (SELECT clip, run, ns, {", ".join(f"CASE WHEN len({c}) < 5 THEN {c} ELSE list_transform(range(1, len({c}) + 1), lambda i: list_sort(list_transform([-2, -1, 0, 1, 2], lambda k: {c}[greatest(1, least(len({c}), i + k))]))[3]) END AS {c}" for c in ("xs", "ys", "ss"))} FROM lists),
    ema AS (SELECT clip, run, ns, xs, ys, ss, 1 AS i, xs[1] AS x, ys[1] AS y, ss[1] AS scale FROM med UNION ALL
      SELECT clip, run, ns, xs, ys, ss, i + 1, 0.35 * xs[i + 1] + 0.65 * x, 0.35 * ys[i + 1] + 0.65 * y, 0.15 * ss[i + 1] + 0.85 * scale FROM ema WHERE i < len(ns)),
    smooth AS (SELECT t.clip, t.n, t.score, t.scene_diff, t.state, coalesce(round_even(e.x, 0), t.x) AS x, coalesce(round_even(e.y, 0), t.y) AS y, coalesce(e.scale, t.scale) AS scale FROM track t LEFT JOIN ema e ON e.clip = t.clip AND e.ns[e.i] = t.n)"""


@register("smoothed_track", f"WITH RECURSIVE {_SMOOTH} SELECT {_ROWS} FROM smooth")
def smoothed_track(spark, sf_dir):
    """Rolling median and exponential mean of each run that is on."""
    return rounded(T.smoothed(tracked(spark, sf_dir)))


_REPORT = f"""{_SMOOTH}, {_runs("r_run", "smooth")}, steps AS (SELECT *, abs(x - lag(x) OVER w) AS sx, abs(y - lag(y) OVER w) AS sy, abs(scale - lag(scale) OVER w) AS ss FROM r_run WINDOW w AS (PARTITION BY clip, live ORDER BY n)),
    report AS (SELECT clip, count(*) AS frames, count(*) FILTER (live) AS on_frames, round(100 * count(*) FILTER (live) / count(*), 1) AS on_pct, round(quantile_cont(score, 0.05), 3) AS score_p05, round(quantile_cont(score, 0.5), 3) AS score_med,
      count(DISTINCT run) FILTER (live) AS on_runs, count(*) FILTER (state = 'hold') AS hold_frames, count(*) FILTER (scene_diff > 25) AS scene_cuts, CAST(trunc(max(x) FILTER (live) - min(x) FILTER (live)) AS INT) AS travel_x,
      CAST(trunc(max(y) FILTER (live) - min(y) FILTER (live)) AS INT) AS travel_y, round(min(scale) FILTER (live), 3) AS scale_lo, round(max(scale) FILTER (live), 3) AS scale_hi,
      CAST(trunc(90 * quantile_cont(scale, 0.5) FILTER (live)) AS INT) || 'x' || CAST(trunc(160 * quantile_cont(scale, 0.5) FILTER (live)) AS INT) AS box_px,
      round(greatest(max(sx) FILTER (live), max(sy) FILTER (live)), 2) AS max_dpos, round(max(ss) FILTER (live), 4) AS max_dscale FROM steps GROUP BY 1)"""


def reported(spark, sf_dir):
    return T.report(T.smoothed(tracked(spark, sf_dir)), 90, 160)


@register("track_figures", f"WITH RECURSIVE {_REPORT} SELECT * FROM report")
def track_figures(spark, sf_dir):
    """A track's figures for review."""
    return reported(spark, sf_dir)


@register("flagged_tracks", f"WITH RECURSIVE {_REPORT} SELECT clip, on_runs FROM report WHERE clip % 11 = 0 OR coalesce(on_pct, 0) < 85 OR coalesce(on_runs, 0) > 2 OR coalesce(max_dpos, 0) > 8")
def flagged_tracks(spark, sf_dir):
    r = reported(spark, sf_dir).withColumn("verdict", F.when(F.col("clip") % 11 == 0, "FAIL").otherwise("PASS"))
    return T.flagged(r, "verdict").select("clip", "on_runs")


@register(
    "best_music_start",
    f"""WITH {_SAMPLE}, l AS (SELECT clip, n, rn - 1 AS i, count(*) OVER (PARTITION BY clip) AS c, -score * 40 AS db, -score * 40 + lag(score * 40) OVER (PARTITION BY clip ORDER BY n) AS jump FROM sample),
      s AS (SELECT *, CASE WHEN count(*) OVER a = 6 THEN avg(db) OVER a END AS score FROM l WINDOW a AS (PARTITION BY clip ORDER BY n ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING)),
      b AS (SELECT *, max(score) OVER (PARTITION BY clip) AS best FROM s), g AS (SELECT clip, coalesce(jump, 0) < 3 AS plain, i, score FROM b WHERE score >= best - 1.2 AND c >= 16 AND c > 6),
      p AS (SELECT clip, arg_min(i, (plain, i)) AS i, arg_min(score, (plain, i)) AS score FROM g GROUP BY 1)
      SELECT c.clip, CASE WHEN i * 0.5 >= 1 THEN CAST(i * 0.5 AS DOUBLE) ELSE 0.0::DOUBLE END AS "offset", round(score, 4) AS score FROM (SELECT DISTINCT clip FROM sample) c LEFT JOIN p USING (clip)""",
)
def best_music_start(spark, sf_dir):
    s = samples(spark, sf_dir).select("clip", "n", (-F.col("score") * 40).alias("db"))
    return T.best_window(s).select("clip", "offset", F.round("score", 4).alias("score"))


@register(
    "edge_runs",
    f"""WITH {_SAMPLE} SELECT clip, count(*) AS n, round(100 * coalesce(min(rn) FILTER (score < 0.3) - 1, count(*)) / count(*), 1) AS head_pct, round(100 * coalesce(count(*) - max(rn) FILTER (score < 0.3), count(*)) / count(*), 1) AS tail_pct FROM sample GROUP BY 1""",
)
def edge_runs(spark, sf_dir):
    """How far samples hold from either end."""
    return T.edge_runs(samples(spark, sf_dir), F.col("score") >= 0.3)


@register(
    "tail_cards",
    f"""WITH {_SAMPLE}, c AS (SELECT clip, rn - 1 AS i FROM sample WHERE score >= 0.5), z AS (SELECT clip, count(*) AS size FROM sample GROUP BY 1),
      r AS (SELECT *, sum(CAST(fresh AS INT)) OVER (PARTITION BY clip ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, coalesce(i - lag(i) OVER (PARTITION BY clip ORDER BY i) > 4, true) AS fresh FROM c)),
      t AS (SELECT clip, min(i) AS lo, max(i) AS hi, size FROM r JOIN z USING (clip) GROUP BY clip, run, size HAVING max(i) = size - 1)
      SELECT z.clip, round(CASE WHEN (z.size - lo) / 4.0 >= 0.8 AND lo / 4.0 - 0.12 >= 1 AND z.size / 4.0 - (lo / 4.0 - 0.12) <= z.size / 4.0 * 0.62 THEN CAST(lo / 4.0 - 0.12 AS DOUBLE) END, 2) AS cut FROM z LEFT JOIN t USING (clip)""",
)
def tail_cards(spark, sf_dir):
    """Where the card that a clip ends on begins."""
    return T.tail_cards(samples(spark, sf_dir), F.col("score") >= 0.5, fps=4.0)


@register(
    "sharp_spans",
    f"""WITH {_SAMPLE}, m AS (SELECT clip, rn - 1 AS i, sum(x) OVER (PARTITION BY clip ORDER BY n ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) / 5 AS v FROM sample),
      a AS (SELECT *, v > 0.3::DOUBLE * max(v) OVER (PARTITION BY clip) AS above FROM m), r AS (SELECT clip, min(i) FILTER (above) AS l, max(i) FILTER (above) + 1 AS r, count(*) AS n FROM a GROUP BY 1)
      SELECT clip, CASE WHEN r - l >= 0.25 * n AND r - l < 0.92 * n THEN l END AS "left", CASE WHEN r - l >= 0.25 * n AND r - l < 0.92 * n THEN r END AS "right" FROM r""",
)
def sharp_spans(spark, sf_dir):
    """The span in which a smoothed profile is well above its edges."""
    return T.crossing(samples(spark, sf_dir), "x", 5).select("clip", F.col("left").cast("bigint").alias("left"), F.col("right").cast("bigint").alias("right"))


@register(
    "subject_cuts",
    f"""WITH {_SAMPLE}, e AS (SELECT clip, count(*) AS size, max(rn - 1) FILTER (score > 0.9) AS body FROM sample GROUP BY 1), c AS (SELECT *, least(size, body + 3) AS cut FROM e),
      b AS (SELECT c.clip, max(s.rn - 1) FILTER (s.score > 0.2) AS light, min(s.rn - 1) AS first FROM c JOIN sample s ON s.clip = c.clip AND s.rn - 1 < c.cut AND s.rn - 1 >= greatest(c.cut - 5, 1) WHERE body IS NOT NULL GROUP BY 1),
      t AS (SELECT c.*, least(cut, coalesce(light + 1, first, cut)) AS stop FROM c LEFT JOIN b USING (clip))
      SELECT clip, CASE WHEN body IS NOT NULL AND stop / 4.0 < size / 4.0 - 0.05 THEN round(CAST(stop / 4.0 AS DOUBLE), 2) END AS cut, CASE WHEN body IS NOT NULL AND stop / 4.0 < size / 4.0 - 0.05 THEN round(CAST((cut - stop) / 4.0 AS DOUBLE), 3) END AS walked FROM t""",
)
def subject_cuts(spark, sf_dir):
    """Where the subject leaves for good, and how far back it is dark from there."""
    return T.left_for_good(samples(spark, sf_dir), F.col("score") > 0.9, F.col("score") <= 0.2, fps=4.0)


@register(
    "reconciled_cuts",
    """WITH c AS (SELECT p_partkey, CASE WHEN p_size % 5 > 0 THEN p_size / 2.0 END AS a, CASE WHEN p_size % 7 > 0 THEN p_size / 2.0 + (p_partkey % 5 - 2) * 0.3 END AS b, p_partkey % 10 / 10.0 AS share FROM part)
      SELECT p_partkey, round(CAST(CASE WHEN b IS NULL THEN a WHEN a IS NULL OR (a - b > 0.4 AND share > 0.35) THEN b ELSE a END AS DOUBLE), 3) AS cut,
        CASE WHEN b IS NULL THEN 'no subject' WHEN a IS NULL THEN 'no card' WHEN a - b > 0.4 AND share > 0.35 THEN 'subject earlier' WHEN a - b < -0.4 THEN 'subject later' ELSE 'agree' END AS reason FROM c""",
)
def reconciled_cuts(spark, sf_dir):
    """The cut of two detectors, with the reason."""
    s, k = F.col("p_size"), F.col("p_partkey")
    cut, reason = T.reconciled(F.when(s % 5 > 0, s / 2), F.when(s % 7 > 0, s / 2 + (k % 5 - 2) * 0.3), k % 10 / 10)
    return table(spark, sf_dir, "part").select("p_partkey", F.round(cut, 3).alias("cut"), reason.alias("reason"))


@register(
    "tail_events",
    """SELECT l_orderkey AS clip, min(t) FILTER (t BETWEEN 40 * 0.7 AND 40 - 0.3) AS at FROM (SELECT l_orderkey, CAST(l_quantity AS DOUBLE) AS t FROM lineitem) GROUP BY 1""",
)
def tail_events(spark, sf_dir):
    """The first change of scene in a clip's last part."""
    e = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("clip"), F.col("l_quantity").alias("t"))
    return T.tail_event(e, "t", F.lit(40 * 0.7), F.lit(40 - 0.3))


@register(
    "trailing_segments",
    """WITH s AS (SELECT l_orderkey AS clip, CAST(l_partkey % 50 AS DOUBLE) AS a, CAST(l_partkey % 50 + l_quantity / 4 AS DOUBLE) AS b, 55.0::DOUBLE AS d FROM lineitem), f AS (SELECT clip, min(a) FILTER (b >= d - 0.6) AS st, max(d) AS d FROM s GROUP BY 1)
      SELECT clip, CASE WHEN d - st >= 0.3 AND d - st <= d * 0.2 THEN st END AS start FROM f""",
)
def trailing_segments(spark, sf_dir):
    """Where the last block of held frames begins."""
    a = (F.col("l_partkey") % 50).cast("double")
    s = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("clip"), a.alias("start"), (a + F.col("l_quantity") / 4).alias("end"), F.lit(55.0).alias("d"))
    return T.trailing_segment(s, "d", most=0.2)


@register(
    "still_shares",
    """SELECT user_id AS clip, round(coalesce(avg(CAST(abs(d) < 20 AS INT)), 1.0), 6) AS still FROM (SELECT user_id, value - lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS d FROM events) GROUP BY 1""",
)
def still_shares(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("clip"), F.col("event_id").alias("n"), "value")
    return T.still_share(e, "value", 20.0).select("clip", F.round("still", 6).alias("still"))


@register(
    "frozen_windows",
    f"""WITH {_SAMPLE}, f AS (SELECT clip, n, rn - 1 AS i, scale, y, coalesce(abs(x - lag(x) OVER (PARTITION BY clip ORDER BY n)) < 90, false) AS still FROM sample),
      g AS (SELECT *, sum(CAST(NOT still AS INT)) OVER (PARTITION BY clip ORDER BY n ROWS UNBOUNDED PRECEDING) AS run FROM f), z AS (SELECT clip, count(*) * 0.5 AS lim FROM sample GROUP BY 1),
      r AS (SELECT clip, min(i) AS lo, max(i) AS hi FROM g WHERE still GROUP BY clip, run HAVING (max(i) - min(i) + 1) * 0.5 >= 1 AND avg(y) <= 60),
      w AS (SELECT clip, greatest(0, (lo - 1) * 0.5) AS s, least(lim, (hi + 1) * 0.5) AS e FROM r JOIN z USING (clip)),
      m AS (SELECT *, sum(CAST(fresh AS INT)) OVER (PARTITION BY clip ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM (SELECT *, coalesce(s > max(e) OVER (PARTITION BY clip ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 0.6, true) AS fresh FROM w)),
      u AS (SELECT clip, CAST(min(s) AS DOUBLE) AS start, CAST(max(e) AS DOUBLE) AS "end" FROM m GROUP BY clip, k)
      SELECT * FROM u UNION ALL SELECT clip, 0, CAST(least(5, lim) AS DOUBLE) FROM z WHERE clip NOT IN (SELECT clip FROM u)""",
)
def frozen_windows(spark, sf_dir):
    """The windows in which a frozen card that looks like a known one is shown."""
    return T.frozen_windows(samples(spark, sf_dir), "x", 0.5, 90.0, F.col("y"), 60.0)
