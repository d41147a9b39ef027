"""Operators, sources, sinks and streams against models and on cases found from their rules."""

import datetime
import json
import random
import re
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenreel import catalog
from lumenreel.functions import gates, levels, names, rules
from lumenreel.functions import text as X
from lumenreel.operators import alerts as batch_alerts
from lumenreel.operators import grouping, intervals, joins, manifests, numbering, tracks
from lumenreel.sources import readers, writers
from lumenreel.streaming import alerts


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("seed", range(3))
def test_srt_time_by_its_parts(spark, seed):
    """Any time is the sum of its parts; halves of a millisecond go to the even one."""
    rnd = random.Random(seed)
    times = [rnd.randrange(400_000_000) / 1000 for _ in range(50)] + [0.0005, 0.0015, 59.9996]
    for r in spark.createDataFrame([(t,) for t in times], "s double").select("s", X.srt_time(F.col("s")).alias("t")).collect():
        hms, ms = r["t"].split(",")
        h, m, s = map(int, hms.split(":"))
        assert abs(((h * 60 + m) * 60 + s) * 1000 + int(ms) - r["s"] * 1000) <= 0.5000001 and m < 60 and s < 60 and len(ms) == 3
    assert value(spark, X.srt_time(F.lit(0.0005))) == "00:00:00,000" and value(spark, X.srt_time(F.lit(0.0015))) == "00:00:00,002"


def test_two_lines_break_nearest_the_middle(spark):
    rnd = random.Random(1)
    texts = [" ".join("x" * rnd.randint(1, 14) for _ in range(rnd.randint(1, 14))) for _ in range(40)] + ["y" * 50, "y" * 41 + " z"]
    for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", X.two_lines(F.col("t"), 30).alias("v")).collect():
        t = r["t"]
        if len(t) <= 30:
            assert r["v"] == t
            continue
        ends = [0, *(i + 1 for i, c in enumerate(t) if c == " "), len(t) + 1]
        cut = min(ends, key=lambda e: (abs(e - len(t) // 2), e))
        assert r["v"] == t[:cut].strip() + "\n" + t[cut:].strip()


def test_json_strings_tell_kinds(spark):
    cases = {'["p", 7, null, false]': ["p", "7", "None", "False"], "```json\n[]\n```": [], 'see [["q"]] here': ['["q"]'], '{"k": [1]}': ["1"], "[broken": None, "": None}
    for reply, want in cases.items():
        assert value(spark, X.json_strings(F.lit(reply))) == want


def test_text_functions(spark):
    assert value(spark, X.tokens(F.lit(" fr ,it,, fr"))) == ["fr", "it"]
    assert value(spark, X.masked(F.lit("sk-0123456789"))) == "...456789"
    assert value(spark, X.word_count(F.lit("l'été n'est pas fini"))) == 4
    assert value(spark, X.slug(F.lit("Zwei Wörter/hier?!"))) == "Zwei_Wörter_hier"
    assert value(spark, X.similarity(F.lit("abc"), F.lit("cab"))) == 1.0 and value(spark, X.similarity(F.lit("aaa"), F.lit("ab"))) == 1.2
    assert value(spark, X.composed(F.lit("é"))) == "é"
    assert value(spark, X.header_line(F.lit("a\nLanguage: x\nLanguage: y"), F.lit("de"))) == "a\nLanguage: de\nLanguage: y"
    assert value(spark, X.header_line(F.lit("no Language: here"), F.lit("de"))) == "Language: de\nno Language: here"


def test_wrapping(spark):
    assert value(spark, X.wrapped(F.lit("漢字かなも"), F.lit(16), F.lit(8.0))) == ["漢字", "かな", "も"]
    assert value(spark, X.wrapped(F.lit("a bb overlong c"), F.lit(32), F.lit(8.0))) == ["a bb", "overlong", "c"]
    assert value(spark, X.wrapped(F.lit(""), F.lit(32), F.lit(8.0))) == [""]


def test_names(spark):
    assert value(spark, names.own_number(F.lit("DE_05110123"), F.lit("DE"), F.lit("0511"))) == 123
    assert value(spark, names.own_number(F.lit("DE_0511x"), F.lit("DE"), F.lit("0511"))) is None
    assert value(spark, names.folder_of(F.lit("qq"))) == "Other_qq" and value(spark, names.folder_of(F.lit(None).cast("string"))) == "Unknown"
    assert value(spark, names.code_of(F.lit("Other_qq"))) == "QQ" and value(spark, names.code_of(F.lit("Deutsch"))) == "DE" and value(spark, names.code_of(F.lit("x"))) is None
    assert value(spark, names.canonical(F.lit("OTHER_Francais"))) == "Français"


def test_intervals_against_a_grid(spark):
    """Union and complement of random intervals with whole ends, second by second."""
    rnd = random.Random(5)
    rows = [(k, float(a), float(a + rnd.randint(-1, 6))) for k in range(6) for a in rnd.choices(range(40), k=8)]
    df = spark.createDataFrame(rows, "k int, start double, end double")
    merged = intervals.union(df, ["k"])
    spans = spark.createDataFrame([(k, 0.0, 50.0) for k in range(7)], "k int, lo double, hi double")
    free = intervals.complement(merged, spans, ["k"]).collect()
    taken = {(k, s) for k, a, b in rows for s in range(int(a), int(b))}
    assert {(r["k"], s) for r in merged.collect() for s in range(int(r["start"]), int(r["end"]))} == taken
    assert {(r["k"], s) for r in free for s in range(int(r["start"]), int(r["end"]))} == {(k, s) for k in range(7) for s in range(50)} - taken
    gaps = intervals.with_gaps(spark.createDataFrame([(1, 2.0, 3.0, 9.0), (1, 3.005, 5.0, 9.0)], "k int, start double, end double, d double"), ["k"], 0.01, duration="d")
    assert sorted(tuple(r) for r in gaps.collect()) == [(1, 0.0, 2.0), (1, 5.0, 9.0)]


def gate(samples, accept, hold, least):
    """The gate by its rules, sample by sample: (state, x)."""
    out, last, step, since = [], None, 0.0, 0
    for x, score, cut in samples:
        if cut:
            last = None
            out.append(["off", x])
        elif score >= accept:
            if last is not None:
                step = x - last
            last, since = x, 0
            out.append(["hit", x])
        else:
            since += 1
            if last is not None and since <= hold:
                out.append(["hold", last + step * since * 0.8**since])
            else:
                last = None
                out.append(["off", x])
    runs, i = [], 0
    while i < len(out):
        j = i
        while j < len(out) and (out[j][0] == "off") == (out[i][0] == "off"):
            j += 1
        runs.append((i, j))
        i = j
    for a, b in runs:
        if out[a][0] == "off" and a > 0 and b < len(out) and b - a <= hold:
            lo, hi = out[a - 1][1], out[b][1]
            for k in range(a, b):
                out[k] = ["hold", lo + (hi - lo) * (k - a + 1) / (b - a + 1)]
    on = [s != "off" for s, _ in out]
    final = [s for s, _ in out]
    i = 0
    while i < len(out):
        j = i
        while j < len(out) and on[j] == on[i]:
            j += 1
        if on[i] and sum(s == "hit" for s, _ in out[i:j]) < least:
            final[i:j] = ["off"] * (j - i)
        i = j
    return [(s, x) for s, (_, x) in zip(final, out, strict=True)]


def test_track_gate(spark):
    rnd = random.Random(11)
    rows, want = [], {}
    for clip in range(25):
        level, some = 0.5, []
        for n in range(70):
            level = min(1.0, max(0.0, level + rnd.uniform(-0.3, 0.3)))
            some.append((rnd.uniform(0, 100), level, rnd.random() < 0.05))
        rows += [(clip, n, x, 0.0, 1.0, s, 40.0 if c else 1.0) for n, (x, s, c) in enumerate(some)]
        want[clip] = gate(some, 0.6, 4, 5)
    df = spark.createDataFrame(rows, "clip int, n int, x double, y double, scale double, score double, scene_diff double")
    got = tracks.track(df, accept=0.6, hold=4, least=5).orderBy("clip", "n").collect()
    for r, (state, x) in zip(got, [z for c in range(25) for z in want[c]], strict=True):
        assert r["state"] == state and (state == "off" or abs(r["x"] - x) < 1e-6)


def test_a_cut_turns_off_whatever_the_score_and_weak_scores_fade(spark):
    shape = "clip int, n int, x double, y double, scale double, score double, scene_diff double"
    df = spark.createDataFrame([(1, n, 0.0, 0.0, 1.0, 0.99, 30.0 if n == 10 else 0.0) for n in range(30)] + [(2, n, 0.0, 0.0, 1.0, 0.9 if n < 9 else 0.6, 0.0) for n in range(40)], shape)
    state = {(r["clip"], r["n"]): r["state"] for r in tracks.gated(df).collect()}
    assert state[1, 10] == "off" and state[1, 11] == "hit"
    assert [state[2, n] for n in range(9, 40)] == ["hold"] * 6 + ["off"] * 25


def test_smoothing_stays_within_a_run(spark):
    rows = [(1, n, 100.0 + (40 if n == 6 else 0) if n < 12 else 500.0, 7.0, 1.0, "off" if n == 12 else "hit") for n in range(24)]
    out = {r["n"]: r["x"] for r in tracks.smoothed(spark.createDataFrame(rows, "clip int, n int, x double, y double, scale double, state string")).collect()}
    assert out[6] == 100.0 and out[11] == 100.0 and out[12] == 500.0 and out[13] == 500.0


def test_sliding_counts_and_cooldown(spark):
    rnd = random.Random(2)
    times = sorted(rnd.randrange(4000) for _ in range(300))
    df = spark.createDataFrame([(i, "ab"[rnd.random() < 0.3], datetime.datetime.fromtimestamp(t, datetime.UTC)) for i, t in enumerate(times)], "id int, kind string, ts timestamp")
    kinds = {r["id"]: r["kind"] for r in df.collect()}
    n = {r["id"]: r["n"] for r in batch_alerts.sliding_count(df, "ts", 60).collect()}
    assert n == {i: sum(t - 60 <= u <= t for u in times) for i, t in enumerate(times)}
    given, last = set(), {}
    for i, t in enumerate(times):
        if kinds[i] not in last or t - last[kinds[i]] >= 120:
            last[kinds[i]] = t
            given.add(i)
    assert {r["id"] for r in batch_alerts.cooled(df, "kind", "ts", "id", 120).collect()} == given


def test_a_long_run_of_alerts_is_no_one_row(spark, monkeypatch):
    """Alerts that never pause, in slices with and without gaps between them, equal times and two kinds: given as by a walk, and no
    row or group of the plan holds a whole run."""
    monkeypatch.setattr(batch_alerts, "SLICE_ROWS", 50)
    rnd = random.Random(6)
    for spread, seconds in ((40_000, 7), (3000, 120), (400_000, 120), (2000, 0)):
        # the first spread is one run, a few alerts lie long after it
        times = [(rnd.randrange(spread) if i % 50 else 10 * spread + rnd.randrange(3 * seconds + 1), i, "ab"[rnd.random() < 0.2]) for i in range(3000)]
        df = spark.createDataFrame([(i, k, datetime.datetime.fromtimestamp(t - 5000, datetime.UTC)) for t, i, k in times], "id int, kind string, ts timestamp")
        given, last = set(), {}
        for t, i, k in sorted(times):
            if k not in last or t - last[k] >= seconds:
                last[k] = t
                given.add(i)
        out = batch_alerts.cooled(df, "kind", "ts", "id", seconds)
        assert {r["id"] for r in out.collect()} == given
        assert "collect_list" not in out._jdf.queryExecution().toString()


def test_largest_sizes_are_those_of_wrapped_lines(spark):
    """Halving finds what trying each size finds, in words and in texts without blanks, also where nothing fits, without text or bounds; and
    takes about as long as wrapping once (trying 31 sizes took 15 times that)."""
    rnd = random.Random(5)
    texts = [None, "", "  ", "漢字かなも", *(" ".join("x" * rnd.randrange(1, 12) for _ in range(rnd.randrange(1, 9))) for _ in range(60)), *("漢" * n for n in range(1, 20))]
    rows = [(t, rnd.choice([None, *range(1, 300)]), rnd.choice([None, 5, *range(14, 200)])) for t in texts for _ in range(5)]
    df = spark.createDataFrame(rows, "t string, w int, h int").withColumn("size", X.largest_size(F.col("t"), F.col("w"), F.col("h"), 10, 40))
    each = df.withColumn("z", F.explode(F.sequence(F.lit(10), F.lit(40)))).withColumn("n", F.size(X.wrapped(F.col("t"), F.col("w"), F.col("z") * 0.55)))
    got = [(r["size"], r["want"]) for r in each.groupBy("t", "w", "h").agg(F.first("size").alias("size"), F.coalesce(F.max(F.when(F.col("n") * (F.col("z") + 4) <= F.col("h"), F.col("z"))), F.lit(10)).alias("want")).collect()]
    assert all(a == b for a, b in got) and len({a for a, _ in got}) > 10
    many = spark.range(40000).select(F.concat_ws(" ", *[F.repeat(F.lit("w"), 1 + (F.col("id") % k).cast("int")) for k in range(2, 10)]).alias("t"))

    def took(column):
        began = time.time()
        many.select(column.alias("x")).write.format("noop").mode("overwrite").save()
        return time.time() - began

    bounds = F.lit(150), F.lit(60)
    quickest = lambda column: min(took(column) for _ in range(3))
    assert quickest(X.largest_size(F.col("t"), *bounds, 10, 40)) < 5 * quickest(X.wrapped(F.col("t"), bounds[0], F.lit(8.0)))


def test_reset_texts_next_to_halves_of_a_tenth(spark, tmp_path):
    """Times up to a few microseconds around the point where the SQL's hours go up, on both offsets."""
    duckdb = pytest.importorskip("duckdb")
    near = [0, 1, 100, 358, 359, 360, 361, 362, 500]
    back = [datetime.timedelta(microseconds=(2 * k + 1) * 180_000_000 - m) for k in range(240) for m in near]
    times = [t - b for t in (datetime.datetime(2024, 1, 5, 8), datetime.datetime(2025, 8, 19, 7)) for b in back]
    pd.DataFrame({"event_id": range(len(times)), "ts": pd.Series(times).astype("datetime64[us]")}).to_parquet(tmp_path / "events.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    got = {tuple(r) for r in catalog.queries()["reset_texts"](spark, str(tmp_path)).collect()}
    assert got == set(c.execute(catalog.oracle_sql()["reset_texts"]).fetchall()) and len(got) == len(times)


def test_pacific_day(spark):
    """Either side of both changes, and of midnight."""
    cases = {"2025-03-09 09:59:59": "2025-03-09", "2025-03-10 06:59:59": "2025-03-09", "2025-03-10 07:00:00": "2025-03-10", "2025-11-02 08:59:59": "2025-11-02", "2025-11-03 07:59:59": "2025-11-02", "2025-11-03 08:00:00": "2025-11-03"}
    for utc, day in cases.items():
        assert str(value(spark, levels.pacific_day(F.lit(utc).cast("timestamp")))) == day


def test_gap_filled_numbers(spark):
    rows = [("a", "x1", 2), ("a", "x2", None), ("a", "x3", None), ("a", "x4", 150), ("b", "y", None)]
    out = {r["name"]: (r["number"], r["padded"]) for r in numbering.gap_filled(spark.createDataFrame(rows, "g string, name string, kept int"), ["g"], ["name"], "kept").collect()}
    assert out == {"x1": (2, "002"), "x2": (1, "001"), "x3": (3, "003"), "x4": (150, "150"), "y": (1, "01")}


def test_batches_have_context_of_the_batch(spark):
    b = {r["batch"]: r for r in numbering.batches(spark.createDataFrame([(1, n, f"t{n}") for n in range(7)], "k int, n int, t string"), ["k"], ["n"], 3, "t").collect()}
    assert b[1]["texts"] == ["t3", "t4", "t5"] and b[1]["before"] == ["t1", "t2"] and b[1]["after"] == ["t6"]
    assert b[0]["before"] == [] and b[0]["after"] == ["t3", "t4"] and b[2]["after"] == []


def test_copies_keep_rows_without_digest(spark):
    df = spark.createDataFrame([(1, "d"), (2, None), (3, "d"), (4, None)], "k int, digest string")
    assert {r["k"]: (r["first_key"], r["n_copies"]) for r in joins.exact_copies(df, "k", "digest").collect()} == {1: (1, 2), 2: (2, 1), 3: (1, 2), 4: (4, 1)}
    assert [tuple(r) for r in joins.twin_pairs(df, "k", "digest").collect()] == [(1, 3)]


def test_near_frames_equal_brute_force(spark):
    rnd = random.Random(3)
    base = [[rnd.getrandbits(63) for _ in range(8)] for _ in range(6)]
    rows = list(enumerate(base))
    for i, b in enumerate(base):
        for far in (3, 40, 60, 61, 90):
            c = list(b)
            for bit in rnd.sample(range(8 * 63), far):
                c[bit // 63] ^= 1 << (bit % 63)
            rows.append((100 + 10 * i + far % 7, c))
    want = {(a, b) for a, x in rows for b, y in rows if a < b and sum((p ^ q).bit_count() for p, q in zip(x, y, strict=True)) <= 60}
    twins = [(900, base[0])]  # an equal signature is one row with the first
    got = joins.near_frames(spark.createDataFrame(rows + twins, "id int, hashes array<bigint>"), "id", "hashes")
    assert {(r["a"], r["b"]) for r in got.collect()} == want


def test_frames_that_share_most_pieces(spark, monkeypatch):
    """Signatures with six equal pieces, in several blocks: all pairs are compared, and verified as verified() does."""
    monkeypatch.setattr(joins, "BLOCK", 300)
    rnd = random.Random(4)
    rows = [(i, [rnd.getrandbits(63) for _ in range(2)] + [7] * 6, [rnd.choice([0.0, 1.0, 9.0, None]) for _ in range(rnd.randrange(1, 4))]) for i in range(1000)]
    df = spark.createDataFrame(rows, "id int, hashes array<bigint>, v array<double>")
    want = {(a, b, d) for a, x, _ in rows for b, y, _ in rows if a < b and (d := sum((p ^ q).bit_count() for p, q in zip(x, y, strict=True))) <= 56}
    pairs = joins.near_frames(df.select("id", "hashes"), "id", "hashes", most=56)
    got = [tuple(r) for r in pairs.collect()]
    assert len(got) == len(want) and set(got) == want
    plain = {tuple(r) for r in joins.verified(pairs, df, "id", "v", 100.0).select("a", "b", "distance", "mad").collect()}
    assert {tuple(r) for r in joins.near_frames(df, "id", "hashes", most=56, values="v", far=100.0).collect()} == plain and 0 < len(plain) < len(want)


def test_signatures_travel_to_few_blocks(spark, monkeypatch):
    """Each of 60,000 signatures goes to 16 blocks, not to one for each 2048; tiles within blocks lose no pair."""
    rows = spark.range(60_000).select("id", F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: F.xxhash64("id", i)).alias("hashes"))
    plan = joins.near_frames(rows, "id", "hashes")._jdf.queryExecution().analyzed().toString()
    assert int(re.search(r"sequence\(0, (\d+)", plan)[1]) + 1 <= 16
    few = rows.where("id < 500")
    whole = {tuple(r) for r in joins.near_frames(few, "id", "hashes", most=230).collect()}
    monkeypatch.setattr(joins, "WIDE", 7)
    assert {tuple(r) for r in joins.near_frames(few, "id", "hashes", most=230).collect()} == whole and len(whole) > 100


def test_merges(spark):
    t = spark.createDataFrame([(1, "a", {"x": "1"}), (2, "b", {"y": "2"})], "id int, s string, m map<string,string>")
    c = spark.createDataFrame([(1, None, {"x": "9", "z": "3"}), (7, "q", {})], "id int, s string, m map<string,string>")
    got = {r["id"]: (r["s"], r["m"]) for r in joins.upsert(t, c, "id", ["s", "m"], ("m",)).collect()}
    assert got == {1: ("a", {"x": "9", "z": "3"}), 2: ("b", {"y": "2"})}
    shape = "id string, angle string, cut double, segs array<struct<id:int,translations:map<string,string>>>, outputs map<string,string>"
    old = spark.createDataFrame([("p", "kept", 0.0, [(1, {"de": "ja"}), (2, {"de": "nein"})], {"de": "f"}), ("q", "", 2.5, None, None), (None, "n", 1.0, None, None)], shape)
    new = spark.createDataFrame([("p", None, 7.0, [(1, {}), (2, {"de": "neu"}), (3, None)], None), ("r", "x", 1.0, [], {"fr": "g"})], shape)
    out = {r["id"]: r for r in manifests.rescanned(old, new, "id", ["angle", "cut"], ["outputs"], "segs").collect()}
    assert set(out) == {"p", "q", "r", None} and out["p"]["angle"] == "kept" and out["p"]["cut"] == 7.0 and out["p"]["outputs"] == {"de": "f"}
    assert [s["translations"] for s in out["p"]["segs"]] == [{"de": "ja"}, {"de": "neu"}, None] and out["q"]["cut"] == 2.5 and out["r"]["outputs"] == {"fr": "g"}


def test_as_of_and_spans(spark):
    knots = spark.createDataFrame([(1, 0.0, [0, 100]), (1, 10.0, [10, 0]), (2, 5.0, [7, 7])], "k int, t double, box array<int>")
    asked = spark.createDataFrame([(1, -1.0), (1, 0.0), (1, 2.55), (1, 10.0), (1, 99.0), (2, 0.0), (3, 1.0)], "k int, t double")
    got = {(r["k"], r["t"]): r["box"] for r in joins.interpolated(asked, knots, ["k"], "t", "box").collect()}
    assert got == {(1, -1.0): [0, 100], (1, 0.0): [0, 100], (1, 2.55): [2, 74], (1, 10.0): [10, 0], (1, 99.0): [10, 0], (2, 0.0): [7, 7], (3, 1.0): None}
    spans = spark.createDataFrame([(1, 0.0, 9.0), (1, 1.0, 2.0), (1, 5.0, 5.0)], "k int, start double, end double")
    points = spark.createDataFrame([(1, x) for x in (-0.1, 0.0, 3.0, 9.0)], "k int, t double")
    assert [r["inside"] for r in joins.in_spans(points, spans, ["k"], "t").orderBy("t").collect()] == [False, True, True, False]
    assert [r["inside"] for r in joins.in_spans(points, spans, ["k"], "t", closed=True).orderBy("t").collect()] == [False, True, True, True]


def test_groups_of_detections(spark):
    shape = "clip int, time double, pos int, text string, x1 int, y1 int, x2 int, y2 int"
    rows = [(1, float(t), 0, "SALE now" if t else "Sale now", t, 0, 100 + t, 40) for t in range(4)]
    rows += [(1, 0.0, 1, "once", 500, 500, 600, 540), (1, 1.0, 2, "sale NOW!", 30, 0, 135, 40), (1, 3.0, 3, "sale now!", 30, 0, 135, 40)]
    out = grouping.persistent(spark.createDataFrame(rows, shape)).collect()
    assert [(r["text"], r["n"], r["start"], r["end"]) for r in out] == [("Sale now", 4, 0.0, 5.0)]
    moving = [(7, float(t), 0, "drift", 40 * t, 0, 40 * t + 100, 50) for t in range(8)]
    assert [r["n"] for r in grouping.tracked(spark.createDataFrame(moving, shape)).collect()] == [8]
    assert max(r["n"] for r in grouping.persistent(spark.createDataFrame(moving, shape)).collect() or [{"n": 0}]) < 8


def test_cards_at_the_end(spark):
    rnd = random.Random(4)
    busy = [[rnd.uniform(0, 255) for _ in range(20)] for _ in range(20)]
    cases = {1: busy + [[10.0] * 20] * 6, 2: busy, 3: busy + [[90.0] * 20] * 5 + [[200.0] * 20] * 4, 4: [[10.0] * 20] * 30}
    frames = spark.createDataFrame([(c, n, v) for c, vs in cases.items() for n, v in enumerate(vs)], "clip int, n int, v array<double>")
    assert {r["clip"]: r["cut"] for r in grouping.plateaus(frames, 4.0).collect()} == {1: 4.9, 2: None, 3: 4.9, 4: None}


def test_rules(spark):
    classes = [("a", ["x", "y"]), ("b", ["y", "z"])]
    assert [value(spark, rules.vote(F.lit(t), classes, "none")) for t in ("Y", "YZ", "q", None)] == ["a", "b", "none", "none"]
    assert value(spark, rules.energy(F.lit("a Demo of the MYTH"))) == "tension" and value(spark, rules.energy(F.lit(None).cast("string"))) == "calm"
    with pytest.raises(Exception, match="no voice"):
        value(spark, rules.voice(F.lit(""), F.lit(None).cast("string")))
    with pytest.raises(Exception, match="disk, codec"):
        value(spark, gates.all_passed(F.array(F.lit("disk"), F.lit("codec"))))
    assert value(spark, gates.complete(F.lit([]).cast("array<struct<translations:map<string,string>>>"), F.array(F.lit("de")), F.lit("de")))


def test_sources(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"videos": [{"id": "u"}, {"id": "v"}]}))
    one = T.StructType([T.StructField("id", T.StringType())])
    assert {r["id"] for r in readers.manifest(spark, str(tmp_path / "m.json"), one).collect()} == {"u", "v"}
    (tmp_path / "l.jsonl").write_text('{"id":"a","v":1}\n\nnot json\n{"id":"a","v":2}\n')
    two = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.IntegerType())])
    assert [tuple(r) for r in readers.json_lines(spark, str(tmp_path / "l.jsonl"), two, "id").collect()] == [("a", 2)]
    (tmp_path / "c.csv").write_text("﻿file,cluster\na,x\nb,\n", encoding="utf-8")
    assert [tuple(r) for r in readers.csv_map(spark, str(tmp_path / "c.csv"), "file", "cluster").collect()] == [("a", "x")]
    env = spark.createDataFrame([("# A=0",), ("A = 1=2",), ("A=3",), ("junk",)], "value string").coalesce(1)
    assert {r["name"]: r["value"] for r in readers.env_pairs(env).collect()} == {"A": "1=2"}
    sidecar = "Intro\nPrimary text (en):\n one \nEU transparency\ntwo\nHeadline\nbuy\nCTA: go\nnow"
    r = readers.sections(spark.createDataFrame([(1, sidecar), (2, None)], "id int, t string"), "id", "t").orderBy("id").collect()
    assert [(x["primary"], x["headline"]) for x in r] == [("one / two", "buy / now"), ("", "")]
    gpu = spark.createDataFrame([("0, RTX, 1, 2, 3, 4",), ("bad",), ("0,a,b,c,d,e",), ("",)], "l string").select(readers.gpu_line(F.col("l")).alias("g"))
    assert [x["g"] is not None for x in gpu.collect()] == [True, False, False, False]


def test_folder_scans(spark, tmp_path):
    for f in ("a.mp4", "x/b.mp4", "x/y/c.mp4", "_work/d.mp4", "out/e.mp4", "x/f.temp.mp4", "x/g.txt", "x/h.part", "x/.DS_Store"):
        (tmp_path / f).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / f).write_text("z")
    scan = lambda **how: [r["relative"] for r in readers.media_files(spark, str(tmp_path), **how).collect()]
    assert scan() == ["a.mp4", "out/e.mp4", "x/b.mp4", "x/f.temp.mp4"]
    assert scan(skip_private=False, outside="out") == ["_work/d.mp4", "a.mp4", "x/b.mp4", "x/f.temp.mp4"]
    every = readers.media_files(spark, str(tmp_path), glob="*", levels=None)
    assert {r["relative"] for r in every.where("junk").collect()} == {"x/f.temp.mp4", "x/h.part"} and "x/y/c.mp4" in {r["relative"] for r in every.collect()}
    assert {r["relative"]: r["folder"] for r in every.collect()}["x/y/c.mp4"] == "x"


def test_sinks(spark, tmp_path):
    seg = spark.createDataFrame([(1, 0.0, 1.0, "Guten Tag"), (1, 1.0, 2.0, ""), (1, 2.0, 3.25, "Ende")], "clip_id int, start double, end double, text string")
    assert writers.srt(seg).first()["srt"] == "1\n00:00:00,000 --> 00:00:01,000\nGuten Tag\n\n2\n00:00:02,000 --> 00:00:03,250\nEnde\n"
    out = str(tmp_path / "out")
    for n in (3, 5, 4, 6):
        writers.replaced(spark.range(n), out)
        assert writers.current(spark, out).count() == n
    assert len([p for p in (tmp_path / "out").iterdir() if p.name.startswith("v-")]) == 2
    writers.csv(spark.createDataFrame([("f", 1)], "file string, n int").coalesce(1), str(tmp_path / "csv"), ["file", "angle", "n"])
    text = next((tmp_path / "csv").glob("*.csv")).read_text(encoding="utf-8")
    assert text == '﻿file,angle,n\nf,"",1\n'
    files = spark.createDataFrame([(2, 0, "p2", "n.mp4"), (1, 1, "p1", "n.mp4"), (1, 0, "p0", "o.mp4")], "job int, pos int, path string, name string")
    assert {r["path"]: r["arcname"] for r in writers.archive(files).collect()} == {"p1": "n.mp4", "p2": "2_n.mp4", "p0": "o.mp4"}
    ads = spark.createDataFrame([("VOICED_German", "b")] * 2 + [("VOICED_German", "a")] + [("BGM_UNIVERSAL", "z")], "campaign string, adset string")
    lines = writers.campaign_report(ads).first()["report"].split("\n")
    assert lines[0] == "[BGM_UNIVERSAL]  (1 ads)  ->  BGM_UNIVERSAL" and lines[3] == "[VOICED_German]  (3 ads)  ->  German" and lines[4].split() == ["b", "2"]


def test_streams_equal_batch(spark, tmp_path):
    rnd = random.Random(6)
    t0 = pd.Timestamp("2024-01-01")
    times = sorted(rnd.randrange(3000) for _ in range(400))
    rows = pd.DataFrame({"api_key": [rnd.choice("kq") for _ in times], "ts": [t0 + pd.Timedelta(seconds=t) for t in times]})
    spark.createDataFrame(rows).coalesce(1).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema("api_key string, ts timestamp").parquet(str(tmp_path / "in"))
    for name, df, mode in (("counted", alerts.window_counts(source), "complete"), ("daily", alerts.daily_counts(source), "complete")):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).start()
        q.processAllAvailable()
        q.stop()
    assert sum(r["n_requests"] for r in spark.table("counted").collect()) == 400
    assert {(r["api_key"], str(r["day"])): r["n_requests"] for r in spark.table("daily").collect()} == {(k, "2023-12-31"): int((rows["api_key"] == k).sum()) for k in "kq"}
