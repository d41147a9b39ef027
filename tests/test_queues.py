"""Queues, numbering and pairing in slices against walks through the rows."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lumenreel.functions import rules
from lumenreel.operators import intervals, joins, numbering, queues, tracks

T0 = 1_700_000_000_000_000


def jobs(seed):
    rnd, rows, t = random.Random(seed), [], 0
    for k in range(300):
        t += rnd.choice([0, 0, 5, 60, 4000])
        rows.append((rnd.choice(["a", "b", None]), k, t, rnd.choice([None, -3, 0, 10, 500, 9000])))
    rnd.shuffle(rows)
    return rows


def walked(rows, timeout):
    out, ends = {}, {}
    for queue, job, t, work in sorted(rows, key=lambda r: (r[2], r[1])):
        work = max(0, work or 0)
        start = max(t, ends.get(queue, t))
        ahead = sum(o[0] == queue and o[3] > t for o in out.values())
        ends[queue] = start + min(work, timeout)
        out[job] = (queue, t, start, ends[queue], "error" if work > timeout else "done", ahead)
    return out


@pytest.mark.parametrize("slice_s", [10**9, 5000, 60, 1])
def test_a_queue_in_slices_is_the_queue_in_one_walk(spark, slice_s):
    rows = jobs(slice_s)
    df = spark.createDataFrame([(q, j, pd.Timestamp((T0 + t * 10**6) * 1000).to_pydatetime(), w) for q, j, t, w in rows], "q string, j int, at timestamp, w int")
    served = queues.served(df, "q", "j", "at", F.col("w").cast("long") * 1_000_000, 1000 * 1_000_000, slice_s * 1_000_000)
    want = walked(rows, 1000)
    got = {r["job"]: r for r in served.collect()}
    second = lambda us: (us - T0) // 10**6
    assert {j: (r["queue"], second(r["arrived"]), second(r["started"]), second(r["ended"]), r["status"]) for j, r in got.items()} == {j: v[:5] for j, v in want.items()}
    assert all(r["waited"] == r["started"] - r["arrived"] for r in got.values())
    assert {r["job"]: r["n_ahead"] for r in queues.ahead(served).collect()} == {j: v[5] for j, v in want.items()}
    log = queues.transitions(served).where("job = 7").orderBy("seq").collect()
    assert [r["status"] for r in log] == ["queued", "running", want[7][4]]
    assert queues.served(df.limit(0), "q", "j", "at", F.col("w"), 5).count() == 0


@pytest.mark.parametrize("plain", [2_000_000, 20, 1])
def test_numbers_of_large_groups(spark, monkeypatch, plain):
    """Groups that are cut into slices get the numbers that one window gives."""
    monkeypatch.setattr(numbering, "PLAIN", plain)
    rnd = random.Random(plain)
    rows = [(rnd.choice(["x", "x", "x", "y", None]), rnd.randrange(40), k) for k in range(300)]
    df = spark.createDataFrame(rows, "g string, o int, id int")
    for group in (["g"], []):
        want = {}
        for g in {r[0] for r in rows} if group else {0}:
            mine = sorted((r for r in rows if not group or r[0] == g), key=lambda r: (r[1], r[2]))
            want |= {r[2]: (k + 1, len(mine)) for k, r in enumerate(mine)}
        assert {r["id"]: (r["place"], r["total"]) for r in numbering.numbered(df, group, ["o", "id"]).collect()} == want


@pytest.mark.parametrize("plain", [2_000_000, 5])
def test_gaps_are_filled_in_large_groups(spark, monkeypatch, plain):
    monkeypatch.setattr(numbering, "PLAIN", plain)
    rnd = random.Random(9)
    rows = [(g, k, rnd.choice([None, None, rnd.randrange(1, 160)])) for g in "abc" for k in range(110 if g == "a" else 12)]
    want = {}
    for g in "abc":
        mine = [r for r in rows if r[0] == g]
        taken, number = {r[2] for r in mine if r[2]}, 0
        for _, k, kept in sorted(mine, key=lambda r: r[1]):
            if kept is None:
                number += 1
                while number in taken:
                    number += 1
            want[g, k] = kept or number
    got = numbering.gap_filled(spark.createDataFrame(rows, "g string, o int, kept int"), ["g"], ["o"], "kept").collect()
    assert {(r["g"], r["o"]): r["number"] for r in got} == want and len(got) == len(rows)
    assert all(int(r["padded"]) == r["number"] and len(r["padded"]) >= (3 if r["g"] == "a" else 2) for r in got)


def test_means_over_block_ends(spark):
    """A run over several blocks, one of a whole block, short ones, and samples that are off."""
    rnd, rows = random.Random(5), []
    for clip, size in enumerate((100, tracks.BLOCK, tracks.BLOCK + 1, 4, 1)):
        rows += [(clip, k, rnd.uniform(0, 900), rnd.uniform(0, 900), rnd.uniform(0.5, 2), "hit") for k in range(size)] + [(clip, size, 5.0, 6.0, 1.0, "off")]
    df = spark.createDataFrame(rows, "clip int, n int, x double, y double, scale double, state string").withColumns({"score": F.lit(1.0), "scene_diff": F.lit(0.0)})
    got = {(r["clip"], r["n"]): r for r in tracks.smoothed(df).collect()}
    assert len(got) == len(rows)
    for clip in range(5):
        mine = [r for r in rows if r[0] == clip and r[5] == "hit"]
        v = [r[4] for r in mine]
        near = [sorted(v[min(max(i + k, 0), len(v) - 1)] for k in range(-2, 3))[2] if len(v) >= 5 else v[i] for i in range(len(v))]
        mean = near[0]
        for i, x in enumerate(near):
            mean = x if i == 0 else 0.15 * x + 0.85 * mean
            assert abs(got[clip, i]["scale"] - (mean if len(v) > 1 else v[i])) < 1e-9
        assert got[clip, len(mine)]["x"] == 5.0 and got[clip, len(mine)]["state"] == "off"


def test_spans_that_stay_open(spark):
    rows = [(1, 0, "end"), (1, 1, "start"), (1, 2, "start"), (1, 3, "other"), (1, 4, "end"), (1, 5, "end"), (1, 6, "start"), (2, 0, "start"), (3, 0, None)]
    df = spark.createDataFrame(rows, "k int, n int, kind string")
    length = spark.createDataFrame([(1, 9), (2, 8), (3, 7)], "k int, eof int")
    got = intervals.paired(df, ["k"], "n", "n", F.col("kind") == "start", F.col("kind") == "end", length, "eof").collect()
    assert sorted((r["k"], r["start"], r["end"]) for r in got) == [(1, 2, 4), (1, 6, 9), (2, 0, 8)]


def test_music_for_markets(spark):
    cases = [
        ("de", "Myth busting", True, ["br", "MX ", "us"], ("latam", "countries", "A_calm_nature", 5, "  (mixed markets: also anglo — pick neutral tracks.)")),
        ("de", "demo", False, ["nowhere", None], ("west_eu", "language", "D_corporate", 5, "")),
        ("xx", None, None, None, ("anglo", "default", "C_lofi_chill", 4, "")),
        (None, "Before and after", True, ["JAPAN", "kr", "de", "fr"], ("east_asia", "countries", "B_uplifting", 5, "  (mixed markets: also west_eu — pick neutral tracks.)")),
    ]
    df = spark.createDataFrame([(k, *c[:4]) for k, c in enumerate(cases)], "id int, l string, a string, v boolean, c array<string>")
    found = rules.music(F.col("l"), F.col("a"), F.col("v"), F.col("c"))
    for r, case in zip(df.select("id", *[c.alias(n) for n, c in found.items()]).orderBy("id").collect(), cases, strict=True):
        region, reason, cluster, n, note = case[4]
        assert (r["region"], r["reason"], r["cluster"], len(r["queries"])) == (region, reason, cluster, n) and r["trend_note"].endswith(note or ".")
        assert len(set(r["queries"])) == n and ("instrumental background" in r["queries"]) == (bool(case[2]) and n == 5 and len(r["queries"]) == 5 and r["queries"][-1] == "instrumental background")


@pytest.mark.parametrize("plain", [2_000_000, 5])
def test_twins_of_large_groups(spark, monkeypatch, plain):
    monkeypatch.setattr(numbering, "PLAIN", plain)
    rows = [(k, "same" if k % 3 else f"d{k % 4}") for k in range(60)] + [(100 + k, None) for k in range(5)]
    df = spark.createDataFrame(rows, "id int, d string")
    groups = {}
    for k, d in rows:
        groups.setdefault(d, []).append(k)
    chains = sorted((a, b) for d, ks in groups.items() if d for a, b in zip(ks, ks[1:], strict=False))
    assert sorted(map(tuple, joins.twin_pairs(df, "id", "d").collect())) == chains
    got = {r["id"]: (r["first_key"], r["n_copies"]) for r in joins.exact_copies(df, "id", "d").collect()}
    assert got == {k: (min(groups[d]), len(groups[d])) if d else (k, 1) for k, d in rows}
