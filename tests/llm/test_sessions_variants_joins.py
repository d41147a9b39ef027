"""Spelling variants, sessions of clicks and the Jaccard join against brute force and SQL."""

import datetime as dt
import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenreel.llm import click_sessions, jaccard_join, queries, spelling_variants

from . import brute

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Nulls, empty and odd texts, repeated rows.
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one two"), (6, "One  TWO"), (6, "One  TWO"), (None, "no id at all"), (None, "no id at all"), (7, "a b c"), (8, "A b\tc"), (9, "ÀB c D"), (10, "àb c d")]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op12_click_sessions", "op13_jaccard_join"])
def test_same_as_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "clicks"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    ours = queries.queries()[name](spark, SF).toPandas()
    theirs = c.execute(queries.oracle_sql()[name]).df()[list(ours.columns)]
    key = list(ours.columns)[:2]
    one, two = (x.sort_values(key).astype(object).where(x.sort_values(key).notna(), None).values.tolist() for x in (ours, theirs))
    assert len(one) > 100 and one == two


# --- spelling variants


def variants(rows):
    n = {}
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] = n.get(run, 0) + 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}

    def one_edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {w: min(v, key=lambda x: (-n[x], x)) for w, v in near.items() if v}
    form = {w: v for w, v in form.items() if n[v] >= 10 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return sorted(((w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n), key=str)


def test_variants_of_invented_words(spark):
    """Edits of every kind at every place, chains of forms, ties, letters beyond ASCII, very long words."""
    rng = np.random.default_rng(3)
    letters = list("abcdeéß")
    base = ["".join(rng.choice(letters, rng.integers(7, 12))) for _ in range(12)] + ["a" * 9, "ab" * 200]
    texts = []
    for w in base:
        texts.append((1, f"{w.upper() if w.isascii() else w} " * 300))
        for _ in range(25):
            k, c = int(rng.integers(0, len(w) + 1)), str(rng.choice(letters))
            v = [w[:k] + c + w[k:], w[:k] + w[k + 1 :], w[:k] + c + w[k + 1 :]][int(rng.integers(0, 3))]
            texts.append((int(rng.integers(0, 99)), f"{v}. " * int(rng.integers(1, 40))))
            texts.append((int(rng.integers(0, 99)), f"{v}z-{v[1:]} " * 2))
    want = variants(texts)
    assert sum(r[1] is not None for r in want) > 50 and any(r[1] is not None and r[2] != r[1] for r in want)
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("word", "n", "key", "root", "codes")})
    assert rows_of(spelling_variants.variants(df)) == want


def test_keys_are_not_broadcast(spark):
    """Each word has some forty keys, which Spark doesn't count: their table seems as small as that of the words."""
    found = spark.createDataFrame([("wordone", 3), ("wordtwo", 2)], "word string, n long")
    plan = spelling_variants.near_pairs(found)._jdf.queryExecution().executedPlan().toString()
    joins = [name for name in ("SortMergeJoin", "BroadcastHashJoin", "BroadcastExchange") if name in plan]
    assert joins == ["SortMergeJoin"]


def test_variants_of_odd_rows(spark):
    odd = [*ODD, (None, "nothing nothing Nothin"), (11, "nothin× NOTHING÷ nothingā ÉTRANGE étrange étrange")]
    assert rows_of(spelling_variants.variants(spark.createDataFrame(odd, "doc_id long, text string"))) == variants(odd)
    assert spelling_variants.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# --- sessions


def sessions(rows):
    """rows: (click_id, us, arrived us, client, kind, value), each click once."""
    out = []
    for client in sorted({r[3] for r in rows if r[3] is not None}):
        mine = sorted((r[1], r[0], r) for r in rows if r[3] == client and r[1] is not None and r[0] is not None)
        late = [r for us, _, r in mine if r[2] is not None and r[2] > us + 3_600_000_000]
        found, before = [], None
        for us, _, r in mine:
            if r in late:
                continue
            value = r[5] if r[5] is not None and r[5] == r[5] and abs(r[5]) < 9e16 else None
            final = r[4] == "purchase" and value is not None and value >= 60
            why = None
            if before:
                why = "end" if before[1] else "gap" if us - before[0] >= 300_000_000 else "length" if us > found[-1]["start"] + 7_200_000_000 else None
            if not before or why:
                if found:
                    found[-1]["by"] = why
                found.append({"start": us, "ids": [], "cents": 0})
            s = found[-1]
            s["ids"].append(r[0])
            s["end"], s["cents"] = us, s["cents"] + (int(np.floor(100 * value + 0.5)) if value is not None else 0)
            s["by"], before = "end" if final else "none", (us, final)
        for k, s in enumerate(found):
            upto = found[k + 1]["start"] if k + 1 < len(found) else float("inf")
            n = sum(s["start"] <= r[1] < upto for r in late)
            out.append((client, s["ids"][0], s["start"], s["end"], len(s["ids"]), n, s["cents"], s["by"], hashlib.sha256(",".join(map(str, s["ids"])).encode()).hexdigest()))
    return sorted(out, key=str)


def clicks(spark, rows, zone=False):
    at = lambda us: None if us is None else dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=us)
    df = spark.createDataFrame([(i, at(a), at(b), c, k, v, "{}") for i, a, b, c, k, v in rows], "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, client_id long, kind string, value double, props string")
    return df.withColumns({c: F.lit("mine") for c in ("us", "late", "final", "session_id", "slice", "h")})


def invented(rng, n):
    """A bot that never pauses nor ends, one that ends often, one with ties, some others."""
    rows, minute = [], 60_000_000
    for client, step, ends in ((1, 2 * minute, 0.0), (2, minute, 0.3), (3, 0, 0.05), *((c, 4 * minute, 0.1) for c in range(4, 9))):
        us = 1_700_000_000_000_000 + client
        for _ in range(n if client < 4 else n // 10):
            us += int(rng.integers(0, step + 1)) if rng.random() > 0.02 or client == 1 else 0
            us += 5 * minute * bool(rng.random() < 0.02 and client > 1)
            late = rng.random() < 0.1
            value = [None, float("nan"), 59.99, 60.0, -1.005, 1e300, 0.125][int(rng.integers(0, 7))]
            rows.append((len(rows), us, None if rng.random() < 0.05 else us + (60 * minute + int(rng.integers(0, 2)) if late else 10), client, "purchase" if rng.random() < ends else rng.choice(["view", "click"]).item(), value))
    return [rows[k] for k in rng.permutation(len(rows))]


@pytest.mark.parametrize("size", [10_000, 40, 7])
def test_sessions_across_groups(spark, size):
    """Groups of a few clicks: sessions, runs without a break and ties go over many of them."""
    rows = invented(np.random.default_rng(8), 220)
    want = sessions(rows)
    assert {r[7] for r in want} == {"end", "gap", "length", "none"} and any(r[5] for r in want)
    assert rows_of(click_sessions.sessions(clicks(spark, rows + rows[:50]), size)) == want


def test_sessions_of_odd_rows(spark):
    t, hour = 1_700_000_000_000_000, 3_600_000_000
    odd = [(1, t, None, 1, None, None), (2, None, t, 1, "view", 1.0), (3, t, t, None, "view", 1.0), (None, t, t, 1, "view", 1.0), (4, t - 1, t + 2 * hour, 1, "view", 1.0), (5, t, t + 2 * hour, 2, "view", 1.0), (6, -5, -5, 3, "purchase", 60.0), (7, -5, -5, 3, "view", 0.005), (8, -5, hour, 3, "x", None)]
    want = sessions(odd)
    assert len(want) == 3 and rows_of(click_sessions.sessions(clicks(spark, odd))) == want
    assert rows_of(click_sessions.sessions(clicks(spark, []))) == []
    utc = clicks(spark, odd).withColumns({c: F.col(c).cast("timestamp") for c in ("ts", "arrived_at")})
    assert rows_of(click_sessions.sessions(utc)) == want


# --- Jaccard join


def linked(rows):
    sets = []
    for _, t in rows:
        w = brute.WORD.findall((t or "").translate(LOWER))
        sets.append({tuple(w)} if 0 < len(w) < 3 else {tuple(w[k : k + 3]) for k in range(len(w) - 2)})
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and find(a) != find(b) and 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min([x for x in (least.get(find(k)), i) if x is not None], default=None)
    return sorted(((i, len(sets[k]), least[find(k)]) for k, (i, _) in enumerate(rows)), key=str)


def changed(rng, words, n):
    out = list(words)
    for k in rng.choice(len(words), n, replace=False):
        out[k] = f"x{rng.integers(0, 10**9)}"
    return out


@pytest.mark.parametrize("hot, place", [(20, 500), (3, 7)])
def test_links_in_families_and_drifting_copies(spark, monkeypatch, hot, place):
    """A family that shares a passage and has links in pairs only, copies that drift away from one
    another, and sizes at the very bound."""
    monkeypatch.setattr(jaccard_join, "HOT", hot)
    monkeypatch.setattr("lumenreel.llm.probminhash.PLACE", place)
    monkeypatch.setattr(jaccard_join, "PLACE", place)
    rng = np.random.default_rng(4)
    passage = [f"p{k}" for k in range(60)]
    family = [passage + [f"u{x}" for x in rng.integers(0, 10**9, 12)] for _ in range(60)]
    texts = family + [changed(rng, w, 1) for w in family[::3]]
    drift = [[f"d{k}" for k in range(150)]]
    for _ in range(60):
        drift.append(changed(rng, drift[-1], 2))
    base = [f"b{k}" for k in range(40)]
    texts += drift + [base[:n] for n in range(1, 40)] + [base[:9], base[:11], base[:12]]
    rows = [(1000 - k, " ".join(w)) for k, w in enumerate(texts)]
    rows = [rows[k] for k in rng.permutation(len(rows))]
    want = linked(rows)
    assert len({r[2] for r in want}) < len(rows) - 60
    assert rows_of(jaccard_join.linked_classes(spark.createDataFrame(rows, "doc_id long, text string"))) == want


def test_links_of_odd_rows(spark):
    long = " ".join(f"w{k % 30_011}" for k in range(300_000))
    odd = [*ODD, (20, long), (21, long + " end"), (22, "x" * 300_000)]
    df = spark.createDataFrame(odd, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("n", "node", "tid", "h", "g", "low", "root", "component_id")})
    assert rows_of(jaccard_join.linked_classes(df)) == linked(odd)
    assert jaccard_join.linked_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_sets_of_a_chunk():
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(["a", "B", "c", "é"], rng.integers(0, 9))).encode() for _ in range(200)]
    for text, found in zip(texts, jaccard_join.shingle_sets(texts), strict=True):
        assert found.tolist() == jaccard_join.shingle_sets([text])[0].tolist()
        w = text.lower().split()
        assert len(found) == len({tuple(w)} if 0 < len(w) < 3 else {tuple(w[k : k + 3]) for k in range(len(w) - 2)})
