"""Each pair of texts that shares a band is compared or in one class already."""

import numpy as np
import pytest

from lumenreel.llm import probminhash

from . import brute


def wanted(rows, threshold=0.8):
    """Classes by hand: all pairs that share a band, compared."""
    sets = [brute.shingles(t) for _, t in rows]
    owners = []
    for _, t in rows:
        h, n = np.unique(probminhash.shingle_hashes(t.encode()), return_counts=True)
        owners.append(probminhash.signature(h, 1 + np.log(n), probminhash.BANDS * probminhash.ROWS))
    bands = probminhash.bands(np.stack(owners))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in np.flatnonzero((bands[a + 1 :] == bands[a]).any(1)) + a + 1:
            if find(a) != find(b) and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)), key=lambda i: str(rows[i][0]))
                root[y] = x
    return {i: rows[find(k)][0] for k, (i, _) in enumerate(rows)}


def classed(spark, rows):
    df = spark.createDataFrame(rows, "doc_id string, text string")
    return {r["doc_id"]: r["class_id"] for r in probminhash.classes(df).collect()}


def changed(rng, words, n):
    out = list(words)
    for k in rng.choice(len(words), n, replace=False):
        out[k] = f"x{rng.integers(0, 10**9)}"
    return out


@pytest.mark.parametrize("place", [500, 60])
def test_drifted_copies_of_a_large_group(spark, monkeypatch, place):
    """Texts that are near some members only, and unlike the pivots."""
    monkeypatch.setattr(probminhash, "PLACE", place)
    rng = np.random.default_rng(5)
    base = [f"p{i}" for i in range(400)]
    group = [changed(rng, base, 4) for _ in range(300)]
    twins = [changed(rng, group[k], 7) for k in range(0, 300, 3)]
    rows = [(f"{i:05d}", " ".join(w)) for i, w in enumerate(group + twins)]
    assert classed(spark, rows) == wanted(rows)


def test_copies_in_a_family_of_unlike_texts(spark):
    """Many texts share a passage, mutual similarity about 0.75; all near copies are found."""
    rng = np.random.default_rng(6)
    body = [f"p{i}" for i in range(180)]
    family = [body + [f"u{x}" for x in rng.integers(0, 10**9, 30)] for _ in range(600)]
    twins = [changed(rng, family[k], 4) for k in range(0, 600, 2)]
    rows = [(f"{i:05d}", " ".join(w)) for i, w in enumerate(family + twins)]
    want = wanted(rows)
    assert 0 < sum(i != c for i, c in want.items()) and classed(spark, rows) == want
