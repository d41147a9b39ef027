"""The cutoff of robust distances is the chi-square quantile."""

import math

import numpy as np

from lumenreel.llm import robust_quality


def test_outliers_beyond_the_quantile_go(spark):
    """A tenth of the characters are symbols: a squared distance of about 40."""
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 5)) + str(rng.integers(100, 999))
    rows = [(i, " ".join(word() for _ in range(60)), "en", "s") for i in range(200)]
    rows += [(1000 + i, " ".join(word()[:7] + ("|" if k % 5 else "x") for k in range(60)), "en", "s") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = {r["doc_id"]: r for r in robust_quality.judge(df).collect()}
    assert all(28.5 < out[i]["distance"] < 60 and not out[i]["kept"] for i in out if i >= 1000)
    assert all(out[i]["kept"] for i in out if i < 1000)


def test_cutoff_is_the_quantile():
    x = robust_quality.CUTOFF
    assert len(robust_quality.STATS) == 4 and abs(math.exp(-x / 2) * (1 + x / 2) / 1e-5 - 1) < 1e-3
