"""The operators against brute force, on the given tables and on awkward rows."""

import time
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lumenreel.llm import bpe_table, kmeans_tree, langid, line_templates, packing, probminhash, queries, robust_quality, substring_dedup, token_counts, url_rules

from . import brute

SF = "/root/testdata/sf0.001"
WORDS, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
SENTENCE = "the quick brown fox jumps over the lazy dog while many other small animals look on from afar and say nothing at all about it "
#: Nulls, empty texts, ties, repeated rows, a long text, special strings, odd white space.
ODD = [
    (1, None), (2, ""), (3, "  \n\t "), (4, SENTENCE * 3), (4, SENTENCE * 3), (5, SENTENCE * 2 + "end"), (None, "no id here"), (6, "a"), (7, "İstanbul ΑΣ <|endoftext|> é\x1cx y <s>"),
    (8, " ".join(f"w{i % 977}" for i in range(30_000))), (9, "x" * 30_000), (10, "1 2 3 !!! ###\n\n###"),
]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    clash = {c: F.lit("mine") for c in ("lang", "source", "n_tokens", "n_words", "kept", "score", "lang_pred", "n_lines", "ids", "verdict")}
    return df.withColumns(clash)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")


@pytest.fixture(scope="module")
def docs():
    d = pd.read_parquet(f"{SF}/documents.parquet")
    return list(zip(d["doc_id"].tolist(), d["text"].tolist(), strict=True))


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_language_held_out(spark):
    df = queries.op1_language_id(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    h = df[df["held_out"]]
    assert len(h) > 100 and (h["lang"] == h["lang_pred"]).mean() > 0.97
    assert df["score"].between(0, 1).all()


def test_language_odd_rows(spark, odd, none):
    known = spark.createDataFrame([("hello there my friend", "en"), ("bonjour mon ami", "fr"), (None, "de"), ("x", None)], "text string, lang string")
    rows = langid.predict(odd, langid.fit(known)).collect()
    assert len(rows) == len(ODD) and {r["lang_pred"] for r in rows if not r["text"] or not any(map(str.isalpha, r["text"]))} == {"und"}
    assert langid.predict(none, langid.fit(none)).count() == 0
    assert {r["lang_pred"] for r in langid.predict(odd, langid.fit(none)).collect()} == {"und"}


def test_code_lengths_are_those_of_ppm():
    """Table look-ups against counts by hand, escapes included."""
    train, text = b"   abracadabra abracadabra", b"abrakadabra"
    grams = np.array([int.from_bytes(train[i : i + 4], "big") for i in range(len(train) - 3)])
    keys, n = np.unique(grams, return_counts=True)
    model = langid.build(["x"], np.zeros(len(keys), int), keys, n)
    seqs = [train[i : i + 4] for i in range(len(train) - 3)]

    def bits(context, symbol, order=3):
        if order < 0:
            return 8.0
        follow = [s[3:4] for s in seqs if s[3 - order : 3] == context[3 - order :]]
        if not follow:
            return bits(context, symbol, order - 1)
        d = len(set(follow))
        if symbol in follow:
            return -np.log2(follow.count(symbol) / (len(follow) + d))
        return -np.log2(d / (len(follow) + d)) + bits(context, symbol, order - 1)

    padded = b"   " + text
    want = sum(bits(padded[i - 3 : i], padded[i : i + 1]) for i in range(3, len(padded)))
    assert abs(model.code_lengths([text])[0, 0] - want) < 1e-4
    each = model.code_lengths([text, b"", b"b", text])[:, 0]
    assert abs(each[0] - want) < 1e-4 and each[1] == 0 and abs(each[3] - want) < 1e-4 and abs(each[2] - bits(b"   ", b"b")) < 1e-4


def test_languages_of_the_documents(spark):
    """lang_pred and score of all texts against counts by hand, over the rows that may be learned from."""
    df = pd.read_parquet(f"{SF}/documents.parquet")
    out = {r["doc_id"]: r for r in queries.op1_language_id(spark, SF).collect()}
    trees = {}
    for i, lang, text in zip(df["doc_id"], df["lang"], df["text"], strict=True):
        if zlib.crc32(str(i).encode()) % 4 == 2 or text is None or lang is None:
            continue
        b = b"   " + text.lower().encode()
        tree = trees.setdefault(lang, [Counter() for _ in range(4)])
        for k in range(3, len(b)):
            for m in range(4):
                tree[m][b[k - m : k + 1]] += 1
    costs = {}
    for lang, tree in trees.items():
        total, kinds = [Counter() for _ in range(4)], [Counter() for _ in range(4)]
        for m in range(4):
            for s, n in tree[m].items():
                total[m][s[:-1]] += n
                kinds[m][s[:-1]] += 1
        costs[lang] = (tree, total, kinds)

    def bits(lang, seq):
        tree, total, kinds = costs[lang]
        out = 0.0
        for m in range(3, -1, -1):
            s = seq[3 - m :]
            n = total[m][s[:-1]]
            if tree[m][s]:
                return out - np.log2(tree[m][s] / (n + kinds[m][s[:-1]]))
            if n:
                out -= np.log2(kinds[m][s[:-1]] / (n + kinds[m][s[:-1]]))
        return out + 8.0

    langs, checked = sorted(costs), 0
    for i, text in zip(df["doc_id"], df["text"], strict=True):
        if text is None or not any(map(str.isalpha, text)):
            assert out[i]["lang_pred"] == "und" and out[i]["score"] == 0
            continue
        b = b"   " + text.lower().encode()
        seqs = Counter(b[k - 3 : k + 1] for k in range(3, len(b)))
        total = np.array([sum(n * bits(lang, s) for s, n in seqs.items()) for lang in langs])
        gap = (total - total.min()) * min(1.0, 64 / (len(b) - 3))
        assert out[i]["lang_pred"] == langs[int(total.argmin())] and abs(out[i]["score"] - 1 / np.exp2(-gap).sum()) < 1e-3
        checked += 1
    assert checked > 150


def test_texts_longer_than_any_block(spark):
    """One text of 14 MB next to short ones, through the operators that work in blocks."""
    rng = np.random.default_rng(3)
    words = np.array([f"w{k:x}" for k in range(60_000)])
    long = " ".join(rng.choice(words, 2_200_000).tolist()) + "\n" + SENTENCE * 3
    rows = [(1, long), (2, SENTENCE * 3), (3, "short text"), (4, SENTENCE * 3 + "end")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert len(long) > 12 << 20
    tok = brute.word_bpe()
    ids = {i: brute.encode(tok, t) for i, t in rows}
    assert {r["doc_id"]: r["n"] for r in bpe_table.encode(df, WORDS).select("doc_id", F.size("ids").alias("n")).collect()} == {i: len(v) for i, v in ids.items()}
    assert got(substring_dedup.remove_repeated(df).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))) == brute.op3(rows)
    assert lines_of(df) == brute.op5(rows)
    pieces = packing.pack_texts(df, WORDS, 2).select("doc_id", "length").groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in pieces} == {i: len(v) + 1 for i, v in ids.items()}
    known = spark.createDataFrame([("the quick brown fox", "en"), ("w1 w2 w3 w4 a9f", "hex")], "text string, lang string")
    assert {r["doc_id"]: r["lang_pred"] for r in langid.predict(df, langid.fit(known)).collect()} == {1: "hex", 2: "en", 3: "en", 4: "en"}


def test_languages_beyond_any_number(spark):
    """Rare bytes and many languages are learned like all others."""
    rows = [(chr(0x4E00 + 50 * k) * 30 + chr(0x3040 + k) * 20, f"l{k:03d}") for k in range(230)]
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    out = langid.predict(spark.createDataFrame(rows, "text string, lang string"), model).collect()
    assert len(model.langs) == 230 and all(r["lang"] == r["lang_pred"] for r in out)


def test_bpe_table(spark, odd, none, docs):
    for rows in (docs, ODD):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        for hot in (0, 1 << 18):
            enc = bpe_table.decode(bpe_table.encode(df, WORDS, hot_words=hot), WORDS).collect()
            mine = sorted(((r["doc_id"], len(r["ids"]), brute.hexed(bytes(r["packed"])), brute.hexed(r["decoded"].encode())) for r in enc), key=str)
            assert mine == brute.op2(rows)
    assert bpe_table.encode(none, WORDS).count() == 0
    clash = odd.withColumns({c: F.lit(c) for c in ("key", "more", "gap", "word", "body", "got", "row", "at", "due", "piece")})
    back = bpe_table.decode(bpe_table.encode(clash, WORDS).withColumns({c: F.lit(c) for c in ("row", "at", "due", "id", "piece", "decoded")}), WORDS)
    assert sorted(((r["doc_id"], brute.hexed(r["decoded"].encode())) for r in back.collect()), key=str) == sorted(((i, h) for i, _, _, h in brute.op2(ODD)), key=str)
    lists = spark.createDataFrame([(1, [320, 49406, 320, 99999]), (2, []), (3, None)], "k int, ids array<int>")
    tok = brute.word_bpe()
    assert {r["k"]: r["decoded"] for r in bpe_table.decode(lists, WORDS).collect()} == {1: tok.decode([320, 49406, 320, 99999], skip_special_tokens=False), 2: "", 3: ""}


def test_token_counts(spark, odd, none, docs):
    assert got(queries.op6_token_counts(spark, SF)) == brute.op6(docs)
    assert got(token_counts.count_tokens(odd, PIECES).select("doc_id", "n_bytes", "n_tokens", "over_limit")) == brute.op6(ODD)
    assert token_counts.count_tokens(none, PIECES).count() == 0


def test_substring_dedup(spark, odd, none, docs):
    assert got(queries.op3_substring_dedup(spark, SF)) == brute.op3(docs)
    mine = substring_dedup.remove_repeated(odd).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))
    assert got(mine) == brute.op3(ODD)
    assert substring_dedup.remove_repeated(none).count() == 0


def test_substring_dedup_hot_minimisers(spark, monkeypatch):
    """One passage in most documents goes window by window."""
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(f"u{x}" for x in rng.integers(0, 10**6, 20)) + " " + SENTENCE * 2 + " ".join(f"v{x}" for x in rng.integers(0, 10**6, 20))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for hot in (1, 10, 1000):
        assert got(substring_dedup.remove_repeated(df, hot=hot).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))) == brute.op3(rows)


def test_substring_dedup_rows_alike(spark):
    """Rows that agree in all columns, and columns with names of every kind, go through unharmed."""
    rows = [(1, SENTENCE * 2)] * 40 + [(None, SENTENCE * 2), (2, SENTENCE), (3, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(c) for c in ("_found", "_key", "found", "key", "row", "digest", "bucket", "at")})
    out = substring_dedup.remove_repeated(df)
    assert out.columns == [*df.columns, "n_words", "n_removed", "kept"]
    assert got(out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))) == brute.op3(rows)


def test_url_rules(spark):
    rules = [(r.verdict, r.host, r.path) for r in queries.RULES]
    rows = queries.op4_url_rules(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url"), "page_id").collect()
    urls = ["http://EXAMPLE.com/en/7x", "https://a.example.net/de/81?q#f", None, "", "nohost", "ftp://Ünder.ORG/es/", "http://com", "http://xcom/en/", "x://y://com/en/", "http://a.net/de/?x=1"]
    odd = url_rules.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumns({c: F.lit("mine") for c in ("host", "tokens", "_fit", "fit", "_query", "row")}), queries.RULES).collect()
    assert odd[0]["tokens"] == "mine" and odd[0]["_query"] == "mine"
    assert len(odd) == len(urls)
    for r in [*rows, *odd]:
        host, path, rule, verdict = brute.op4(r["url"], rules)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and r["verdict"] == (verdict or r["verdict"])


def test_mined_rules(spark):
    """Labels that belong to the URLs; what tells them apart lies deep in the path or in a late key."""
    rows = [(i, f"http://{'casino' if i % 3 == 0 else 'plain'}.a{i % 7}.shop/x/{i}", "block" if i % 3 == 0 else "allow") for i in range(300)]
    rows += [(1000 + i, f"http://site{i % 5}.org/a/b/c/d/{'spam' if i % 4 == 0 else 'ham'}/{i}?k=1&l=2&m=3&n=4&{'track' if i % 8 == 1 else 'page'}=1", "block" if i % 4 == 0 or i % 8 == 1 else "allow") for i in range(400)]
    df = spark.createDataFrame(rows, "page_id long, url string, label string")
    want = {i: label for i, _, label in rows}
    for given in (df, df.where("page_id % 2 = 1 OR page_id % 5 > 0")):
        out = url_rules.judge(df.select("page_id", "url"), [], given.select("page_id", "label"), min_confidence=0.6).collect()
        assert sum(r["verdict"] != want[r["page_id"]] for r in out) <= 0.02 * len(out)


def test_mined_verdicts_against_brute_force(spark):
    """The verdict is that of the most confident rule whose tokens a URL has, over all combinations."""
    rng = np.random.default_rng(9)
    rows = [(i, f"http://{'abc'[rng.integers(3)]}.{'xyz'[rng.integers(3)]}.org/{'pqr'[rng.integers(3)]}/{i}") for i in range(400)]
    marks = {i: "block" if "a.x" in u or ("/q/" in u and "b." in u) else "allow" for i, u in rows if i % 3}
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame(list(marks.items()), "page_id long, label string")
    out = {r["page_id"]: r["verdict"] for r in url_rules.judge(pages, [], labels, min_confidence=0.6).collect()}
    assert out == brute.mined(rows, marks, 0.6)


def test_verdicts_of_the_query(spark):
    """What op4's own query says of each URL that no rule fits."""
    pages = pd.read_parquet(f"{SF}/pages.parquet")
    rows = list(zip(pages["page_id"].tolist(), pages["url"].tolist(), strict=True))
    rules = [(r.verdict, r.host, r.path) for r in queries.RULES]
    given = {i: brute.op4(u, rules)[3] for i, u in rows}
    want = brute.mined(rows, {i: v for i, v in given.items() if v})
    out = {r["page_id"]: r["verdict"] for r in queries.op4_url_rules(spark, SF).collect()}
    assert out == {i: given[i] or want[i] for i, _ in rows} and set(out.values()) == {"block", "allow"}


def test_urls_of_more_tokens_than_eight(spark):
    """URLs of five to eleven tokens; the rules are those of all combinations of all of them."""
    rng = np.random.default_rng(12)
    rows = []
    for i in range(1500):
        keys = [f"k{k}" for k in range(6) if rng.random() < 0.75]
        rows.append((i, f"http://{'ab'[rng.integers(2)]}.{'xyz'[rng.integers(3)]}.org/{'pq'[rng.integers(2)]}?{'&'.join(f'{k}=1' for k in keys)}"))
    has = lambda u, *ts: all(t in brute.url_tokens(u) for t in ts)
    marks = {i: "block" if has(u, "q:k0", "h:x", "p:q") or has(u, "q:k1", "q:k2", "q:k3", "q:k4", "h:a") else "allow" for i, u in rows if i % 5}
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame(list(marks.items()), "page_id long, label string")
    out = {r["page_id"]: r["verdict"] for r in url_rules.judge(pages, [], labels, min_confidence=0.7).collect()}
    assert out == brute.mined(rows, marks, 0.7, told=99) and out != brute.mined(rows, marks, 0.7)


@pytest.mark.parametrize("deep", [True, False])
def test_searched_rules_are_those_of_all_combinations(spark, monkeypatch, deep):
    """Where combinations are too many to be listed: none is left out, whatever the number of a URL's tokens."""
    monkeypatch.setattr(url_rules, "COMBINATIONS", 0)
    rng = np.random.default_rng(21)
    keys = lambda: [f"k{k}" for k in range(6) if rng.random() < 0.75]
    rows = [(i, f"http://{'ab'[rng.integers(2)]}.{'xyz'[rng.integers(3)]}.org/{'pq'[rng.integers(2)]}?{'&'.join(f'{k}=1' for k in keys())}") for i in range(1200)]
    has = lambda u, *ts: all(t in brute.url_tokens(u) for t in ts)
    block = lambda u: has(u, "q:k1", "q:k2", "q:k3", "q:k4", "h:a") if deep else has(u, "q:k0", "h:x") or has(u, "h:z", "p:q") and rng.random() < 0.9
    marks = {i: "block" if block(u) else "allow" for i, u in rows if i % 5}
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame(list(marks.items()), "page_id long, label string")
    out = {r["page_id"]: r["verdict"] for r in url_rules.judge(pages, [], labels, min_confidence=0.7).collect()}
    want = brute.mined(rows, marks, 0.7, told=99)
    assert out == want and set(want.values()) == {"block", "allow"} and (not deep or want != brute.mined(rows, marks, 0.7))


def test_many_keys_in_nearly_all_urls(spark):
    """Thirty keys, each in 97 of 100 URLs, make no combinations; the one that tells is found."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(2000):
        keys = "&".join(f"k{k}=1" for k in range(30) if rng.random() < 0.97)
        rows.append((i, f"http://{'bad' if i % 4 == 0 else 'good'}{i % 3}.org/x?{keys}", "block" if i % 4 == 0 else "allow"))
    df = spark.createDataFrame(rows, "page_id long, url string, label string")
    began = time.time()
    out = url_rules.judge(df.select("page_id", "url"), [], df.select("page_id", "label")).collect()
    assert time.time() - began < 60 and all(r["verdict"] == rows[r["page_id"]][2] for r in out)


def test_few_urls_that_agree(spark):
    rows = [(i, f"http://x{i}.com/en/{i}", "block") for i in range(28)] + [(100 + i, f"http://y{i}.com/fr/{i}", "allow") for i in range(28)] + [(200, "http://b.org/en/x", None), (201, "http://b.org/fr/x", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, label string")
    out = {r["page_id"]: r["verdict"] for r in url_rules.judge(df.select("page_id", "url"), [], df.select("page_id", "label")).collect()}
    assert out[200] == "block" and out[201] == "allow"


def lines_of(df, **how):
    out = line_templates.drop_recurring(df, **how)
    return got(out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept", F.lit("")), 256)))


def test_line_templates(spark, docs):
    """Against brute force, and by both ways of looking templates up."""
    rng = np.random.default_rng(6)
    pick = lambda n, k: " ".join(f"{chr(97 + x)}{chr(97 + y)}" for x, y in rng.integers(0, k, (n, 2)))
    copy = "\n".join(f"a line that only the copied text has and that is number {chr(97 + i)} of its own kind" for i in range(6))
    rows = [(i, f"{pick(6, 26)}\nposted by {pick(1, 20)} in the daily news of today\nJoined {i} days ago at {i}:00\n{pick(12, 26)}\nthe same words in all\n42\n\nYes.") for i in range(30)]
    rows += [(50 + i, f"we met {pick(5, 26)} at noon and left the {pick(2, 26)}") for i in range(30)]
    rows += [(100 + i, copy) for i in range(40)] + [(200, None), (201, ""), (202, "\n\n"), (203, "42\n43"), (None, copy)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.op5(rows)
    assert lines_of(df) == want and lines_of(df, broadcast=-1) == want
    assert lines_of(spark.createDataFrame(docs, "doc_id long, text string")) == brute.op5(docs)


def test_line_templates_learn_a_free_field(spark):
    """One free field in ten tokens is learned; five random ones in twelve make no template."""
    rng = np.random.default_rng(7)
    word = lambda: "".join(map(chr, rng.integers(97, 123, 7)))
    rows = [(i, f"{word()} {word()} {word()}\nPosted by {word()} in the local section of the news\nthe {word()} of {word()} and {word()} was {word()} for {word()} again now") for i in range(30)]
    out = line_templates.drop_recurring(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all("Posted" not in r["kept"] and r["n_removed"] == 1 for r in out)


def test_line_templates_odd_rows(spark, odd, none):
    df = odd.withColumns({c: F.lit(c) for c in ("row", "h", "gone", "_key", "_gone", "group")})
    out = line_templates.drop_recurring(df)
    assert out.columns == [c for c in df.columns if c not in ("kept", "n_lines")] + ["kept", "n_lines", "n_removed"]
    assert lines_of(df) == brute.op5(ODD) and line_templates.drop_recurring(none).count() == 0


def test_neighbours(spark):
    """Many leaves, not all visited, against all rows."""
    rng = np.random.default_rng(4)
    middles = rng.normal(size=(40, 24))
    x = np.concatenate([m + 0.35 * rng.normal(size=(100, 24)) for m in middles]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    exact = brute.op7(rows)
    mine = kmeans_tree.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).toPandas()
    found = mine.sort_values(["query_id", "rank"]).groupby("query_id")["vec_id"].apply(list).to_dict()
    assert set(found) == set(exact) and sum(len(set(found[i]) & set(exact[i])) for i in exact) >= 0.9 * sum(map(len, exact.values()))
    v = dict(rows)
    assert all(abs(r.score - np.dot(np.float64(v[r.query_id]), np.float64(v[r.vec_id]))) < 1e-9 for r in mine.itertuples())
    assert (mine.groupby("query_id")["rank"].apply(list).str.len() == 20).all()


def test_neighbours_of_the_given_table(spark):
    d = pd.read_parquet("/root/testdata/sf0.01/embeddings.parquet")
    exact = brute.op7(list(zip(d["vec_id"], d["embedding"], strict=True)))
    mine = queries.op7_nearest_neighbours(spark, "/root/testdata/sf0.01").toPandas()
    found = mine.sort_values(["query_id", "rank"]).groupby("query_id")["vec_id"].apply(list).to_dict()
    assert set(found) == set(exact) and sum(len(set(found[i]) & set(exact[i])) for i in exact) >= 0.9 * sum(map(len, exact.values()))


def test_a_leaf_is_taken_only_if_visited():
    """best() compares a query with the rows of the leaves that it asks for."""
    ids, x, leaf = np.arange(6), np.eye(6), np.array([0, 0, 1, 1, 2, 2])
    q = np.full((2, 6), 1.0)
    got = {i: a.tolist() for i, a, _ in kmeans_tree.best(ids, x, leaf, np.array([0, 9]), q, [np.array([0, 2]), np.array([1])], 3)}
    assert got == {0: [1, 4, 5], 1: [2, 3]}


def test_neighbours_odd_rows(spark):
    """Ties, short, null, zero, non-finite vectors; other lengths; ids that repeat; clashing columns."""
    rows = [(i, [1.0, float(i % 3)]) for i in range(40)] + [(100, None), (120, [0.0, 0.0]), (140, [float("nan"), 1.0]), (160, []), (180, [1.0]), (181, [2.0]), (None, [1.0, 1.0]), (200, [1.0, None])]
    rows += [(20, [5.0, 5.0]), (220, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit("mine") for c in ("leaf", "h", "v", "dim", "score", "rank")})
    mine = kmeans_tree.search(df, k=5).toPandas()
    assert sorted(mine["query_id"].unique()) == [0, 20, 180]
    assert mine[mine["query_id"] == 20].sort_values("rank")["vec_id"].tolist() == [2, 5, 8, 11, 14]
    assert mine[mine["query_id"] == 180][["vec_id", "score"]].values.tolist() == [[181, 2.0]]
    assert mine[mine["query_id"] == 0].sort_values("rank")["vec_id"].tolist() == [20, 1, 2, 3, 4]
    assert kmeans_tree.search(df.limit(0)).count() == 0
    assert kmeans_tree.search(df.where("vec_id in (0, 1)")).count() == 1


def test_neighbours_around_a_common_vector(spark):
    """A third of the rows are one vector: its leaf is cut into parts, and ties go to the smaller ids."""
    rng = np.random.default_rng(5)
    rows = [(i, [1.0, 0.0, 0.0, 0.0] if i % 3 == 0 else rng.normal(size=4).round(2).tolist()) for i in range(1200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    mine = kmeans_tree.search(df, block=100).toPandas()
    exact = {i: sorted(-np.dot(v, u) for j, u in rows if j != i)[19] for i, v in rows if i % 20 == 0}
    assert (mine.groupby("query_id").size() == 20).all()
    assert sum(-r.score <= exact[r.query_id] + 1e-12 for r in mine.itertuples()) >= 0.9 * len(mine)
    near = mine[(mine["query_id"] == 60) & (mine["score"] == 1.0)].sort_values("rank")["vec_id"].tolist()
    assert near == [i for i in range(0, 1200, 3) if i != 60][: len(near)]


def test_packing(spark, none, docs):
    rows = [r.asDict() for r in queries.op8_packing(spark, SF).collect()]
    assert brute.check_packing(rows, brute.op8_ids(docs)) < 0.01
    clean = [r for r in dict(ODD).items()]
    clash = spark.createDataFrame(clean, "doc_id long, text string").withColumns({c: F.lit(c) for c in ("ids", "start", "small", "task", "rank", "h", "length")})
    pieces = queries.packed_digest(packing.pack(packing.tokenize(clash, WORDS, 2))).collect()
    brute.check_packing([p.asDict() for p in pieces], brute.op8_ids(clean))
    # repeated rows, each with an id of its own here, are packed each for itself
    again = [(100 * k + (i or 50), t) for k in range(3) for i, t in clean]
    pieces = queries.packed_digest(packing.pack(packing.tokenize(spark.createDataFrame(again, "doc_id long, text string"), WORDS, 2))).collect()
    brute.check_packing([p.asDict() for p in pieces], brute.op8_ids(again))
    assert packing.pack(packing.tokenize(none, WORDS, 2)).count() == 0
    assert packing.pack(packing.tokenize(spark.createDataFrame([(1, "a b"), (1, "a b")], "doc_id long, text string"), WORDS, 2)).count() >= 2


def test_base_statistics(spark, odd, none, docs):
    for rows, df in ((docs, spark.createDataFrame(docs, "doc_id long, text string")), (ODD, odd)):
        mine = robust_quality.base_statistics(df).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        assert got(mine) == sorted(((i, *brute.op9(t)[:5]) for i, t in rows), key=str)
    assert robust_quality.judge(odd).count() == len(ODD) and robust_quality.judge(none).count() == 0


def test_base_statistics_clashing_columns(spark):
    df = spark.createDataFrame([(1, SENTENCE)], "doc_id long, text string").withColumns({c: F.lit(c) for c in ("n_group", "m_0", "c_0_0", "d2", "_k0", "k0", "cell", "est", "w", "_w", "row", "lang", "source", "n_words")})
    out = robust_quality.judge(df)
    assert set(out.columns) == set(df.columns) - {"text"} | {*robust_quality.OWN, "base_failed", "distance", "kept"}
    assert out.first()["m_0"] == "m_0" and out.first()["n_words"] == len(SENTENCE.split())


def test_robust_outliers(spark):
    rng = np.random.default_rng(2)
    rows = [(i, " ".join("abcdefgh"[: rng.integers(3, 8)] + str(x) for x in rng.integers(100, 999, 60)), "en", "s") for i in range(200)]
    rows += [(1000 + i, " ".join(f"w{x}%%%***" for x in rng.integers(100, 9999, 60)), "en", "s") for i in range(10)]
    rows += [(2000 + i, " ".join(f"w{x}%%%***" for x in rng.integers(100, 9999, 60)), "en", "small") for i in range(5)]
    kept = {r["doc_id"]: r["kept"] for r in robust_quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(kept[i] for i in kept if i >= 1000) and sum(kept[i] for i in kept if i < 1000) >= 198


def test_least_determinant(spark):
    """Against all subsets of small groups, of which a fifth lies far off."""
    rng = np.random.default_rng(8)
    rows = []
    for g in range(4):
        good = rng.normal([5, 0.3, 0.4, 0.5], [2.0, 0.4, 0.3, 0.5], (11, 4))
        bad = rng.normal([12, 3, 3, 4], 0.2, (3, 4))
        rows += [(f"g{g}", *map(float, x)) for x in np.concatenate([good, bad])]
    df = spark.createDataFrame(rows, "cell string, x_len double, x_sym double, x_dup double, x_rep double")
    for r in robust_quality.robust_estimates(df).collect():
        x = np.array([z[1:] for z in rows if z[0] == r["cell"]])
        det, mean, scatter = brute.least_determinant(x, 11, 1.486, list(robust_quality.FLOORS.values()))
        assert r["det"] <= det * 1.02 and np.allclose([r["est"][f"m_{i}"] for i in range(4)], mean, atol=0.05)
        far = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(scatter), x - mean)
        lower = np.array([[r["est"][f"l_{i}_{j}"] if j < i else 1 / r["est"][f"l_{i}_{i}"] if i == j else 0 for j in range(4)] for i in range(4)])
        mine = (np.linalg.solve(lower, (x - [r["est"][f"m_{i}"] for i in range(4)]).T) ** 2).sum(0)
        assert ((mine <= robust_quality.CUTOFF) == (far <= robust_quality.CUTOFF)).all() and (far > robust_quality.CUTOFF).any()


def near_by_hand(rows):
    s = {i: brute.shingles(t) for i, t in rows}
    root = {i: i for i in s}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in s:
        for j in s:
            if i < j and s[i] and len(s[i] & s[j]) >= 0.8 * len(s[i] | s[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in s}


def test_near_duplicates(spark, odd, none, docs):
    mine = {r["doc_id"]: r["class_id"] for r in queries.op10_near_duplicates(spark, SF).collect()}
    assert mine == near_by_hand(docs)
    rows = probminhash.classes(odd).collect()
    assert len(rows) == len(ODD) and probminhash.classes(none).count() == 0
    assert {r["class_id"] for r in rows if r["doc_id"] == 4} == {4}


def test_many_texts_around_one_passage(spark):
    """Texts that share a passage without being alike stay apart; the alike among them are found."""
    rng = np.random.default_rng(3)
    body = " ".join(f"p{i}" for i in range(60))
    rows = [(i, body + " " + " ".join(f"u{x}" for x in rng.integers(0, 10**6, 30))) for i in range(120)]
    rows += [(1000 + i, rows[i][1] + " more") for i in range(0, 120, 10)]
    mine = {r["doc_id"]: r["class_id"] for r in probminhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = near_by_hand(rows)
    assert mine == want


def test_prob_minhash_estimates_weighted_similarity():
    a, b = np.arange(1, 41, dtype=np.uint64), np.arange(11, 51, dtype=np.uint64)
    wa, wb = np.where(a % 2 == 0, 3.0, 1.0), np.where(b % 2 == 0, 3.0, 1.0)
    fa, fb = dict(zip(a.tolist(), wa, strict=True)), dict(zip(b.tolist(), wb, strict=True))
    keys = sorted(fa.keys() | fb.keys())
    x, y = np.array([fa.get(k, 0) for k in keys]), np.array([fb.get(k, 0) for k in keys])
    true = sum(1 / np.maximum(x / x[i], y / y[i]).sum() for i in range(len(keys)) if x[i] and y[i])
    m = 4000
    assert abs((probminhash.signature(a * np.uint64(7919), wa, m) == probminhash.signature(b * np.uint64(7919), wb, m)).mean() - true) < 0.05


def test_components(spark):
    pairs = [(b"a", b"b"), (b"b", b"c"), (b"x", b"y")] + [(f"n{i:03d}".encode(), f"n{i + 1:03d}".encode()) for i in range(60)]
    roots = {bytes(r["node"]): bytes(r["root"]) for r in probminhash.components(spark.createDataFrame(pairs, "a binary, b binary")).collect()}
    assert roots[b"c"] == b"a" and roots[b"y"] == b"x" and roots[b"n060"] == b"n000"


def test_pipeline_stages_against_brute_force(spark):
    """Each stage on what the one before kept: its rows are those of the brute-force version."""
    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "line_dedup", "minhash_near_dedup", "substring_dedup", "packing"]
    d = spark.read.parquet(f"{SF}/documents.parquet")

    def texts(df):
        assert df.columns == d.columns
        rows = [(r["doc_id"], r["text"]) for r in df.collect()]
        assert all(r["n_chars"] == len(r["text"]) for r in df.collect())
        return rows

    first = stages["language_id"](spark, d, SF)
    model = langid.fit(d.where(~langid.held_out(F.col("doc_id"))))
    want = []
    for r in d.collect():
        if r["text"] and any(map(str.isalpha, r["text"])):
            coded = langid.prepared(r["text"])
            if model.code_lengths([coded])[0].min() / len(coded) <= 7.0:
                want.append(r["doc_id"])
    rows = [(r["doc_id"], r["text"]) for r in first.collect()]
    assert sorted(i for i, _ in rows) == sorted(want) and len(want) >= 0.95 * d.count()

    second = stages["line_dedup"](spark, first, SF)
    kept = {(i, brute.hexed(t.encode())) for i, t in texts(second)}
    assert kept == {(i, h) for i, _, _, h in brute.op5(rows)}

    rows = texts(second)
    third = stages["minhash_near_dedup"](spark, second, SF)
    assert sorted(i for i, _ in texts(third)) == sorted(i for i, c in near_by_hand(rows).items() if i == c)

    rows = texts(third)
    fourth = stages["substring_dedup"](spark, third, SF)
    gone = {i: (n, h) for i, _, n, h in brute.op3(rows)}
    for i, t in texts(fourth):
        n, h = gone[i]
        assert (brute.hexed(t.encode()) == h) if n else t == dict(rows)[i]

    rows = texts(fourth)
    pieces = [r.asDict() for r in stages["packing"](spark, fourth, SF).collect()]
    assert brute.check_packing(pieces, brute.op8_ids(rows)) < 0.01


def test_pipeline_runs_whole(spark):
    import corpus_pipeline

    assert corpus_pipeline.run(spark, SF).count() > 0


def test_pipeline_odd_rows(spark):
    """Nulls in any column, repeated ids and rows, empty tables, extra columns."""
    import corpus_pipeline

    d = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    odd = [(None, SENTENCE * 3, None, None, None), (None, "quite another text of other words than all the rest here", "en", None, 5), (7, None, "en", "s", None), (7, "", "en", "s", 0), (7, "42", "en", "s", 2)]
    odd += [(80_008, SENTENCE, "en", "s", 1), (80_008, "different words under the same number as the other one has", "en", "s", 1)] * 2
    rows = d.unionByName(spark.createDataFrame(odd, d.schema)).withColumns({c: F.lit(c) for c in ("row", "kept", "key", "node", "_id")})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rows, SF)
        assert out.columns == d.columns and out.count() > 0, name
        assert stage(spark, rows.limit(0), SF).count() == 0, name
    near = corpus_pipeline.drop_near_copies(spark, rows, SF)
    assert {r["text"] for r in near.where("doc_id = 80008").collect()} == {SENTENCE, odd[6][1]}
    assert corpus_pipeline.pack(spark, rows, SF).count() >= rows.count() and corpus_pipeline.pack(spark, rows.limit(0), SF).count() == 0
