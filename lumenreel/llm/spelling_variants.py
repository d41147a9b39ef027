"""Groups spelling variants of words: each word points to a much more frequent one, one edit away.

Rare-first prefix filter over positional bigrams. Bigrams are ordered by the number of words' places
that they have in all words, rarest first (then by letters, then by position). One edit destroys at
most two bigrams of a word, so two words that are one edit apart share one of their three rarest, at
positions at most one apart: only these three are joined. The edit lies on one side of a shared
bigram; the other side is equal, and so is one half of the edited side (cut in the middle of the
shorter one). The join's keys say all that: the bigram, the equal side, and a half of the other. What
meets is verified by its edit distance.

All joins are sort-merge joins by hint: Spark takes a table that was exploded, or read from well-packed
Parquet, for much smaller than it is, and would broadcast it through the driver.

All in the JVM. The bigrams' ranks are a literal: there are at most LETTERS ** 2 = 8100 of them,
whatever the number of words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, stored

#: Runs of at least SHORTEST letters; shorter runs can't give words.
SHORTEST = 7
RUN = f"[A-Za-z\\u00C0-\\u00FF]{{{SHORTEST},}}"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: a-z and U+00C0 to U+00FF.
LETTERS = 26 + 64
#: One run in so many loses a letter.
ONE_IN = 31
LEAST, RATIO, RAREST = 2, 10, 3


def damaged(doc_id: Column, run: Column) -> Column:
    """The run without one code point, for those whose checksum with the document's id says so."""
    h = F.crc32(F.encode(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run), "UTF-8"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % ONE_IN == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def words(docs: DataFrame) -> DataFrame:
    """(word, n) of all documents (doc_id, text): n occurrences, LEAST at least."""
    lower = lambda c: F.when(c.rlike("[\\u00C0-\\u00DE]"), F.translate(c, UPPER, LOWER)).otherwise(F.lower(c))
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run")).select("doc_id", lower(F.col("run")).alias("run"))
    word = runs.select(damaged(F.col("doc_id"), F.col("run")).alias("word")).where(F.length("word") >= SHORTEST)
    return word.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST)


def _codes(word: str) -> Column:
    """The letters of a word as numbers below LETTERS."""
    code = lambda c: F.when(F.ascii(c) >= 0xC0, F.ascii(c) - 0xC0 + 26).otherwise(F.ascii(c) - 97)
    return F.transform(F.split(word, ""), code)


def _bigrams(codes: str) -> Column:
    """(bigram, position from 0), a bigram being a number below LETTERS ** 2."""
    pair = lambda i: F.struct((F.get(codes, i) * LETTERS + F.get(codes, i + 1)).alias("g"), i.alias("p"))
    return F.transform(F.sequence(F.lit(0), F.size(codes) - 2), pair)


def ranks(found: DataFrame) -> list[int]:
    """The place of each bigram in the order, by its number; found: the words."""
    rows = found.select(_codes("word").alias("codes")).select(F.explode(_bigrams("codes")).alias("b")).groupBy("b.g").count().collect()
    out = [0] * (LETTERS * LETTERS)
    for k, (_, g) in enumerate(sorted((r["count"], r["g"]) for r in rows)):
        out[g] = k
    return out


def _keys(rank: list[int]) -> Column:
    """The keys of a word (columns word, codes): for each of its rarest bigrams, each side that the edit
    can be on, each length of the shorter word's edited side (the word itself is that or the longer
    one), and each half that can be equal."""
    order = F.lit(rank)
    ranked = F.transform(_bigrams("codes"), lambda b: F.struct(F.get(order, b["g"]).alias("r"), b["p"].alias("p")))
    rarest = F.slice(F.array_sort(ranked), 1, RAREST)
    w, n = F.col("word"), F.size("codes")

    def keys(b: Column) -> Column:
        p, out = b["p"], []
        for side, size in (("after", n - p - 2), ("before", p)):
            for less in (0, 1):
                m = size - less  # of the shorter word's edited side
                half = F.floor(m / 2).cast("int")
                rest = (m - half).cast("int")
                if side == "after":
                    same, parts = F.substring(w, F.lit(1), p + 2), (F.substring(w, p + 3, half), F.right(w, rest))
                else:
                    same, parts = F.substring(w, p + 1, n), (F.left(w, half), F.substring(w, p - rest + 1, rest))
                for tag, part in zip("ab", parts, strict=True):
                    out.append(F.when(m >= 0, F.xxhash64(F.lit(side + tag), b["r"], m, same, part)))
        return F.array(*out)

    return F.array_compact(F.array_distinct(F.flatten(F.transform(rarest, keys))))


def near_pairs(found: DataFrame) -> DataFrame:
    """(a, an, b, bn): words (word, n) one edit apart, a < b, each pair once."""
    coded = found.select("word", "n", _codes("word").alias("codes"))
    keyed = coded.select("word", "n", F.explode(_keys(ranks(found))).alias("key"))
    a, b = keyed.select("key", F.col("word").alias("a"), F.col("n").alias("an")), keyed.select("key", F.col("word").alias("b"), F.col("n").alias("bn"))
    met = a.join(b.hint("merge"), "key").where((F.col("a") < F.col("b")) & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "an", "b", "bn").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words in forms (word, form), by doubling: a form is RATIO times as frequent, so
    chains are short."""
    at = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = stored(at.join(step.hint("merge"), "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        discard(at)
        at = new.select("word", "root")
        at._stored_at = new._stored_at
        if new.where("moved").isEmpty():
            return at


def variants(docs: DataFrame) -> DataFrame:
    """One row per word of documents (doc_id, text) that occurs LEAST times or more: word, form (its
    near word of largest count, ties by code points, if that count is RATIO times its own), root,
    n, n_near (near words) and form_n.

    Null and empty texts have no words. A null doc_id counts as an empty one; each of repeated rows counts. An
    empty table gives no rows; other columns are not read."""
    found = stored(words(docs.select("doc_id", "text")), "words")
    pairs = stored(near_pairs(found), "pairs")
    other = lambda w, v, n: pairs.select(F.col(w).alias("word"), F.col(v).alias("near"), F.col(n).alias("near_n"))
    both = other("a", "b", "bn").unionByName(other("b", "a", "an"))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    named = found.join(best.hint("merge"), "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.near").alias("near"), (-F.col("best.m")).alias("near_n"))
    large = F.col("near_n") >= RATIO * F.col("n")
    named = stored(named.select("word", "n", "n_near", F.when(large, F.col("near")).alias("form"), F.when(large, F.col("near_n")).alias("form_n")), "named")
    roots = _roots(named.where("form IS NOT NULL"))
    discard(found, pairs)
    return named.join(roots.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
