"""Language identification by prediction by partial matching (PPM).

For every language a variable-order byte model is fitted: a tree of contexts of ``order`` bytes down to
none, each with the counts of the bytes that followed it. A byte's code length under a language is
``-log2 c/(T+D)`` in the longest context that has seen it, plus ``-log2 D/(T+D)`` for every longer
context that was seen but had to escape (T occurrences, D distinct followers; escape method C), ending
in a uniform code over all bytes. The statistics are frozen after the fit, so the code length of each
sequence of ``order`` + 1 bytes is known; a text is scored by its distinct sequences, exactly. A level of
a tree is two sorted arrays, of its contexts and of what followed them. The language with the shortest
code for the whole text wins.

The fit uses a bounded sample: at most about ``docs_per_language`` labelled documents of each
language (documented parameter), chosen by a hash of the text. Everything else covers the whole input:
all languages, bytes and contexts of the sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded, lean

#: Bytes of text that are scored at once.
BLOCK = 1 << 18
ORDER = 3
UNKNOWN = "und"
#: Up to so many languages their shares are broadcast.
BROADCAST_LANGUAGES = 10_000


def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether each is among the sorted keys, its value)."""
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.float32)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, values[at]


class Tree:
    """The contexts of a language: for each level (bytes of context) the sequences seen with their code
    lengths, and the contexts with what an escape from them costs."""

    def __init__(self, grams: np.ndarray, n: np.ndarray, order: int) -> None:
        self.levels = []
        for k in range(order + 1):
            seen, at = np.unique(grams & np.uint64((1 << 8 * (k + 1)) - 1), return_inverse=True)
            c = np.bincount(at, weights=n, minlength=len(seen))
            contexts, of = np.unique(seen >> np.uint64(8), return_inverse=True)
            total, distinct = np.bincount(of, weights=c, minlength=len(contexts)), np.bincount(of, minlength=len(contexts))
            both = total + distinct
            self.levels.append((seen, (-np.log2(c / both[of])).astype(np.float32), contexts, (-np.log2(distinct / both)).astype(np.float32)))

    def code_lengths(self, grams: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each sequence, given the bytes before it."""
        out, todo = np.zeros(len(grams)), np.arange(len(grams))
        for k in range(len(self.levels) - 1, -1, -1):
            seen, bits, contexts, escape = self.levels[k]
            key = grams[todo] & np.uint64((1 << 8 * (k + 1)) - 1)
            hit, cost = _look_up(seen, bits, key)
            out[todo[hit]] += cost[hit]
            todo, key = todo[~hit], key[~hit]
            known, cost = _look_up(contexts, escape, key >> np.uint64(8))
            out[todo[known]] += cost[known]
        out[todo] += 8.0
        return out


def _sequences(b: np.ndarray, order: int) -> np.ndarray:
    """All runs of ``order`` + 1 bytes as numbers, the last byte lowest."""
    n = max(0, len(b) - order)
    out = np.zeros(n, np.uint64)
    for k in range(order + 1):
        out = (out << np.uint64(8)) | b[k : k + n]
    return out


@dataclass
class PpmModel:
    """The frozen trees of languages."""

    langs: list[str]
    trees: list[Tree]
    order: int

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text (row) under each language (column); the texts are whole."""
        out = np.zeros((len(texts), len(self.langs)))
        if not texts or not self.langs:
            return out
        pad = b" " * self.order
        flat = np.frombuffer(b"".join(pad + t for t in texts), np.uint8)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        start = np.cumsum(size + self.order) - size - self.order
        for lo in range(0, len(flat), BLOCK):
            g = _sequences(flat[lo : lo + BLOCK + self.order], self.order)
            at = np.arange(lo, lo + len(g))
            who = np.searchsorted(start, at, "right") - 1
            mine = np.flatnonzero(at - start[who] < size[who])  # sequences that run into the next text's pad aren't any
            distinct, of = np.unique(g[mine], return_inverse=True)
            first = np.flatnonzero(np.diff(who[mine], prepend=-1))
            if len(first):
                for k, tree in enumerate(self.trees):
                    out[who[mine][first], k] += np.add.reduceat(tree.code_lengths(distinct)[of], first)
        return out


def _grams(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of the sequences by language, summed over some texts."""
        for batch in batches:
            some: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                some.setdefault(lang, []).append(_sequences(np.frombuffer(b" " * order + prepared(text), np.uint8), order))
            for lang, parts in some.items():
                keys, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    return run


def prepared(text: str) -> bytes:
    """What is coded: the text in lower case, as UTF-8."""
    return text.lower().encode("utf-8", "replace")


def build(langs: list[str], lang_ix: np.ndarray, grams: np.ndarray, n: np.ndarray, order: int = ORDER) -> PpmModel:
    """The model from counts of sequences by language."""
    grams = grams.astype(np.int64).view(np.uint64)
    return PpmModel(langs, [Tree(grams[lang_ix == k], n[lang_ix == k], order) for k in range(len(langs))], order)


def fit(labelled: DataFrame, docs_per_language: int = 1500, order: int = ORDER) -> PpmModel:
    """The model of ``labelled`` (text, lang). Bound: about ``docs_per_language`` documents of each
    language. ``order`` is 7 at most. Rows without text or lang are left out; an empty table gives a
    model without languages."""
    bounded(labelled.sparkSession)
    rows = labelled.select("text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    size = rows.groupBy("lang").count()
    langs = sorted(r["lang"] for r in size.select("lang").collect())
    if not langs:
        return build([], np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0, np.int64), order)
    share = size.select("lang", F.least(F.lit(1.0), docs_per_language / F.col("count")).alias("share"))
    picked = rows.join(F.broadcast(share) if len(langs) <= BROADCAST_LANGUAGES else share, "lang")
    picked = picked.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / float(1 << 20) < F.col("share")).select("lang", "text")
    got = picked.mapInArrow(lean(_grams(order)), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    ix = {x: k for k, x in enumerate(langs)}
    lang_ix = np.array([ix[x] for x in got["lang"].to_pylist()], dtype=np.int64)
    return build(langs, lang_ix, got["gram"].to_numpy(), got["n"].to_numpy(), order)


def predict(docs: DataFrame, model: PpmModel, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and bits_per_byte; columns of those names are replaced.

    Null texts, texts without a letter, and all texts when nothing was learned get ``und`` with
    score 0. Ties go to the first language by name. ``score`` is the winner's posterior when the
    evidence of the whole text is scaled to that of 64 bytes at most, so it tells texts in one
    language from mixtures at every length. Repeated rows get equal answers."""
    own = ("lang_pred", "score", "bits_per_byte")
    bounded(docs.sparkSession)
    docs = docs.drop(*own)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = batch[text].to_pylist()
            lang, score, per = [UNKNOWN] * len(texts), [0.0] * len(texts), [None] * len(texts)
            todo = [i for i, t in enumerate(texts) if t and m.langs and any(map(str.isalpha, t))]
            for group in _groups(todo, texts):
                coded = [prepared(texts[i]) for i in group]
                bits = m.code_lengths(coded)
                best = bits.argmin(1)
                size = np.array([len(c) for c in coded], dtype=np.float64)
                gap = (bits - bits.min(1, keepdims=True)) * np.minimum(1.0, 64 / size)[:, None]
                p = 1 / np.exp2(-gap).sum(1)
                for j, i in enumerate(group):
                    lang[i], score[i], per[i] = m.langs[best[j]], float(p[j]), float(bits[j, best[j]] / size[j])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(per, pa.float64())],
                names=[*batch.schema.names, *own],
            )

    out = T.StructType([*docs.schema.fields, T.StructField(own[0], T.StringType()), T.StructField(own[1], T.DoubleType()), T.StructField(own[2], T.DoubleType())])
    return docs.mapInArrow(lean(run), out)


def _groups(todo: list[int], texts: list[str | None]) -> Iterator[list[int]]:
    """Runs of texts of about BLOCK characters, so that few bytes are held at once."""
    group, size = [], 0
    for i in todo:
        group.append(i)
        size += len(texts[i])
        if size >= BLOCK:
            yield group
            group, size = [], 0
    if group:
        yield group


def held_out(doc_id: Column) -> Column:
    """True for the quarter of ids on which nothing is learned."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))
