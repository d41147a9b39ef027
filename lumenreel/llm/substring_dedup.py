"""Substring dedup by super-k-mer partitioning.

A window is ``n`` consecutive words. Its minimiser is the group of ``M`` words in it with the least
hash (the first such). Consecutive windows with the same minimiser overlap in all but one word, so
they travel together as one packed string, a super-k-mer, to the bucket that the minimiser names.
Equal windows have equal minimisers and meet in a bucket, where the windows of the strings that
share a minimiser are sorted and counted, word for word.

Each task packs what goes to a bucket into compressed blocks and sends a string only once per
block, with its count; so copies don't pile up. A minimiser of ``HOT`` super-k-mers or more, counted
over all texts, would still gather different strings without end; its windows travel one by one
instead, as 128-bit digests to the bucket of the digest, and are counted there. Which way a window
goes depends on its minimiser alone, so both counts are complete.

Answers go back by the digest of the string, and the spans to remove by the digest of the text. Three
sets are broadcast as bitmaps of a fixed size, in which a few others may seem to be: the hot minimisers,
the digests with an answer and the texts with spans. What isn't in them need not travel: a string
without an answer stays unsent, and a text without spans is never shuffled.
"""

from __future__ import annotations

import hashlib
import math
import struct
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bitmaps import bitmap, in_bitmap, leading
from .common import bounded, discard, lean, partitions, slices, stored
from .wordhash import encoded, mixed, runs, word_hashes

N, M = 35, 6
#: Super-k-mers from which on a minimiser is hot.
HOT = 1000
#: Bytes of strings that a bucket gets, about.
BUCKET = 64 << 20
#: Characters of text after which a task sends its blocks on.
FLUSH = 12 << 20
#: Bytes of blocks in a batch.
SENT = 1 << 20


def plain(text: str | None) -> bytes:
    """The words (runs of other characters than the six ASCII spaces) joined by one space."""
    return b" ".join(encoded(text).split())


def _least(g: np.ndarray, w: int) -> np.ndarray:
    """Position of the least of each run of w values, the first of equals."""
    at = np.arange(len(g))
    size, best = 1, at
    while size < w:
        step = min(size, w - size)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(g[right] < g[left], right, left)
        size += step
    return best


def super_kmers(text: bytes, n: int = N, m: int = M) -> tuple[np.ndarray, ...]:
    """(first window, number of windows, hash of the minimiser, start, end) of each super-k-mer;
    start and end are its bytes in the text."""
    starts, ends, h = word_hashes(text)
    none = np.zeros(0, np.int64)
    if len(h) < n:
        return none, none, np.zeros(0, np.uint64), none, none
    g = runs(h, m)
    pos = _least(g, n - m + 1)
    first = np.flatnonzero(np.r_[True, pos[1:] != pos[:-1]])
    length = np.diff(np.r_[first, len(pos)])
    return first, length, g[pos[first]], starts[first], ends[first + length + n - 2]


def _digest(b: bytes) -> bytes:
    return hashlib.blake2b(b, digest_size=16).digest()


def _minimisers(m_of: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many super-k-mers each minimiser has. (Their hashes are mixed: least hashes are small.)"""
        for b in batches:
            for part in slices(b, "text", FLUSH // 8):
                h, c = np.unique(np.concatenate([m_of(t.as_py()) for t in part["text"]]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))], names=["h", "c"])

    return run


def _pack(items: dict, singles: dict, zipper: zstandard.ZstdCompressor) -> bytes:
    """One block: items {(minimiser, string): count}, singles {digest: count}."""
    text = b"\n".join(s for _, s in items)
    head = struct.pack("<II", len(items), len(singles))
    return zipper.compress(
        b"".join([head, np.array([h for h, _ in items], "<u8").tobytes(), np.array(list(items.values()), "<u4").tobytes(), b"".join(singles), np.array(list(singles.values()), "<u4").tobytes(), text])
    )


def _unpack(block: bytes) -> tuple[list[int], list[int], list[bytes], list[bytes], list[int]]:
    b = zstandard.ZstdDecompressor().decompress(block)
    k, s = struct.unpack_from("<II", b)
    at = 8
    mh = np.frombuffer(b, "<u8", k, at).tolist()
    at += 8 * k
    counts = np.frombuffer(b, "<u4", k, at).tolist()
    at += 4 * k
    digests = [b[at + 16 * i : at + 16 * i + 16] for i in range(s)]
    at += 16 * s
    single_counts = np.frombuffer(b, "<u4", s, at).tolist()
    at += 4 * s
    return mh, counts, b[at:].split(b"\n") if k else [], digests, single_counts


def _answers(blocks: list[bytes], n: int) -> Iterator[tuple[bytes, bytes]]:
    """(digest, spans of its repeated windows) of the strings and single windows in a bucket that
    have any. Spans: first and last+1 window, as unsigned 32-bit integers."""
    by_min: dict[int, dict[bytes, int]] = {}
    singles: dict[bytes, int] = defaultdict(int)
    for block in blocks:
        mh, counts, strings, digests, single_counts = _unpack(block)
        for h, c, s in zip(mh, counts, strings, strict=True):
            mine = by_min.setdefault(h, {})
            mine[s] = mine.get(s, 0) + c
        for d, c in zip(digests, single_counts, strict=True):
            singles[d] += c
    one = struct.pack("<II", 0, 1)
    for d, c in singles.items():
        if c > 1:
            yield d, one
    for strings in by_min.values():
        if len(strings) == 1:
            ((s, c),) = strings.items()
            if c > 1:
                yield _digest(s), struct.pack("<II", 0, s.count(b" ") + 2 - n)
            continue
        windows = []
        for k, (s, c) in enumerate(strings.items()):
            ends = [i for i, x in enumerate(s) if x == 32]
            starts = [0, *(e + 1 for e in ends)]
            ends.append(len(s))
            windows += [(s[starts[i] : ends[i + n - 1]], k, i, c) for i in range(len(starts) - n + 1)]
        windows.sort()
        again: dict[int, list[int]] = defaultdict(list)
        lo = 0
        while lo < len(windows):
            hi, total = lo, 0
            while hi < len(windows) and windows[hi][0] == windows[lo][0]:
                total += windows[hi][3]
                hi += 1
            if total > 1:
                for _, k, i, _ in windows[lo:hi]:
                    again[k].append(i)
            lo = hi
        for k, s in enumerate(strings):
            if k in again:
                at = np.array(sorted(again[k]))
                cut = np.flatnonzero(np.diff(at) > 1)
                yield _digest(s), np.stack([at[np.r_[0, cut + 1]], at[np.r_[cut, len(at) - 1]] + 1], 1).astype("<u4").tobytes()


def repeated_spans(docs: DataFrame, n: int = N, m: int = M, buckets: int | None = None, hot: int = HOT) -> DataFrame:
    """key (MD5 of the text) and found: (at, spans) structs, spans being (first, last+1 window)
    pairs, binary unsigned 32-bit, relative to ``at``, of every window of a text in docs (text) that
    starts anywhere else as well."""
    spark = docs.sparkSession
    docs = docs.select("text").where(F.col("text").isNotNull())
    if not buckets:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = max(2 * partitions(spark), math.ceil(4 * size / BUCKET))
    counts = docs.mapInArrow(lean(_minimisers(lambda t: mixed(super_kmers(plain(t), n, m)[2]))), "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
    often = spark.sparkContext.broadcast(bitmap(counts.where(F.col("c") >= hot), "h"))

    def strings(text: bytes) -> Iterator[tuple[bool, int, int, bytes]]:
        """What travels of a text: (whether a single window, hash of the minimiser, first window, words)."""
        first, length, mh, start, end = super_kmers(text, n, m)
        hot_here, ws = in_bitmap(often.value, mixed(mh)), ()
        if hot_here.any():
            ws = text.split()
        for a, w, h, s, e, single in zip(*(z.tolist() for z in (first, length, mh, start, end, hot_here)), strict=True):
            if single:
                for i in range(a, a + w):
                    yield True, h, i, b" ".join(ws[i : i + n])
            else:
                yield False, h, a, text[s:e]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: dict[int, dict] = defaultdict(dict)
        singles: dict[int, dict] = defaultdict(dict)
        size, zipper = 0, zstandard.ZstdCompressor(level=3)

        def flush() -> Iterator[pa.RecordBatch]:
            some, held = [], 0

            def batch_of() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array([b for b, _ in some], pa.int32()), pa.array([x for _, x in some], pa.binary())], names=["bucket", "block"])

            for b in sorted(items.keys() | singles.keys()):
                some.append((b, _pack(items.pop(b, {}), singles.pop(b, {}), zipper)))
                held += len(some[-1][1])
                if held >= SENT:
                    yield batch_of()
                    some, held = [], 0
            if some:
                yield batch_of()

        for batch in batches:
            for t in batch["text"]:
                text = plain(t.as_py())
                for single, h, _, words in strings(text):
                    if single:
                        d = _digest(words)
                        mine, k = singles[int.from_bytes(d[:8], "little") % buckets], d
                    else:
                        mine, k = items[(h >> 20) % buckets], (h, words)
                    mine[k] = mine.get(k, 0) + 1
                size += len(text)
                if size >= FLUSH:
                    yield from flush()
                    size = 0
        yield from flush()

    def count_windows(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_answers(pdf["block"].tolist(), n), columns=["digest", "spans"])

    blocks = docs.mapInArrow(lean(send), "bucket int, block binary")
    answers = stored(blocks.groupBy("bucket").applyInPandas(count_windows, "digest binary, spans binary"), "answers")
    asked = spark.sparkContext.broadcast(bitmap(answers.select(leading("digest").alias("h")), "h"))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Where the strings and single windows that may have an answer stand; of the texts of a batch
        each once."""
        for batch in batches:
            keys, ds, at = [], [], []
            for t in dict.fromkeys(batch["text"].to_pylist()):
                some = [(i, _digest(words)) for _, _, i, words in strings(plain(t))]
                if some:
                    h = np.frombuffer(b"".join([d for _, d in some]), ">u8")[::2].astype(np.uint64)
                    mine = [some[i] for i in np.flatnonzero(in_bitmap(asked.value, h)).tolist()]
                    keys += [hashlib.md5(encoded(t)).digest()] * len(mine)
                    at += [i for i, _ in mine]
                    ds += [d for _, d in mine]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ds, pa.binary()), pa.array(at, pa.int32())], names=["key", "digest", "at"])

    where = docs.mapInArrow(lean(places), "key binary, digest binary, at int")
    out = stored(where.join(answers, "digest").groupBy("key").agg(F.collect_set(F.struct("at", "spans")).alias("found")), "spans")
    discard(answers)
    return out


def remove_repeated(docs: DataFrame, text: str = "text", n: int = N, m: int = M, buckets: int | None = None, hot: int = HOT) -> DataFrame:
    """``docs`` with n_words, n_removed and kept (the kept words joined by one space) in place of
    columns of these names.

    Every word in a window of ``n`` words whose word sequence starts anywhere else too, in the
    same or another document, is removed; windows are judged on the input. Null and empty texts
    have no words; rows that are repeated count as documents of their own, so their windows
    repeat; texts shorter than a window keep all; an empty table gives no rows. Texts and strings are
    told by 128-bit digests."""
    bounded(docs.sparkSession)
    docs = docs.drop("n_words", "n_removed", "kept")
    found = repeated_spans(docs.select(F.col(text).alias("text")), n, m, buckets, hot)
    hit = docs.sparkSession.sparkContext.broadcast(bitmap(found.select(leading("key").alias("h")), "h"))
    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    row = T.StructField("row", docs.schema)
    shape = T.StructType([row, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])

    def dealt(batches: Iterator[pa.RecordBatch], spans: bool) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
        """The rows whose text may have spans, or those whose has none, with the digests of the texts."""
        for batch in batches:
            for part in slices(batch, "text", FLUSH // 8):
                keys = [hashlib.md5(encoded(t)).digest() for t in part["text"].to_pylist()]
                h = np.frombuffer(b"".join(keys), ">u8")[::2].astype(np.uint64)
                at = np.flatnonzero(in_bitmap(hit.value, h) == spans)
                yield part.take(pa.array(at)), [keys[i] for i in at.tolist()]

    def cleaned(part: pa.RecordBatch, found: list) -> pa.RecordBatch:
        total, gone, kept = [], [], []
        for t, mine in zip(part["text"], found, strict=True):
            ws = encoded(t.as_py()).split()
            edge = np.zeros(len(ws) + n, np.int64)
            for f in mine or ():
                for a, b in np.frombuffer(f["spans"], "<u4").reshape(-1, 2).tolist():
                    edge[f["at"] + a] += 1
                    edge[f["at"] + b + n - 1] -= 1
            out = np.cumsum(edge)[: len(ws)] > 0
            total.append(len(ws))
            gone.append(int(out.sum()))
            kept.append(b" ".join([w for w, x in zip(ws, out.tolist(), strict=True) if not x] if gone[-1] else ws).decode())
        return pa.RecordBatch.from_arrays([part["row"], pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], names=shape.names)

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _ in dealt(batches, False):
            yield cleaned(part, [None] * part.num_rows)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, keys in dealt(batches, True):
            yield pa.RecordBatch.from_arrays([part["row"], part["text"], pa.array(keys, pa.binary())], names=["row", "text", "key"])

    def spliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", FLUSH // 8):
                yield cleaned(part, part["found"].to_pylist())

    touched = rows.mapInArrow(lean(named), T.StructType([row, T.StructField("text", T.StringType()), T.StructField("key", T.BinaryType())]))
    touched = touched.join(found, "key", "left").select("row", "text", "found").mapInArrow(lean(spliced), shape)
    return rows.mapInArrow(lean(untouched), shape).unionByName(touched).select("row.*", "n_words", "n_removed", "kept")
