"""Packing of token sequences into windows by non-negative least squares.

Every document (ids and an end id) is cut into full windows and one remainder. Remainders count
only by length, so the plan is made on a histogram of at most ``window`` bins, whatever the size
of the corpus. Shallow combinations that fill a window exactly (k of length a and one of length b,
or k of a alone) are enumerated; non-negative least squares finds repeat counts that match the
histogram; they are rounded down and made feasible; what is left is packed greedily, longest
first, each window filled to the end by cutting the piece that crosses it. The last, partly filled
window is cut into powers of two, which need no padding.

Ranks within a length come from a range partitioning by length and a hash, so that a length that
many documents share spreads over tasks; the driver holds counts by task and length, of which
there are no more than tasks and lengths together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_table import SPLIT_BYTES, hot_table
from .common import bounded, discard, lean, slices, stored
from .fast_bpe import WordEncoder

WINDOW = 4096
#: Columns of a piece.
PIECE = "doc_id {}, start long, length int, doc_tokens long, small binary"
def combinations(window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All (k, a, b) with k*a + b = window, 0 <= b <= a; b = 0 stands for no filler."""
    ks, as_, bs = [], [], []
    for a in range(1, window):
        for k in range(1, window // a + 1):
            b = window - k * a
            if b <= a and not (k == 1 and b == 0):
                ks.append(k)
                as_.append(a)
                bs.append(b)
    return np.array(ks, np.int64), np.array(as_, np.int64), np.array(bs, np.int64)


def solve(hist: np.ndarray, window: int, rounds: int = 400) -> tuple[np.ndarray, ...]:
    """Repeat counts x >= 0 of the combinations that minimise |A x - hist|, by accelerated
    projected gradients; columns that need an absent length are left out."""
    k, a, b = combinations(window)
    ok = (hist[a] >= k) & ((b == 0) | (hist[b] > 0))
    k, a, b = k[ok], a[ok], b[ok]
    if not len(k):
        return k, a, b, np.zeros(0, np.int64)
    scale = 1 / np.sqrt(k * k + 1.0)  # columns of unit length

    def forward(x: np.ndarray) -> np.ndarray:
        out = np.bincount(a, weights=x * k * scale, minlength=window + 1) + np.bincount(b, weights=x * scale, minlength=window + 1)
        out[0] = 0
        return out

    goal = hist.astype(np.float64).copy()
    goal[0] = 0
    v = np.ones(len(k))  # the largest eigenvalue, by power iteration
    for _ in range(20):
        r = forward(v)
        v = scale * (k * r[a] + np.where(b > 0, r[b], 0))
        size = np.linalg.norm(v)
        v /= size
    step = 1 / (1.05 * size)
    x = np.zeros(len(k))
    y, t = x, 1.0
    for _ in range(rounds):
        r = forward(y) - goal
        new = np.maximum(0, y - step * scale * (k * r[a] + np.where(b > 0, r[b], 0)))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / t2 * (new - x), new, t2
    return k, a, b, np.floor(x * scale).astype(np.int64)


@dataclass
class Plan:
    """By length: rank ranges and what they go to. Entry i of a length serves the ranks from
    ``first[i]``, ``per[i]`` of them to a window, starting with window ``seq[i]`` at offset
    ``at[i]``. Ranks from ``rest_rank`` go to the greedy stream, which starts at ``rest_at``."""

    window: int
    first: dict[int, np.ndarray]
    per: dict[int, np.ndarray]
    seq: dict[int, np.ndarray]
    at: dict[int, np.ndarray]
    rest_rank: np.ndarray
    rest_at: np.ndarray
    rest_seq: int
    total: int

    def place(self, length: int, ranks: np.ndarray) -> list[list[tuple[int, int, int]]]:
        """For each rank the pieces (sequence, offset, length), in order of the ids."""
        out: list[list[tuple[int, int, int]]] = []
        for j in ranks.tolist():
            if j < self.rest_rank[length]:
                i = int(np.searchsorted(self.first[length], j, "right")) - 1
                j -= int(self.first[length][i])
                per = int(self.per[length][i])
                out.append([(int(self.seq[length][i]) + j // per, int(self.at[length][i]) + j % per * length, length)])
            else:
                out.append(self._stream(int(self.rest_at[length]) + (j - int(self.rest_rank[length])) * length, length))
        return out

    def _stream(self, at: int, length: int) -> list[tuple[int, int, int]]:
        """The stream is cut at every window; its last part at the powers of two that make it up."""
        full = self.total // self.window
        pieces = []
        while length:
            seq, off = divmod(at, self.window)
            room = self.window - off
            if seq >= full:  # the tail: which power of two does the position lie in?
                tail, start, n = self.total - full * self.window, 0, 0
                for bit in range(tail.bit_length() - 1, -1, -1):
                    if tail >> bit & 1:
                        if off < start + (1 << bit):
                            break
                        start, n = start + (1 << bit), n + 1
                seq, off, room = full + n, off - start, start + (1 << bit) - off
            take = min(room, length)
            pieces.append((self.rest_seq + seq, off, take))
            at, length = at + take, length - take
        return pieces


def plan(hist: np.ndarray, window: int) -> Plan:
    """hist[L]: pieces of length L, 1 <= L <= window."""
    left = hist.astype(np.int64).copy()
    used = np.zeros(window + 1, np.int64)
    entries: dict[int, list[tuple[int, int, int, int]]] = {}
    seq = 0

    def take(length: int, per: int, repeats: int, at: int) -> None:
        entries.setdefault(length, []).append((int(used[length]), per, seq, at))
        used[length] += per * repeats
        left[length] -= per * repeats

    if left[window]:
        n = int(left[window])
        take(window, 1, n, 0)
        seq += n
    k, a, b, x = solve(left, window)
    for i in np.argsort(-x, kind="stable"):
        ki, ai, bi = int(k[i]), int(a[i]), int(b[i])
        n = min(int(x[i]), int(left[ai]) // (ki + (ai == bi)))
        if bi and bi != ai:
            n = min(n, int(left[bi]))
        if n <= 0:
            continue
        if bi == ai:
            take(ai, ki + 1, n, 0)
        else:
            take(ai, ki, n, 0)
            if bi:
                take(bi, 1, n, ki * ai)
        seq += n
    at = np.zeros(window + 1, np.int64)
    here = 0
    for length in range(window, 0, -1):
        at[length] = here
        here += int(left[length]) * length
    cols = [{length: np.array([e[i] for e in es], np.int64) for length, es in entries.items()} for i in range(4)]
    return Plan(window, cols[0], cols[1], cols[2], cols[3], used, at, seq, here)


def _encoder(docs: DataFrame, path: str, end_id: int) -> Callable:
    """A function over batches of doc_id and text that gives doc_id and ids."""
    shared = docs.sparkSession.sparkContext.broadcast(hot_table(docs, path))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = WordEncoder(path)
        for batch in batches:
            for part in slices(batch, "text", SPLIT_BYTES):
                found = shared.value.look_up(part["text"].to_pylist())
                rest = enc.encode(found.words)
                ids, first, _ = found.ids(np.frombuffer(b"".join(rest), "<u4"), np.fromiter((len(x) // 4 for x in rest), np.int64, len(rest)))
                edge = np.append(first, len(ids)).tolist()
                out = [ids[a:b].astype("<u4").tobytes() + end for a, b in zip(edge, edge[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(out, pa.binary())], names=["doc_id", "ids"])

    return run


def _cutter(window: int) -> Callable:
    """A function over batches of doc_id and ids that gives pieces of at most a window."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            who, cols = [], {"start": [], "length": [], "doc_tokens": [], "small": []}
            for i, b in enumerate(batch["ids"]):
                ids = np.frombuffer(b.as_py() or b"", "<u4")
                n = len(ids)
                for start in range(0, n, window):
                    one = ids[start : start + window]
                    who.append(i)
                    cols["start"].append(start)
                    cols["length"].append(len(one))
                    cols["doc_tokens"].append(n)
                    # two bytes an id where they are enough, and it's the window's length that tells
                    cols["small"].append(one.astype("<u2").tobytes() if one.max() < 65536 else one.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(who, pa.int64())), pa.array(cols["start"], pa.int64()), pa.array(cols["length"], pa.int32()), pa.array(cols["doc_tokens"], pa.int64()), pa.array(cols["small"], pa.binary())],
                names=["doc_id", *cols],
            )

    return cut


def _named(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, str]:
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return docs, docs.schema["doc_id"].dataType.simpleString()


def tokenize(docs: DataFrame, path: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ids (binary, little-endian unsigned 32-bit) with the end id. Words that the broadcast
    table lacks are encoded where they are, of a MB of text each once. Null and empty texts have the
    end id alone; repeated rows each get their row; an empty table gives none; other columns are not read."""
    docs, kind = _named(docs, doc_id, text)
    return docs.mapInArrow(lean(_encoder(docs, path, end_id)), f"doc_id {kind}, ids binary")


def pack(tokens: DataFrame, window: int = WINDOW) -> DataFrame:
    """Pieces of ``tokens`` (doc_id, ids) in windows: doc_id, start, length, doc_tokens,
    sequence_id, offset, ids (binary, unsigned 32-bit).

    Each id lies in one piece; a window is filled without gaps from 0. Rows without ids give no
    piece; repeated rows are packed each for itself; ids of null count as none; an empty table
    gives no rows; other columns are not read; ties of lengths go by a hash of the document."""
    bounded(tokens.sparkSession)
    kind = tokens.schema["doc_id"].dataType.simpleString()
    return _packed(tokens.select("doc_id", "ids").mapInArrow(lean(_cutter(window)), PIECE.format(kind)), kind, window)


def pack_texts(docs: DataFrame, path: str, end_id: int, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """pack() of tokenize(), in one pass of the workers."""
    docs, kind = _named(docs, doc_id, text)
    encode, cut = _encoder(docs, path, end_id), _cutter(window)
    return _packed(docs.mapInArrow(lean(lambda batches: cut(encode(batches))), PIECE.format(kind)), kind, window)


def _packed(cut: DataFrame, kind: str, window: int) -> DataFrame:
    cols = PIECE.format(kind)
    pieces = stored(cut, "pieces")

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rank within the task of each length; the rows come sorted by it."""
        task, last, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            out = []
            for length in batch["length"].to_pylist():
                n = n + 1 if length == last else 0
                last = length
                out.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([task] * len(out), pa.int32()), pa.array(out, pa.int64())], names=[*batch.schema.names, "task", "rank"])

    spread = pieces.withColumn("h", F.xxhash64("doc_id", "start", F.octet_length("small"), F.crc32("small"))).repartitionByRange("length", "h")
    rows = stored(spread.drop("h").sortWithinPartitions("length").mapInArrow(lean(ranked), cols + ", task int, rank long"), "ranked")
    discard(pieces)
    counts = rows.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")).collect()
    hist, base = np.zeros(window + 1, np.int64), {}
    for r in sorted(counts, key=lambda r: (r["length"], r["task"])):
        base[r["task"], r["length"]] = int(hist[r["length"]])
        hist[r["length"]] += r["n"]
    shared = cut.sparkSession.sparkContext.broadcast((plan(hist, window), base))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        todo, base = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                who, out = [], [[], [], [], [], []]
                for i, (start, length, small, task, rank) in enumerate(zip(*(part[c].to_pylist() for c in ("start", "length", "small", "task", "rank")), strict=True)):
                    ids = np.frombuffer(small, "<u2" if len(small) == 2 * length else "<u4")
                    done = 0
                    for seq, off, n in todo.place(length, np.array([base[task, length] + rank]))[0]:
                        who.append(i)
                        for col, v in zip(out, (start + done, n, seq, off, ids[done : done + n].astype("<u4").tobytes()), strict=True):
                            col.append(v)
                        done += n
                at = pa.array(who, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"].take(at), *(pa.array(c, pa.int64()) for c in out[:2]), part["doc_tokens"].take(at), *(pa.array(c, pa.int64()) for c in out[2:4]), pa.array(out[4], pa.binary())],
                    names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
                )

    return rows.mapInArrow(lean(placed), f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")

