"""Exact Jaccard join of documents on word shingles, as a blocked sparse matrix product.

Rows of the matrix are the distinct shingle sets (nodes), columns are shingles. Of the product of the
matrix with its transpose only the entries that can reach the threshold are wanted, which bounds
derived from the sizes say: two sets link only if the smaller has 9/10 of the larger's size, and then
they share a column among each one's first n // 10 + 1 in any fixed order of the columns. The order is
rare columns first: those that HOT documents or more have (a bitmap of them is broadcast) come last,
ties by hash. Whether a column is in the bitmap changes the order for all sets alike, and so no result.

Of these leading columns the product is made column by column. A column with at most HOT nodes gives
its pairs; their overlap counts are summed, and pairs are discarded whose sum and remaining columns can't
reach the threshold. In larger columns (passages, groups of copies) all nodes meet the column's least and
greatest; what is linked then is one class, and where a column still has several, its
nodes are dealt to blocks of about PLACE, and blocks are multiplied with blocks, except for pairs within the
largest class: first over the leading columns only, where the same bounds discard pairs, each pair in
the least large column that it shares. The pairs that are left are counted over all their columns. In a product of blocks
one side is held as an inverted index, which the other's rows are counted against.

Shingles are 64-bit hashes throughout. Classes are the connected components of the links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bitmaps import fitted, in_bitmap, leading
from .common import bounded, discard, lean, slices, stored
from .probminhash import PLACE, components, unmet
from .wordhash import encoded, runs, word_hashes

SHINGLE = 3
#: Documents that make a column hot, and nodes of a column whose pairs are given one by one.
HOT = 20
#: Columns are counted whose hash is in the first COUNTED sixteenths: no other is among the first of many sets.
COUNTED = 3
#: Bytes of text that are hashed at once, and shingles that are looked up at once.
CHUNK, LOOKUP = 1 << 17, 4096
_U = np.uint64


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted hashes of each text's distinct shingles; fewer words than SHINGLE are one shingle."""
    b = b"\n".join(texts).lower()
    starts, _, h = word_hashes(b)
    edges = np.cumsum([0] + [len(t) + 1 for t in texts])
    owner = np.searchsorted(edges, starts, "right") - 1
    g, at = runs(h, SHINGLE), owner[: max(0, len(h) - SHINGLE + 1)]
    whole = at == owner[SHINGLE - 1 :] if len(g) else np.zeros(0, bool)
    parts, owners = [g[whole]], [at[whole]]
    first, count = np.unique(owner, return_index=True)[1], np.bincount(owner, minlength=len(texts))
    count = count[count > 0]
    for m in range(1, SHINGLE):
        few = first[count == m]
        if len(few):
            parts.append(runs(h, m)[few])
            owners.append(owner[few])
    g, at = np.concatenate(parts), np.concatenate(owners)
    order = np.lexsort((g, at))
    g, at = g[order], at[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (at[1:] != at[:-1])
    g, at = g[new], at[new]
    return np.split(g, np.searchsorted(at, np.arange(1, len(texts))))


def leading_columns(n: int) -> int:
    return n // 10 + 1


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for part in slices(batch, "text", CHUNK):
            yield part, shingle_sets([encoded(t) for t in part["text"].to_pylist()])


def _lists(found: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(x) for x in found])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*found, np.zeros(0, _U)]).view(np.int64)))


def _sketched(docs: DataFrame, kind: str) -> DataFrame:
    """doc_id, tid (digest of the text), node, n and low, the least hashes: all counted ones, and twice the leading columns at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit = _U(COUNTED) << _U(60)
        for part, sets in _texts(batches):
            low = [g[: max(2 * leading_columns(len(g)) + 8, int(np.searchsorted(g, limit)))] for g in sets]
            nodes = [hashlib.md5(g.tobytes()).digest() for g in sets]
            yield pa.RecordBatch.from_arrays([part["doc_id"], part["tid"], pa.array(nodes, pa.binary()), pa.array([len(g) for g in sets], pa.int64()), _lists(low)], names=["doc_id", "tid", "node", "n", "low"])

    return docs.mapInArrow(lean(run), f"doc_id {kind}, tid binary, node binary, n long, low array<long>")


def _leading(sets: DataFrame, hot, shared) -> DataFrame:
    """node, n, tid, keys (the leading columns that other sets may have), loose (how many of these aren't known to be in less than
    HOT sets), of sets (node, n, tid, low); keys is null where low doesn't reach so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hots, shares, limit = hot.value, shared.value, _U(COUNTED) << _U(60)
        for batch in batches:
            keys, loose = [], []
            for n, low in zip(batch["n"].to_pylist(), batch["low"], strict=True):
                g, p = low.values.to_numpy().view(_U), leading_columns(n)
                counted = g < limit
                is_hot = counted & in_bitmap(hots, g)
                cold = np.flatnonzero(~is_hot)[:p]
                if len(cold) < p and len(g) < n:
                    keys.append(None)
                    loose.append(0)
                    continue
                take = np.concatenate((cold, np.flatnonzero(is_hot)[: p - len(cold)]))
                take = take[~counted[take] | in_bitmap(shares, g[take])]
                keys.append(g[take].view(np.int64).tolist())
                loose.append(int((~counted[take] | is_hot[take]).sum()))
            yield pa.RecordBatch.from_arrays([batch["node"], batch["n"], batch["tid"], pa.array(keys, pa.list_(pa.int64())), pa.array(loose, pa.int64())], names=["node", "n", "tid", "keys", "loose"])

    return sets.select("node", "n", "tid", "low").mapInArrow(lean(run), "node binary, n long, tid binary, keys array<long>, loose long")


def _sets(docs: DataFrame, wanted, column: str) -> DataFrame:
    """node, n, g (all hashes) of the texts of docs (text, tid) whose digest ``column`` (tid or node) is in the
    bitmap ``wanted``, or seems to be; each node once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        asked = lambda found: in_bitmap(bits, np.array([int.from_bytes(x[:8], "big") for x in found], _U))
        for batch in batches:
            if column == "tid":
                batch = batch.filter(pa.array(asked(batch["tid"].to_pylist())))
            for _, sets in _texts([batch]):
                nodes = [hashlib.md5(g.tobytes()).digest() for g in sets]
                took = [k for k in range(len(sets)) if len(sets[k])] if column == "tid" else np.flatnonzero(asked(nodes)).tolist()
                yield pa.RecordBatch.from_arrays([pa.array([nodes[k] for k in took], pa.binary()), pa.array([len(sets[k]) for k in took], pa.int64()), pa.array([sets[k].tobytes() for k in took], pa.binary())], names=["node", "n", "g"])

    return docs.select("tid", "text").mapInArrow(lean(run), "node binary, n long, g binary").groupBy("node").agg(F.first("n").alias("n"), F.first("g").alias("g"))


def _cold_pairs(rows: DataFrame) -> DataFrame:
    """(a, b) that small columns give and the bounds don't exclude; rows: h, node, n, loose."""
    held = rows.groupBy("h").agg(F.array_sort(F.collect_list(F.struct("node", "n", "loose"))).alias("m"))
    pair = F.transform("m", lambda x, i: F.transform(F.slice("m", i + 2, HOT), lambda y: F.struct(x.alias("x"), y.alias("y"))))
    met = held.select(F.explode(F.flatten(pair)).alias("p")).select("p.*").where("10 * least(x.n, y.n) >= 9 * greatest(x.n, y.n)")
    summed = met.groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b")).agg(F.count(F.lit(1)).alias("c"), F.first("x.n").alias("m"), F.first("y.n").alias("n"), F.first(F.least("x.loose", "y.loose")).alias("loose"))
    return summed.where("19 * (c + loose + greatest(m - m div 10 - 1, n - n div 10 - 1)) >= 9 * (m + n)").select("a", "b")


class _Block:
    """Rows of hashes as an inverted index."""

    def __init__(self, held: list[np.ndarray]) -> None:
        self.size = np.array([len(g) for g in held])
        h = np.concatenate(held)
        order = np.argsort(h, kind="stable")
        self.h, self.owner = h[order], np.repeat(np.arange(len(held)), self.size)[order]

    def common(self, g: np.ndarray) -> np.ndarray:
        """How many of g each has: the row of g times the block."""
        found = np.zeros(len(self.size), np.int64)
        for k in range(0, len(g), LOOKUP):
            lo, hi = (np.searchsorted(self.h, g[k : k + LOOKUP], side) for side in ("left", "right"))
            n = hi - lo
            found += np.bincount(self.owner[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())], minlength=len(found))
        return found


def _at_places(rows: DataFrame) -> DataFrame:
    return rows.repartition("h", "i", "j").sortWithinPartitions("h", "i", "j", ~F.col("holds"))


def _by_place(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[tuple, list[tuple], Iterator[tuple]]]:
    """(place, the rows it holds, those that meet them), a row being (whether held, *columns). What is held
    comes first, and of it what meets the others as well comes last."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for h, i, j, holds, meets, *rest in zip(*(batch[c].to_pylist() for c in ("h", "i", "j", "holds", "meets", *columns)), strict=True):
                yield (h, i, j), holds, meets, rest

    for place, some in groupby(rows(), key=lambda r: r[0]):
        held, first, both = [], None, []
        for r in some:
            if not r[1]:
                first = r
                break
            held.append(r[3])
            both += [(True, *r[3])] * r[2]
        meeting = chain(((False, *first[3]),) if first else (), ((False, *r[3]) for r in some), both)
        if held:
            yield place, held, meeting


def _sieved(keyed: DataFrame, at: DataFrame) -> DataFrame:
    """The rows of ``at`` (node, root, h, i, j, holds, meets) with a pair at their place that the bounds don't
    exclude over the leading columns; keyed: node, n, keys, big (its large columns). A pair counts in the least large column of both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (h, i, j), held, meeting in _by_place(batches, "node", "root", "n", "keys", "big"):
            block, sizes = _Block([np.array(keys, np.int64) for _, _, _, keys, _ in held]), np.array([r[2] for r in held])
            roots, rest, bigs = np.array([r[1] for r in held], object), sizes - sizes // 10 - 1, [set(r[4]) for r in held]
            out = {}
            for own, node, root, n, keys, big in meeting:
                most = block.common(np.array(keys, np.int64)) + np.maximum(rest, n - n // 10 - 1)
                fit = (19 * most >= 9 * (n + sizes)) & (10 * np.minimum(n, sizes) >= 9 * np.maximum(n, sizes)) & (roots != root)
                mine = set(big)
                left = [k for k in np.flatnonzero(fit).tolist() if min(mine & bigs[k]) == h]
                if left:
                    out[node] = [root, own or (node in out and out[node][1]), True]
                    for k in left:
                        other = out.setdefault(held[k][0], [held[k][1], True, False])
                        other[1] = True
            if out:
                n = len(out)
                cols = [list(out), [v[0] for v in out.values()], [h] * n, [i] * n, [j] * n, [v[1] for v in out.values()], [v[2] for v in out.values()]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()], strict=True)], names=["node", "root", "h", "i", "j", "holds", "meets"])

    met = at.join(keyed, "node").select("h", F.col("i").cast("long"), F.col("j").cast("long"), "holds", "meets", "node", "root", "n", "keys", "big")
    return _at_places(met).mapInArrow(lean(run), "node binary, root binary, h long, i long, j long, holds boolean, meets boolean")


def _multiplied(sets: DataFrame, at: DataFrame) -> DataFrame:
    """(a, b): roots of linked sets; at: node, root, h, i, j, holds, meets. At place (h, i, j) the sets that
    it holds are a block, and those that meet them its other factor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held, meeting in _by_place(batches, "root", "g"):
            block, roots, out, up = _Block([np.frombuffer(g, _U) for _, g in held]), [r for r, _ in held], [], {}

            def top(x: bytes, up: dict[bytes, bytes]) -> bytes:
                while x in up:
                    x = up[x]
                return x

            for _, root, g in meeting:
                both, n = block.common(np.frombuffer(g, _U)), len(g) // 8
                for k in np.flatnonzero(100 * both >= 90 * (n + block.size - both)).tolist():
                    x, y = top(root, up), top(roots[k], up)
                    if x != y:
                        up[x] = y
                        out.append((root, roots[k]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*out, strict=True)], names=["a", "b"])

    met = at.join(sets, "node").select("h", "i", "j", "holds", "meets", "root", "g")
    return _at_places(met).mapInArrow(lean(run), "a binary, b binary").distinct()


def _places(pairs: DataFrame) -> DataFrame:
    """Places for pairs (a, b): a is held, about PLACE of its partners meet it."""
    need = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PLACE).cast("int").alias("places"))
    place = lambda i, node, holds: [node.alias("node"), node.alias("root"), F.xxhash64("a").alias("h"), i.alias("i"), F.xxhash64(F.lit(1), "a").alias("j"), F.lit(holds).alias("holds"), F.lit(not holds).alias("meets")]
    meets = pairs.join(need, "a").select(place(F.pmod(F.xxhash64("b"), "places").cast("int"), F.col("b"), False))
    holds = need.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("places") - 1))).select(place(F.col("k"), F.col("a"), True))
    return meets.unionByName(holds)


def _linked(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, root) of the nodes in links, stored; rows: as _sketched gives them, with words."""
    sc = docs.sparkSession.sparkContext
    counted = rows.select(F.explode("low").alias("h")).where(F.shiftrightunsigned("h", 60) < COUNTED)
    shared = stored(counted.groupBy("h").count().where("count > 1"), "shared")
    hot, more = (sc.broadcast(fitted(x, "h")) for x in (shared.where(F.col("count") >= HOT), shared))
    first = [F.first(c).alias(c) for c in ("n", "tid", "keys", "loose")]
    keyed = stored(_leading(rows, hot, more).groupBy("node").agg(*first), "keyed")
    far = keyed.where("keys IS NULL")
    tables = [shared, keyed]
    if not far.isEmpty():  # these need all their columns
        whole = stored(_sets(docs, sc.broadcast(fitted(far.select(leading("tid").alias("h")), "h")), "tid"), "whole")
        full = whole.join(far.select("node", "tid"), "node").mapInArrow(_unpacked, "node binary, n long, tid binary, low array<long>")
        further = stored(_leading(full, hot, more), "keyed")
        keyed = keyed.where("keys IS NOT NULL").unionByName(further)
        tables += [whole, further]
    columns = stored(keyed.select("node", "n", "loose", F.explode("keys").alias("h")), "columns")
    sizes = columns.groupBy("h").agg(F.count(F.lit(1)).alias("k"), F.min("node").alias("low"), F.max("node").alias("high")).where("k > 1")
    dealt = stored(columns.join(sizes, "h"), "dealt")
    big = dealt.where(F.col("k") > HOT)
    # columns with the same nodes give the same pairs
    alike = big.groupBy("h").agg(F.bit_xor(F.xxhash64("node")).alias("s"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("t"))
    big = stored(big.join(alike.groupBy("s", "t").agg(F.min("h").alias("h")).select("h"), "h"), "big")
    poles = big.select("node", F.explode(F.array("low", "high")).alias("pole"), "n").where("node <> pole").select(F.col("pole").alias("a"), F.col("node").alias("b"))
    pairs = stored(_cold_pairs(dealt.where(F.col("k") <= HOT).select("h", "node", "n", "loose")).unionByName(poles).distinct(), "pairs")
    near_sets = lambda asked: stored(_sets(docs, sc.broadcast(fitted(asked.select(leading("node").alias("h")), "h")), "node"), "sets")
    sets = near_sets(pairs.select(F.explode(F.array("a", "b")).alias("node")))
    near = components(_multiplied(sets, _places(pairs)))
    rest, within = unmet(big.select("node", "h"), near)
    rest = rest.select("node", "root", F.explode("at").alias("at")).select("node", "root", "at.*")
    large = keyed.join(big.groupBy("node").agg(F.collect_list("h").alias("big")), "node").select("node", "n", "keys", "big")
    rest = stored(_sieved(large, rest), "sieved")
    more_sets = near_sets(rest.select("node"))
    wider = components(_multiplied(more_sets, rest))
    up = wider.select(F.col("node").alias("root"), F.col("root").alias("top"))
    both = near.select("node", "root").unionByName(wider.select("node", F.col("node").alias("root"))).distinct()
    both = both.groupBy("node").agg(F.min("root").alias("root")).join(up, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    out = stored(both, "linked")
    discard(*tables, columns, dealt, big, pairs, sets, near, within, rest, more_sets, wider)
    return out


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch["node"], batch["n"], batch["tid"], _lists([np.frombuffer(g, _U) for g in batch["g"].to_pylist()])], names=["node", "n", "tid", "low"])


def linked_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles and component_id, the least doc_id that links lead to (null last).

    Texts without words, and null, have no shingles and are linked with nothing, each row for itself. Equal
    sets are linked; repeated rows share a class. An empty table gives no rows; other columns are not read."""
    bounded(docs.sparkSession)
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.withColumn("tid", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    rows = stored(_sketched(docs, kind), "rows")
    worded = rows.where("n > 0")
    roots = _linked(docs, worded)
    least = worded.groupBy("node").agg(F.min("doc_id").alias("least"))
    of = stored(least.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "of")
    classes = stored(of.groupBy("root").agg(F.min("least").alias("component_id")), "classes")
    named = stored(of.join(classes, "root").select("node", "component_id"), "named")
    discard(roots, of, classes)
    found = worded.select("doc_id", "n", "node").join(named, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return found.unionByName(rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
