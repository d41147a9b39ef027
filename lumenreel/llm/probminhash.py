"""Near-duplicate classes by ProbMinHash.

A text's shingles (five consecutive words) are weighted by how often they occur. Each shingle is a
Poisson process, whose arrivals come at a rate of its weight and fall on registers; a register
keeps the shingle of its first arrival, and a shingle stops as soon as its next arrival is later
than every register's. Two texts agree in a register with the probability Jaccard similarity of
their weights. Bands of registers give candidates, and each candidate pair that is used is verified
on the sets of shingles.

Equal texts are one node from the start. In a band's bucket the nodes first meet a pivot; two orders
of the bands give two pivots. Their connected components are classes for the time being. Where a
bucket still has nodes of several classes, those outside its largest class meet all its others, in
blocks: so each pair that shares a band is compared or in one class already. A block is held as an
inverted index of its shingles, which all that meet it are counted against; its cost is that of the
shingles in common. A bucket of n texts in many classes (that share a passage, say) costs in
proportion to n * n, spread over places of about PLACE by PLACE nodes. Classes are the connected
components of the verified pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, discard, lean, stored
from .wordhash import MIX, encoded, mixed, runs, word_hashes

SHINGLE, BANDS, ROWS = 5, 20, 5
#: Nodes that meet a pivot, or a block of as many, at one place.
PLACE = 500
#: Shingles that are looked up in a block at once.
LOOKUP = 4096
_U = np.uint64


def shingle_hashes(text: bytes, n: int = SHINGLE) -> np.ndarray:
    """Hashes of all shingles; a text with fewer words than n has one, of all its words."""
    h = word_hashes(text)[2]
    return runs(h, min(n, len(h))) if len(h) else np.zeros(0, _U)


def signature(h: np.ndarray, w: np.ndarray, m: int) -> np.ndarray:
    """ProbMinHash of the distinct element hashes h with weights w > 0: the element in each of the
    m registers. Arrival k of an element depends on its hash and k only."""
    first, owner = np.full(m, np.inf), np.zeros(m, _U)
    active, now, k = np.arange(len(h)), np.zeros(len(h)), 0
    while len(active):
        # at first as many arrivals as fill all registers, mostly
        t = 1 + 6 * m // len(active) if k == 0 else 1 + 2 * m // len(active)
        e = h[active]
        r = mixed(e[:, None] + np.arange(k + 1, k + t + 1, dtype=_U) * MIX)
        gaps = -np.log(((r >> _U(32)).astype(np.float64) + 0.5) / (1 << 32))
        x = now[active][:, None] + np.cumsum(gaps, 1) / w[active][:, None]
        # the other half of the bits, so that every register can be met, however many there are
        reg = ((r & _U(0xFFFFFFFF)) * _U(m) >> _U(32)).astype(np.int64).ravel()
        flat = x.ravel()
        ok = np.flatnonzero(flat < first[reg])
        ok = ok[np.argsort(-flat[ok], kind="stable")]  # the earliest is written last
        first[reg[ok]] = flat[ok]
        owner[reg[ok]] = e[ok // t]
        now[active] = x[:, -1]
        k += t
        active = active[now[active] < first.max()]
    return owner


def bands(owners: np.ndarray, count: int = BANDS) -> np.ndarray:
    """For each row of registers a hash of each band, its number included."""
    z = owners.reshape(len(owners), count, -1)
    g = np.arange(1, count + 1, dtype=_U) * MIX
    for k in range(z.shape[2]):
        g = mixed(g ^ z[:, :, k]) * MIX
    return g.view(np.int64)


def _shingle_set(text: bytes, n: int = SHINGLE) -> set[bytes]:
    ws = text.split()
    if len(ws) < n:
        return {b" ".join(ws)} if ws else set()
    return {b" ".join(ws[k : k + n]) for k in range(len(ws) - n + 1)}


def jaccard(a: set, b: set) -> float:
    both = len(a & b)
    return both / max(1, len(a) + len(b) - both)


def _signed(docs: DataFrame, kind: str) -> DataFrame:
    """doc_id, node (digest of the text) and bands; only texts with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[bytes, np.ndarray] = {}
        for batch in batches:
            at, nodes, owners = [], [], []
            for i, t in enumerate(batch["text"]):
                text = encoded(t.as_py())
                node = hashlib.md5(text).digest()
                if node not in last:
                    g = shingle_hashes(text)
                    if not len(g):
                        continue
                    if len(last) > 10_000:
                        last.clear()
                    h, n = np.unique(g, return_counts=True)
                    last[node] = signature(h, 1 + np.log(n), BANDS * ROWS)
                at.append(i)
                nodes.append(node)
                owners.append(last[node])
            out = bands(np.stack(owners)) if owners else np.zeros((0, BANDS), np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1) * BANDS, pa.int32()), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"].take(pa.array(at, pa.int64())), pa.array(nodes, pa.binary()), lists], names=["doc_id", "node", "bands"])

    return docs.mapInArrow(lean(run), f"doc_id {kind}, node binary, bands array<long>")


def _verified(texts: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """pairs (pivot, node) with ``same``: whether their shingle sets are that similar. Each text
    (node, text) goes to the places where it is asked for; a place has a pivot and about PLACE nodes."""
    need = pairs.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / PLACE).cast("int").alias("places"))
    place = F.pmod(F.xxhash64("node"), F.col("places")).cast("int")
    members = pairs.join(need, "pivot").select("node", "pivot", place.alias("place"), F.lit(1).alias("role"))
    pivots = need.select(F.col("pivot").alias("node"), "pivot", F.explode(F.sequence(F.lit(0), F.col("places") - 1)).alias("place"), F.lit(0).alias("role"))
    wanted = members.unionByName(pivots).groupBy("node").agg(F.collect_list(F.struct("pivot", "place", "role")).alias("at"))
    met = texts.join(wanted, "node").select("node", "text", F.explode("at").alias("at")).select("at.pivot", "at.place", "at.role", "node", "text")
    spread = met.repartition("pivot", "place").sortWithinPartitions("pivot", "place", "role")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, ours = None, set()
        for batch in batches:
            out = [[], [], []]
            for pivot, place, role, node, text in zip(*(batch[c] for c in ("pivot", "place", "role", "node", "text")), strict=True):
                s, key = _shingle_set(encoded(text.as_py())), (pivot.as_py(), place.as_py())
                if role.as_py() == 0:
                    here, ours = key, s
                elif key == here:
                    for col, v in zip(out, (key[0], node.as_py(), jaccard(ours, s) >= threshold), strict=True):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.bool_())], names=["pivot", "node", "same"])

    return spread.mapInArrow(lean(compare), "pivot binary, node binary, same boolean").distinct()


def components(edges: DataFrame, most: int = 50) -> DataFrame:
    """node, root for the nodes of ``edges`` (a, b), by alternating large and small stars; root is
    the least node of the component. The table that it reads is the result's ``_stored_at``.

    The least neighbours are written before they are joined: both sides of the join then come straight from
    a shuffle, and AQE splits a star of very many edges."""
    e = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    before = None
    for _ in range(most):
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        large = stored(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "large")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(least, "u").where("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        old, e = e, stored(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
        discard(old, low, large, least)
        # xor, so that the order of rows doesn't count
        now = tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not converge")
    out = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    out._stored_at = e._stored_at
    return out


def _bucketed(rows: DataFrame) -> DataFrame:
    """(node, h, pivot) of rows (node, band, h) that share their bucket h with another node. Even
    bands take the least node of a bucket for its pivot, odd ones the greatest."""
    ends = rows.groupBy("h").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.min("band").alias("band")).where("low <> high")
    ends = ends.select("h", F.when(F.col("band") % 2 == 0, F.col("low")).otherwise(F.col("high")).alias("pivot"))
    return rows.join(ends, "h").where("node <> pivot").select("node", "h", "pivot")


def unmet(buckets: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, root, at), and the stored table that it reads, of the nodes in buckets (node, h) of several classes (roots: node, root);
    ``at`` lists places (h, i, j, holds, meets). The nodes outside a bucket's largest class are
    dealt to blocks i, all of its nodes to blocks j; at place (i, j) those of i are held and those
    of j meet them."""
    of = stored(buckets.join(roots, "node", "left").select("node", "h", F.coalesce("root", "node").alias("root")), "of")
    sizes = of.groupBy("h", "root").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy("h").agg(F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    blocks = lambda n: F.ceil(n / PLACE).cast("int")
    sizes = sizes.select("h", F.col("main.root").alias("main"), blocks(F.col("n") - F.col("main.n")).alias("few"), blocks(F.col("n")).alias("all"))
    dealt = of.join(sizes, "h").withColumn("open", F.col("root") != F.col("main"))
    dealt = dealt.withColumns({"i": F.pmod(F.xxhash64("node", F.lit("i")), "few").cast("int"), "j": F.pmod(F.xxhash64("node", F.lit("j")), "all").cast("int")})
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    place = lambda i, j: F.struct("h", i.alias("i"), j.alias("j"), (F.col("open") & (i == F.col("i"))).alias("holds"), (j == F.col("j")).alias("meets"))
    held = F.when(F.col("open"), F.transform(upto("all"), lambda j: place(F.col("i"), j))).otherwise(F.array())
    at = F.array_union(held, F.transform(upto("few"), lambda i: place(i, F.col("j"))))
    return dealt.select("node", "root", at.alias("at")).groupBy("node", "root").agg(F.flatten(F.collect_list("at")).alias("at")), of


class _Block:
    """Texts (root, text, shingle hashes) that others are counted against."""

    def __init__(self, held: list[tuple]) -> None:
        self.held = held
        self.size = np.array([len(g) for _, _, g in held])
        h = np.concatenate([g for _, _, g in held])
        order = np.argsort(h, kind="stable")
        self.h, self.owner = h[order], np.repeat(np.arange(len(held)), self.size)[order]

    def common(self, g: np.ndarray) -> np.ndarray:
        """How many of g each text of the block has."""
        found = np.zeros(len(self.held), np.int64)
        for k in range(0, len(g), LOOKUP):
            lo, hi = (np.searchsorted(self.h, g[k : k + LOOKUP], side) for side in ("left", "right"))
            n = hi - lo
            found += np.bincount(self.owner[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())], minlength=len(found))
        return found


def _joined(texts: DataFrame, unmet: DataFrame, threshold: float) -> DataFrame:
    """(a, b): classes with a pair of texts, held and met at a place, that are that similar. Hashes
    find the pairs, the sets of shingles verify them; two classes are joined once at a place."""
    met = texts.join(unmet, "node").select("root", "text", F.explode("at").alias("at")).select("at.*", "root", "text")
    spread = met.repartition("h", "i", "j").sortWithinPartitions("h", "i", "j", ~F.col("holds"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for h, i, j, holds, meets, root, text in zip(*(batch[c] for c in ("h", "i", "j", "holds", "meets", "root", "text")), strict=True):
                yield (h.as_py(), i.as_py(), j.as_py()), holds.as_py(), meets.as_py(), root.as_py(), encoded(text.as_py())

    def edges(block: _Block, root: bytes, text: bytes, g: np.ndarray, up: dict[bytes, bytes]) -> Iterator[tuple[bytes, bytes]]:
        def top(x: bytes) -> bytes:
            while x in up:
                x = up[x]
            return x

        both, mine = block.common(g), None
        for k in np.flatnonzero(both >= (threshold - 1e-9) * (len(g) + block.size - both)).tolist():
            other, their, _ = block.held[k]
            if top(root) != top(other):
                mine = mine or _shingle_set(text)
                if jaccard(mine, _shingle_set(their)) >= threshold:
                    up[top(root)] = top(other)
                    yield root, other

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, place in groupby(rows(batches), key=lambda r: r[0]):
            held, meet, block, out, up = [], [], None, [], {}
            for _, holds, meets, root, text in place:
                g = np.unique(shingle_hashes(text))
                if holds:
                    held.append((root, text, g))
                    if meets:
                        meet.append(held[-1])
                    continue
                block = block or _Block(held)
                out += edges(block, root, text, g, up)
            block = block or _Block(held)
            for one in meet:
                out += edges(block, *one, up)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*out, strict=True)], names=["a", "b"])

    return spread.mapInArrow(lean(compare), "a binary, b binary").distinct()


def _rooted(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The texts with words of docs (doc_id, text): (doc_id, node, bands) by row, and (node, rep,
    root) by text, with its least doc_id and its class."""
    bounded(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    signed = stored(_signed(docs, kind), "signed")
    nodes = signed.groupBy("node").agg(F.first("bands").alias("bands"), F.min("doc_id").alias("rep"))
    nodes = stored(nodes, "nodes")
    reps = nodes.select("node", F.coalesce(F.col("rep").cast("string"), F.lit("-")).alias("rep"))
    rows = nodes.select("node", F.posexplode("bands").alias("band", "h"))
    buckets = stored(_bucketed(rows), "buckets")
    # null ids are told apart from all others, so that the join needs no null-safe equality
    asked = buckets.select("node").unionByName(buckets.select(F.col("pivot").alias("node"))).distinct().join(reps, "node")
    texts = docs.where(F.col("text").isNotNull()).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")).alias("rep"), F.unhex(F.md5("text")).alias("node"), "text")
    texts = stored(texts.join(asked, ["node", "rep"]).select("node", "text"), "texts")
    done = _verified(texts, buckets.select("pivot", "node").distinct(), threshold)
    roots = components(done.where("same").select(F.col("pivot").alias("a"), F.col("node").alias("b")))
    rest, within = unmet(buckets, roots)
    rest = stored(rest, "unmet")
    links = components(_joined(texts, rest, threshold))
    wider = links.select(F.col("node").alias("root"), F.col("root").alias("top"))
    of = nodes.select("node", "rep").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    of = of.join(wider, "root", "left").withColumn("root", F.coalesce("top", "root")).drop("top")
    of = stored(of, "classes")
    discard(nodes, buckets, texts, within, rest, roots, links)
    return signed, of


def wordless(text: str) -> Column:
    """Whether a text, or null, has no words."""
    return F.col(text).isNull() | ~F.coalesce(F.col(text), F.lit("")).rlike("[^\\x20\\x09-\\x0D]")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.8) -> DataFrame:
    """One row per document: doc_id, class_id (the least doc_id of its class) and n_texts (different
    texts in its class).

    Texts without words, and null, are classes of their own, each row for itself (n_texts 0).
    Repeated rows and equal texts share a class; null ids come last among the ids; an empty table
    gives no rows; other columns are not read."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    signed, of = _rooted(docs, threshold)
    least = of.groupBy("root").agg(F.min("rep").alias("class_id"), F.count(F.lit(1)).alias("n_texts"))
    named = of.join(least, "root").select("node", "class_id", "n_texts")
    found = signed.select("doc_id", "node").join(named, "node").select("doc_id", "class_id", "n_texts")
    bare = docs.where(wordless("text"))
    return found.unionByName(bare.select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_texts")))


def survivors(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """One row per class of docs (doc_id, text) with words: node (digest of the text) and rep, of its
    text with the least doc_id (null last), and n, the rows that agree in both."""
    signed, of = _rooted(docs.select("doc_id", "text"), threshold)
    first = of.groupBy("root").agg(F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "node")).alias("least")).select("least.node", "least.rep")
    return signed.join(first, "node").where(F.col("doc_id").eqNullSafe(F.col("rep"))).groupBy("node", "rep").agg(F.count(F.lit(1)).alias("n"))
