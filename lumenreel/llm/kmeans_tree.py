"""Approximate nearest neighbours in a hierarchical k-means tree.

The tree is fitted on a bounded sample: spherical seeds, Lloyd steps, and a further split of every
cell that holds more than its share; it has about as many leaves as the square root of the number of
rows. Every row is then indexed: it goes down to the nearest child at each level. A query goes through
the tree best bin first: a priority queue holds the branches not yet taken, the one with the best
bound of its inner product in front. How many leaves a query visits is calibrated: for a bounded set
of sample queries the exact neighbours are found against all rows, and the visits are widened until
``recall`` is reached.

Neighbouring leaves lie together in groves of about ``block`` rows (eight groves at least); one that
holds more, because of a leaf with a third of all rows say, is cut into parts by a hash. A part is held and meets
the queries, a batch at a time, that visit its leaves, compares each with the rows of these leaves, and hands on
the k best for each. So what is merged grows with the queries and the groves that they visit.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, discard, lean, stored


@dataclass
class Node:
    """``center``: mean of the sample below; ``radius``: how far its vectors lie from it (a high
    quantile of the sample); ``leaf``: number of the leaf, -1 inside the tree."""

    center: np.ndarray
    radius: float
    leaf: int = -1
    children: list[Node] = field(default_factory=list)


@dataclass
class Tree:
    root: Node
    leaves: int

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row: the nearest child at every level."""
        out = np.zeros(len(x), np.int32)

        def down(node: Node, at: np.ndarray) -> None:
            if node.leaf >= 0:
                out[at] = node.leaf
                return
            c = np.array([n.center for n in node.children])
            near = (2 * x[at] @ c.T - (c * c).sum(1)).argmax(1)
            for k, n in enumerate(node.children):
                if (mine := at[near == k]).size:
                    down(n, mine)

        down(self.root, np.arange(len(x)))
        return out

    def visits(self, q: np.ndarray, most: int | None = None) -> list[int]:
        """Leaves in the order of a best-bin-first traversal for the query, at most ``most``."""
        size, order = float(np.linalg.norm(q)), []
        heap = [(0.0, 0, self.root)]
        tie = 1
        while heap and (most is None or len(order) < most):
            _, _, node = heapq.heappop(heap)
            if node.leaf >= 0:
                order.append(node.leaf)
                continue
            bounds = np.array([n.center for n in node.children]) @ q
            for n, b in zip(node.children, bounds.tolist(), strict=True):
                heapq.heappush(heap, (-(b + 0.5 * size * n.radius), tie, n))
                tie += 1
        return order


def fit(x: np.ndarray, leaves: int, branching: int = 16, seed: int = 7) -> Tree:
    """A tree of about ``leaves`` leaves over the sample ``x``."""
    rng = np.random.default_rng(seed)
    made = [0]

    def grow(rows: np.ndarray, budget: int) -> Node:
        center = rows.mean(0) if len(rows) else np.zeros(x.shape[1])
        far = np.linalg.norm(rows - center, axis=1) if len(rows) else np.zeros(1)
        node = Node(center, float(np.quantile(far, 0.9)))
        k = min(branching, budget, len(np.unique(rows, axis=0)) if len(rows) < 4 * branching else branching)
        if k < 2:
            node.leaf = made[0]
            made[0] += 1
            return node
        c = rows[rng.choice(len(rows), k, replace=False)].copy()
        for _ in range(8):
            near = (2 * rows @ c.T - (c * c).sum(1)).argmax(1)
            n = np.bincount(near, minlength=k)
            for j in range(k):
                c[j] = rows[near == j].mean(0) if n[j] else rows[rng.integers(len(rows))]
        near = (2 * rows @ c.T - (c * c).sum(1)).argmax(1)
        parts = [rows[near == j] for j in range(k)]
        parts = [p for p in parts if len(p)]
        if len(parts) < 2:
            node.leaf = made[0]
            made[0] += 1
            return node
        node.children = [grow(p, max(1, round(budget * len(p) / len(rows)))) for p in parts]
        return node

    root = grow(x, leaves)
    return Tree(root, made[0])


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of the rows of q and the columns of x, summed dimension by dimension in double
    precision, in the same order for every pair, so that equal vectors get equal scores everywhere."""
    s = np.zeros((len(q), x.shape[1]))
    for d in range(x.shape[0]):
        s += q[:, d : d + 1] * x[d]
    return s


def best(ids: np.ndarray, x: np.ndarray, leaf: np.ndarray, qid: np.ndarray, q: np.ndarray, asked: list[np.ndarray], k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its k best rows in the leaves ``asked``, rows with its id left out: (position
    of the query, ids, scores); ties go to the smaller id."""
    order = np.lexsort((ids, leaf))
    ids, leaf, x = ids[order], leaf[order], np.ascontiguousarray(x[order].T, dtype=np.float64)
    starts = np.flatnonzero(np.diff(leaf, prepend=-1))
    edges = np.append(starts, len(leaf))
    for lo in range(0, len(q), 64):
        part = q[lo : lo + 64].astype(np.float64)
        s = np.full((len(part), len(ids)), -np.inf)
        who = np.repeat(np.arange(len(part)), [len(z) for z in asked[lo : lo + 64]])
        wanted = np.concatenate([*asked[lo : lo + 64], np.zeros(0, np.int64)])
        for one, a, b in zip(leaf[starts].tolist(), edges, edges[1:], strict=False):
            mine = who[wanted == one]
            if len(mine):
                s[mine, a:b] = _scores(part[mine], x[:, a:b])
        for i in range(len(part)):
            row = s[i]
            row[ids == qid[lo + i]] = -np.inf
            cut = np.partition(row, len(row) - k)[len(row) - k] if len(row) > k else -np.inf
            near = np.flatnonzero((row >= cut) & (row > -np.inf))
            top = near[np.lexsort((ids[near], -row[near]))[:k]]
            yield lo + i, ids[top], row[top]


#: Bytes of vectors that a part holds at once, about; half as much again where groves are uneven.
PART_BYTES = 64 << 20


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id, v (doubles): rows whose vector is not null, not empty, not zero and finite."""
    v = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    bad = lambda a: a.isNull() | F.isnan(a) | (F.abs(a) == float("inf"))
    return v.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", bad) & F.exists("v", lambda a: a != 0))


def _matrix(a: pa.Array) -> np.ndarray:
    flat = a.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(a), -1) if len(a) else np.zeros((0, 0))


def search(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    recall: float = 0.94,
    sample: int = 20_000,
    most_sample: int = 400_000,
    calibrate: int = 128,
    block: int = 50_000,
) -> DataFrame:
    """For each row whose id is divisible by ``every`` its k nearest other rows by inner product:
    query_id, rank, vec_id, score; nearest first, ties to the smaller id.

    Null, empty, zero and non-finite vectors take no part. Vectors are compared with those of their
    own length. Rows that repeat an id are candidates each, but never for their own id; the query of
    an id is its shortest and then least vector. With fewer candidates than k all are returned; an
    empty table gives no rows; other columns are not read. Bounds: a tree is fitted on ``sample`` rows,
    or eight for each leaf if that is more, at most ``most_sample``; ``calibrate`` queries calibrate it."""
    spark = vectors.sparkSession
    bounded(spark)
    rows = stored(usable(vectors, vec_id, embedding).withColumn("dim", F.size("v")), "vectors")
    sizes = {r["dim"]: r["count"] for r in rows.groupBy("dim").count().collect()}
    asks = rows.where(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id").agg(F.min(F.struct("dim", "v")).alias("q")).select("vec_id", "q.dim", "q.v")
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for dim, total in sorted(sizes.items()):
        mine = [df.where(F.col("dim") == dim).drop("dim") for df in (rows, asks)]
        out = out.unionByName(_search(*mine, total, k, recall, sample, most_sample, calibrate, min(block, max(1, PART_BYTES // (8 * dim)))))
    discard(rows)  # what is asked and indexed has been stored
    return out


def _search(rows: DataFrame, asks: DataFrame, total: int, k: int, recall: float, sample: int, most_sample: int, calibrate: int, block: int) -> DataFrame:
    spark = rows.sparkSession
    leaves = max(1, min(math.isqrt(total), most_sample // 8))
    share = min(1.0, max(sample, 8 * leaves) / total)
    picked = rows.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 30)) < int(share * (1 << 30))).select("v").toArrow()
    x = _matrix(picked["v"].combine_chunks()) if picked.num_rows else _matrix(rows.select("v").limit(1).toArrow()["v"].combine_chunks())
    tree = fit(x, leaves)
    shared = spark.sparkContext.broadcast(tree)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = shared.value.assign(_matrix(b["v"])) if b.num_rows else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([b["vec_id"], b["v"], pa.array(leaf, pa.int32())], names=["vec_id", "v", "leaf"])

    indexed = stored(rows.mapInArrow(lean(index), "vec_id long, v array<double>, leaf int"), "indexed")
    asks = stored(asks, "asks")
    most = _calibrated(indexed, asks, tree, k, recall, calibrate)
    per_leaf = np.zeros(tree.leaves, np.int64)
    for r in indexed.groupBy("leaf").count().collect():
        per_leaf[r["leaf"]] = r["count"]
    room = max(1, math.ceil(total / max(8, math.ceil(total / block))))
    grove = ((np.cumsum(per_leaf) - per_leaf) // room).astype(np.int32)
    held = np.bincount(grove, weights=per_leaf)
    parts = np.maximum(1, np.ceil(held / (2 * room))).astype(np.int64)
    plan = spark.sparkContext.broadcast((tree, most, grove, parts))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The grove and the part of each row."""
        _, _, grove, parts = plan.value
        for b in batches:
            g = grove[b["leaf"].to_numpy()]
            part = (b["h"].to_numpy().view(np.uint64) % parts[g].astype(np.uint64)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(g, pa.int32()), pa.array(part), b["vec_id"], b["v"], b["leaf"]], names=["grove", "part", "vec_id", "v", "leaf"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A query goes to the parts of each grove that it visits, with its leaves there."""
        tree, most, grove, parts = plan.value
        for b in batches:
            who, at, part, seen = [], [], [], []
            for i, q in enumerate(_matrix(b["v"])):
                found = np.sort(np.array(tree.visits(q, most), np.int32))
                for g, mine in zip(*_split(grove[found], found), strict=True):
                    for p in range(parts[g]):
                        who.append(i)
                        at.append(g)
                        part.append(p)
                        seen.append(mine)
            take = pa.array(who, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), pa.array(part, pa.int32()), b["vec_id"].take(take), b["v"].take(take), pa.array(seen, pa.list_(pa.int32()))],
                names=["grove", "part", "vec_id", "v", "seen"],
            )

    hashed = indexed.withColumn("h", F.xxhash64("vec_id", "v"))
    mine = hashed.mapInArrow(lean(placed), "grove int, part int, vec_id long, v array<double>, leaf int")
    theirs = asks.select("vec_id", "v").mapInArrow(lean(visit), "grove int, part int, vec_id long, v array<double>, seen array<int>")
    both = mine.unionByName(theirs, allowMissingColumns=True)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A part's rows come first and are held; its queries pass them, a batch at a time."""
        key, held = None, []
        for b in batches:
            grove, part, asks = b["grove"].to_numpy(), b["part"].to_numpy(), b["seen"].is_valid().to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero((np.diff(grove) != 0) | (np.diff(part) != 0) | (np.diff(asks) != 0)) + 1).tolist(), len(grove)]
            for lo, hi in zip(edges, edges[1:], strict=False):
                if hi == lo:
                    continue
                if (grove[lo], part[lo]) != key:
                    key, held = (grove[lo], part[lo]), []
                some = b.slice(lo, hi - lo)
                if not asks[lo]:
                    held.append((some["vec_id"].to_numpy(), _matrix(some["v"]), some["leaf"].to_numpy().astype(np.int64)))
                elif held:
                    held = [tuple(np.concatenate(z) for z in zip(*held, strict=True))] if len(held) > 1 else held
                    qid = some["vec_id"].to_numpy()
                    found = best(*held[0], qid, _matrix(some["v"]), [np.asarray(x) for x in some["seen"].to_pylist()], k)
                    got = [(np.full(len(i), qid[at]), i, s) for at, i, s in found]
                    if got:
                        cols = [np.concatenate(z) for z in zip(*got, strict=True)]
                        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())], names=["query_id", "vec_id", "score"])

    met = both.repartition("grove", "part").sortWithinPartitions("grove", "part", F.col("seen").isNotNull())
    near = met.mapInArrow(lean(meet), "query_id long, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _split(key: np.ndarray, values: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Runs of equal keys: (keys, the values of each)."""
    at = np.flatnonzero(np.diff(key)) + 1
    return [int(key[i]) for i in [0, *at]] if len(key) else [], np.split(values, at) if len(key) else []


def _calibrated(indexed: DataFrame, asks: DataFrame, tree: Tree, k: int, recall: float, calibrate: int) -> int:
    """Leaves to visit. For at most ``calibrate`` queries the exact neighbours are found among all
    rows, task by task; then visits are doubled, and halved back, until the share asked for lies
    in the leaves visited."""
    chosen = asks.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(calibrate).toArrow()
    qid, q = chosen["vec_id"].to_numpy(), _matrix(chosen["v"].combine_chunks()) if chosen.num_rows else np.zeros((0, 0))
    if not len(qid):
        return 1
    shared = asks.sparkSession.sparkContext.broadcast((qid, q))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The k best of the task's rows for each query, with their leaves."""
        qid, q = shared.value
        kept: dict[int, list[tuple[float, int, int]]] = {i: [] for i in range(len(qid))}
        for b in batches:
            x, leaf = _matrix(b["v"]), b["leaf"].to_numpy()
            place = np.arange(len(x)) if len(x) else np.zeros(0, int)
            ids = b["vec_id"].to_numpy()
            s = q @ x.T if len(x) else np.zeros((len(q), 0))
            for i in range(len(q)):
                own = place[ids != qid[i]]
                top = own[np.argpartition(-s[i, own], k)[:k]] if len(own) > k else own
                kept[i] = sorted([*kept[i], *((-float(s[i, j]), int(ids[j]), int(leaf[j])) for j in top)])[:k]
        flat = [(i, -s, v, leaf) for i, z in kept.items() for s, v, leaf in z]
        cols = list(zip(*flat, strict=True)) if flat else [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int32())], names=["q", "score", "vec_id", "leaf"])

    w = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    near = indexed.mapInArrow(lean(exact), "q int, score double, vec_id long, leaf int").withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).select("q", "leaf").toPandas()
    depth = []
    for i, found in near.groupby("q")["leaf"]:
        place = {leaf: n for n, leaf in enumerate(tree.visits(q[i]))}
        depth += [place[x] + 1 for x in found]
    depth = np.sort(np.array(depth)) if depth else np.array([1])
    most = 1
    while most < tree.leaves and (depth <= most).mean() < recall:
        most *= 2
    low = most // 2
    while most - low > 1:
        mid = (low + most) // 2
        low, most = (low, mid) if (depth <= mid).mean() >= recall else (mid, most)
    return min(most, tree.leaves)
