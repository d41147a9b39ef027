"""Line dedup with a log-template tree.

A line is parsed at a fixed depth: by its number of tokens, then its leading tokens (or a wildcard for them); tokens that
are variable in themselves (numbers, addresses, assignments) are a wildcard from the start. Two kinds of
template recur and are dropped:

- whole ones, the tokens of a line in order, in ``min_docs`` different texts or more;
- general ones, whose other variable fields are learned. A line's tokens are cut into four quarters, and
  the line goes to a leaf for each two of them (PAIRS): those with the first quarter are behind its leading tokens,
  the others behind the wildcard. Where a leaf's lines are in ``min_docs`` different texts or more, they are a
  group: alike in half of their tokens at least. The places in the other two quarters are learned from its
  distinct lines: a token that ``AGREE`` of them share is literal, any other place is a
  wildcard. The group's template stands if at least ``LITERAL`` of its tokens are literal; the lines
  that agree with it in all of them are dropped. So any number of fields is found, at the start of a line too, that
  lie in two of its quarters and leave enough literal tokens.

Near copies of a text don't make its lines recur. Texts that are equal count once. A text that has less
than a quarter (OWN) of its shingles for itself counts by a signature instead: the least hash of the templates and groups that
recur in it, which near copies share but for the few in which they differ there. Its own shingles are estimated by
the words in quarters of lines that are in no template or group of ``min_docs`` texts, and OVER more for each run of such
quarters, as a changed word is in five shingles. (A family of m near copies that each lack a share q of these hashes has
about log m / log (1/q) signatures: seven for a million copies and a share of 0.15.) Its copies are left to
near-dedup, and its lines stay unless ``min_docs`` other texts have them.

Recurring lines are dropped, however short; only lines of fewer than ``BARE`` tokens that are all wildcards (a number,
say) are not counted, as they share no word. A leaf, a group and a template are rows of aggregates with partial
sums by task, so that none of them, however common, is gathered anywhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bitmaps import fitted, in_bitmap
from .common import bounded, discard, lean, stored
from .wordhash import MIX, U, encoded, mixed, word_hashes

#: Lines of fewer tokens need a literal one.
BARE = 4
#: Share of a group's distinct lines that a literal token stands in; of literal tokens in a template.
AGREE, LITERAL = 0.9, 0.7
#: The quarters of a line that make its groups; share of its shingles that a text needs for itself, and shingles over a run of words.
PAIRS, OWN, OVER = ((0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3)), 0.25, 4
#: Bytes of text that are parsed at once.
PART = 1 << 18
#: Up to so many whole templates, and tokens of general ones, are broadcast; more are joined.
BROADCAST = 1 << 20
#: Bytes that make a token a variable field: digits, and signs of addresses and assignments.
_FIELD = np.isin(np.arange(256), [*b"0123456789@=\\"])


class Lines:
    """Some texts, parsed. Of each line among all: ``n`` tokens, whether it is ``counted``, the hash of
    its ``whole`` template and of its ``groups``, by PAIRS (0 for none). ``bounds``: where each text's lines
    start and end among all. ``token``: 32 bits of each token, 0 for a wildcard."""

    def __init__(self, texts: list[bytes]) -> None:
        self.texts = texts
        whole_text = b"\n".join(texts)
        a = np.frombuffer(whole_text, np.uint8)
        broken = np.cumsum(a == 10, dtype=np.int32)
        lines = np.fromiter((t.count(b"\n") + 1 for t in texts), np.int64, len(texts))
        self.bounds = np.concatenate(([0], np.cumsum(lines)))
        total = int(self.bounds[-1])
        starts, ends, h = word_hashes(whole_text)
        self.whole, self.groups = np.zeros(total, U), np.zeros((len(PAIRS), total), U)
        self.n, self.first, self.token = np.zeros(total, np.int64), np.zeros(total, np.int64), np.zeros(0, np.uint32)
        self.counted = np.zeros(total, bool)
        if not len(h):
            return
        vary = np.cumsum(_FIELD[a], dtype=np.int32)
        h[vary[ends - 1] != vary[starts] - _FIELD[a[starts]]] = 0
        self.token = (h >> U(32)).astype(np.uint32)
        self.token[(h != 0) & (self.token == 0)] = 1
        line = broken[starts]
        self.n = np.bincount(line, minlength=total)
        self.first = np.cumsum(self.n) - self.n
        literal = np.bincount(line[h != 0], minlength=total)
        self.counted = (literal > 0) | (self.n >= BARE)
        place = np.arange(len(h)) - self.first[line]
        value = mixed(h + (place + 1).astype(U) * MIX)
        some = self.n > 0
        at, size = self.first[some], self.n[some].astype(U) * MIX

        def by_line(v: np.ndarray) -> np.ndarray:
            out = np.zeros(total, U)
            out[some] = np.add.reduceat(v, at)
            return out

        quarter = 4 * place // self.n[line]
        parts = [by_line(np.where(quarter == q, value, U(0))) for q in range(4)]
        length = np.zeros(total, U)
        length[some] = size
        self.whole[some] = mixed(sum(parts) + length)[some]
        self.groups = np.stack([mixed(parts[i] + parts[j] + length + U(1 + k)) for k, (i, j) in enumerate(PAIRS)])
        self.groups[:, (self.n < BARE) | ~self.counted] = 0

    def rest(self, kind: int, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens outside the two quarters of the lines, one after the other; how many each has)."""
        size = self.n[lines]
        before = np.cumsum(size) - size
        place = np.arange(size.sum()) - np.repeat(before, size)
        quarter = 4 * place // np.repeat(size, size)
        outside = np.flatnonzero((quarter != PAIRS[kind][0]) & (quarter != PAIRS[kind][1]))
        owner = np.repeat(np.arange(len(lines)), size)[outside]
        return self.first[lines][owner] + place[outside], np.bincount(owner, minlength=len(lines))

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.texts)), np.diff(self.bounds))


class Templates:
    """General templates: ``group`` hashes, sorted, and the tokens outside the block of each (0: wildcard)."""

    def __init__(self, groups: list[int], tokens: list[list[int | None]]) -> None:
        g = np.array(groups, np.int64).view(U)
        order = np.argsort(g)
        self.group = g[order]
        flat = [tokens[i] for i in order.tolist()]
        self.at = np.cumsum([0, *map(len, flat)])
        self.wild = np.array([t is None for ts in flat for t in ts], bool)
        self.token = np.array([t or 0 for ts in flat for t in ts], np.int64).astype(np.uint32)

    def fitting(self, lines: Lines) -> np.ndarray:
        """Which of the lines agree with the template of one of their groups."""
        out = np.zeros(len(lines.n), bool)
        if not len(self.group):
            return out
        for kind, group in enumerate(lines.groups):
            k = np.minimum(np.searchsorted(self.group, group), len(self.group) - 1)
            mine = np.flatnonzero((self.group[k] == group) & (group != 0))
            words, size = lines.rest(kind, mine)
            before = np.cumsum(size) - size
            theirs = np.repeat(self.at[k[mine]] - before, size) + np.arange(size.sum())
            unlike = ~self.wild[theirs] & (self.token[theirs] != lines.token[words])
            out[mine] |= np.bincount(np.repeat(np.arange(len(mine)), size), weights=unlike, minlength=len(mine)) == 0
        return out


def _parts(batch: pa.RecordBatch, text: str) -> Iterator[tuple[pa.RecordBatch, Lines]]:
    """A batch in parts of about PART bytes, so that few are held at once."""
    size = lo = 0
    some: list[bytes] = []
    for i, t in enumerate(batch[text]):
        some.append(encoded(t.as_py()))
        size += len(some[-1])
        if size >= PART:
            yield batch.slice(lo, i + 1 - lo), Lines(some)
            lo, size, some = i + 1, 0, []
    if some:
        yield batch.slice(lo), Lines(some)


def _content(texts: list[bytes]) -> np.ndarray:
    return np.fromiter((int.from_bytes(hashlib.blake2b(x, digest_size=8).digest()) for x in texts), U, len(texts))


def often(docs: DataFrame, min_docs: int) -> DataFrame:
    """h: the hashes of whole templates and of groups that are in ``min_docs`` different texts of
    ``docs`` (text) or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, lines in _parts(batch, "text"):
                content, use = _content(lines.texts), np.flatnonzero(lines.counted)
                h, d = np.concatenate([lines.whole[use], *lines.groups[:, use]]), np.tile(lines.owners()[use], 1 + len(PAIRS))
                h, d = h[h != 0], d[h != 0]
                order = np.lexsort((h, d))
                h, d = h[order], d[order]
                keep = np.concatenate(([True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])))[: len(h)]
                yield pa.RecordBatch.from_arrays([pa.array(h[keep].view(np.int64)), pa.array(content[d[keep]].view(np.int64))], names=["h", "content"])

    pairs = docs.select("text").mapInArrow(lean(run), "h long, content long").distinct()
    return pairs.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs).select("h")


def _seen(docs: DataFrame, found: DataFrame) -> DataFrame:
    """A row for each line and hash in ``found`` (h), or nearly: content, words (of the text), line, n (its words), h, whole and mask (its quarters, as bits); of a
    group also inside (literal tokens in its quarters) and rest (tokens outside)."""
    bits = docs.sparkSession.sparkContext.broadcast(fitted(found, "h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, lines in _parts(batch, "text"):
                content, owner = _content(lines.texts).view(np.int64), lines.owners()
                words = np.add.reduceat(lines.n, lines.bounds[:-1])
                literal = np.concatenate(([0], np.cumsum(lines.token != 0)))
                for kind, hashes in enumerate([lines.whole, *lines.groups]):
                    mine = np.flatnonzero(lines.counted & (hashes != 0) & in_bitmap(bits.value, hashes))
                    cols = [content[owner[mine]], words[owner[mine]], mine - lines.bounds[owner[mine]], lines.n[mine], hashes[mine].view(np.int64), lines.whole[mine].view(np.int64), np.full(len(mine), sum(1 << q for q in PAIRS[kind - 1]) if kind else 15)]
                    inside, rest = pa.nulls(len(mine), pa.int64()), pa.nulls(len(mine), pa.list_(pa.int64()))
                    if kind:
                        tokens, size = lines.rest(kind - 1, mine)
                        ends = np.concatenate(([0], np.cumsum(size)))
                        outside = np.concatenate(([0], np.cumsum(lines.token[tokens] != 0)))
                        inside = pa.array(literal[lines.first[mine] + lines.n[mine]] - literal[lines.first[mine]] - outside[ends[1:]] + outside[ends[:-1]])
                        rest = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(lines.token[tokens].astype(np.int64)))
                    yield pa.RecordBatch.from_arrays([*(pa.array(z.astype(np.int64)) for z in cols), inside, rest], names=["content", "words", "line", "n", "h", "whole", "mask", "inside", "rest"])

    return docs.select("text").mapInArrow(lean(run), "content long, words long, line long, n long, h long, whole long, mask long, inside long, rest array<long>")


def recurring(seen: DataFrame, found: DataFrame, min_docs: int) -> DataFrame:
    """h: those of ``found`` that texts with enough words of their own, and signatures of the others, have ``min_docs`` times or more."""
    hits = seen.select("content", "words", "line", "n", "h", "mask").join(found, "h", "left_semi")
    lines = hits.groupBy("content", "line").agg(F.first("words").alias("words"), F.first("n").alias("n"), F.bit_or("mask").alias("mask"), F.min(F.xxhash64("h")).alias("least"))
    upto = lambda q: F.ceil(q * F.col("n") / 4)
    free = lambda q: F.col("mask").bitwiseAND(F.lit(1 << q)) == 0
    begins = lambda q: free(q) & ~free(q - 1) if q else free(0)
    own = sum(F.when(free(q), upto(q + 1) - upto(q)).otherwise(0) + F.when(begins(q), OVER).otherwise(0) for q in range(4))
    texts = lines.groupBy("content").agg(F.first("words").alias("words"), (F.first("words") - F.sum("n") + F.sum(own)).alias("own"), F.min("least").alias("least"))
    own = F.col("own") >= OWN * F.greatest(F.lit(1), F.col("words") - OVER)
    named = texts.select("content", F.when(own, F.col("content")).otherwise(F.col("least")).alias("text"), own.alias("own"))
    pairs = hits.select("content", "h").distinct().join(named, "content").select("h", "text", "own").distinct()
    return pairs.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs).select("h")


def learned(seen: DataFrame, found: DataFrame) -> DataFrame:
    """group, tokens (null: wildcard): the general templates of the groups in ``found`` (h)."""
    first = [F.first(c).alias(c) for c in ("n", "inside", "rest")]  # the same in all rows
    groups = seen.where("rest IS NOT NULL").withColumnRenamed("h", "group")
    kinds = groups.groupBy("group", "whole").agg(*first).join(found.select(F.col("h").alias("group")), "group", "left_semi")
    at = kinds.select("group", "n", "inside", F.posexplode("rest").alias("at", "token"))
    counts = at.groupBy("group", "at", "token").agg(F.count(F.lit(1)).alias("c"), F.first("n").alias("n"), F.first("inside").alias("inside"))
    places = counts.groupBy("group", "at").agg(F.max(F.struct("c", "token")).alias("top"), F.sum("c").alias("all"), F.first("n").alias("n"), F.first("inside").alias("inside"))
    token = F.when(F.col("top.c") >= AGREE * F.col("all"), F.col("top.token"))
    whole = places.groupBy("group").agg(
        F.first("n").alias("n"),
        (F.first("inside") + F.count_if(token > 0)).alias("literal"),
        F.count_if(token.isNull()).alias("wild"),
        F.transform(F.sort_array(F.collect_list(F.struct("at", token.alias("token")))), lambda x: x["token"]).alias("tokens"),
    )
    return whole.where((F.col("wild") > 0) & (F.col("literal") >= LITERAL * F.col("n"))).select("group", "tokens")


def drop_recurring(docs: DataFrame, text: str = "text", min_docs: int = 10, broadcast: int = BROADCAST) -> DataFrame:
    """``docs`` with ``kept`` (the text without its recurring lines), n_lines and n_removed in place
    of columns of these names. A null text stays null, with no lines; an empty one has none either; blank
    lines and lines of fewer than ``BARE`` tokens without a literal one stay; a line that a document
    repeats counts once for it; repeated rows are one content, and near copies no more than a few; an empty table stays empty."""
    docs = docs.drop("kept", "n_lines", "n_removed")
    spark = docs.sparkSession
    bounded(spark)
    texts = docs.select(F.col(text).alias("text"))
    many = stored(often(texts, min_docs), "often")
    seen = stored(_seen(texts, many), "seen")
    found = stored(recurring(seen, many, min_docs), "recurring")
    general = stored(learned(seen, found), "templates")
    discard(many, seen)
    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    row = T.StructField("row", docs.schema)
    shape = T.StructType([row, T.StructField("kept", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())])
    tokens = general.agg(F.coalesce(F.sum(F.size("tokens")), F.lit(0))).first()[0]
    if found.count() <= broadcast and tokens <= broadcast:
        got = general.toArrow()
        gone = spark.sparkContext.broadcast((np.sort(found.toArrow()["h"].to_numpy().view(U)), Templates(got["group"].to_pylist(), got["tokens"].to_pylist())))
        discard(found, general)
        out = rows.mapInArrow(lean(lambda batches: _cleaned(batches, lambda lines, _: _gone(lines, *gone.value))), shape)
        return out.select("row.*", "kept", "n_lines", "n_removed")

    sets = spark.sparkContext.broadcast((fitted(found, "h"), fitted(general, "group")))

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The hashes of each text that seem to be in either table."""
        whole, groups = sets.value
        for batch in batches:
            for _, lines in _parts(batch, "text"):
                h, d = np.concatenate([lines.whole, *lines.groups]), np.tile(lines.owners(), 1 + len(PAIRS))
                mine = np.flatnonzero((h != 0) & (in_bitmap(whole, h) | in_bitmap(groups, h)))
                keys = [hashlib.md5(t).digest() for t in lines.texts]
                yield pa.RecordBatch.from_arrays([pa.array([keys[i] for i in d[mine].tolist()], pa.binary()), pa.array(h[mine].view(np.int64))], names=["key", "h"])

    hashes = texts.mapInArrow(lean(asked), "key binary, h long").distinct()
    hits = hashes.join(found, "h").select("key", "h", F.lit(None).cast("array<long>").alias("tokens"))
    hits = hits.unionByName(hashes.join(general.withColumnRenamed("group", "h"), "h"))
    gone = hits.groupBy("key").agg(F.collect_list(F.struct("h", "tokens")).alias("gone"))
    joined = rows.withColumn("key", F.unhex(F.md5(F.coalesce("text", F.lit(""))))).join(gone, "key", "left").select("row", "text", "gone")

    def each(lines: Lines, part: pa.RecordBatch) -> np.ndarray:
        out = np.zeros(len(lines.n), bool)
        for i, mine in enumerate(part["gone"].to_pylist()):
            if mine:
                one = Lines([lines.texts[i]])
                whole = np.sort(np.array([x["h"] for x in mine if x["tokens"] is None], np.int64).view(U))
                some = [x for x in mine if x["tokens"] is not None]
                out[lines.bounds[i] : lines.bounds[i + 1]] = _gone(one, whole, Templates([x["h"] for x in some], [x["tokens"] for x in some]))
        return out

    return joined.mapInArrow(lean(partial(_cleaned, gone=each)), shape).select("row.*", "kept", "n_lines", "n_removed")


def _gone(lines: Lines, whole: np.ndarray, templates: Templates) -> np.ndarray:
    """Which lines go; ``whole`` is sorted (it holds groups as well, which no line's template equals)."""
    out = templates.fitting(lines)
    if len(whole):
        out |= whole[np.minimum(np.searchsorted(whole, lines.whole), len(whole) - 1)] == lines.whole
    return out & lines.counted


def _cleaned(batches: Iterator[pa.RecordBatch], gone) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, lines in _parts(batch, "text"):
            out, bounds = gone(lines, part), lines.bounds
            removed = np.add.reduceat(out.astype(np.int64), bounds[:-1])
            kept = part["text"].to_pylist()
            for i in np.flatnonzero(removed).tolist():
                kept[i] = "\n".join([x for x, z in zip(kept[i].split("\n"), out[bounds[i] : bounds[i + 1]].tolist(), strict=True) if not z])
            total = np.where(np.fromiter(map(len, lines.texts), np.int64, len(lines.texts)) > 0, np.diff(bounds), 0)
            yield pa.RecordBatch.from_arrays([part["row"], pa.array(kept, pa.string()), pa.array(total, pa.int64()), pa.array(removed, pa.int64())], names=["row", "kept", "n_lines", "n_removed"])
