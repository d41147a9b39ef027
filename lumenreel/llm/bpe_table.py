"""BPE encoding and decoding through a distinct-word table.

A word is a run of characters without white space. The tokenizer neither merges nor composes
across white space, so a text's ids are its words' ids in order. Each distinct word is encoded
once and the ids come back by position. The table has two parts. The commonest words of a bounded
sample of the texts (``sample_docs`` documents; at most ``hot_words`` words and ``HOT_BYTES``) are
broadcast as flat arrays. All other words are split off in Spark with their place (key of the text,
number of the gap), dealt out and sorted by the word, encoded once for each distinct word, and joined
back to their gaps. What moves of a document are the numbers of its words in the table, with the
gaps, not its text; a frequent word meets no shuffle. Which part a word is in changes no result.

Decoding makes a row of each distinct id of some documents, joins it with the id-to-piece table
(broadcast: its size is the vocabulary's) and brings the pieces back by position where the documents
are, without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from .common import bounded, lean, slices
from .fast_bpe import WordEncoder
from .word_table import Found, WordTable

HOT_BYTES = 24 << 20
#: A task hands on its word counts at this many distinct words.
FLUSH_WORDS = 500_000
#: Bytes of text that are split into words at once.
SPLIT_BYTES = 1 << 20
#: Characters that Python's split() takes for white space and the tokenizer doesn't.
_CONTROL = re.compile("[\x1c-\x1f]")
_SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")


def words(text: str | None) -> list[str]:
    """The words of a text, in order; none for null."""
    if not text:
        return []
    return [w for w in _SPACE.split(text) if w] if _CONTROL.search(text) else text.split()


def load(path: str) -> Tokenizer:
    """The tokenizer of a file, without truncation and padding."""
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        b = pa.RecordBatch.from_pydict({"word": pa.array(seen.keys(), pa.large_string()).cast(pa.string()), "n": pa.array(seen.values(), pa.int64())})
        seen.clear()
        return b

    for batch in batches:
        for text in batch.column(0):
            seen.update(words(text.as_py()))
            if len(seen) >= FLUSH_WORDS:
                yield out()
    yield out()


def hot_table(docs: DataFrame, path: str, text: str = "text", sample_docs: int = 50_000, hot_words: int = 1 << 20) -> WordTable:
    """The commonest words of about ``sample_docs`` texts, chosen by a hash of the text, with their
    ids; at most ``hot_words`` words and HOT_BYTES of words and ids. A choice of what to broadcast, not
    of what to count."""
    bounded(docs.sparkSession)
    share = min(1.0, sample_docs / max(1, docs.count()))
    picked = docs.select(text).where(F.pmod(F.xxhash64(text), F.lit(1 << 20)) < share * (1 << 20))
    counts = picked.mapInArrow(lean(_count), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counts.where((F.col("n") > 1) & (F.length("word") <= 1024)).orderBy(F.desc("n"), "word").limit(hot_words)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = WordEncoder(path)
        for batch in batches:
            ids = enc.encode(batch["word"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["word"], batch["n"], pa.array(ids, pa.binary())], names=["word", "n", "ids"])

    got = top.repartition("word").mapInArrow(lean(encoded), "word string, n long, ids binary").toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    size = np.cumsum([len(w.encode()) + len(x) for w, x in zip(got["word"].to_pylist(), got["ids"].to_pylist(), strict=True)])
    got = got.slice(0, int(np.searchsorted(size, HOT_BYTES, "right")))
    return WordTable.of(got["word"].to_pylist(), got["ids"].to_pylist())


def _packed(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers below 2**28 in one to four bytes, seven bits in each; and where each starts."""
    n = 1 + (r >= 1 << 7) + (r >= 1 << 14) + (r >= 1 << 21)
    at = np.cumsum(n) - n
    out = np.zeros(int(n.sum()), np.uint8)
    for k in range(4):
        some = np.flatnonzero(n > k)
        out[at[some] + k] = (r[some] >> 7 * k & 127) | (n[some] > k + 1) * 128
    return out, at


def _unpacked(b: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The numbers, and where each starts."""
    a = np.frombuffer(b, np.uint8).astype(np.int64)
    ends = np.flatnonzero(a < 128) + 1
    at = np.append(0, ends)[:-1][: len(ends)]
    r, n = np.zeros(len(ends), np.int64), ends - at
    for k in range(4):
        some = np.flatnonzero(n > k)
        r[some] |= (a[at[some] + k] & 127) << 7 * k
    return r, at


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", sample_docs: int = 50_000, hot_words: int = 1 << 20) -> DataFrame:
    """One row per document: ``doc_id``, ``ids`` (array of int) and ``packed``, the ids as little-endian
    unsigned 32-bit integers.

    Null and empty texts get no ids; repeated rows each get their row; ties of word counts go by
    the word; an empty table gives no rows; other columns are not read. Texts are found again by 96
    bits of hashes; a gap that gets no ids, or two, raises."""
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    shared = spark.sparkContext.broadcast(hot_table(docs, path, "text", sample_docs, hot_words))
    keyed = docs.withColumns({"key": F.xxhash64("text"), "more": F.hash("text").cast("long")})

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The words that aren't in the broadcast table, with the number of their gap; of the texts of
        a batch each once."""
        for batch in batches:
            for part in slices(batch, "text", SPLIT_BYTES):
                once = list({t: i for i, t in enumerate(part["text"].to_pylist()) if t}.values())
                part = part.take(pa.array(once, pa.int64()))
                found = shared.value.look_up(part["text"].to_pylist())
                who = found.owners()
                # one number for the rest of the text's hash and the gap
                gap = (part["more"].to_numpy()[who] << 32) + np.arange(len(who)) - np.searchsorted(who, who)
                yield pa.RecordBatch.from_arrays([part["key"].take(pa.array(who)), pa.array(gap), pa.array(found.words, pa.string())], names=["key", "gap", "word"])

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by the word: each distinct word is encoded once, but for one at a batch's edge."""
        enc = WordEncoder(path)
        for batch in batches:
            coded = enc.encode(batch["word"].to_pylist())
            body, at = _packed(np.frombuffer(b"".join(coded), "<u4").astype(np.int64))
            edge = np.append(at, len(body))[np.cumsum([0, *(len(x) // 4 for x in coded)])].tolist()
            ids = [body[a:b].tobytes() for a, b in zip(edge, edge[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch["key"], batch["gap"], pa.array(ids, pa.binary())], names=["key", "gap", "ids"])

    asked = keyed.mapInArrow(lean(others), "key long, gap long, word string")
    table = asked.repartition("word").sortWithinPartitions("word").mapInArrow(lean(once), "key long, gap long, ids binary")
    # dealt out before they are gathered: partial lists would take more room than the rows
    got = table.repartition("key").groupBy("key").agg(F.sort_array(F.collect_set(F.struct("gap", "ids"))).alias("got"))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The numbers of the words, from 1; 0 for a gap."""
        for batch in batches:
            for part in slices(batch, "text", SPLIT_BYTES):
                found = shared.value.look_up(part["text"].to_pylist())
                body, at = _packed(found.k + 1)
                edge = np.append(at, len(body))[np.append(found.first, len(at))].tolist()
                out = [body[a:b].tobytes() for a, b in zip(edge, edge[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["key"], part["more"], pa.array(out, pa.binary())], names=["doc_id", "key", "more", "body"])

    def splice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body", SPLIT_BYTES // 4):
                bodies = part["body"].to_pylist()
                r, at = _unpacked(b"".join(bodies))
                first = np.searchsorted(at, np.cumsum([0, *map(len, bodies)])[:-1])
                found = Found(shared.value, r - 1, first, np.flatnonzero(r == 0), [])
                got = part["got"].flatten()
                mine = pc.fill_null(pc.list_value_length(part["got"]), 0).to_numpy(zero_copy_only=False)
                owner, gap = np.repeat(np.arange(part.num_rows), mine), got.field("gap").to_numpy()
                own = gap >> 32 == part["more"].to_numpy()[owner]  # another text may have the same key
                got, gap, mine = got.filter(pa.array(own)), gap[own] & 0xFFFFFFFF, np.bincount(owner[own], minlength=part.num_rows)
                want = np.bincount(found.owners(), minlength=part.num_rows)
                if (want != mine).any() or (gap != np.arange(len(gap)) - np.repeat(np.cumsum(mine) - mine, mine)).any():
                    raise ValueError("words of a text were lost")
                some = got.field("ids")
                rest, at = _unpacked(b"".join(some.to_pylist()))
                edge = np.searchsorted(at, np.append(0, np.cumsum(pc.binary_length(some).to_numpy())))
                ids, first, _ = found.ids(rest, np.diff(edge))
                ids, edge = ids.astype("<u4"), np.append(first, len(ids))
                lists = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(ids.view("<i4")))
                out = [ids[a:b].tobytes() for a, b in zip(edge.tolist(), edge[1:].tolist(), strict=False)]
                yield pa.RecordBatch.from_arrays([part["doc_id"], lists, pa.array(out, pa.binary())], names=["doc_id", "ids", "packed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    coded = keyed.mapInArrow(lean(code), f"doc_id {kind}, key long, more long, body binary")
    return coded.join(got, "key", "left").select("doc_id", "more", "body", "got").mapInArrow(lean(splice), f"doc_id {kind}, ids array<int>, packed binary")


def pieces(path: str) -> list[tuple[int, str]]:
    """The id-to-piece table; its size is the vocabulary's."""
    return sorted((i, p) for p, i in load(path).get_vocab(with_added_tokens=True).items())


def decode(encoded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``encoded`` with the column ``text`` (one of that name is replaced): what the library's decode()
    gives for the ids (array of int), special tokens kept. Without a decoder in the file that is the
    pieces joined by one space; with one, the decoder is applied to the pieces. Null and empty ids give
    an empty text; ids without a piece are left out, as by the library; repeated rows each get theirs."""
    spark = encoded.sparkSession
    bounded(spark)
    encoded = encoded.drop(text)
    vocabulary = spark.createDataFrame(pieces(path), "id int, piece string")
    plain, names = load(path).decoder is None, [*encoded.columns, text]
    fields = [T.StructField("row", encoded.schema), T.StructField("at", T.ArrayType(T.IntegerType())), T.StructField("due", T.IntegerType()), T.StructField("id", T.IntegerType())]

    def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For some documents a row each, with its columns and the places of its ids among the distinct
        ones, then a row for each distinct id. The first row says how many those are."""
        for batch in batches:
            for b in slices_of_lists(batch, ids, SPLIT_BYTES // 2):
                n = pc.fill_null(pc.list_value_length(b[ids]), 0).to_numpy(zero_copy_only=False)
                distinct, at = _distinct(b[ids].flatten().to_numpy(zero_copy_only=False))
                head, tail = b.num_rows, max(1, len(distinct))
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *n]), pa.int32()), pa.array(at, pa.int32()))
                docs = pa.array([*range(head), *[None] * tail], pa.int64())
                whole = pa.StructArray.from_arrays(b.columns, fields=list(b.schema))
                out = np.concatenate([np.full(head, -1), distinct if len(distinct) else [-1]])
                yield pa.RecordBatch.from_arrays([whole.take(docs), lists.take(docs), pa.array([tail, *[None] * (head + tail - 1)], pa.int32()), pa.array(out, pa.int32())], names=["row", "at", "due", "id"])

    met = encoded.mapInArrow(lean(exploded), T.StructType(fields)).join(F.broadcast(vocabulary), "id", "left").select("row", "at", "due", "piece")

    def closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The distinct pieces of some documents follow these; how many is checked."""
        decoder = load(path).decoder
        docs, lists, found, due = [], [], [], 0

        def texts() -> list[str]:
            piece = pa.concat_arrays(found)
            if plain and not piece.null_count:
                return pc.binary_join(pa.concat_arrays([pa.ListArray.from_arrays(x.offsets, piece.take(x.values)) for x in lists]), " ").to_pylist()
            out = []
            for x in lists:
                flat, ends = piece.take(x.flatten()).to_pylist(), np.cumsum([0, *pc.list_value_length(x).to_pylist()]).tolist()
                for a, b in zip(ends, ends[1:], strict=False):
                    some = [p for p in flat[a:b] if p is not None]
                    out.append(" ".join(some) if plain else decoder.decode(some))
            return out

        for batch in batches:
            is_doc = batch["at"].is_valid().to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(is_doc[1:] != is_doc[:-1]) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:], strict=False):
                if b <= a:
                    continue
                if is_doc[a]:
                    if found:
                        raise ValueError("the ids of some documents were parted from them")
                    docs.append(batch["row"].slice(a, b - a))
                    # of their own, without the rows before
                    lists.append(batch["at"].take(pa.array(range(a, b))))
                    due = next((x for x in batch["due"].slice(a, b - a).to_pylist() if x), due)
                    continue
                found.append(batch["piece"].slice(a, b - a))
                if sum(map(len, found)) == due:
                    yield pa.RecordBatch.from_arrays([*pa.concat_arrays(docs).flatten(), pa.array(texts(), pa.string())], names=names)
                    docs, lists, found = [], [], []
        if docs:
            raise ValueError("the ids of some documents were lost")

    return met.mapInArrow(lean(closed), T.StructType([*encoded.schema.fields, T.StructField(text, T.StringType())]))


def _distinct(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers, and the place of each among them."""
    if not len(flat) or flat.min() < 0 or flat.max() >= 1 << 22:
        return np.unique(flat, return_inverse=True)
    there = np.zeros(int(flat.max()) + 1, bool)
    there[flat] = True
    return np.flatnonzero(there), np.cumsum(there)[flat] - 1


def slices_of_lists(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows with about ``size`` items in a list column."""
    n = pc.fill_null(pc.list_value_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    at = [0, *(np.flatnonzero(np.diff(np.cumsum(n, dtype=np.int64) // size)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(at, at[1:], strict=False):
        if hi > lo:
            yield batch.slice(lo, hi - lo)
