"""Distinct words and their ids in flat arrays, looked up for all words of some texts at once.

A word of at most SHORT bytes is told by its first eight bytes, its last eight and its length, so that
a look-up compares the whole word; longer ones are in a dictionary. The slots are an open-addressing
hash table, probed in lockstep.
"""

from __future__ import annotations

import re

import numpy as np
import zstandard

from .wordhash import MIX, U, mixed, spans

SHORT = 16
#: White space of the tokenizer beyond ASCII.
_WIDE = re.compile("[\x85\xa0  -     　]")
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)] + [(1 << 64) - 1] * (SHORT - 8), U)
_PAD = bytes(8)


def joined(texts: list[str | None]) -> tuple[bytes, np.ndarray]:
    """The texts as UTF-8, one after the other and parted by line ends, with all white space of the
    tokenizer in ASCII; and where each one starts."""
    coded = [(t if t.isascii() else _WIDE.sub(" ", t)).encode() if t else b"" for t in texts]
    size = np.fromiter(map(len, coded), np.int64, len(coded)) + 1
    return b"\n".join(coded), np.cumsum(size) - size


def _keys(b: bytes, starts: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last bytes and the hash of words of at most SHORT bytes."""
    eight = np.ndarray((len(b) + 9,), "<u8", _PAD + b + _PAD, 0, (1,))
    first = eight[starts + 8] & _MASK[n]
    last = np.where(n > 8, eight[starts + n], U(0))
    return first, last, mixed(first * MIX ^ mixed(last + n.astype(U)))


class WordTable:
    """Ids of distinct words: ``flat``, the words parted by line ends; ``ids`` one after the other, and
    how many (``n``) each word has. It is pickled as these, compressed, and built anew where it goes."""

    def __init__(self, flat: bytes, ids: np.ndarray, n: np.ndarray) -> None:
        self.ids = ids.astype("<u2") if not len(ids) or ids.max() < 65536 else ids.astype("<u4")
        self.flat, self.n = flat, n.astype(np.uint16)
        self.at = (np.cumsum(n, dtype=np.int64) - n).astype(np.int32)
        starts, ends = spans(flat)
        size = ends - starts
        few = np.flatnonzero(size <= SHORT)
        self.long = {flat[starts[i] : ends[i]]: i for i in np.flatnonzero(size > SHORT).tolist()}
        self.first, self.last, h = _keys(flat, starts[few], size[few])
        self.size, self.of = size[few].astype(np.int8), few.astype(np.int32)
        bits = max(4, (2 * len(few)).bit_length())
        self.shift = U(64 - bits)
        self.slots = np.full(1 << bits, -1, np.int32)
        todo, at = np.arange(len(few)), (h >> self.shift).astype(np.int64)
        while len(todo):
            free = self.slots[at] < 0
            self.slots[at[free]] = todo[free]  # of those that want a slot the last gets it
            lost = self.slots[at] != todo
            todo, at = todo[lost], (at[lost] + 1) & (len(self.slots) - 1)

    @classmethod
    def of(cls, words: list[str], ids: list[bytes]) -> WordTable:
        """Of words (distinct, without white space) and their ids, little-endian unsigned 32-bit."""
        return cls("\n".join(words).encode(), np.frombuffer(b"".join(ids), "<u4"), np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids)))

    def __reduce__(self) -> tuple:
        pack = zstandard.ZstdCompressor(level=9).compress
        return _unpickled, (pack(self.flat), pack(self.ids.tobytes()), self.ids.dtype.str, pack(self.n.tobytes()))

    def find(self, b: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of each word in the table, -1 if it isn't there."""
        size = ends - starts
        out = np.full(len(starts), -1, np.int64)
        todo = np.flatnonzero(size <= SHORT)
        first, last, h = _keys(b, starts[todo], size[todo])
        n, at = size[todo], (h >> self.shift).astype(np.int64)
        while len(todo):
            k = self.slots[at]
            some = k >= 0
            if not some.all():
                todo, first, last, n, at, k = (x[some] for x in (todo, first, last, n, at, k))
            same = (self.first[k] == first) & (self.last[k] == last) & (self.size[k] == n)
            out[todo[same]] = self.of[k[same]]
            other = ~same
            todo, first, last, n, at = (x[other] for x in (todo, first, last, n, at))
            at = (at + 1) & (len(self.slots) - 1)
        if self.long:
            for i in np.flatnonzero(size > SHORT).tolist():
                out[i] = self.long.get(b[starts[i] : ends[i]], -1)
        return out

    def look_up(self, texts: list[str | None]) -> Found:
        b, at = joined(texts)
        starts, ends = spans(b)
        k = self.find(b, starts, ends) if len(starts) else np.zeros(0, np.int64)
        missing = np.flatnonzero(k < 0)
        words = [b[s:e].decode() for s, e in zip(starts[missing].tolist(), ends[missing].tolist(), strict=True)]
        return Found(self, k, np.searchsorted(starts, at), missing, words)


def _unpickled(flat: bytes, ids: bytes, kind: str, n: bytes) -> WordTable:
    unpack = zstandard.ZstdDecompressor().decompress
    return WordTable(unpack(flat), np.frombuffer(unpack(ids), kind), np.frombuffer(unpack(n), np.uint16))


class Found:
    """The words of some texts: ``k``, the number in the table of each; ``first``, the first word of
    each text; ``missing``, which words the table lacks, and ``words``, their strings."""

    def __init__(self, table: WordTable, k: np.ndarray, first: np.ndarray, missing: np.ndarray, words: list[str]) -> None:
        self.table, self.k, self.first, self.missing, self.words = table, k, first, missing, words

    def owners(self) -> np.ndarray:
        """The text of each missing word."""
        return np.searchsorted(self.first, self.missing, "right") - 1

    def ids(self, others: np.ndarray | None = None, each: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids one after the other, where each text's start, where each missing word's belong).
        ``others``: ids of the missing words, ``each``: how many each has; without them they are left out."""
        t = self.table
        n = np.where(self.k >= 0, t.n[self.k] if len(t.n) else 0, 0).astype(np.int64)
        src = np.where(self.k >= 0, t.at[self.k] if len(t.at) else 0, 0).astype(np.int64)
        flat = t.ids
        if others is not None:
            n[self.missing] = each
            src[self.missing] = len(flat) + np.cumsum(each) - each
            flat = np.concatenate([flat, others.astype(flat.dtype) if not len(others) or others.max() < 1 << 8 * flat.itemsize else others])
        before = np.cumsum(n) - n
        out = flat[np.repeat(src - before, n) + np.arange(n.sum())]
        ends = np.append(before, n.sum())
        return out, ends[self.first], before[self.missing]
