"""Token counts with a whole-token shortcut.

For a BPE vocabulary in which no piece holds a white-space mark after another character, merges
never cross the boundary before a mark: a text's tokens are the tokens of its pre-tokens (a run of
marks and what follows up to the next mark). Offline, every vocabulary string of that shape is
encoded alone, and those that give exactly themselves are proven: a pre-token among them is one
token and is counted by look-up. Only the rest is merged by the library. Texts are independent of
each other: one pass, no shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import sentencepiece as spm
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded, lean

MARK = "▁"
#: Remembered counts of merged pre-tokens; the memory starts over beyond it.
MEMO = 400_000


def _fields(b: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a serialised message."""

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            x = b[at]
            out, at, shift = out | (x & 127) << shift, at + 1, shift + 7
            if x < 128:
                return out

    at = 0
    while at < len(b):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = varint() if key & 7 == 2 else {1: 8, 5: 4}[key & 7]
        yield key >> 3, b[at : at + size]
        at += size


def normaliser(model: bytes) -> dict[str, bool]:
    """What a model's own rules do to a text: the third field of a model, whose fields two to five are a
    table of replaced characters, a mark put in front, runs of blanks cut to one, marks for blanks."""
    rules = {"charsmap": False, "dummy_prefix": True, "remove_extra": True, "escape": True}  # the format's defaults
    for number, value in _fields(model):
        if number == 3:
            for k, v in _fields(value):
                if 2 <= k <= 5:
                    rules[list(rules)[k - 2]] = bool(v)
    return rules


class PieceCounter(dict):
    """pre-token (without its first mark) -> number of tokens."""

    def __init__(self, path: str):
        super().__init__()
        self.sp = spm.SentencePieceProcessor(model_file=path)
        self.proven = self._prove(Path(path).read_bytes())
        self.update(self.proven)

    def _prove(self, model: bytes) -> dict[str, int]:
        """The vocabulary strings that encode alone as one token, without their first mark.
        Raises if a piece lets merges cross a boundary, or if by the model's rules a text is changed before it is cut
        but for the marks of its blanks and the one put in front."""
        sp, found = self.sp, {}
        if normaliser(model) != {"charsmap": False, "dummy_prefix": True, "remove_extra": False, "escape": True}:
            raise ValueError("the model normalises texts; the shortcut isn't proven for it")
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if MARK in piece.lstrip(MARK):
                raise ValueError(f"piece {i} crosses a word boundary")
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or piece[:1] != MARK:
                continue
            if piece == MARK or sp.encode(piece[1:].replace(MARK, " ")) == [i]:
                found[piece[1:]] = 1
        return found

    def __missing__(self, rest: str) -> int:
        n = len(self.sp.encode(rest.replace(MARK, " ")))
        if rest == "":
            n = len(self.sp.encode("a ")) - len(self.sp.encode("a"))
        if len(self) - len(self.proven) >= MEMO:
            self.clear()
            self.update(self.proven)
        if len(rest) <= 100:
            self[rest] = n
        return n

    def count(self, text: str | None) -> int:
        """Tokens of a whole text, without begin and end."""
        if not text:
            return 0
        marked = text.replace(" ", MARK)
        if MARK + MARK not in marked and marked[0] != MARK and marked[-1] != MARK:
            parts = marked.split(MARK)
        else:
            parts = self._parts(MARK + marked)
        return sum(self[p] * n for p, n in Counter(parts).items()) if len(parts) > 200 else sum(map(self.__getitem__, parts))

    @staticmethod
    def _parts(marked: str) -> list[str]:
        """Pre-tokens without their first mark, where marks follow one another."""
        out, run = [], 0
        for p in marked.split(MARK)[1:]:
            if p == "":
                run += 1
            else:
                out.append(MARK * run + p)
                run = 0
        if run:
            out.append(MARK * (run - 1))
        return out


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = 4096) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit (columns of these names are replaced). Null
    counts as empty; repeated rows get equal counts; an empty table stays empty."""
    own = ("n_bytes", "n_tokens", "over_limit")
    bounded(docs.sparkSession)
    docs = docs.drop(*own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(path)
        for batch in batches:
            n = [counter.count(t.as_py()) for t in batch[text]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64())], names=[*batch.schema.names, "n_tokens"])

    counted = docs.mapInArrow(lean(run), T.StructType([*docs.schema.fields, T.StructField("n_tokens", T.LongType())]))
    return counted.withColumn("n_bytes", F.coalesce(F.octet_length(text), F.lit(0)).cast("long")).withColumn("over_limit", F.col("n_tokens") > limit)
