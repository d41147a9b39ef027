"""Byte-pair merges of many words in lockstep.

The words of a batch are rows of a matrix of symbols; in every step each row merges its pair of
least rank (the first of equals), until no row has a pair that merges. That is the order of the
tokenizers library, without its cost for each call. It serves files whose steps it knows: NFC,
white space to a blank, lower case; a splitting pattern whose matches are kept; bytes as
characters; BPE with an end-of-word suffix. For any other file, and for words that hold a special
token or are very long, the library itself encodes the word.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import regex
from tokenizers import Tokenizer

#: Longest pre-token, in bytes, that is merged here.
LONGEST = 48
NONE = np.int32(2**31 - 1)


def _byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable, else one above 255."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class WordEncoder:
    """Ids of words, as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        with open(path, encoding="utf-8") as f:
            self.known = self._understood(json.load(f))

    def _understood(self, spec: dict) -> bool:
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        kinds = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        steps = pre.get("pretokenizers", [])
        suffix = model.get("end_of_word_suffix")
        if not (
            kinds == ["NFC", "Replace", "Lowercase"]
            and [x["type"] for x in steps] == ["Split", "ByteLevel"]
            and steps[0]["behavior"] == "Removed"
            and steps[0]["invert"]
            and not steps[1]["add_prefix_space"]
            and not steps[1]["use_regex"]
            and model["type"] == "BPE"
            and suffix
            and not model.get("dropout")
            and not model.get("continuing_subword_prefix")
            and not model.get("ignore_merges")
        ):
            return False
        vocab, chars = model["vocab"], _byte_characters()
        if not all(c in vocab and c + suffix in vocab for c in chars):
            return False
        self.special = [x["content"] for x in spec.get("added_tokens", [])]
        self.pattern = regex.compile(steps[0]["pattern"]["Regex"])
        self.inner = np.array([vocab[c] for c in chars], np.int32)
        self.last = np.array([vocab[c + suffix] for c in chars], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        return True

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a.astype(np.int64) << 32) | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.ranks[at], NONE)

    def merge(self, some: list[bytes]) -> list[bytes]:
        """Ids of pre-tokens, given as UTF-8 of at most LONGEST bytes."""
        out: list[bytes] = [b""] * len(some)
        size = np.fromiter(map(len, some), np.int64, len(some))
        order = np.argsort(size, kind="stable")
        for lo in range(0, len(some), 4096):
            rows = order[lo : lo + 4096]
            width = int(size[rows].max())
            x = np.full((len(rows), width + 1), -1, np.int32)
            flat = np.frombuffer(b"".join([some[i] for i in rows]), np.uint8)
            n = size[rows]
            inside = np.arange(width + 1) < n[:, None]
            x[inside] = self.inner[flat]
            x[np.arange(len(rows)), n - 1] = self.last[flat[np.cumsum(n) - 1]]
            r = np.full(x.shape, NONE, np.int32)
            r[:, :-1] = self._rank(x[:, :-1], x[:, 1:])
            done, live = x, np.arange(len(rows))
            x = x.copy()
            places = np.arange(width + 1)
            while len(live):
                p = r.argmin(1)
                i = np.arange(len(live))
                best = r[i, p]
                on = best < NONE
                if not on.all():
                    done[live[~on]] = x[~on]
                    live, x, r, p, best = live[on], x[on], r[on], p[on], best[on]
                    i = np.arange(len(live))
                    if not len(live):
                        break
                x[i, p] = self.made[best]
                src = np.minimum(places + (places > p[:, None]), width)
                x, r = np.take_along_axis(x, src, 1), np.take_along_axis(r, src, 1)
                x[:, -1], r[:, -1] = -1, NONE
                r[i, p] = self._rank(x[i, p], x[i, np.minimum(p + 1, width)])
                before = np.flatnonzero(p > 0)
                q = p[before] - 1
                r[before, q] = self._rank(x[before, q], x[before, q + 1])
            keep = done >= 0
            n = keep.sum(1)
            whole, at = done[keep].astype("<u4").tobytes(), 0
            for row, k in zip(rows.tolist(), n.tolist(), strict=True):
                out[row] = whole[at : at + 4 * k]
                at += 4 * k
        return out

    def _library(self, word: str) -> bytes:
        return np.array(self.tok.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, words: list[str]) -> list[bytes]:
        """Ids of each word; a word that is repeated, and a pre-token, is encoded once."""
        distinct = dict.fromkeys(words)
        if not self.known:
            return list(map({w: self._library(w) for w in distinct}.get, words))
        split, found = {}, {}
        for w in distinct:
            if "<" in w and any(s in w for s in self.special):
                found[w] = self._library(w)
                continue
            t = w if w.isascii() else unicodedata.normalize("NFC", w).replace("Σ", "σ")
            split[w] = self.pattern.findall(t.lower())
        todo = list(dict.fromkeys(p for ps in split.values() for p in ps))
        coded = [p.encode() for p in todo]
        short = [k for k, c in enumerate(coded) if len(c) <= LONGEST]
        parts = {todo[k]: ids for k, ids in zip(short, self.merge([coded[k] for k in short]), strict=True)}
        for p, c in zip(todo, coded, strict=True):
            if len(c) > LONGEST:
                parts[p] = self._library(p)
        for w, ps in split.items():
            found[w] = parts[ps[0]] if len(ps) == 1 else b"".join([parts[p] for p in ps])
        return list(map(found.__getitem__, words))
