"""Hashes of all words of a text at once: one pass of array operations over its bytes.

A word is a run of other bytes than the six ASCII spaces. Its hash is a polynomial over its bytes
modulo 2**64, taken from prefix sums, then mixed. The hashes choose and group; what they find is
compared word for word wherever equality counts.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
MIX = U(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Powers are kept for texts of up to so many bytes; for a longer one they are made for the call.
KEPT = 1 << 18
_powers: list[np.ndarray] = []


def _powers_of(n: int) -> list[np.ndarray]:
    out = []
    for base in (_BASE, _INVERSE):
        p = np.full(n + 1, base, U)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out


def _tables(n: int) -> list[np.ndarray]:
    """The powers up to n of the base and of its inverse."""
    if n > KEPT:
        return _powers_of(n)
    if not _powers:
        _powers.extend(_powers_of(KEPT))
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def encoded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def spans(b: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words start and end."""
    a = np.frombuffer(b, np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate(([True], _SPACE[a], [True]))))
    return edge[::2], edge[1::2]


def word_hashes(b: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes) of the words."""
    a = np.frombuffer(b, np.uint8)
    starts, ends = spans(b)
    power, inverse = _tables(len(a))
    total = np.zeros(len(a) + 1, U)
    np.cumsum((a.astype(U) + U(1)) * power[: len(a)], out=total[1:])
    return starts, ends, mixed((total[ends] - total[starts]) * inverse[starts])


def runs(h: np.ndarray, m: int) -> np.ndarray:
    """Hashes of all runs of m consecutive words."""
    n = max(0, len(h) - m + 1)
    g = np.full(n, m, U)
    for k in range(m):
        g = (g ^ h[k : n + k]) * MIX
        g ^= g >> U(29)
    return g
