"""Vectorised words, shingles and lines of a slice of texts (numpy, inside tasks).

A slice is one byte array plus row offsets. Words are maximal runs of bytes
other than space and 0x09-0x0D, which equals the same rule on code points.
Word hashes are polynomial prefix hashes modulo 2^64 over secret byte weights
with a final mix; two different words collide with a chance near 2^-60.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_P = np.uint64(0xD6E8FEB86659FD93)
_POWERS: dict[str, np.ndarray] = {}

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (two xor-shift-multiply rounds)."""
    x = x ^ (x >> np.uint64(32))
    x = x * _P
    x = x ^ (x >> np.uint64(29))
    x = x * _ODD
    return x ^ (x >> np.uint64(32))


def _weights() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * _ODD)


def lower_table() -> np.ndarray:
    """Byte table that lower-cases A-Z only."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def line_table() -> np.ndarray:
    """Byte table of line normalisation: lower-case A-Z, every digit as 0."""
    t = lower_table()
    t[48:58] = 48
    return t


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, 1 << 20)
        up = np.full(size, _P, np.uint64)
        up[0] = 1
        down = np.full(size, np.uint64(pow(int(_P), -1, 1 << 64)), np.uint64)
        down[0] = 1
        with np.errstate(over="ignore"):
            _POWERS["up"], _POWERS["down"] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _POWERS["up"], _POWERS["down"]


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums S with S[j] - S[i] the position-weighted sum of values i..j-1."""
    up, _ = _powers(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=out[1:])
    return out


def span_hash(s: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the value spans [starts, ends), independent of where they lie."""
    _, down = _powers(len(s))
    return mix((s[ends] - s[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _ODD)


@dataclass
class Words:
    buf: np.ndarray        # the bytes, after the byte table
    starts: np.ndarray     # word spans
    ends: np.ndarray
    first: np.ndarray      # row i has the words first[i] .. first[i + 1] - 1
    hashes: np.ndarray

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(buf: np.ndarray, offs: np.ndarray, table: np.ndarray | None = None) -> Words:
    """Words of every row, hashed after ``table`` is applied to the bytes."""
    if table is not None:
        buf = table[buf]
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return Words(buf, z, z, np.zeros(len(offs), np.int64), np.zeros(0, np.uint64))
    inside = ~SPACE[buf]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    cut = offs[:-1][offs[:-1] < n]
    begin[cut] = inside[cut]
    finish = inside.copy()
    finish[:-1] &= ~inside[1:]
    cut = offs[1:][offs[1:] > 0] - 1
    finish[cut] = inside[cut]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    with np.errstate(over="ignore"):
        h = span_hash(prefix(_weights()[buf]), starts, ends)
    return Words(buf, starts, ends, np.searchsorted(starts, offs), h)


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, row starts) of every row's consecutive ``size``-word shingles, repeats included.

    A row with fewer words (but at least one) has its whole sequence as one shingle.
    """
    n = np.diff(w.first)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    at = np.zeros(len(count) + 1, np.int64)
    np.cumsum(count, out=at[1:])
    if at[-1] == 0:
        return np.zeros(0, np.uint64), at
    pos = np.arange(at[-1]) - np.repeat(at[:-1] - w.first[:-1], count)
    length = np.repeat(np.minimum(n, size), count)
    with np.errstate(over="ignore"):
        out = span_hash(prefix(w.hashes), pos, pos + length)
    return out, at


def distinct_sets(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of every row, and their row starts."""
    parts = [np.unique(h[a:b]) for a, b in zip(at[:-1], at[1:])]
    out = np.zeros(len(at), np.int64)
    np.cumsum([len(p) for p in parts], out=out[1:])
    return (np.concatenate(parts) if parts else h[:0]), out


def repeated_within_rows(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """For every value: whether it occurs at least twice in its row."""
    if len(h) == 0:
        return np.zeros(0, bool)
    with np.errstate(over="ignore"):
        key = mix(h ^ mix(row.astype(np.uint64) + _ODD))
    _, back, count = np.unique(key, return_inverse=True, return_counts=True)
    return count[back] > 1


def lines(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of the \\n-separated lines of every row (an empty row has none)."""
    nl = np.flatnonzero(buf == 10)
    lo = offs[:-1][np.diff(offs) > 0]
    starts = np.union1d(lo, nl + 1)
    # a line may start at a row's end (after its last newline): it belongs to that row and is empty
    row_last = np.isin(nl + 1, offs[1:])
    if row_last.any():
        starts = np.setdiff1d(starts, np.setdiff1d((nl + 1)[row_last], lo))
    ends = np.minimum(np.append(nl, len(buf))[np.searchsorted(nl, starts)],
                      offs[1:][np.searchsorted(offs, starts, side="right") - 1] if len(starts) else starts)
    return starts, ends, np.searchsorted(offs, starts, side="right") - 1
