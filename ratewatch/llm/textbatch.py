"""Vectorised text handling inside tasks: Arrow string columns to byte buffers, words, hashes.

A batch of texts is one uint8 buffer plus row offsets; words, word hashes and shingle hashes come
from whole-buffer numpy passes, so no Python loop runs per word or per character.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
#: White space that parts words: 0x20 and 0x09-0x0D.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Odd base of the polynomial word hash and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Odd multipliers that tell the places in a word n-gram apart.
PLACE = [U(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                        0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i <= n, kept for the worker's lifetime."""
    if not _powers or len(_powers[0]) <= n:
        m = max(1 << 20, 1 << (n + 1).bit_length())
        _powers[:] = []
        for b in (BASE, INVERSE):
            steps = np.full(m, U(b))
            steps[0] = 1
            _powers.append(np.cumprod(steps, dtype=U))
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def buffers(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 row offsets (from 0) of an Arrow string column; nulls are empty."""
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    parts = column.buffers()
    off = np.frombuffer(parts[1], np.int64 if wide else np.int32)
    off = off[column.offset:column.offset + n + 1].astype(np.int64)
    if parts[2] is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    raw = memoryview(parts[2])[int(off[0]):int(off[-1])]
    raw = bytes(raw).translate(LOWER) if lower else raw
    return np.frombuffer(raw, np.uint8), off - off[0]


def row_groups(off: np.ndarray, most: int, rows: int = 1 << 30):
    """Runs of rows [i, j) of at most ``most`` bytes and ``rows`` rows; a longer row stands alone."""
    i, n = 0, len(off) - 1
    while i < n:
        j = int(np.searchsorted(off, off[i] + most, "right")) - 1
        j = min(max(j, i + 1), i + rows, n)
        yield i, j
        i = j


def word_bounds(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and per row the index of its first word (rows + 1 entries)."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    word = ~SEPARATOR[buf]
    edge = np.empty(len(buf) + 1, bool)
    edge[0], edge[-1] = word[0], word[-1]
    np.not_equal(word[1:], word[:-1], out=edge[1:-1])
    cuts = off[1:-1]
    cuts = np.unique(cuts[(cuts > 0) & (cuts < len(buf))])
    glued = cuts[word[cuts] & word[cuts - 1]]          # rows that touch inside a run of word bytes
    at = np.flatnonzero(edge)
    if len(glued):
        at = np.sort(np.concatenate([at, glued, glued]), kind="stable")
    starts, ends = at[0::2], at[1::2]
    return starts, ends, np.searchsorted(starts, off)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, by polynomial prefix sums; equal bytes give equal hashes."""
    up, down = powers(len(buf))
    sums = np.zeros(len(buf) + 1, U)
    np.cumsum((buf.astype(U) + U(1)) * up[:len(buf)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of every row, and the row of each; a row of fewer words gives
    its whole word sequence as one shingle, a row without words none."""
    n = np.diff(first)
    rows = np.repeat(np.arange(len(n)), n)
    out = np.zeros(max(0, len(words) - k + 1), U)
    for j in range(k):
        out += words[j:j + len(out)] * PLACE[j]
    fits = np.zeros(len(out), bool)
    if len(out):
        fits = rows[:len(out)] == rows[k - 1:]
    hashes, row = [out[fits]], [rows[:len(out)][fits]]
    for m in range(1, k):
        short = np.flatnonzero(n == m)
        if len(short):
            at = first[:-1][short]
            hashes.append(sum((words[at + j] * PLACE[j] for j in range(m)), np.full(len(at), U(m))))
            row.append(short)
    return mix(np.concatenate(hashes)), np.concatenate(row)


def strings(parts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """An Arrow binary column from joined bytes and the rows' lengths."""
    off = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=off[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(lengths),
                                 [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(parts))]
                                 ).cast(pa.binary())


class SpanCache:
    """Integer lists for byte spans (token ids of words, say): each distinct span is worked out once
    and kept by its hash, up to ``most`` spans. ``work`` maps strings to joined lists and lengths."""

    def __init__(self, work, most: int):
        self.work, self.most = work, most
        self.clear()

    def clear(self) -> None:
        self.hashes, self.flat = np.zeros(0, U), np.zeros(0, np.int32)
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def lists(self, raw: bytes, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray):
        """Joined lists of all spans in order, and the length of each."""
        distinct, at, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hashes) > self.most:
            self.clear()
        near = np.searchsorted(self.hashes, distinct)
        new = np.ones(len(distinct), bool)
        inside = near < len(self.hashes)
        new[inside] = self.hashes[near[inside]] != distinct[inside]
        if new.any():
            spans = [raw[i:j].decode("utf-8", "replace") for i, j in zip(starts[at[new]].tolist(), ends[at[new]].tolist())]
            flat, sizes = self.work(spans)
            self.begin = np.insert(self.begin, near[new], len(self.flat) + np.cumsum(sizes) - sizes)
            self.size = np.insert(self.size, near[new], sizes)
            self.hashes = np.insert(self.hashes, near[new], distinct[new])
            self.flat = np.concatenate([self.flat, flat])
        place = np.searchsorted(self.hashes, distinct)[back]
        return gathered(self.flat, self.begin[place], self.size[place]), self.size[place]


def gathered(flat: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices ``flat[begin:begin + size]``, joined."""
    ends = np.cumsum(sizes)
    index = np.arange(int(ends[-1]) if len(ends) else 0)
    return flat[index - np.repeat(ends - sizes - begin, sizes)]
