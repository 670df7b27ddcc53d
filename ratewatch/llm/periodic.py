"""Operator 13, periodic run detection: multi-scale minimizers and direct lag scans.

A run is a stretch of consecutive words with smallest period q and at least ``max(LEAST_WORDS, REPEATS * q)``
words that can't be extended on either side. Periods up to ``SHORT`` are found by comparing the words
with themselves at every such lag. Longer ones are found scale by scale; a scale k = 16, 32, 64 .. is
responsible for the periods from k / 2 + 1 to k:

* every block of k words has a polynomial hash; the least hash of each window of k / 2 blocks marks a
  minimizer (all of equal least ones). Inside a run the hashes repeat at distance q, so the minimizers do
  too: a run of four periods has room for a window and the same window one period on.
* two equal blocks of k >= q words can't lie closer than q in a run of smallest period q, so the next
  minimizer of the same hash is exactly one period away. Each minimizer is paired with that one only.
* a pair whose distance fits the scale is extended on the words themselves, both ways, as far as they
  agree at that lag; pairs inside a stretch that was extended already are left out. Stretches that are
  too short, or whose smallest period is a divisor of the lag, are no runs.

There are some 4 n / k minimizers on a scale, so the work is n log n for any text, however long, and
memory stays in proportion to it. Texts of a batch are worked on together; a long one stands alone.
It is a narrow pass without a shuffle.

Words are ``[^\\x20\\x09-\\x0D]+`` and compared exactly (hash names are verified on bytes). Null, empty and
blank texts have no words and no runs; a null text keeps a null ``collapsed``. Runs are ordered by start,
then period. Repeated rows give equal results, each its row; empty tables give no rows. Extra columns
pass through; the output columns replace columns of the same names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import packed, unpacked
from .textbatch import U, buffers, gathered, mix, powers, row_groups, span_hashes, strings, word_bounds

#: A run has at least this many words, and this many periods.
LEAST_WORDS, REPEATS = 6, 4
#: Periods found by direct lag scans; the first scale begins above.
SHORT = 8
CHUNK = 1 << 20
RESULT = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def word_names(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word, equal for equal bytes only."""
    if not len(starts):
        return np.zeros(0, np.int64)
    _, at, name = np.unique(span_hashes(buf, starts, ends), return_index=True, return_inverse=True)
    size = ends - starts
    same = np.array_equal(size, size[at][name])
    if same and np.array_equal(gathered(buf, starts, size), gathered(buf, starts[at][name], size)):
        return name.astype(np.int64)
    known: dict[bytes, int] = {}                       # two words share a hash: name by bytes
    raw = buf.tobytes()
    return np.array([known.setdefault(raw[i:j], len(known)) for i, j in zip(starts.tolist(), ends.tolist())], np.int64)


def _prime_divisors(q: int) -> list[int]:
    found, p = [], 2
    while p * p <= q:
        if q % p == 0:
            found.append(p)
            while q % p == 0:
                q //= p
        p += 1
    return found + [q] if q > 1 else found


def _is_smallest(names: np.ndarray, start: int, period: int) -> bool:
    """Whether a stretch of two periods or more has no shorter period: that would divide this one."""
    own = names[start:start + period]
    return not any(np.array_equal(own, names[start + period // p:start + period // p + period]) for p in _prime_divisors(period))


def _long_enough(length, period):
    return length >= np.maximum(LEAST_WORDS, REPEATS * period)


def lag_scan(names: np.ndarray, row: np.ndarray, period: int) -> list[tuple[int, int, int]]:
    """All runs of one period, by comparing every word with the one ``period`` places on."""
    if len(names) <= period:
        return []
    same = np.concatenate([[False], (names[period:] == names[:-period]) & (row[period:] == row[:-period]), [False]])
    edge = np.flatnonzero(same[1:] != same[:-1])
    begin, length = edge[0::2], edge[1::2] - edge[0::2] + period
    fit = _long_enough(length, period)
    return [(s, n, period) for s, n in zip(begin[fit].tolist(), length[fit].tolist()) if _is_smallest(names, s, period)]


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over [i, i + width), ``width`` a power of two; the last
    width - 1 entries cover less."""
    step = 1
    while step < width:
        values = np.concatenate([pick(values[:-step], values[step:]), values[-step:]])
        step *= 2
    return values


def minimizer_pairs(hashes: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance to the next equal minimizer) for the distances of scale ``k``, by distance
    and position. ``hashes`` are word hashes of joined rows."""
    n, w = len(hashes), k // 2
    if n < k + w:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    up, down = powers(n)
    sums = np.zeros(n + 1, U)
    np.cumsum(hashes * up[:n], out=sums[1:])
    block = mix((sums[k:] - sums[:-k]) * down[:n - k + 1])
    whole = row[k - 1:] == row[:n - k + 1]              # blocks inside one row
    block[~whole] = ~U(0)
    least = _sliding(block, w, np.minimum)
    inside = np.zeros(len(block), bool)                 # windows inside one row
    inside[:n - k - w + 2] = row[k + w - 2:] == row[:n - k - w + 2]
    least[~inside] = 0
    # a block is a minimizer if it is the least of some window: the greatest of these leasts is its own hash
    most = np.concatenate([np.zeros(w - 1, U), least])
    chosen = np.flatnonzero(whole & (_sliding(most, w, np.maximum)[:len(block)] == block))
    chosen = chosen[np.argsort(block[chosen], kind="stable")]
    gap = np.diff(chosen)
    fit = (block[chosen[1:]] == block[chosen[:-1]]) & (gap > w) & (gap <= k)
    at, gap = chosen[:-1][fit], gap[fit]
    fit = row[at] == row[at + gap]
    at, gap = at[fit], gap[fit]
    order = np.lexsort((at, gap))
    return at[order], gap[order]


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading entries of two arrays agree."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        differs = a[at:at + step][:n - at] != b[at:at + step][:n - at]
        if differs.any():
            return at + int(differs.argmax())
        at += step
        step *= 2
    return n


def _extended(names: np.ndarray, at: int, lag: int, begin: int, end: int) -> tuple[int, int]:
    """The stretch [s, e) of places i around ``at`` where word i and word i + lag agree, within a row."""
    e = at + _agree(names[at:end - lag], names[at + lag:end])
    s = at - _agree(names[begin:at][::-1], names[begin + lag:at + lag][::-1])
    return s, e


def find_runs(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Runs of joined rows of word names, as rows (start in the joined words, length, period)."""
    size = np.diff(first)
    row = np.repeat(np.arange(len(size)), size)
    found = [r for q in range(1, SHORT + 1) for r in lag_scan(names, row, q)]
    hashes = mix(names.astype(U) + U(0x9E3779B97F4A7C15))
    k = 2 * SHORT
    while True:
        live = size >= REPEATS * (k // 2 + 1)           # rows with room for a run of this scale
        if not live.any():
            break
        place = np.flatnonzero(live[row])
        at, gap = minimizer_pairs(hashes[place], row[place], k)
        lag, done = 0, 0
        for i, q in zip(place[at].tolist(), gap.tolist()):
            if q != lag:
                lag, done = q, 0
            if i < done:
                continue
            r = row[i]
            s, done = _extended(names, i, q, int(first[r]), int(first[r + 1]))
            length = done + q - s
            if _long_enough(length, q) and _is_smallest(names, s, q):
                found.append((s, length, q))
        k *= 2
    runs = np.array(found, np.int64).reshape(-1, 3)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def dropped_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Words that some run holds after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:-1]) > 0


def joined_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, keep: np.ndarray) -> pa.Array:
    """Per row the kept words, joined by one space."""
    size = (ends - starts)[keep] + 1                    # a word and a space
    joined = gathered(np.append(buf, np.uint8(32)), starts[keep], size)
    stop = np.cumsum(size)
    joined[stop - 1] = 32
    words = np.diff(np.concatenate([[0], np.cumsum(keep)])[first])
    some = np.flatnonzero(words)
    last = np.cumsum(words)[some] - 1                   # the last word of a row has no space
    joined = np.delete(joined, stop[last] - 1)
    total = np.concatenate([[0], stop])[np.concatenate([[0], np.cumsum(words)])]
    lengths = np.diff(total)
    lengths[some] -= 1
    return strings(joined, lengths)


def _chunk(buf: np.ndarray, off: np.ndarray):
    starts, ends, first = word_bounds(buf, off)
    runs = find_runs(word_names(buf, starts, ends), first)
    keep = ~dropped_words(len(starts), runs)
    row = np.searchsorted(first, runs[:, 0], "right") - 1
    per_row = np.bincount(row, minlength=len(off) - 1)
    runs[:, 0] -= first[row]
    return np.diff(first), per_row, runs, joined_words(buf, starts, ends, first, keep)


def _found(column: pa.Array) -> pa.Array:
    buf, off = buffers(column)
    parts = [_chunk(buf[off[i]:off[j]], off[i:j + 1] - off[i]) for i, j in row_groups(off, CHUNK)]
    n = np.concatenate([p[0] for p in parts] or [np.zeros(0, np.int64)])
    per_row = np.concatenate([p[1] for p in parts] or [np.zeros(0, np.int64)])
    runs = np.concatenate([p[2] for p in parts] or [np.zeros((0, 3), np.int64)])
    fields = pa.StructArray.from_arrays([pa.array(runs[:, i]) for i in range(3)], ["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32)), fields)
    collapsed = pa.concat_arrays([p[3] for p in parts]) if parts else pa.array([], pa.binary())
    return pa.StructArray.from_arrays([pa.array(n.astype(np.int64)), lists, collapsed.cast(pa.string())],
                                      ["n_words", "runs", "collapsed"])


def _annotated():
    _found.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(_found, RESULT)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Add ``n_words``, ``runs`` (start, length, period) and ``collapsed``, the text's words without what
    runs repeat, to documents."""
    found = packed(docs, found=_annotated()(F.col("text")), blank=F.col("text").isNull())
    return unpacked(found, docs.columns, n_words=F.col("found.n_words"), runs=F.col("found.runs"),
                    collapsed=F.when(~F.col("blank"), F.col("found.collapsed")))


def longest(runs: Column) -> Column:
    """The run of greatest length; of equal ones that with the smallest start, then period. Null without runs."""
    ranked = F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    best = F.array_max(ranked)
    return F.when(best.isNotNull(), F.struct((-best["start"]).alias("start"), best["length"].alias("length"), (-best["period"]).alias("period")))


def runs_text(runs: Column) -> Column:
    """Every run as ``start,length,period`` and a line feed."""
    return F.array_join(F.transform(runs, lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"),
                                                             F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
