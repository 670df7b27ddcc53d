"""Operator 5, quality rules: tokeniser fertility of whole documents, with bands per script.

A public subword vocabulary reads natural text in few, long tokens. Each document's words are
tokenised with it and measured: characters per token, share of byte-fallback tokens, and entropy of
the token distribution in bits. A text outside the bands of its main script is rejected, next to
base rules on word counts and repeated three-word windows.

Words are ``[^\\x20\\x09-\\x0D]+``. As no piece of the vocabulary spans white space, a word's tokens
don't depend on its neighbours: each distinct word of a task is tokenised once and kept, up to a
bound. One narrow pass, no shuffle; the model file travels as bytes of a checked size.

Null and empty texts, and texts of white space, have no words: all counts 0, ``base_failed``. Ties
and repeated rows are measured alike; empty tables give no rows; columns of other names pass through
``measure``, which adds the single struct column that it is asked for.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbatch import SEPARATOR, SpanCache, buffers, row_groups, shingle_hashes, span_hashes, word_bounds

CHUNK = 1 << 21
#: Largest model file that is broadcast, and distinct words kept by a task.
MODEL_BYTES, KEPT_WORDS = 16 << 20, 400_000
SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens", "n_byte_tokens")

#: First code points of scripts (fixed values of the Unicode block layout), up to the next entry.
SCRIPTS = [(0x41, "Latin"), (0x370, "Greek"), (0x400, "Cyrillic"), (0x530, "Other"), (0x590, "Hebrew"),
           (0x600, "Arabic"), (0x780, "Other"), (0x900, "Indic"), (0xE00, "Thai"), (0xE80, "Other"),
           (0x1100, "Hangul"), (0x1200, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Common"),
           (0x2E80, "Han"), (0x3040, "Kana"), (0x3100, "Han"), (0xAC00, "Hangul"), (0xD7B0, "Other"),
           (0xF900, "Han"), (0xFB00, "Other"), (0x20000, "Han"), (0x30000, "Other")]
#: Bands by script: least and most characters per token, most byte-fallback share, least entropy as
#: a share of the entropy that as many distinct tokens could have. A script not listed uses "Other".
BANDS = {
    "Latin": (1.3, 7.0, 0.10, 0.25),
    "Greek": (0.7, 5.0, 0.30, 0.25),
    "Cyrillic": (1.0, 6.0, 0.15, 0.25),
    "Hebrew": (0.6, 4.0, 0.40, 0.25),
    "Arabic": (0.6, 4.0, 0.40, 0.25),
    "Han": (0.3, 3.0, 0.80, 0.25),
    "Kana": (0.3, 3.0, 0.80, 0.25),
    "Hangul": (0.3, 3.0, 0.90, 0.25),
    "Other": (0.2, 7.0, 1.00, 0.25),
}
#: Entropy is judged from this many tokens on.
ENTROPY_TOKENS = 50
STRUCT = ", ".join(f"{f} long" for f in FIELDS) + ", entropy double, script string"


def _row_sums(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[off])


def duplicate_lines(raw: bytes, off: np.ndarray) -> np.ndarray:
    """Per row, the lines with a word that equal an earlier line of the row."""
    out = np.zeros(len(off) - 1, np.int64)
    for r in range(len(out)):
        lines = [x for x in raw[off[r]:off[r + 1]].split(b"\n") if x.split(None, 1)]
        out[r] = len(lines) - len(set(lines))
    return out


def repeated_words(words: np.ndarray, first: np.ndarray, k: int = 3) -> np.ndarray:
    """Per row, the words inside a k-word window that the row has twice or more."""
    n = np.diff(first)
    full, row = shingle_hashes(words, first, k)
    # windows come before the short rows' sequences, in word order
    windows = n[n >= k].sum() - (k - 1) * np.count_nonzero(n >= k)
    full, row = full[:windows], row[:windows]
    start = first[:-1][row] + (np.arange(windows) - np.searchsorted(row, row))
    order = np.lexsort((full, row))
    same = np.zeros(windows, bool)
    if windows > 1:
        equal = (full[order][1:] == full[order][:-1]) & (row[order][1:] == row[order][:-1])
        same[order[1:]] |= equal
        same[order[:-1]] |= equal
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, start[same], 1)
    np.add.at(cover, start[same] + k, -1)
    return _row_sums(np.cumsum(cover)[:-1] > 0, first)


def main_scripts(raw: bytes, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The script that most letters of each row belong to; ties go to the first in the table."""
    names = list(dict.fromkeys(s for _, s in SCRIPTS if s != "Common"))
    points = np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    ends = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])[off]
    seen = np.flatnonzero(np.bincount(points, minlength=1))
    starts = np.array([a for a, _ in SCRIPTS])
    number = np.full(int(seen[-1]) + 1 if len(seen) else 1, -1, np.int64)
    for p in seen.tolist():
        name = SCRIPTS[max(0, np.searchsorted(starts, p, "right") - 1)][1]
        if chr(p).isalpha() and name != "Common":
            number[p] = names.index(name)
    script = number[points]
    rows = np.repeat(np.arange(len(off) - 1), np.diff(ends))
    ok = script >= 0
    counts = np.bincount(rows[ok] * len(names) + script[ok], minlength=(len(off) - 1) * len(names))
    counts = counts.reshape(-1, len(names))
    return np.where(counts.any(axis=1), np.array(names, object)[counts.argmax(axis=1)], "Other")


class Vocabulary:
    """Token ids of words by the public vocabulary."""

    def __init__(self, model: bytes):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.vocab_size())])
        self.words = SpanCache(self.tokenised, KEPT_WORDS)

    def tokenised(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = self.model.encode(words, num_threads=1)
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum())), sizes


def entropies(ids: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Bits of entropy of each row's token distribution."""
    rows = np.repeat(np.arange(len(off) - 1), np.diff(off))
    _, at, n = np.unique(rows << 32 | ids, return_index=True, return_counts=True)
    part = n / np.diff(off)[rows[at]]
    return np.bincount(rows[at], -part * np.log2(part), len(off) - 1) + 0.0


def measure_batch(column: pa.Array, vocabulary: Vocabulary) -> pa.StructArray:
    buf, off = buffers(column)
    out = {f: np.zeros(len(column), np.int64) for f in FIELDS}
    entropy, script = np.zeros(len(column)), np.full(len(column), "Other", object)
    for i, j in row_groups(off, CHUNK):
        b, o = buf[off[i]:off[j]], off[i:j + 1] - off[i]
        if not len(b):
            continue
        raw = bytes(b)
        starts, ends, first = word_bounds(b, o)
        hashes = span_hashes(b, starts, ends)
        ids, tokens = vocabulary.words.lists(raw, starts, ends, hashes)
        token_off = np.concatenate([[0], np.cumsum(tokens)])[first]
        out["n_words"][i:j] = np.diff(first)
        out["word_chars"][i:j] = _row_sums(((b & 0xC0) != 0x80) & ~SEPARATOR[b], o)
        out["n_symbols"][i:j] = _row_sums(SYMBOLS[b], o)
        out["n_dup_lines"][i:j] = duplicate_lines(raw, o)
        out["n_repeat_words"][i:j] = repeated_words(hashes, first)
        out["n_tokens"][i:j] = np.diff(token_off)
        out["n_byte_tokens"][i:j] = _row_sums(vocabulary.is_byte[ids], token_off)
        entropy[i:j] = entropies(ids, token_off)
        script[i:j] = main_scripts(raw, b, o)
    return pa.StructArray.from_arrays([pa.array(out[f]) for f in FIELDS] + [pa.array(entropy), pa.array(script, pa.string())],
                                      [*FIELDS, "entropy", "script"])


def measure(docs: DataFrame, model_path: str, column: str = "fertility") -> DataFrame:
    """Add the struct ``column`` with every count, the entropy and the main script of ``text``."""
    from collections.abc import Iterator

    with open(model_path, "rb") as f:
        data = f.read()
    if len(data) > MODEL_BYTES:
        raise ValueError(f"{model_path} has {len(data)} bytes; vocabularies up to {MODEL_BYTES} are broadcast")
    model = docs.sparkSession.sparkContext.broadcast(data)

    def run(batches):
        vocabulary = Vocabulary(model.value)
        for texts in batches:
            yield measure_batch(texts, vocabulary)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn(column, F.arrow_udf(run, STRUCT)(F.col("text")))


def verdicts(measured: DataFrame, bands: dict = BANDS, column: str = "fertility") -> DataFrame:
    """Add ``base_failed``, ``chars_per_token``, ``byte_share``, ``entropy_share`` and ``kept``."""
    f = F.col(column)
    cpt, share = (F.try_divide(f[x], f["n_tokens"]) for x in ("word_chars", "n_byte_tokens"))
    # the most entropy that so many tokens can have; a vocabulary has some 2**15 tokens
    even = f["entropy"] / F.least(F.log2(F.greatest(f["n_tokens"], F.lit(2))), F.lit(15.0))

    def limit(i: int):
        out = F.lit(float(bands["Other"][i]))
        for name, band in bands.items():
            out = F.when(f["script"] == name, F.lit(float(band[i]))).otherwise(out)
        return out

    failed = (f["n_words"] < 50) | (100 * f["n_repeat_words"] > 50 * f["n_words"])
    inside = ((F.col("chars_per_token") >= limit(0)) & (F.col("chars_per_token") <= limit(1))
              & (F.col("byte_share") <= limit(2))
              & ((f["n_tokens"] < ENTROPY_TOKENS) | (F.col("entropy_share") >= limit(3))))
    return (measured.withColumn("base_failed", failed).withColumn("chars_per_token", F.coalesce(cpt, F.lit(0.0)))
            .withColumn("byte_share", F.coalesce(share, F.lit(0.0))).withColumn("entropy_share", F.coalesce(even, F.lit(0.0)))
            .withColumn("kept", ~F.col("base_failed") & inside))
