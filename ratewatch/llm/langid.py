"""Operator 10, language ID: rank-order profiles of character n-grams (out-of-place distance).

A profile is the list of a language's most frequent n-grams (1 to 3 letters, words padded with a
space), most frequent first. A document gets the same list from its whole text; its distance to a
language sums, over its n-grams, how far their places differ, or the profile length where an n-gram
is missing. The nearest language wins; ``score`` is 1 minus the distance over its greatest value.

Profiles are fitted on a bounded sample, some ``fit_rows`` different labelled documents a language at most, chosen
by a hash of doc_id and text; a document's copies count with it, but its text is counted once. More than
``languages`` labels are an error. So what is broadcast is at most ``languages * places`` numbers. A label whose
documents have no letter has no profile and is never predicted. Prediction is one narrow pass without a shuffle.

A null text or one without a letter is ``und`` with score 0, and so is every text when nothing could
be learned. Equal counts rank by n-gram length, then code points; equal distances go to the first
language by name. Null doc_id counts as an empty key. Repeated rows are predicted alike. Empty
tables give no rows. Extra columns pass through ``identify`` untouched; its two output columns
replace columns of the same names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import packed, unpacked
from .textbatch import buffers, row_groups

#: Length of a profile.
PLACES = 300
#: Bounds of the fitted model: labelled documents per language, and languages.
FIT_ROWS, LANGUAGES = 4000, 1000
CHUNK = 1 << 19
#: Code point that pads words in keys; not a letter, and above 0 so that keys of each length differ.
PAD = 1
UNDETERMINED = "und"


def _letters(buf: np.ndarray, off: np.ndarray):
    """Lower-cased letters of joined rows as numbers 2.., other runs as one pad (1); the row of each
    symbol; and the code points behind the numbers, in order."""
    points = np.frombuffer(bytes(buf).decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    ends = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])[off]
    seen = np.flatnonzero(np.bincount(points, minlength=1))
    fold = {}
    for p in seen.tolist():
        c = chr(p)
        if c.isalpha():
            low = c.lower()
            fold[p] = ord(low) if len(low) == 1 else p
    alphabet = np.array(sorted(set(fold.values())), np.int64)
    number = np.full(int(seen[-1]) + 1 if len(seen) else 1, PAD, np.int64)
    if fold:
        number[list(fold)] = np.searchsorted(alphabet, list(fold.values())) + 2
    rows = np.repeat(np.arange(len(off) - 1), np.diff(ends))
    # a pad before every row, then runs of pads become one
    symbols = np.insert(number[points], ends[:-1], PAD)
    rows = np.insert(rows, ends[:-1], np.arange(len(off) - 1))
    symbols, rows = np.append(symbols, PAD), np.append(rows, len(off) - 2)
    keep = np.ones(len(symbols), bool)
    keep[1:] = (symbols[1:] != PAD) | (symbols[:-1] != PAD)
    return symbols[keep], rows[keep], alphabet


def ngram_counts(buf: np.ndarray, off: np.ndarray, group: np.ndarray | None = None):
    """(row or group, n-gram key, count), by row and key. Keys hold three 21-bit code points; their
    order is by length, then code points."""
    symbols, rows, alphabet = _letters(buf, off)
    if not len(alphabet):
        return (np.zeros(0, np.int64),) * 3
    letter = symbols != PAD
    width = int(len(alphabet) + 1).bit_length()
    owner = rows.copy()                               # a pad in front belongs to the word after it
    owner[:-1][~letter[:-1]] = rows[1:][~letter[:-1]]
    if group is not None:
        owner, rows = group[owner], group[rows]
    high = owner << (3 * width)
    two = symbols[:-1] << width | symbols[1:]
    bi = letter[:-1] | letter[1:]
    bi &= ~(~letter[:-1] & ~letter[1:])
    tri = letter[1:-1]
    three = two[:-1] << width | symbols[2:]
    # a word's closing pad is the row's own, also where the next row begins at once
    coded = np.concatenate([high[letter] | symbols[letter],
                            (np.where(letter[:-1], rows[:-1], owner[:-1]) << (3 * width) | two)[bi],
                            (np.where(letter[:-2], rows[:-2], owner[:-2]) << (3 * width) | three)[tri]])
    coded, counts = np.unique(coded, return_counts=True)
    points = np.concatenate([[0, PAD], alphabet])
    mask = (1 << width) - 1
    key = (points[coded >> 2 * width & mask] << 42 | points[coded >> width & mask] << 21 | points[coded & mask])
    return coded >> 3 * width, key, counts


def top_places(row: np.ndarray, counts: np.ndarray, places: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices and places (0 the most frequent) of each row's first ``places`` entries; the input is
    in row and key order, which settles ties."""
    order = np.argsort((row << 32) + ((1 << 32) - 1 - np.minimum(counts, (1 << 32) - 1)), kind="stable")
    row = row[order]
    starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else np.zeros(0, int)
    place = np.arange(len(row)) - np.repeat(starts, np.diff(np.append(starts, len(row))))
    near = place < places
    return order[near], place[near]


def fit_profiles(labelled: DataFrame, fit_rows: int = FIT_ROWS, languages: int = LANGUAGES,
                 places: int = PLACES) -> tuple[list[str], np.ndarray, np.ndarray]:
    """``labelled`` (doc_id, text, lang) -> language names, sorted n-gram keys, and their places by
    language (``places`` where missing)."""
    spark = labelled.sparkSession
    labelled = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "text", F.col("lang").alias("label"), F.xxhash64("doc_id", "text").alias("h"))
    sizes = labelled.select("label", "h").distinct().groupBy("label").count().limit(languages + 1).collect()
    if len(sizes) > languages:
        raise ValueError(f"more than {languages} languages")
    if not sizes:
        return [], np.zeros(0, np.int64), np.zeros((0, 0), np.int64)
    share = spark.createDataFrame([(r["label"], int(min(1.0, fit_rows / r["count"]) * (1 << 30))) for r in sizes],
                                  "label string, share long")
    sample = (labelled.join(F.broadcast(share), "label")            # at most ``languages`` rows
              .where(F.pmod(F.xxhash64("h"), F.lit(1 << 30)) < F.col("share"))
              .groupBy("label", "h").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies")))

    def count(batches):
        for batch in batches:
            labels, group = np.unique(np.asarray(batch.column("label").to_pylist(), object), return_inverse=True)
            copies = batch.column("copies").to_numpy()
            buf, off = buffers(batch.column("text"))
            for i, j in row_groups(off, CHUNK):
                row, key, n = ngram_counts(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                if not len(row):
                    continue
                g, n = group[i:j][row], n * copies[i:j][row]
                order = np.lexsort((key, g))
                g, key, n = g[order], key[order], n[order]
                at = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (key[1:] != key[:-1])]))
                yield pa.RecordBatch.from_arrays([pa.array(labels[g[at]], pa.string()), pa.array(key[at]), pa.array(np.add.reduceat(n, at))],
                                                 ["label", "key", "n"])

    from pyspark.sql import Window
    counts = sample.mapInArrow(count, "label string, key long, n long").groupBy("label", "key").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("label").orderBy(F.desc("n"), "key"))
    rows = counts.withColumn("place", place - 1).where(F.col("place") < places).select("label", "key", "place").collect()
    names = sorted({r["label"] for r in rows})
    keys = np.array(sorted({r["key"] for r in rows}), np.int64)
    table = np.full((len(keys), len(names)), places, np.int64)
    for r in rows:
        table[np.searchsorted(keys, r["key"]), names.index(r["label"])] = r["place"]
    return names, keys, table


def distances(row: np.ndarray, key: np.ndarray, counts: np.ndarray, rows: int, profiles, places: int):
    """Out-of-place distances (rows x languages) and the number of n-grams compared for each row."""
    _, keys, table = profiles
    at, place = top_places(row, counts, places)
    row, key = row[at], key[at]
    found = np.minimum(np.searchsorted(keys, key), max(0, len(keys) - 1))
    known = keys[found] == key if len(keys) else np.zeros(len(key), bool)
    seen = np.bincount(row, minlength=rows)
    apart = np.empty((rows, table.shape[1]), np.int64)
    for lang in range(table.shape[1]):
        theirs = np.where(known, table[found, lang], places)
        far = np.where(theirs < places, np.abs(theirs - place), places)
        apart[:, lang] = np.bincount(row, far, rows).astype(np.int64)
    return apart, seen


def identify(docs: DataFrame, profiles, places: int = PLACES) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to documents."""
    model = docs.sparkSession.sparkContext.broadcast(profiles)

    def guess(column: pa.Array) -> pa.Array:
        names = model.value[0]
        buf, off = buffers(column)
        pred, score = np.full(len(column), UNDETERMINED, object), np.zeros(len(column))
        if names:
            for i, j in row_groups(off, CHUNK):
                row, key, n = ngram_counts(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                apart, seen = distances(row, key, n, j - i, model.value, places)
                best = apart.argmin(axis=1)
                some = seen > 0
                pred[i:j][some] = np.array(names, object)[best[some]]
                score[i:j][some] = 1 - apart[np.arange(j - i), best][some] / (seen[some] * places)
        return pa.StructArray.from_arrays([pa.array(pred, pa.string()), pa.array(score)], ["lang_pred", "score"])

    guess.__annotations__ = {"column": pa.Array, "return": pa.Array}
    guessed = F.arrow_udf(guess, "lang_pred string, score double")(F.col("text"))
    return unpacked(packed(docs, guess=guessed), docs.columns,
                    lang_pred=F.col("guess.lang_pred"), score=F.col("guess.score"))


def held_out(folds: int = 4, fold: int = 2):
    """Documents kept from learning: crc32 of doc_id as text, modulo ``folds``."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(F.encode(key, "UTF-8")) % folds == fold


def predict_languages(docs: DataFrame) -> DataFrame:
    """Fit on the documents that aren't held out, then predict every document."""
    profiles = fit_profiles(docs.where(~held_out()))
    return identify(docs, profiles)
