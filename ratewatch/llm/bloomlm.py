"""Operator 3, LM scoring: quantised n-gram counts in a log-frequency Bloom filter.

Words and word pairs of the training documents are counted over the whole corpus, those seen once too. A count c is
kept as q = 1 + floor(log2 c): the n-gram's events (x, 1) .. (x, q) go into the filter, and reading back
probes (x, 1), (x, 2) .. until one is missing. Filters only err upwards, by a level with the rate of
false positives. A token's probability mixes its share among the tokens after its predecessor with its add-one
unigram share, both from probes; counts that are read back are the middle of their level, so the shares after a
context add up to one only up to that rounding.

Counting: every task sums its own n-grams and sends them packed, one row for each segment of the hash
space that it has something for; each segment's group merges its rows and builds its own piece of the filter, as large as
its events need. Segments are as many as input partitions, so groups keep their size as the input grows.

The filter grows with the corpus, so only its head is broadcast: the events of the most frequent words and pairs,
``HEAD`` of each at most, with the words' exact counts; a key that reads below the head's least level isn't in it. All
other n-grams are looked up where their piece lies: each chunk of documents sends its distinct keys to their segments,
one cogroup probes the pieces, and the levels (for words the exact counts too, which the base score needs) go back to
the chunk, in the order of its sorted keys. So there is one pass of each kind at any size, a frequent n-gram
is never asked for, and the driver holds the head alone. A chunk is one Arrow batch; its answers carry
a checksum of the keys, and a chunk that isn't met again as it was asked for is an error, never a wrong score.

Words are compared by 64-bit hashes, pairs by 48-bit ones. Null, empty and blank texts are the single
token *end*. Ties play no part; repeated rows get equal results, each its row. Without training
documents every count is 0. Empty tables give no rows. Extra columns aren't read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import cut
from .textbatch import U, buffers, mix, row_groups, span_hashes, word_bounds

#: Hashes of the end token and of the context in front of a text.
END, BEGIN = U(0x5851F42D4C957F2D), U(0x14057B7EF767814F)
PAIR = (U(0x9FB21C651E98DF25), U(0xD1B54A32D192ED03))
#: Filter bits per event and probes per event: about 1 % false positives.
BITS, PROBES = 10, 7
#: Weight of the pair's share; the rest goes to the unigram share.
PAIR_WEIGHT = 0.2
#: Words, and pairs, of the head; pairs below this level are never in it.
HEAD, LEAST_PAIR_LEVEL = 150_000, 5
#: Tokens summed before a task sends them, and bytes worked on at once.
FLUSH, CHUNK = 1 << 21, 1 << 21
SEGMENT = ("seg int, bits binary, bit_count long, words binary, counts binary, pairs binary, pair_levels binary, tokens long, types long, "
           "by_level array<long>, pairs_by_level array<long>")


def tokens(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of every row with *end* after them, and row offsets."""
    starts, ends, first = word_bounds(buf, off)
    hashes = np.insert(span_hashes(buf, starts, ends), first[1:], END)
    return hashes, first + np.arange(len(first))


def pairs(hashes: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 48-bit hash of each token with the one before it, and the hash of that one."""
    before = np.empty_like(hashes)
    before[1:] = hashes[:-1]
    before[off[:-1]] = BEGIN
    return mix(before * PAIR[0] + hashes * PAIR[1]) >> U(16), before


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], np.add.reduceat(counts, at)


#: Bytes of a packed list without entries.
NOTHING = 16


def pack(keys: np.ndarray, counts: np.ndarray, width: int) -> bytes:
    """Keys in ``width`` bytes each, counts in one byte, those from 255 on in eight more."""
    big = counts[counts >= 255].astype(np.uint64)
    return b"".join([np.array([len(keys), len(big)], np.int64).tobytes(),
                     np.ascontiguousarray(keys).view(np.uint8).reshape(-1, 8)[:, :width].tobytes(),
                     np.minimum(counts, 255).astype(np.uint8).tobytes(), big.tobytes()])


def unpack(data: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    n, big = np.frombuffer(data, np.int64, 2)
    keys = np.zeros((n, 8), np.uint8)
    keys[:, :width] = np.frombuffer(data, np.uint8, n * width, 16).reshape(n, width)
    counts = np.frombuffer(data, np.uint8, n, 16 + n * width).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, np.uint64, big, 16 + n * (width + 1)).astype(np.int64)
    return keys.reshape(-1).view(np.uint64), counts


def _count(segments: int):
    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush():
            own = [np.concatenate(x) if x else np.zeros(0, U) for x in zip(*held)] or [np.zeros(0, U)] * 2
            held.clear()
            packed = []
            for keys, width in zip(own, (8, 6)):
                keys, counts = np.unique(keys, return_counts=True)
                seg = (keys % U(segments)).astype(np.int64)
                order = np.argsort(seg, kind="stable")
                ends = np.searchsorted(seg[order], np.arange(segments + 1))
                packed.append([pack(keys[order[a:b]], counts[order[a:b]], width) for a, b in zip(ends, ends[1:])])
            some = np.array([i for i in range(segments) if len(packed[0][i]) + len(packed[1][i]) > 2 * NOTHING], np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(some), *[pa.array([x[i] for i in some], pa.binary()) for x in packed]],
                                             ["seg", "words", "pairs"])

        size = 0
        for batch in batches:
            buf, off = buffers(batch.column("text"), lower=True)
            for i, j in row_groups(off, CHUNK):
                hashes, at = tokens(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                held.append((hashes, pairs(hashes, at)[0]))
                size += len(hashes)
                if size >= FLUSH:
                    yield from flush()
                    size = 0
        if size:
            yield from flush()
    return run


def levels(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log2 c)."""
    return np.frexp(counts.astype(float))[1].astype(np.int64)


def events(keys: np.ndarray, level) -> np.ndarray:
    return mix(keys + np.asarray(level).astype(U) * U(0x9E3779B97F4A7C15))


def places(event: np.ndarray, i: int, bit_count) -> np.ndarray:
    """The i-th bit of an event in a filter of ``bit_count`` bits."""
    return ((event >> U(32)) + U(i) * ((event & U(0xFFFFFFFF)) | U(1))) % np.asarray(bit_count).astype(U)


def pair_keys(keys: np.ndarray) -> np.ndarray:
    """Pairs' place in the filter, apart from words."""
    return mix(keys ^ U(0xC2B2AE3D27D4EB4F))


def _merge(group: pa.Table) -> pa.Table:
    """One segment: its n-grams' sums, the piece of the filter, and the exact word counts."""
    sums = []
    for name, width in (("words", 8), ("pairs", 6)):
        parts = [unpack(x.as_py(), width) for x in group.column(name)]
        sums.append(summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])))
    (words, word_counts), (two, two_counts) = sums
    keys = np.concatenate([words, pair_keys(two)])
    level = np.concatenate([levels(word_counts), levels(two_counts)])
    bits, bit_count = filter_bits(keys, level)
    by_level = np.bincount(levels(word_counts), minlength=64)[:64]
    pair_level = levels(two_counts)
    often = pair_level >= LEAST_PAIR_LEVEL
    return pa.table({"seg": pa.array([group.column("seg")[0].as_py()], pa.int32()),
                     "bits": pa.array([bits.tobytes()], pa.binary()),
                     "bit_count": [bit_count], "words": pa.array([words.tobytes()], pa.binary()),
                     "counts": pa.array([word_counts.astype(np.int64).tobytes()], pa.binary()),
                     "pairs": pa.array([two[often].tobytes()], pa.binary()),
                     "pair_levels": pa.array([pair_level[often].astype(np.uint8).tobytes()], pa.binary()),
                     "tokens": [int(word_counts.sum())], "types": [len(words)],
                     "by_level": pa.array([by_level.tolist()], pa.list_(pa.int64())),
                     "pairs_by_level": pa.array([np.bincount(pair_level[often], minlength=64)[:64].tolist()], pa.list_(pa.int64()))})


def filter_bits(keys: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, int]:
    """The filter of some keys, as bytes, and its number of bits."""
    bit_count = max(64, int(level.sum()) * BITS + 7 & ~7)
    bits = np.zeros(bit_count, bool)
    for at in range(1, int(level.max(initial=0)) + 1):
        event = events(keys[level >= at], at)
        for i in range(PROBES):
            bits[places(event, i, bit_count).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little"), bit_count


def read_levels(data: np.ndarray, bit_count: int, keys: np.ndarray) -> np.ndarray:
    """Levels of filter keys by probes; 0: absent."""
    out, live, level = np.zeros(len(keys), np.uint8), np.arange(len(keys)), 0
    while len(live):
        level += 1
        event = events(keys[live], level)
        for i in range(PROBES):
            bit = places(event, i, bit_count).astype(np.int64)
            hit = data[bit >> 3] >> (bit & 7) & 1 > 0
            live, event = live[hit], event[hit]
        out[live] = level
    return out


class Head:
    """The broadcast part: exact counts of the most frequent words, and the filter of words and pairs with the least level
    of each. Holds numbers of the whole model too."""

    def __init__(self, words, counts, word_level, pairs, pair_levels, pair_level, totals):
        self.words, self.counts, self.totals, self.pair_level = words, counts, totals, pair_level
        keys = np.concatenate([words, pair_keys(pairs)])
        self.bits, self.bit_count = filter_bits(keys, np.concatenate([levels(counts), pair_levels.astype(np.int64)]))

    def word(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(in the head, level, exact count) of words."""
        if not len(self.words):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.uint8), np.zeros(len(keys), np.int64)
        near = np.minimum(np.searchsorted(self.words, keys), len(self.words) - 1)
        known = self.words[near] == keys
        return known, np.where(known, read_levels(self.bits, self.bit_count, keys), 0), np.where(known, self.counts[near], 0)

    def pair(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(in the head, level) of pairs: one that isn't reads its least level by that many false positives only."""
        level = read_levels(self.bits, self.bit_count, pair_keys(keys))
        known = level >= self.pair_level
        return known, np.where(known, level, 0)


class Chunk:
    """The tokens of a batch of texts, their distinct words and pairs, and what the head knows of them."""

    def __init__(self, texts, head: Head, segments: int):
        buf, off = buffers(texts, lower=True)
        parts = [tokens(buf[off[i]:off[j]], off[i:j + 1] - off[i]) for i, j in row_groups(off, CHUNK)]
        self.hashes = np.concatenate([p[0] for p in parts] or [np.zeros(0, U)])
        self.at = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p[1]) for p in parts] or [np.zeros(0, np.int64)]))]).astype(np.int64)
        two, before = pairs(self.hashes, self.at) if len(self.hashes) else (np.zeros(0, U), np.zeros(0, U))
        self.words, self.word_of = np.unique(self.hashes, return_inverse=True)
        self.pairs, self.pair_of = np.unique(two, return_inverse=True)
        self.known_word, self.word_level, self.count = head.word(self.words)
        self.known_pair, self.pair_level = head.pair(self.pairs)
        # the others by segment, sorted within it
        self.ask_words = self._by_segment(self.words, ~self.known_word, segments)
        self.ask_pairs = self._by_segment(self.pairs, ~self.known_pair, segments)

    @staticmethod
    def _by_segment(keys, wanted, segments):
        place = np.flatnonzero(wanted)
        seg = (keys[place] % U(segments)).astype(np.int64)
        order = np.argsort(seg, kind="stable")
        return place[order], seg[order]

    def check(self) -> int:
        """A checksum of all that is asked for."""
        total = 31 * int(self.words[self.ask_words[0]].sum(dtype=U)) + int(self.pairs[self.ask_pairs[0]].sum(dtype=U))
        return total % (1 << 63)

    def questions(self):
        """(segment, words, pairs) as packed keys."""
        (w, ws), (p, ps) = self.ask_words, self.ask_pairs
        for seg in np.union1d(ws, ps).tolist():
            a, b = np.searchsorted(ws, [seg, seg + 1])
            c, d = np.searchsorted(ps, [seg, seg + 1])
            yield seg, self.words[w[a:b]].tobytes(), self.pairs[p[c:d]].view(np.uint8).reshape(-1, 8)[:, :6].tobytes()

    def answered(self, answers: list[dict]) -> None:
        """Take the answers in, by segment."""
        answers = sorted(answers, key=lambda r: r["seg"])
        asked = self.check()
        counts = np.frombuffer(b"".join(r["counts"] for r in answers), np.int64)
        word = np.frombuffer(b"".join(r["word_levels"] for r in answers), np.uint8)
        pair = np.frombuffer(b"".join(r["pair_levels"] for r in answers), np.uint8)
        if len(word) != len(self.ask_words[0]) or len(pair) != len(self.ask_pairs[0]) or any(r["check"] != asked for r in answers):
            raise RuntimeError("a chunk of documents was read in another way than it was asked for: the input isn't stable")
        self.word_level[self.ask_words[0]], self.count[self.ask_words[0]], self.pair_level[self.ask_pairs[0]] = word, counts, pair

    def scores(self, totals) -> tuple[np.ndarray, ...]:
        """(tokens, known tokens, base score, score) of each text."""
        n_tokens, n_types, n_docs = totals
        worth = np.concatenate([[0], 1.5 * 2.0 ** np.arange(-1, 254)])
        worth[1] = 1.0                                 # level 1 is a count of 1
        c, c2 = worth[self.word_level][self.word_of], worth[self.pair_level][self.pair_of]
        context = np.empty_like(c)
        context[1:] = c[:-1]
        context[self.at[:-1]] = n_docs
        share = c2 / np.maximum(np.maximum(context, c2), 1.0)
        p = PAIR_WEIGHT * share + (1 - PAIR_WEIGHT) * (c + 1) / (n_tokens + n_types + 1)
        base = np.log10((self.count + 1) / (n_tokens + n_types + 1))[self.word_of]
        first = self.at[:-1]
        return (np.diff(self.at), np.add.reduceat((self.count > 0).astype(np.int64)[self.word_of], first),
                np.add.reduceat(base, first), np.add.reduceat(np.log10(np.minimum(p, 1.0)), first))


QUESTION = "chunk long, seg int, check long, words binary, pairs binary"
ANSWER = "chunk long, seg int, check long, word_levels binary, counts binary, pair_levels binary"
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _ask(head, segments: int):
    """The questions of every chunk; a chunk without any asks nothing."""
    def run(batches):
        for batch in batches:
            chunk = Chunk(batch.column("text"), head.value, segments)
            rows = list(chunk.questions())
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("row")[0].as_py()] * len(rows), pa.int64()), pa.array([r[0] for r in rows], pa.int32()),
                     pa.array([chunk.check()] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary()),
                     pa.array([r[2] for r in rows], pa.binary())], ["chunk", "seg", "check", "words", "pairs"])
    return run


def _answer(piece: pa.Table, questions: pa.Table) -> pa.Table:
    """One segment: probe its piece of the filter for every question."""
    if piece.num_rows:
        bits = np.frombuffer(piece.column("bits")[0].as_py(), np.uint8)
        bit_count = piece.column("bit_count")[0].as_py()
        known, counts = (np.frombuffer(piece.column(c)[0].as_py(), t) for c, t in (("words", U), ("counts", np.int64)))
    else:
        bits, bit_count, known, counts = np.zeros(8, np.uint8), 64, np.zeros(0, U), np.zeros(0, np.int64)
    out = []
    for w, p in zip(questions.column("words"), questions.column("pairs")):
        words = np.frombuffer(w.as_py(), U)
        raw = np.frombuffer(p.as_py(), np.uint8).reshape(-1, 6)
        two = np.zeros((len(raw), 8), np.uint8)
        two[:, :6] = raw
        near = np.minimum(np.searchsorted(known, words), max(0, len(known) - 1))
        exact = np.where(known[near] == words, counts[near], 0) if len(known) else np.zeros(len(words), np.int64)
        level = read_levels(bits, bit_count, np.concatenate([words, pair_keys(two.reshape(-1).view(U))]))
        out.append((level[:len(words)].tobytes(), exact.astype(np.int64).tobytes(), level[len(words):].tobytes()))
    same = [questions.column(c) for c in ("chunk", "seg", "check")]
    return pa.Table.from_arrays([*same, *[pa.array([o[i] for o in out], pa.binary()) for i in range(3)]],
                                ["chunk", "seg", "check", "word_levels", "counts", "pair_levels"])


def _score(head, segments: int):
    """The scores of a chunk's documents, from its texts and answers."""
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        texts = texts.combine_chunks()
        column = texts.column("text")
        chunk = Chunk(column.chunk(0) if column.num_chunks else pa.array([], pa.string()), head.value, segments)
        chunk.answered(answers.to_pylist())
        result = chunk.scores(head.value.totals)
        return pa.Table.from_arrays([texts.column("doc_id"), texts.column("held_out"), *[pa.array(x) for x in result]],
                                    ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])
    return run


def _chunks(batches):
    """Documents with the chunk that they are asked for in: the batch that begins with its first row."""
    for batch in batches:
        chunk = pa.array(np.full(batch.num_rows, batch.column("row")[0].as_py()), pa.int64())
        yield pa.RecordBatch.from_arrays([chunk, *batch.columns[1:]], ["chunk", *batch.schema.names[1:]])


def _level_for(by_level: list, most: int) -> int:
    """The least level such that all n-grams from it on are ``most`` at most. ``by_level``: (level, number)."""
    size, least = 0, 65
    for level, n in sorted(by_level, reverse=True):
        if size + n > most:
            break
        size, least = size + n, level
    return least


def fit_head(model: DataFrame, head: int) -> tuple[Head, tuple[int, int, int]]:
    """The head of a model: ``head`` words and as many pairs at most, and the end token, reach the driver."""
    def per_level(column):
        return [tuple(r) for r in model.select(F.posexplode(column).alias("level", "n")).groupBy("level").agg(F.sum("n")).collect()]

    total = model.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).first()
    word_level = max(1, _level_for(per_level("by_level"), head))
    pair_level = max(LEAST_PAIR_LEVEL, _level_for(per_level("pairs_by_level"), head))

    def words(batches):
        for batch in batches:
            for w, c in zip(batch.column("words"), batch.column("counts")):
                keys, counts = np.frombuffer(w.as_py(), np.int64), np.frombuffer(c.as_py(), np.int64)
                own = (levels(counts) >= word_level) | (keys == END.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(keys[own]), pa.array(counts[own])], ["key", "n"])

    def two(batches):
        for batch in batches:
            for w, c in zip(batch.column("pairs"), batch.column("pair_levels")):
                keys, level = np.frombuffer(w.as_py(), np.int64), np.frombuffer(c.as_py(), np.uint8).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys[level >= pair_level]), pa.array(level[level >= pair_level])], ["key", "n"])

    def fetched(columns, how):
        got = model.select(*columns).mapInArrow(how, "key long, n long").toPandas()     # a bounded number of rows
        keys, n = got["key"].to_numpy(np.int64).view(U), got["n"].to_numpy(np.int64)
        order = np.argsort(keys)
        return keys[order], n[order]

    keys, counts = fetched(["words", "counts"], words)
    pair_keys_, pair_levels = fetched(["pairs", "pair_levels"], two)
    totals = (int(total[0]), int(total[1]), int(counts[keys == END].sum()))
    return Head(keys, counts, word_level, pair_keys_, pair_levels, pair_level, totals), totals


def held_out(folds: int = 7, fold: int = 2):
    """Documents kept from training: crc32 of doc_id as text, modulo ``folds``."""
    return F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")) % folds == fold


def score_documents(docs: DataFrame, head: int = HEAD, segments: int | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    docs = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                       F.coalesce("text", F.lit("")).alias("text"))
    train = docs.where(~F.col("held_out")).select("text")
    segments = segments or max(32, docs.rdd.getNumPartitions())    # groups of the same size at any input size
    counted = train.mapInArrow(_count(segments), "seg int, words binary, pairs binary")
    model = cut(counted.groupBy("seg").applyInArrow(_merge, SEGMENT), "ngrams")
    frequent, totals = fit_head(model, head)
    shared = spark.sparkContext.broadcast(frequent)
    # asked for and read again with the same columns, so batches are the same
    questions = docs.mapInArrow(_ask(shared, segments), QUESTION)
    pieces = model.select("seg", "bits", "bit_count", "words", "counts")
    answers = cut(pieces.groupBy("seg").cogroup(questions.groupBy("seg")).applyInArrow(_answer, ANSWER), "answers")
    texts = docs.mapInArrow(_chunks, "chunk long, doc_id long, held_out boolean, text string")
    scored = texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_score(shared, segments), SCORED)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(totals[0]).cast("long").alias("train_tokens"),
                         "base_score", "score")
