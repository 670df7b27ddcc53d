"""Operator 7, SentencePiece encoding and decoding: Viterbi over pieces found by Aho-Corasick.

An Aho-Corasick automaton over all pieces reads the text once. Where pieces end (the automaton's
node and its output links, longest first), the best score up to their start plus their own score
relaxes the best score there; a character that no piece covers is spelt as byte tokens. Following
the kept last pieces backwards gives the best segmentation. The automaton is a few arrays, and a
task moves all its units through it side by side, one character a step.

Spaces are written as U+2581 and one is put in front, as in the public format; a literal U+2581 is
spelt in bytes, so decoding gives back every text exactly. A file of log-probabilities is used with its own
scores. A file that carries merge ranks (whole numbers) has none, so a piece's score is its log-probability under
the Zipf-Mandelbrot law of its rank (fixed values below). Pieces that the file marks as unused stay out. Equal scores keep the longest last
piece.

No piece goes on past a space into the next word or spans a line end (checked when the vocabulary
is loaded, which else takes whole texts as units), so the best segmentation of a text is that of its
units, each a word with the spaces before it; a task segments each distinct unit once and keeps it, up to a
bound. One narrow pass, no shuffle; the vocabulary is broadcast, at most ``PIECES`` pieces.

A unit longer than ``LONG`` characters (a line of Han, base64, a text of a vocabulary whose pieces span spaces)
is cut into chunks that also go side by side. No piece is longer than ``reach`` characters, so what lies before
a chunk acts on it only by the best scores of the ``reach`` places up to its start. Each chunk is first scored
from each of these places alone; taking the best of sums over them, chunk after chunk, gives the
true scores at every chunk's start, and from these all chunks relax again, now for good. Scores are whole
numbers, so scores, ties and ids are those of the plain pass.

Null text: null ids, decoded as null. Empty text: no ids, decoded as empty. Unknown ids in decoding
give nothing. Invalid byte sequences decode with U+FFFD. Very long texts are one unit list, very long units
go in chunks; repeated rows encode alike. Empty tables give no rows; other columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import packed, unpacked
from .textbatch import SpanCache, buffers, gathered, row_groups, span_hashes, strings

SPACE = "\u2581"
#: Vocabulary bound for the broadcast, distinct units that a task keeps, bytes worked on at once.
PIECES, KEPT_UNITS, CHUNK = 1_000_000, 300_000, 1 << 19
#: Units of more characters go in chunks of ``LONG_CHUNK``, ``LONG_LANES`` chunks at once.
LONG, LONG_CHUNK, LONG_LANES = 2048, 512, 2048
#: Below every score that a text can have, and still far from overflow when two are added.
NEVER = -(1 << 60)
#: Zipf-Mandelbrot offset, and what a spelt-out character scores below the rarest piece.
ZIPF_OFFSET, SPELT = 2.7, 10.0
#: Scores are kept in whole steps of 1 / this.
SCALE = 1 << 20
#: Pieces of several characters that the file scores below this are never used there.
UNUSED = -1e8


class Vocabulary:
    """Pieces, scores and the Aho-Corasick automaton over them, as arrays."""

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: list[int]):
        """``scores``: NaN keeps a piece out of matching. ``byte_ids``: ids of the 256 byte tokens."""
        usable = [i for i, s in enumerate(scores) if s == s and pieces[i]]
        self.byte_ids = np.array(byte_ids)
        # whole numbers: sums are exact, so ties are the same in any grouping of units
        self.scores = np.rint(np.nan_to_num(np.array(scores, float)) * SCALE).astype(np.int64)
        self.lengths = np.array([len(p) for p in pieces])
        self.reach = int(self.lengths[usable].max(initial=1))
        self.spelt = int(self.scores[usable].min(initial=0) - SPELT * SCALE)
        #: units may be cut out only where no piece crosses
        self.by_unit = not any(SPACE in pieces[i].lstrip(SPACE) or "\n" in pieces[i] for i in usable)
        blobs = [b""] * len(pieces)
        for i in usable:
            blobs[i] = pieces[i].replace(SPACE, " ").encode()
        for b, i in enumerate(byte_ids):
            blobs[i] = bytes([b])
        self.sizes = np.array([len(x) for x in blobs], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.blob = np.frombuffer(b"".join(blobs), np.uint8)
        self._automaton(pieces, usable)

    @classmethod
    def of(cls, state: dict) -> "Vocabulary":
        """A vocabulary again from ``vars()`` of one: plain arrays are what is broadcast."""
        made = cls.__new__(cls)
        made.__dict__.update(state)
        return made

    def _automaton(self, pieces: list[str], usable: list[int]) -> None:
        children: list[dict[int, int]] = [{}]
        ends = [-1]                               # the piece that ends at a node
        for i in usable:
            node = 0
            for c in map(ord, pieces[i]):
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    ends.append(-1)
                node = children[node][c]
            ends[node] = i
        fail, link, level = [0] * len(children), [0] * len(children), [0]
        while level:                              # nodes of one depth after the other
            below = []
            for node in level:
                for c, child in children[node].items():
                    back = fail[node]
                    while back and c not in children[back]:
                        back = fail[back]
                    if node:
                        fail[child] = children[back].get(c, 0)
                    link[child] = fail[child] if ends[fail[child]] >= 0 else link[fail[child]]
                    below.append(child)
            level = below
        edges = sorted((node << 21 | c, child) for node, own in enumerate(children) for c, child in own.items())
        self.edge_keys = np.array([k for k, _ in edges], np.int64)
        self.edge_to = np.array([to for _, to in edges], np.int64)
        self.fail, self.link, self.ends = np.array(fail), np.array(link), np.array(ends)

    def step(self, state: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Next node for each pair of node and code point."""
        out, open_ = np.zeros_like(state), np.arange(len(state))
        if not len(self.edge_keys):
            return out
        while len(open_):
            key = state[open_] << 21 | points[open_]
            at = np.minimum(np.searchsorted(self.edge_keys, key), len(self.edge_keys) - 1)
            hit = self.edge_keys[at] == key
            out[open_[hit]] = self.edge_to[at[hit]]
            open_ = open_[~hit]
            open_ = open_[state[open_] > 0]
            state = state.copy()
            state[open_] = self.fail[state[open_]]
        return out

    def segment(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Joined ids of the best segmentations of all units, and the number of each. Spaces count
        as the pieces' space mark."""
        sizes = np.array([len(u) for u in units], np.int64)
        original = np.frombuffer("".join(units).encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
        points = np.where(original == 0x20, 0x2581, np.where(original == 0x2581, 0, original))
        order = np.argsort(-sizes, kind="stable")
        long = order[sizes[order] > LONG]
        order = order[len(long):]
        starts = (np.cumsum(sizes) - sizes)[order]
        base = starts + order                     # places of best[] before the first character
        ordered = sizes[order]
        best = np.zeros(len(points) + len(units), np.int64)
        last = np.full(len(best), -1, np.int64)
        state = np.zeros(len(units), np.int64)
        for t in range(int(ordered[0]) if len(order) else 0):
            n = int(np.searchsorted(-ordered, -t, "left"))
            state[:n] = self.step(state[:n], points[starts[:n] + t])
            at = base[:n] + t + 1
            best[at] = best[at - 1] + self.spelt
            node = np.where(self.ends[state[:n]] >= 0, state[:n], self.link[state[:n]])
            live = np.flatnonzero(node)
            while len(live):
                piece, to = self.ends[node[live]], at[live]
                score = best[to - self.lengths[piece]] + self.scores[piece]
                better = score > best[to]
                best[to[better]], last[to[better]] = score[better], piece[better]
                node[live] = self.link[node[live]]
                live = live[node[live] > 0]
        # back from every unit's end, all units side by side
        place, who, ids, spot = ordered.copy(), [], [], []
        live = np.flatnonzero(place)
        while len(live):
            piece = last[base[live] + place[live]]
            plain = piece < 0
            place[live] -= np.where(plain, 1, self.lengths[piece])
            point = original[np.minimum(starts[live] + place[live], len(original) - 1)]
            who.append(order[live])
            spot.append(place[live])
            ids.append(np.where(plain, -1 - point, piece))
            live = live[place[live] > 0]
        if len(long):
            begin = (np.cumsum(sizes) - sizes)[long]
            for unit, a, (piece, at) in zip(long, begin, self._long(points, begin, sizes[long])):
                who.append(np.full(len(at), unit))
                spot.append(at)
                ids.append(np.where(piece < 0, -1 - original[a + at], piece))
        if not who:
            return np.zeros(0, np.int32), sizes
        who, ids, spot = np.concatenate(who), np.concatenate(ids), np.concatenate(spot)
        sort = np.lexsort((spot, who))
        ids, who = ids[sort], who[sort]
        plain = np.flatnonzero(ids < 0)
        if len(plain):                            # a spelt character becomes its bytes' tokens
            spelt = [self.byte_ids[list(chr(-1 - x).encode("utf-8", "replace"))] for x in ids[plain].tolist()]
            size = np.ones(len(ids), np.int64)
            size[plain] = [len(x) for x in spelt]
            out, who = np.repeat(ids, size), np.repeat(who, size)
            out[np.repeat(ids < 0, size)] = np.concatenate(spelt)
            ids = out
        return ids.astype(np.int32), np.bincount(who, minlength=len(units))

    def _long(self, points: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each long unit, the pieces of its best segmentation (-1: a spelt character), last one
        first, and where in the unit each starts."""
        reach, size = self.reach, max(LONG_CHUNK, self.reach)
        chunks = -(-sizes // size)
        own = np.repeat(np.arange(len(sizes)), chunks)               # the unit of each chunk
        first = np.cumsum(chunks) - chunks
        number = np.arange(len(own)) - first[own]
        last = np.empty((len(own), size), np.int32)
        start = np.zeros(reach, np.int64)
        for a in range(0, len(own), LONG_LANES):
            unit, n = own[a:a + LONG_LANES], number[a:a + LONG_LANES]
            nodes = self._chunk_nodes(points, begin[unit], n * size, sizes[unit], size)
            alone = np.full((len(unit), reach, reach), NEVER)        # place scored from, place back from the start
            alone[:, np.arange(reach), np.arange(reach)] = 0
            ends = self._relaxed(nodes, alone)[0]
            starts = np.empty((len(unit), reach), np.int64)
            for k in range(len(unit)):                               # ``start`` goes on into the next round of chunks
                if n[k] == 0:
                    start = np.full(reach, NEVER)
                    start[0] = 0
                starts[k] = start
                start = (start[:, None] + ends[k]).max(axis=0)
            last[a:a + len(unit)] = self._relaxed(nodes, starts[:, None, :], True)[1]
        for a, k, length in zip(first, chunks, sizes):
            yield self._back(last[a:a + k].reshape(-1)[:length])

    def _chunk_nodes(self, points, begin, shift, length, size) -> np.ndarray:
        """(place, chunk) -> the node of the longest piece that ends there, 0 for none. The automaton is at its right
        node after the ``reach`` characters before a chunk."""
        out = np.zeros((size, len(begin)), np.int64)
        state = np.zeros(len(begin), np.int64)
        for t in range(-self.reach, size):
            at = shift + t
            inside = (at >= 0) & (at < length)
            state = self.step(state, np.where(inside, points[np.where(inside, begin + at, 0)], -1))
            if t >= 0:
                out[t] = np.where(self.ends[state] >= 0, state, self.link[state])
        return out

    def _relaxed(self, nodes: np.ndarray, start: np.ndarray, keep: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """``start`` (chunk, variant, j): scores j places before a chunk's first character end. The scores at
        the chunk's end in the same form and, with ``keep``, the last pieces (chunk, place) of the first variant."""
        size, reach = len(nodes), self.reach
        ring = np.ascontiguousarray(np.moveaxis(start, 2, 0)[::-1])  # place t of the chunk at (t - 1) % reach
        last = np.full((nodes.shape[1], size), -1, np.int32) if keep else None
        for t in range(size):
            top = ring[(t - 1) % reach] + self.spelt
            node = nodes[t].copy()
            live = np.flatnonzero(node)
            while len(live):
                piece = self.ends[node[live]]
                score = ring[(t - self.lengths[piece]) % reach, live] + self.scores[piece][:, None]
                if keep:
                    better = score[:, 0] > top[live, 0]
                    last[live[better], t] = piece[better]
                top[live] = np.maximum(top[live], score)
                node[live] = self.link[node[live]]
                live = live[node[live] > 0]
            ring[t % reach] = top
        return np.stack([ring[(size - 1 - j) % reach] for j in range(reach)], axis=2), last

    def _back(self, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From the end of a unit along its last pieces."""
        lengths, place, spots = self.lengths.tolist(), len(last), []
        while place:
            low = max(0, place - 2 * CHUNK)
            block, found = last[low:place].tolist(), []
            while place > low:
                piece = block[place - low - 1]
                place -= 1 if piece < 0 else lengths[piece]
                found.append(place)
            spots.append(np.array(found))
        spots = np.concatenate(spots)
        return last[np.concatenate([[len(last)], spots[:-1]]) - 1], spots

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Joined bytes of all texts and the bytes of each, without the space put in front."""
        known = (ids >= 0) & (ids < len(self.sizes))
        safe = np.where(known, ids, 0)
        sizes = np.where(known, self.sizes[safe], 0)
        out = gathered(self.blob, self.starts[safe], sizes)
        off = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]
        front = off[:-1][np.diff(off) > 0]
        lead = np.zeros(len(out), bool)
        lead[front[out[front] == 0x20]] = True
        lengths = np.diff(off) - np.diff(np.concatenate([[0], np.cumsum(lead)])[off])
        return out[~lead], lengths


def load_vocabulary(model_path: str) -> Vocabulary:
    """The vocabulary of a public model file with byte-fallback pieces."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    size = model.vocab_size()
    if size > PIECES:
        raise ValueError(f"{model_path} has {size} pieces; up to {PIECES} are broadcast")
    pieces = [model.id_to_piece(i) for i in range(size)]
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    if not all(model.is_byte(i) for i in byte_ids):
        raise ValueError(f"{model_path} has no byte-fallback pieces")
    norm = math.log(math.log(size))
    scores = [math.nan] * size
    plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    ranked = all(model.get_score(i).is_integer() for i in plain)
    for i in plain:
        rank = -model.get_score(i)
        if not ranked:
            if not model.is_unused(i):
                scores[i] = -rank
        elif rank < -UNUSED or len(pieces[i]) == 1:
            scores[i] = -math.log(ZIPF_OFFSET + min(max(rank, 0.0), size)) - norm
    return Vocabulary(pieces, scores, byte_ids)


def unit_bounds(buf: np.ndarray, off: np.ndarray, by_unit: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of units (spaces and the word after them, or a line end), per row the first."""
    cut = np.zeros(len(buf) + 1, bool)
    cut[off] = True
    if by_unit and len(buf):
        space, line = buf == 0x20, buf == 0x0A
        cut[:-1] |= line
        cut[1:] |= line
        cut[1:-1] |= space[1:] & ~space[:-1]
    cuts = np.flatnonzero(cut)
    return cuts[:-1], cuts[1:], np.searchsorted(cuts, off)


class Encoder:
    """Encodes batches; units segmented once are kept by their hash."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.units = SpanCache(vocabulary.segment, KEPT_UNITS)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Joined ids of all texts and the number of ids of each."""
        buf, off = buffers(column)
        flat, counts = [np.zeros(0, np.int32)], np.zeros(len(column), np.int64)
        for i, j in row_groups(off, CHUNK):
            b, o = buf[off[i]:off[j]], off[i:j + 1] - off[i]
            some = np.diff(o) > 0                 # the space in front of every text that isn't empty
            b = np.insert(b, o[:-1][some], 0x20)
            o = o + np.concatenate([[0], np.cumsum(some)])
            starts, ends, first = unit_bounds(b, o, self.vocabulary.by_unit)
            ids, sizes = self.units.lists(bytes(b), starts, ends, span_hashes(b, starts, ends))
            flat.append(ids)
            counts[i:j] = np.diff(np.concatenate([[0], np.cumsum(sizes)])[first])
        return np.concatenate(flat), counts


def _lists(flat: np.ndarray, counts: np.ndarray, null: np.ndarray) -> pa.Array:
    off = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat, pa.int32()), mask=pa.array(null) if null.any() else None)


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """Add ``token_ids``, ``n_tokens``, ``n_byte_tokens`` and ``round_trip`` (decoding the ids gave
    the text back, byte by byte)."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(load_vocabulary(model_path)))

    def run(batches):
        vocabulary = Vocabulary.of(shared.value)
        encoder = Encoder(vocabulary)
        is_byte = np.zeros(len(vocabulary.sizes), bool)
        is_byte[vocabulary.byte_ids] = True
        for column in batches:
            null = column.is_null().to_numpy(zero_copy_only=False)
            flat, counts = encoder.encode(column)
            off = np.concatenate([[0], np.cumsum(counts)])
            spelt = np.diff(np.concatenate([[0], np.cumsum(is_byte[flat])])[off])
            out, sizes = vocabulary.decode(flat, counts)
            buf, at = buffers(column)
            same = np.diff(at) == sizes
            if same.all() and len(out) == len(buf):
                wrong = np.concatenate([[0], np.cumsum(out != buf)])[at]
                same = np.diff(wrong) == 0
            else:                                 # not met so far: the texts one by one
                back = strings(out, sizes).to_pylist()
                same = np.array([bytes(buf[a:b]) == x for a, b, x in zip(at, at[1:], back)], bool)
            yield pa.StructArray.from_arrays(
                [_lists(flat, counts, null), pa.array(counts, mask=null), pa.array(spelt, mask=null), pa.array(same, mask=null)],
                ["token_ids", "n_tokens", "n_byte_tokens", "round_trip"])

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    coded = F.arrow_udf(run, "token_ids array<int>, n_tokens long, n_byte_tokens long, round_trip boolean")
    return unpacked(packed(docs, coded=coded(F.col("text"))), docs.columns, **{
        name: F.col("coded")[name] for name in ("token_ids", "n_tokens", "n_byte_tokens", "round_trip")})


def decode(df: DataFrame, model_path: str, ids: str = "token_ids", to: str = "decoded") -> DataFrame:
    """Add the text that a column of ids stands for."""
    shared = df.sparkSession.sparkContext.broadcast(vars(load_vocabulary(model_path)))

    def run(batches):
        vocabulary = Vocabulary.of(shared.value)
        for column in batches:
            null = column.is_null().to_numpy(zero_copy_only=False)
            flat = column.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            counts = np.where(null, 0, column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            texts = [None if n else b.decode("utf-8", "replace")
                     for n, b in zip(null, strings(*vocabulary.decode(flat, counts)).to_pylist())]
            yield pa.array(texts, pa.string())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return df.withColumn(to, F.arrow_udf(run, "string")(F.col(ids)))
