"""Operators 3, 5, 7 and 10 against brute force."""
import math
import random
import re
import struct
import time
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ratewatch.llm import bloomlm, fertility, langid, pieces
from ratewatch.llm.queries import QUERIES
from ratewatch.llm.textbatch import buffers

from .conftest import CLASH, lower, prose, words

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def rows(df):
    return df.collect()


# ---- LM scoring ---------------------------------------------------------------------------------

def brute_base(docs):
    toks = [(r.doc_id, words(lower(r.text)) + [None]) for r in docs]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    counts = Counter(t for i, w in toks if not held(i) for t in w)
    n, v = sum(counts.values()), len(counts)
    return Counter((i, held(i), len(w), sum(counts[t] > 0 for t in w), n,
                    round(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in w), 5)) for i, w in toks)


@pytest.mark.parametrize("limits", [{}, {"head": 5, "segments": 3}])
def test_base_scores_and_model(odd, prose_docs, empty, limits):
    docs = odd.select("doc_id", "text").unionByName(prose_docs.select("doc_id", "text"))
    got = rows(bloomlm.score_documents(docs, **limits))
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5) + 0.0) for r in got) == brute_base(docs.collect())
    assert all(r.score <= 0 and math.isfinite(r.score) for r in got)
    assert bloomlm.score_documents(empty).count() == 0


def test_an_unstable_chunk_is_an_error(odd):
    head = bloomlm.Head(np.zeros(0, np.uint64), np.zeros(0, np.int64), 65, np.zeros(0, np.uint64), np.zeros(0, np.int64), 65, (0, 0, 0))
    asked, met = (bloomlm.Chunk(pa.array([t]), head, 2) for t in ("a b c", "a b d"))
    rows = [{"seg": s, "check": asked.check(), "word_levels": bytes(len(w) // 8), "counts": bytes(len(w)), "pair_levels": bytes(len(p) // 6)}
            for s, w, p in asked.questions()]
    asked.answered(rows)
    with pytest.raises(RuntimeError, match="stable"):
        met.answered(rows)


def test_filter_holds_levels():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 62, 4000, dtype=np.uint64)
    counts = np.concatenate([np.ones(3000, int), rng.integers(2, 10**6, 1000)])
    table = pa.table({"seg": pa.array([0], pa.int32()), "words": [bloomlm.pack(np.sort(keys), counts[np.argsort(keys)], 8)],
                      "pairs": [bloomlm.pack(np.zeros(0, np.uint64), np.zeros(0, int), 6)]})
    out = bloomlm._merge(table).to_pylist()[0]
    bits = np.frombuffer(out["bits"], np.uint8)
    found = bloomlm.read_levels(bits, out["bit_count"], keys)
    true = np.floor(np.log2(counts)).astype(int) + 1
    assert (found >= true).all() and (found > true).mean() < 0.05
    assert (bloomlm.read_levels(bits, out["bit_count"], rng.integers(0, 1 << 62, 4000, dtype=np.uint64)) > 0).mean() < 0.05


M64 = (1 << 64) - 1


def plain_mix(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & M64
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & M64
    return x ^ x >> 31


class PlainFilter:
    """The filter as a set of bit numbers, its false positives included."""

    def __init__(self, level_of):
        self.size = max(64, sum(level_of.values()) * bloomlm.BITS + 7 & ~7)
        self.bits = {b for k, q in level_of.items() for at in range(1, q + 1) for b in self.places(k, at)}

    def places(self, key, level):
        e = plain_mix((key + level * 0x9E3779B97F4A7C15) & M64)
        return [((e >> 32) + i * (e & 0xFFFFFFFF | 1)) % self.size for i in range(bloomlm.PROBES)]

    def read(self, key):
        level = 0
        while all(b in self.bits for b in self.places(key, level + 1)):
            level += 1
        return level


def plain_scores(docs, segments, most):
    """Scores token by token, from dictionaries of counts and plain filters."""
    own = lambda key: plain_mix(key ^ 0xC2B2AE3D27D4EB4F)  # noqa: E731  (a pair's key in the filter)
    texts = []
    for r in docs:
        buf, off = buffers(pa.array([r.text or ""]), lower=True)
        w = [int(x) for x in bloomlm.tokens(buf, off)[0]]
        two = [plain_mix((a * int(bloomlm.PAIR[0]) + b * int(bloomlm.PAIR[1])) & M64) >> 16 for a, b in zip([int(bloomlm.BEGIN), *w], w)]
        texts.append((r.doc_id, w, two))
    train = [t for t in texts if zlib.crc32(("" if t[0] is None else str(t[0])).encode()) % 7 != 2]
    words, twos = Counter(x for t in train for x in t[1]), Counter(x for t in train for x in t[2])

    def least(counts, floor):
        size, found = 0, 65
        for level, n in sorted(Counter(c.bit_length() for c in counts.values() if c.bit_length() >= floor).items(), reverse=True):
            if size + n > most:
                break
            size, found = size + n, level
        return max(floor, found)

    word_least, pair_least = least(words, 1), least(twos, bloomlm.LEAST_PAIR_LEVEL)
    end = int(bloomlm.END)
    in_head = {w for w, c in words.items() if c.bit_length() >= word_least or w == end}
    head = PlainFilter({**{w: words[w].bit_length() for w in in_head}, **{own(p): c.bit_length() for p, c in twos.items() if c.bit_length() >= pair_least}})
    piece = [PlainFilter({**{w: c.bit_length() for w, c in words.items() if w % segments == s},
                          **{own(p): c.bit_length() for p, c in twos.items() if p % segments == s}}) for s in range(segments)]
    worth = lambda q: 0.0 if q == 0 else 1.0 if q == 1 else 1.5 * 2.0 ** (q - 2)
    n, v, out = words.total(), len(words), Counter()
    for i, w, two in texts:
        score, before = 0.0, float(words[end])
        for a, p in zip(w, two):
            c = worth(head.read(a) if a in in_head else piece[a % segments].read(a))
            q = head.read(own(p))
            c2 = worth(q if q >= pair_least else piece[p % segments].read(own(p)))
            share = c2 / max(before, c2, 1.0)
            score += math.log10(min(1.0, bloomlm.PAIR_WEIGHT * share + (1 - bloomlm.PAIR_WEIGHT) * (c + 1) / (n + v + 1)))
            before = c
        out[i, round(score, 6)] += 1
    return out


@pytest.mark.parametrize("segments,head", [(1, 0), (5, 40), (3, bloomlm.HEAD)])
def test_scores_like_a_plain_filter(spark, segments, head):
    rng = random.Random(8)
    texts = [prose(rng, 6) for _ in range(260)]
    texts += [" ".join(t.split()[:4]) for t in texts[:140]]          # pairs of count 1 and 2, also in held-out documents
    texts += [" ".join(texts[0].split()[:3])] * 60                    # frequent pairs
    docs = spark.createDataFrame([(None if i == 9 else i, None if i == 11 else t) for i, t in enumerate(texts)],
                                 "doc_id long, text string").repartition(3).persist()
    expected = plain_scores(docs.collect(), segments, head)
    got = Counter((r.doc_id, round(r.score, 6)) for r in rows(bloomlm.score_documents(docs, head=head, segments=segments)))
    assert got == expected


def test_filter_holds_pairs_seen_once():
    two = np.sort(np.random.default_rng(2).integers(0, 1 << 48, 3000, dtype=np.uint64))
    counts = np.where(np.arange(3000) % 2, 1, 5)
    none = bloomlm.pack(np.zeros(0, np.uint64), np.zeros(0, int), 8)
    out = bloomlm._merge(pa.table({"seg": pa.array([0], pa.int32()), "words": [none], "pairs": [bloomlm.pack(two, counts, 6)]})).to_pylist()[0]
    found = bloomlm.read_levels(np.frombuffer(out["bits"], np.uint8), out["bit_count"], bloomlm.pair_keys(two))
    assert (found >= np.where(counts == 1, 1, 3)).all() and (found[counts == 1] == 1).mean() > 0.95


# ---- fertility ----------------------------------------------------------------------------------

def brute_counts(text, model):
    w = words(text)
    grams = Counter(zip(w, w[1:], w[2:]))
    inside = {j for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    ids = [t for x in w for t in model.encode(x)]
    share = [c / len(ids) for c in Counter(ids).values()]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside),
            len(ids), sum(model.is_byte(i) for i in ids), round(-sum(p * math.log2(p) for p in share), 6) + 0.0)


def test_fertility_like_brute_force(odd, prose_docs, empty):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = odd.unionByName(prose_docs, allowMissingColumns=True)
    got = rows(fertility.verdicts(fertility.measure(docs, MODEL)))
    for r in got:
        f = r.fertility
        expected = brute_counts(r.text, model)
        assert (*[f[x] for x in fertility.FIELDS], round(f.entropy, 6) + 0.0) == expected, r.text[:80]
        assert r.base_failed == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
        assert r.kept <= (not r.base_failed)
    assert any(r.kept for r in got)
    assert fertility.verdicts(fertility.measure(empty, MODEL)).count() == 0


def brute_script(text):
    """The script of most letters, from the characters' Unicode names; ties go to the first."""
    of = {"LATIN": "Latin", "GREEK": "Greek", "CYRILLIC": "Cyrillic", "RUNIC": "Other", "HEBREW": "Hebrew", "ARABIC": "Arabic", "DEVANAGARI": "Indic",
          "THAI": "Thai", "HANGUL": "Hangul", "CJK": "Han", "HIRAGANA": "Kana", "KATAKANA": "Kana"}
    found = Counter(of[re.split("[ -]", unicodedata.name(c))[0]] for c in text or "" if c.isalpha())
    return max(dict.fromkeys(of.values()), key=lambda s: found[s]) if found else "Other"


def test_fertility_query_like_brute_force(spark, odd, tmp_path):
    import sentencepiece
    model, rng = sentencepiece.SentencePieceProcessor(model_file=MODEL), random.Random(12)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(2, 7)))
    scripts = ["abcdefgh", "αβγδεζηθ", "абвгдежз", "ᚠᛇᚻᛒᛦᚦ", "אבגדהו", "ابتثجح", "कखगघच", "กขคงจ", "가나다라마", "日本語中国人", "あいうえお", "aбaб", "日あ"]
    texts = [" ".join(word(letters) for _ in range(n)) for letters in scripts for n in (40, 90)]
    texts += ["aaaa " * 400, " ".join(f"{i * 7919 % 65536:04x}" * 12 for i in range(80)), " ".join(prose(rng, 60).split() + ["😀🀄"] * 45),
              "internationalisation information " * 2 + " ".join(prose(rng, 1) * 9 for _ in range(60)), "12 34 " * 30 + " ".join(map(str, range(60)))]
    docs = odd.select("doc_id", "text").collect()
    docs = [(r.doc_id, r.text) for r in docs if not {"\ufdd0"} & set(r.text or "")] + [(1000 + i, t) for i, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    expected = Counter()
    for i, text in docs:
        c = dict(zip([*fertility.FIELDS, "entropy"], brute_counts(text, model)))
        script = brute_script(text)
        low, high, most, least = fertility.BANDS.get(script, fertility.BANDS["Other"])
        cpt, share = (c[x] / c["n_tokens"] if c["n_tokens"] else 0.0 for x in ("word_chars", "n_byte_tokens"))
        even = c["entropy"] / min(math.log2(max(c["n_tokens"], 2)), 15.0)
        failed = c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"]
        kept = not failed and low <= cpt <= high and share <= most and (c["n_tokens"] < fertility.ENTROPY_TOKENS or even >= least)
        expected[(i, *[c[f] for f in fertility.FIELDS], script, round(cpt, 6), round(share, 6), round(even, 5), failed, kept)] += 1
    got = Counter((r.doc_id, *[r[f] for f in fertility.FIELDS], r.script, round(r.chars_per_token, 6), round(r.byte_share, 6), round(r.entropy_share, 5) + 0.0,
                   r.base_failed, r.kept) for r in rows(QUERIES["op5_fertility"](spark, str(tmp_path))))
    assert got == expected
    # each rule rejects something here, and every script is met
    assert {x[-1] for x in expected if not x[-2]} == {True, False} and {x[8] for x in expected} >= {brute_script(t) for t in scripts[:11]}


def test_bands_reject_what_the_vocabulary_cannot_read(spark):
    runes = " ".join("ᚠᛇᚻ᛫ᛒᛦᚦ" + chr(0x16A0 + i % 60) for i in range(80))
    hexes = " ".join(f"{i * 7919 % 65536:04x}" * 12 for i in range(80))
    same = "aaaa " * 400
    docs = spark.createDataFrame([(1, hexes), (2, same), (3, runes)], "doc_id long, text string")
    got = {r.doc_id: r for r in rows(fertility.verdicts(fertility.measure(docs, MODEL)))}
    assert not got[2].kept and got[3].fertility.script == "Other" and got[3].byte_share > 0.5


# ---- pieces -------------------------------------------------------------------------------------

def brute_segment(text, vocabulary, names):
    """Dynamic programme over all pieces ending at each place, longest first."""
    marked, table = text.replace("\u2581", "\ufdd1").replace(" ", "\u2581"), {}
    for i, (p, s) in enumerate(zip(names, vocabulary.scores)):
        if s:
            table[p] = i
    best, last = [0], [None]
    for end in range(1, len(marked) + 1):
        top, how = best[end - 1] + vocabulary.spelt, -1
        for start in range(max(0, end - 50), end):
            i = table.get(marked[start:end])
            if i is not None and best[start] + vocabulary.scores[i] > top:
                top, how = best[start] + vocabulary.scores[i], i
        best.append(top)
        last.append(how)
    out, end = [], len(marked)
    while end:
        if last[end] == -1:
            end -= 1
            out += [int(vocabulary.byte_ids[b]) for b in reversed(text[end].encode())]
        else:
            out.append(last[end])
            end -= len(names[last[end]])
    return out[::-1]


def test_segmentation_like_brute_force():
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    names = [model.id_to_piece(i) for i in range(model.vocab_size())]
    vocabulary = pieces.load_vocabulary(MODEL)
    texts = ["Hello world, this is internationalisation.", "  two  spaces \n\n and\tlines ", "ñandú 日本語 😀 ▁x \u0000\ufdd0", "aaaaaaa", " ", "\n", "x" * 400]
    flat, counts = pieces.Encoder(vocabulary).encode(pa.array(texts + ["", None]))
    ends = np.cumsum(counts)
    for t, a, b in zip(texts, ends - counts, ends):
        assert flat[a:b].tolist() == brute_segment(" " + t, vocabulary, names), t
    assert counts[-2:].tolist() == [0, 0]


def test_pieces_across_spaces_are_one_unit():
    names = ["a", "b", "\u2581", "a\u2581b", "\u2581a"] + [f"<{b}>" for b in range(256)]
    vocabulary = pieces.Vocabulary(names, [-3.0, -3.0, -3.0, -1.0, -2.0] + [math.nan] * 256, list(range(5, 261)))
    assert not vocabulary.by_unit
    flat, _ = pieces.Encoder(vocabulary).encode(pa.array(["a b ba b"]))
    assert flat.tolist() == brute_segment(" a b ba b", vocabulary, names)


def test_long_units_in_chunks_like_whole_ones(monkeypatch):
    vocabulary, rng = pieces.load_vocabulary(MODEL), random.Random(4)
    spaced = pieces.Vocabulary(["a", "b", "\u2581", "ab", "a\u2581b", "\u2581a", "bab" * 9] + [f"<{b}>" for b in range(256)],
                               [-3.0, -3.0, -3.0, -5.0, -1.0, -2.0, -30.0] + [math.nan] * 256, list(range(7, 263)))
    units = ["x" * 700, " " * 300, "".join(chr(rng.randrange(33, 127)) for _ in range(900)), "short", "", "internationalisation" * 40,
             "".join(rng.choice("ab\u2581日本語のé😀\u0000") for _ in range(800)), " word", "y" * 65]
    mixed = ["".join(rng.choice("ab ") for _ in range(n)) for n in (900, 64, 65, 0, 300)]
    whole = [v.segment(u) for v, u in ((vocabulary, units), (spaced, mixed))]
    for chunk, lanes in ((64, 2000), (40, 3), (1, 1)):
        monkeypatch.setattr(pieces, "LONG", 64)
        monkeypatch.setattr(pieces, "LONG_CHUNK", chunk)
        monkeypatch.setattr(pieces, "LONG_LANES", lanes)
        for (ids, counts), v, u in zip(whole, (vocabulary, spaced), (units, mixed)):
            got = v.segment(u)
            assert got[0].tolist() == ids.tolist() and got[1].tolist() == counts.tolist()


def test_texts_are_segmented_half_a_megabyte_at_a_time():
    """What is worked on at once bounds a worker's memory: a step holds some fifty bytes per byte of text."""
    rng, sizes = random.Random(6), []
    texts = pa.array([prose(rng, 9000) for _ in range(30)])
    encoder = pieces.Encoder(pieces.load_vocabulary(MODEL))
    lists = encoder.units.lists
    encoder.units.lists = lambda raw, *rest: (sizes.append(len(raw)), lists(raw, *rest))[1]
    flat, counts = encoder.encode(texts)
    assert sum(sizes) > 1 << 20 and max(sizes) <= (1 << 19) + len(texts)
    alone = [pieces.Encoder(encoder.vocabulary).encode(texts.slice(i, 1)) for i in (0, 17, 29)]
    off = np.concatenate([[0], np.cumsum(counts)])
    for i, (ids, _) in zip((0, 17, 29), alone):
        assert ids.tolist() == flat[off[i]:off[i + 1]].tolist()


def test_a_word_of_four_million_characters_takes_seconds():
    vocabulary, rng = pieces.load_vocabulary(MODEL), random.Random(5)
    word = rng.randbytes(2_000_000).hex()
    begin = time.monotonic()
    flat, counts = pieces.Encoder(vocabulary).encode(pa.array([word]))
    assert time.monotonic() - begin < 60
    out, sizes = vocabulary.decode(flat, counts)
    assert bytes(out) == word.encode() and sizes.tolist() == [len(word)]


def unigram_file(named):
    """A unigram model file (protocol buffer) of pieces and scores, after <unk> and the byte pieces."""
    number = lambda n: bytes([n]) if n < 128 else bytes([n & 127 | 128]) + number(n >> 7)
    whole = lambda field, n: number(field << 3) + number(n)
    part = lambda field, data: number(field << 3 | 2) + number(len(data)) + data
    piece = lambda text, score, kind: part(1, part(1, text.encode()) + number(2 << 3 | 5) + struct.pack("<f", score) + whole(3, kind))
    out = piece("<unk>", 0.0, 2) + b"".join(piece(f"<0x{b:02X}>", 0.0, 6) for b in range(256))
    out += b"".join(piece(p, s, 1) for p, s in named)
    trainer = whole(3, 1) + whole(35, 1) + whole(40, 0) + whole(41, (1 << 64) - 1) + whole(42, (1 << 64) - 1) + whole(43, (1 << 64) - 1)
    return out + part(2, trainer) + part(3, part(1, b"identity") + whole(3, 1) + whole(4, 0) + whole(5, 1))


def test_ids_of_a_unigram_file_are_the_librarys(tmp_path):
    import sentencepiece
    rng = random.Random(6)
    names = list("abcdeé日本\u2581") + list({rng.choice(["", "\u2581"]) + "".join(rng.choice("abcdeé日本") for _ in range(rng.randint(2, 5))) for _ in range(400)})
    path = tmp_path / "unigram.model"
    path.write_bytes(unigram_file([(n, -rng.uniform(2.0, 12.0)) for n in names]))
    texts = ["".join(rng.choice("abcdeé日本 q😀\n") for _ in range(n)) for n in [*range(1, 60), 3000]] + ["", "abc" * 1500, "  a  b "]
    model = sentencepiece.SentencePieceProcessor(model_file=str(path))
    flat, counts = pieces.Encoder(pieces.load_vocabulary(str(path))).encode(pa.array(texts))
    ends = np.cumsum(counts)
    assert [flat[a:b].tolist() for a, b in zip(ends - counts, ends)] == model.encode(texts)


def test_round_trip_of_every_text(odd, empty):
    coded = pieces.encode(odd, MODEL)
    got = rows(pieces.decode(coded, MODEL))
    assert len(got) == odd.count()
    for r in got:
        assert r.decoded == r.text and r.round_trip == (None if r.text is None else True)
        assert (r.token_ids is None) == (r.text is None) and r.n_tokens == (None if r.text is None else len(r.token_ids))
        assert r._d == "own"
    assert pieces.encode(empty, MODEL).count() == 0


def test_sentencepiece_query_like_brute_force(spark, odd, tmp_path):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    names = [model.id_to_piece(i) for i in range(model.vocab_size())]
    vocabulary = pieces.load_vocabulary(MODEL)
    docs = [r for r in odd.select("doc_id", "text").collect() if len(r.text or "") < 5000]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    expected = Counter()
    for r in docs:
        ids = None if r.text is None else tuple(brute_segment(" " + r.text, vocabulary, names)) if r.text else ()
        spelt = None if ids is None else sum(model.is_byte(i) for i in ids)
        expected[r.doc_id, None if ids is None else len(ids), spelt, None if ids is None else True, ids] += 1
    got = Counter((r.doc_id, r.n_tokens, r.n_byte_tokens, r.round_trip, None if r.token_ids is None else tuple(r.token_ids))
                  for r in rows(QUERIES["op7_sentencepiece"](spark, str(tmp_path))))
    assert got == expected


# ---- language ID --------------------------------------------------------------------------------

def brute_ngrams(text):
    folded = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text or "")
    out = Counter()
    for w in folded.split():
        w = f" {w} "
        out.update(w[i:i + n] for n in (1, 2, 3) for i in range(len(w) - n + 1) if w[i:i + n].strip())
    return out


def test_ngrams_like_brute_force(odd):
    texts = [r.text for r in odd.collect()] + ["ab", "ba", "İß ǅ", "a" * 9]
    buf, off = buffers(pa.array(texts))
    got = [Counter() for _ in texts]
    for r, key, n in zip(*langid.ngram_counts(buf, off)):
        got[r]["".join(chr(c) for c in (key >> 42, key >> 21 & 0x1FFFFF, key & 0x1FFFFF) if c).replace("\x01", " ")] += int(n)
    assert got == [brute_ngrams(t) for t in texts]


def test_prediction_like_brute_force(spark, odd, empty):
    other = "der die das und nicht sein haben werden mit auf für ist den von zu ein eine über schön größer"
    docs = odd.select("doc_id", "text", "lang", *CLASH).unionByName(spark.createDataFrame(
        [(100 + i, " ".join(other.split()[i % 7:]) * 3, "xx") for i in range(20)], "doc_id long, text string, lang string"), allowMissingColumns=True)
    train = [r for r in docs.collect() if zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 4 != 2]
    place = {}
    for lang in sorted({r.lang for r in train if r.lang and r.text is not None}):
        total = sum((brute_ngrams(r.text) for r in train if r.lang == lang and r.text is not None), Counter())
        first = sorted(total, key=lambda g: (-total[g], len(g), g.replace(" ", "\x01")))[:langid.PLACES]
        place[lang] = {g: i for i, g in enumerate(first)}
    for r in rows(langid.predict_languages(docs)):
        own = brute_ngrams(r.text)
        mine = sorted(own, key=lambda g: (-own[g], len(g), g.replace(" ", "\x01")))[:langid.PLACES]
        if not mine:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        far = {x: sum(abs(p.get(g, 10**6) - i) if g in p else langid.PLACES for i, g in enumerate(mine)) for x, p in place.items()}
        best = min(sorted(far), key=far.get)
        assert r.lang_pred == best and abs(r.score - (1 - far[best] / (len(mine) * langid.PLACES))) < 1e-9
    assert langid.predict_languages(empty).count() == 0
    assert {r.lang_pred for r in rows(langid.predict_languages(odd.withColumn("lang", odd.lang.substr(9, 1)).where("lang is null or lang <> ''")))} >= {"und"}


def test_a_language_under_one_doc_id_is_learned(spark):
    german = "der die das und nicht sein haben werden mit auf für ist den von zu ein eine über schön größer".split()
    rows = [(7, " ".join(german[i % 11:] + german[:i % 5] + [f"wort{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}"]), "de") for i in range(3000)]
    rows += [(i, "the of and to in is that for it with as was on are be this", "en") for i in range(20)]
    rows += [(7, "one text many times", "xx")] * 500 + [(1, "... 12", "yy")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    names, keys, table = langid.fit_profiles(docs, fit_rows=100)
    assert names == ["de", "en", "xx"] and all((table[:, i] < langid.PLACES).any() for i in range(3))
    with pytest.raises(ValueError, match="languages"):
        langid.fit_profiles(docs, languages=3)
