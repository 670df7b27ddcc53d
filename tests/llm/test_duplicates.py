"""Operators 2, 6, 8, 9 and the pipeline against brute force."""
import hashlib
from collections import Counter, defaultdict, namedtuple

import pytest

from ratewatch.llm.components import components
from ratewatch.llm.decontam import contaminated_pairs, decontaminate
from ratewatch.llm.linededup import dedup_lines
from ratewatch.llm.neardup import keep_one, near_duplicates
from ratewatch.llm.queries import QUERIES
from ratewatch.llm.substrings import remove_repeats

from .conftest import lower, words


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (103, 102), (101, 102), (7, 7), (200, 199), (200, 199)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(2, 61)}, 101: 100, 102: 100, 103: 100, 200: 199}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- near duplicates ----------------------------------------------------------------------------

def brute_components(docs):
    sets = [shingles(lower(r.text)) for r in docs]
    parent = list(range(len(docs)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                x, y = find(parent, i), find(parent, j)
                parent[max(x, y)] = min(x, y)
    least = defaultdict(list)
    for i, r in enumerate(docs):
        least[find(parent, i)].append(r.doc_id)
    out = Counter()
    for i, r in enumerate(docs):
        ids = [x for x in least[find(parent, i)] if x is not None]
        own = min(ids) if ids else None
        out[(r.doc_id, len(sets[i]), own, r.doc_id == own)] += 1
    return out


@pytest.mark.parametrize("which", ["odd", "prose_docs"])
def test_near_duplicates_like_brute_force(request, which):
    docs = request.getfixturevalue(which)
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs).collect())
    assert got == brute_components(docs.collect())


def test_a_large_group_of_near_copies(spark):
    """Variants of one text, each pair alike or linked by others, stay one component; unlike ones
    that share a passage don't join."""
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(base[:i] + [f"x{i}"] + base[i + 1:])) for i in range(150)]
    rows += [(1000 + i, " ".join(base[:90] + [f"u{i}_{j}" for j in range(60)])) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_duplicates(docs).collect()}
    assert {got[i] for i in range(150)} == {0}
    assert all(got[1000 + i] == 1000 + i for i in range(40))


def test_keep_one_and_empty(odd, empty):
    kept = keep_one(odd)
    assert kept.columns == odd.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[0] == 2 and not ids[1] and not ids[2] and not ids[3] and ids[8] == 1 and not ids[9]     # row 0 is there twice
    assert near_duplicates(empty).count() == 0 and keep_one(empty).count() == 0


def test_near_dedup_stage_leaves_one_row_of_each_group(spark, empty):
    import random

    import corpus_pipeline as P

    from .conftest import prose
    rng = random.Random(4)
    same, no_id, variants, alone = (prose(rng, 90) for _ in range(4))
    near = variants.split()
    near[40] = "changed"
    rows = [(1, same, "en")] * 30 + [(None, no_id, "en")] * 20 + [(None, no_id.upper(), "en"), (2, variants, "en"), (2, " ".join(near), "en"),
            (3, alone, "en"), (3, prose(rng, 90), "de"), (4, prose(rng, 90), "en"), (None, same, "en"), (1, same, "de"), (5, None, "en"), (5, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    left = P.near_dedup(spark, docs, "").collect()
    group = lambda t: (t or "").lower().replace("changed", variants.split()[40])
    assert Counter(r.doc_id for r in left) == {1: 1, None: 1, 2: 1, 3: 2, 4: 1, 5: 2}
    assert len({group(r.text) for r in left if r.text}) == 6 == sum(r.text is not None for r in left)
    assert all(tuple(r) in rows for r in left)
    assert P.near_dedup(spark, empty, "").count() == 0


# ---- repeated substrings ------------------------------------------------------------------------

def brute_removed(docs, span=200):
    texts = [(r.doc_id, (r.text or "").encode()) for r in docs]
    seen = Counter(b[i:i + span] for _, b in texts for i in range(len(b) - span + 1))
    out = Counter()
    for i, b in texts:
        gone, stop = bytearray(len(b)), 0
        for p in range(len(b) - span + 1):
            if seen[b[p:p + span]] > 1:
                gone[max(p, stop):p + span] = b"\1" * (p + span - max(p, stop))
                stop = p + span
        kept = bytes(x for x, g in zip(b, gone) if not g)
        starts = sum(1 for j in range(len(b)) if gone[j] and not (j and gone[j - 1]))
        out[(i, len(b), sum(gone), starts, hashlib.sha256(kept).hexdigest())] += 1
    return out


@pytest.mark.parametrize("which,hot", [("odd", 20_000), ("prose_docs", 20_000), ("prose_docs", 2)])
def test_repeated_substrings_like_brute_force(request, which, hot):
    docs = request.getfixturevalue(which)
    got = Counter(tuple(r) for r in remove_repeats(docs, hot_pieces=hot).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
    expected = brute_removed(docs.collect())
    assert got == expected, list((got - expected).items())[:3]


def test_queries_like_brute_force(spark, odd, prose_docs, tmp_path):
    odd.select("doc_id", "text").unionByName(prose_docs.select("doc_id", "text")).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet")).collect()
    near = QUERIES["op2_near_duplicates"](spark, str(tmp_path)).select("doc_id", "n_shingles", "component_id", "kept")
    assert Counter(map(tuple, near.collect())) == brute_components(docs)
    left = QUERIES["op6_repeated_substrings"](spark, str(tmp_path)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert Counter(map(tuple, left.collect())) == brute_removed(docs)


def test_repeated_substrings_of_nothing(empty):
    assert remove_repeats(empty).count() == 0


def test_hash_collisions_are_settled_on_bytes(monkeypatch):
    import numpy as np

    from ratewatch.llm import substrings as S
    rng = np.random.default_rng(5)
    piece = rng.integers(97, 123, 230, dtype=np.uint8)
    other = piece.copy()
    other[5] = 64
    buf = np.concatenate([piece, other, piece[10:]])
    true = S.repeated_windows(buf, np.array([0, 230]), np.array([31, 31]), np.array([0, 0]), np.array([30, 30]))
    assert true[0].tolist() == [6, 6] and true[1].tolist() == [30, 30]
    monkeypatch.setattr(S, "span_hash", lambda sums, starts, sizes: np.zeros(len(starts), np.uint64))
    low, high = S.repeated_windows(buf, np.array([0, 230]), np.array([31, 31]), np.array([0, 0]), np.array([30, 30]))
    assert (low.tolist(), high.tolist()) == (true[0].tolist(), true[1].tolist())


# ---- line runs ----------------------------------------------------------------------------------

def brute_lines(docs, least):
    """Deletes line by line: a line goes if a run of ``least`` characters or more over it occurs earlier."""
    keyed = sorted({(r.doc_id is not None, r.doc_id or 0, r.text) for r in docs if r.text is not None})
    lines = [[(n, x) for n, x in enumerate(t.split("\n")) if words(x)] for *_, t in keyed]
    place = defaultdict(list)
    for d, own in enumerate(lines):
        for i, (_, x) in enumerate(own):
            place[x].append((d, i))
    out = {}
    for d, own in enumerate(lines):
        gone = set()
        for i, (_, x) in enumerate(own):
            for e, j in place[x]:
                if (e, j) < (d, i):
                    n = 0
                    while i + n < len(own) and j + n < len(lines[e]) and own[i + n][1] == lines[e][j + n][1]:
                        n += 1
                    if sum(len(own[i + m][1]) for m in range(n)) >= least:
                        gone.update(range(i, i + n))
        out[keyed[d]] = gone, own
    return out


@pytest.mark.parametrize("least", [1, 12, 100])
def test_line_runs_like_brute_force(spark, odd, least):
    import random
    rng = random.Random(least)
    made = [(50 + i, "\n".join(rng.choice(["a", "bb b", "ccc c c", "dd", " ", "", "long line with several words " * 2]) for _ in range(rng.randint(0, 14))))
            for i in range(60)]
    rows = [(r.doc_id, r.text) for r in odd.collect()] + made
    # rows that share a doc_id are ordered by a hash of the text: left to the other tests
    twice = {i for i, n in Counter(r[0] for r in rows).items() if n > 1 and i != 0}
    docs = spark.createDataFrame([r for r in rows if r[0] not in twice], "doc_id long, text string")
    expected = brute_lines(docs.collect(), least)
    for r, s in zip(sorted(docs.collect(), key=str), sorted(dedup_lines(docs, least).collect(), key=lambda r: str((r.doc_id, r.text)))):
        assert s.doc_id is not None or s.text is None
    source = {(r.doc_id, r.text) for r in docs.collect()}
    got = defaultdict(list)
    for r in dedup_lines(docs, least).collect():
        got[r.doc_id].append(r)
    for i, text in source:
        for r in got[i]:
            if text is None:
                assert (r.text, r.n_lines, r.n_deleted, r.n_runs) == (None, 0, 0, 0)
                continue
            gone, own = expected[(i is not None, i or 0, text)]
            assert (r.n_lines, r.n_deleted) == (len(own), len(gone)), (i, text[:60])
            assert r.n_runs == sum(1 for x in gone if x - 1 not in gone)
            assert [x for x in r.text.split("\n") if words(x)] == [x for k, (_, x) in enumerate(own) if k not in gone]
            if not gone:
                assert r.text == text


def test_line_runs_keep_columns_and_rows(odd, empty):
    out = dedup_lines(odd)
    assert out.count() == odd.count() and set(odd.columns) < set(out.columns)
    assert {r._d for r in out.collect()} == {"own"}
    assert dedup_lines(empty).count() == 0


# ---- decontamination ----------------------------------------------------------------------------

def brute_pairs(docs, items):
    out = set()
    for i in items:
        own = shingles((i.text or "").lower())
        for d in docs:
            both = len(own & shingles((d.text or "").lower()))
            if own and both >= 0.75 * len(own):
                out.add((d.doc_id, i.item_id, len(own), both))
    return out


def test_contaminated_pairs_like_brute_force(spark, prose_docs, odd, monkeypatch):
    from ratewatch.llm import decontam
    docs = prose_docs.select("doc_id", "text").unionByName(odd.select((odd.doc_id + 1000).alias("doc_id"), "text"))
    texts = [r.text for r in docs.collect() if r.text]
    parts = [" ".join(t.split()[3:3 + n]) for t, n in zip(texts, [8, 20, 45, 60, 4, 90, 70, 12] * 4)]
    edited = [" ".join(w if k % 21 else "edited" for k, w in enumerate(p.split())) for p in parts]
    items = spark.createDataFrame(list(enumerate(parts + edited + ["", None, "one two", "unseen words only here now and then"])), "item_id long, text string")
    expected = brute_pairs(docs.collect(), items.collect())
    for rows in (decontam.BROADCAST_ROWS, 0):
        monkeypatch.setattr(decontam, "BROADCAST_ROWS", rows)
        got = [tuple(r) for r in contaminated_pairs(docs, items).select("doc_id", "item_id", "n_item", "n_shared").collect()]
        assert set(got) == expected and len(got) == len(expected)
    kept = {r.doc_id for r in decontaminate(docs, items).collect()}
    assert kept == {r.doc_id for r in docs.collect()} - {d for d, *_ in expected}


def test_items_without_an_id_and_items_that_share_one(spark):
    import random

    from ratewatch.llm import decontam
    from .conftest import prose
    rng = random.Random(4)
    texts = [prose(rng, n) for n in (12, 30, 70, 200)]
    rows = [(None, texts[0]), (5, texts[1]), (5, texts[2]), (6, texts[3]), (6, texts[3]), (None, texts[3])]
    items = spark.createDataFrame([(*r, 1) for r in rows], "item_id long, text string, _i int")
    docs = spark.createDataFrame([(i, prose(rng, 20) + " " + t + " " + prose(rng, 20)) for i, t in enumerate(texts)] + [(9, prose(rng, 90))],
                                 "doc_id long, text string")
    got = Counter((r.doc_id, r.item_id) for r in contaminated_pairs(docs, items).collect())
    assert got == Counter([(0, None), (1, 5), (2, 5), (3, 6), (3, None)])
    assert [r.doc_id for r in decontaminate(docs, items).collect()] == [9]
    sizes = {r.n_item: r.part for r in decontam.item_shingles(items).select("n_item", "part").distinct().collect()}
    assert sizes == {8: 3, 26: 4, 66: 6, 196: 7}
    bounds = [(decontam.coordinates(p), decontam.least_hits(p)) for p in range(decontam.PARTS)]
    assert bounds == sorted(bounds) and bounds[5] == (32, 11) and bounds[-1][0] == 64


def test_decontamination_of_nothing(spark, odd, empty):
    items = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    assert contaminated_pairs(empty, items).count() == 0 and contaminated_pairs(odd, items.limit(0)).count() == 0
    assert decontaminate(odd, items).count() == odd.count() and decontaminate(odd, items).columns == odd.columns


# ---- pipeline -----------------------------------------------------------------------------------

def test_pipeline_stages(spark, odd, empty, tmp_path):
    import corpus_pipeline as P
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa")], "item_id long, text string")
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    extra = spark.createDataFrame([(500, "intro words\nalpha beta gamma delta epsilon zeta eta theta iota kappa and more")], "doc_id long, text string")
    docs = odd.where("doc_id is not null").unionByName(extra, allowMissingColumns=True)
    before = docs
    for name, stage in P.STAGES:
        after = stage(spark, before, str(tmp_path))
        if name != P.STAGES[-1][0]:
            assert after.columns == docs.columns
        path = str(tmp_path / name)
        after.write.parquet(path)
        before = spark.read.parquet(path)
    rows = before.collect()
    ids = Counter(r.doc_id for r in rows)
    assert not {1, 2, 3, 4, 5, 6, 500} & set(ids)               # copies, near copies, no language, benchmark
    assert {10, 14, 17} <= set(ids) and all(r.round_trip for r in rows)
    for name, stage in P.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def brute_pipeline(docs, items):
    """All five stages, one document after the other; doc_ids are unique and no line is blank."""
    import sentencepiece

    from ratewatch.llm import pieces
    from ratewatch.llm.queries import VOCABULARY
    from .test_texts import brute_segment
    Doc = namedtuple("Doc", "doc_id text")
    kept = [Doc(r.doc_id, r.text) for r in docs if any(c.isalpha() for c in r.text or "")]
    after = []
    for (_, i, _), (gone, own) in brute_lines(kept, 100).items():
        if len(gone) < len(own):
            after.append(Doc(i, "\n".join(x for k, (_, x) in enumerate(own) if k not in gone)))
    alone = {i for i, n, own, first in brute_components(after) if n == 0 or first}
    after = [d for d in after if d.doc_id in alone]
    bad = {d for d, *_ in brute_pairs(after, items)}
    model = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)
    names = [model.id_to_piece(i) for i in range(model.vocab_size())]
    vocabulary = pieces.load_vocabulary(VOCABULARY)
    return {d.doc_id: (d.text, len(d.text), brute_segment(" " + d.text, vocabulary, names)) for d in after if d.doc_id not in bad}


def test_pipeline_like_brute_force(spark, tmp_path):
    import random

    import corpus_pipeline as P
    from .conftest import prose
    rng = random.Random(21)
    base = [prose(rng, rng.randint(8, 70)) for _ in range(30)]
    passage, items = prose(rng, 40), [prose(rng, n) for n in (9, 25, 60)]
    texts = base + base[:4]                                                          # copies: line dedup takes them
    texts += [" ".join(w if k != 5 else "other" for k, w in enumerate(t.split())) for t in base[4:14]]
    texts += [prose(rng, 12) + "\n" + passage + "\n" + prose(rng, 9 + i) for i in range(6)]
    texts += [prose(rng, 8) + "\n" + x + "\n" + prose(rng, 30) for x in items] + [items[2] + " " + prose(rng, 3)]
    texts += ["... 12 !", "9 9 9", None, "", passage, "two words", "two words"]
    rng.shuffle(texts)
    rows = [(i, t, "en" if i % 2 else "xx", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    bench = spark.createDataFrame([(None, items[0]), (4, items[1]), (4, items[2]), (5, None), (6, "")], "item_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r.doc_id: (r.text, r.n_chars, list(r.token_ids)) for r in P.run(spark, str(tmp_path)).collect()}
    expected = brute_pipeline(docs.collect(), bench.collect())
    assert got == expected and 25 < len(got) < len(texts) - 15


def test_registered_queries():
    import __spark_entry__ as E
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in E.queries()
