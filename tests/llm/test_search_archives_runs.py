"""Operators 11, 12 and 13 against brute force and by round trips."""
import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ratewatch.llm import lexical, periodic, queries, warc

from .conftest import lower, prose, words

# ---- ranked search ------------------------------------------------------------------------------


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text))


def brute_search(docs, items, top=10):
    counted = [(r.doc_id, Counter(terms(r.text))) for r in docs]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = Counter()
    for item in items:
        scores = []
        for i, c in counted:
            m = 100 - 90 + (90 * c.total() * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in set(terms(item.text)) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        for rank, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:top], 1):
            out[item.item_id, rank, i, -s] += 1
    return out


@pytest.fixture(scope="module")
def items(spark, prose_docs):
    texts = [r.text for r in prose_docs.limit(12).collect()] + ["", None, "nothing of this ZZZZ", "TH er 日本語 on", "th th th"]
    rows = [(i, t, "own") for i, t in enumerate(texts)] + [(3, texts[1], "own"), (None, texts[2], "own"), (3, texts[1], "own")]
    return spark.createDataFrame(rows, "item_id long, text string, tid string")


@pytest.mark.parametrize("top,size", [(10, None), (3, 20)])
def test_ranked_search(odd, prose_docs, items, top, size, monkeypatch):
    if size:                                           # many slices and blocks: stages prune in each
        monkeypatch.setattr(lexical, "SLICE", size)
        monkeypatch.setattr(lexical, "BLOCK", 4)
    docs = odd.select("doc_id", "text", F.lit(1).alias("row"), F.lit(2).alias("slice")).unionByName(
        prose_docs.select("doc_id", "text", F.lit(1).alias("row"), F.lit(2).alias("slice")))
    got = Counter(tuple(r) for r in lexical.ranked_search(docs, items, top).collect())
    assert got == brute_search(docs.collect(), items.collect(), top)


def test_ranked_search_of_nothing(empty, prose_docs, items):
    assert lexical.ranked_search(empty, items).count() == 0
    assert lexical.ranked_search(prose_docs, items.limit(0)).count() == 0


def test_stages_prune_exactly():
    """A document that can't reach the slice's best any more goes, one that can stays."""
    import pyarrow as pa
    plan = [{"owner": 0, "tid": 0, "w": 10, "most": 0}, {"owner": 3, "tid": 1, "w": 1, "most": 50}]
    left = pa.table({"iid": [1], "item_id": [1], "slice": [0], "block": [0], "plan": pa.array([plan], lexical.PLAN),
                     **{c: pa.array([[]], pa.list_(pa.int64())) for c in ("rows", "ids", "scores")}})
    right = pa.table({"row": [1, 2, 3], "id": [1, 2, 3], "tid": [0, 0, 0], "impact": [100, 96, 10]})
    assert lexical._stage(0, 1)(left, right).column("rows").to_pylist() == [[1, 2]]


# ---- archives -------------------------------------------------------------------------------------

PAGES = [(1, "https://a.example/x", "<p>one</p>"), (2, "https://a.example/y", "<p>one</p>"), (3, None, None), (4, "u\r\nX: y", ""),
         (None, "https://b.example/", "<p>one</p>"), (5, "https://b.example/ü", "é\r\n\r\nWARC/1.1\r\n日本"), (6, "z", "x" * 300_000),
         (2, "https://a.example/y", "<p>one</p>"), (7, "z", "x" * 300_000), (8, "w", "alone")]


@pytest.fixture(scope="module")
def pages(spark):
    df = spark.createDataFrame([(*p, "own") for p in PAGES], "page_id long, url string, html string, row string")
    return df.withColumns({c: F.lit(1) for c in ("id", "payload", "same", "response")}).coalesce(1)


def expected_pages(rows, least=0):
    by = {}
    for place, (i, _, html) in enumerate(rows):
        data = (html or "").encode()
        if len(data) >= least:
            by.setdefault(data, []).append((-1 if i is None else i, place))
    out = Counter()
    for place, (i, _, html) in enumerate(rows):
        data = (html or "").encode()
        top = max(by[data]) if data in by else (0, place)
        kind = "response" if top[1] == place else "revisit"
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out[i, len(data), digest, kind, None if kind == "response" else rows[top[1]][0], True] += 1
    return out


@pytest.mark.parametrize("least,options", [(0, {}), (1, {"compression": "none"}), (9, {"rollBytes": "1"})])
def test_archive_round_trip(spark, pages, tmp_path, least, options):
    path = str(tmp_path / "a")
    warc.register(spark)
    warc.with_revisits(pages, path, min_bytes=least).write.format("warc").mode("append").options(path=path, **options).save()
    assert Counter(tuple(r) for r in warc.resolve(spark, path).collect()) == expected_pages(PAGES, least)
    whole = warc.read_archive(spark, path).where("record_type = 'response'").collect()
    assert sum(r.payload.decode() == "é\r\n\r\nWARC/1.1\r\n日本" for r in whole) == 1
    assert {r.target_uri for r in whole} >= {"u%0D%0AX: y", "https://b.example/ü"}
    assert all(r.headers["warc-type"] == r.record_type for r in whole)


def test_filters_reach_the_reader(spark, pages, tmp_path):
    path = str(tmp_path / "a")
    warc.write_archive(pages, path)
    columns = ["record_type", "target_uri", "content_length"]

    def left_to_spark(df):
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
        return [x for x in df._jdf.queryExecution().explainString(mode).split("\n") if "Filter " in x]

    some = warc.read_archive(spark, path, columns, [("record_type", "=", "response"), ("target_uri", "startswith", "https://"),
                                                    ("content_length", ">", 10)])
    assert all(" = " not in x and "StartsWith" not in x and ">" not in x for x in left_to_spark(some))
    assert Counter(r.target_uri for r in some.collect()) == {"https://a.example/y": 1, "https://b.example/ü": 1}
    # a frame may be read by several queries, each with more filters of its own
    some = warc.read_archive(spark, path, columns, [("record_type", "in", ["response", "revisit"])])
    assert some.where("target_uri IS NULL").count() == 1
    assert some.where("NOT target_uri = 'w'").union(some.where("target_uri = 'w'")).count() == 9
    assert some.count() == len(PAGES)
    whole = warc.read_archive(spark, path, columns)
    assert whole.where("target_uri = 'w'").count() == 1
    assert whole.where("record_type = 'warcinfo' OR target_uri = 'w'").count() == 2
    for how, value, n in (("isnull", None, 2), ("isnotnull", None, 9), ("contains", "exa", 5), ("endswith", "y", 3), ("<=", "https://a.example/x", 1),
                          ("<", "https://b", 3), (">=", "w", 3)):
        assert warc.read_archive(spark, path, columns, [("target_uri", how, value)]).count() == n, how
    once = spark.read.format("warc").schema("target_uri string").option("pushFilters", "all").load(path).where("NOT target_uri LIKE 'https%'")
    assert once.count() == 4


def test_unwanted_payloads_are_not_inflated():
    rec = warc.record_bytes("response", [("WARC-Record-ID", "<a>"), ("Content-Type", "text/plain")], bytes(range(256)) * 40_000)
    small = warc.record_bytes("resource", [("WARC-Record-ID", "<b>"), ("Content-Type", "text/plain")], b"kept")
    import gzip
    import io

    class Counting(io.BytesIO):
        read_bytes = 0

        def read(self, n=-1):
            data = super().read(n)
            self.read_bytes += len(data)
            return data

    import random as r
    noise = r.Random(1).randbytes(5 << 20)
    rec = warc.record_bytes("response", [("WARC-Record-ID", "<a>"), ("Content-Type", "text/plain")], noise)
    for data, skips in ((warc.gzip_member(rec) + warc.gzip_member(small), True), (rec + small, True),
                        (gzip.compress(rec) + gzip.compress(small), False)):
        file = Counting(data)
        got = list(warc.records(file, len(data), lambda h: h["warc-type"] == "resource", True))
        assert [(h["warc-record-id"], p) for h, p in got] == [("<b>", b"kept")]
        assert (file.read_bytes < len(data) / 2) == skips
        assert [p for _, p in warc.records(Counting(data), len(data), lambda h: True, True)] == [noise, b"kept"]
    assert gzip.decompress(warc.gzip_member(rec)) == rec
    with pytest.raises(ValueError, match="several records"):
        list(warc.records(io.BytesIO(gzip.compress(small * 3)), len(gzip.compress(small * 3)), lambda h: True, True))
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(gzip.compress(small)[:-12]), len(gzip.compress(small)) - 12, lambda h: True, True))


def test_failed_tasks_leave_nothing(spark, pages, tmp_path):
    """Files that no commit lists aren't read; foreign folders are read whole."""
    path = tmp_path / "a"
    warc.write_archive(pages, str(path))
    n = warc.read_archive(spark, str(path)).count()
    stray = warc.gzip_member(warc.record_bytes("resource", [("WARC-Record-ID", "<s>")], b"s"))
    (path / "part-stray.warc.gz").write_bytes(stray)
    assert warc.read_archive(spark, str(path)).count() == n
    foreign = tmp_path / "foreign"
    foreign.mkdir()
    (foreign / "x.warc.gz").write_bytes(stray)
    (foreign / "notes.txt").write_text("no archive")
    assert [r.record_type for r in warc.read_archive(spark, str(foreign)).collect()] == ["resource"]
    assert warc.resolve(spark, str(foreign)).count() == 0


def test_archive_of_nothing(spark, pages, tmp_path):
    path = str(tmp_path / "a")
    warc.write_archive(pages.limit(0), path)
    assert warc.resolve(spark, path).count() == 0


# ---- periodic runs ----------------------------------------------------------------------------------


def brute_runs(w):
    found = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j + q - i
            if j > i and n >= max(6, 4 * q) and not any(all(w[x] == w[x + p] for x in range(i, i + n - p)) for p in range(1, q)):
                found.append((i, n, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {x for s, n, q in runs for x in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def repeated_texts(seed=7):
    rng = random.Random(seed)
    texts = ["", None, " \n", "a a a a a a", "a a a a a", "a b " * 9, " ".join("abaab"), "x " * 5000, "é 日 " * 40]
    for _ in range(60):
        alphabet = [prose(rng, 1) for _ in range(rng.choice([1, 2, 3, 40]))]
        w = [rng.choice(alphabet) for _ in range(rng.randint(0, 50))]
        for _ in range(rng.randint(0, 4)):
            unit = [rng.choice(alphabet) for _ in range(rng.randint(1, 70))]
            w += (unit * 8)[:int(len(unit) * rng.uniform(3, 7))] + [rng.choice(alphabet) for _ in range(rng.randint(0, 20))]
        texts.append(rng.choice([" ", "\n", "\t "]).join(w))
    fib = ["a", "b"]
    for _ in range(14):
        fib = [fib[1], fib[1] + fib[0]]
    texts += [" ".join(fib[1]), " ".join(str(bin(i).count("1") % 2) for i in range(3000))]
    return texts


def test_periodic_runs(spark, odd):
    rows = [(i, t, "own", "own") for i, t in enumerate(repeated_texts())]
    docs = spark.createDataFrame(rows + rows[5:7], "doc_id long, text string, runs string, found string").repartition(3)
    for df in (docs, odd):
        got = periodic.periodic_runs(df)
        assert len(got.columns) == len(set(got.columns)) and set(df.columns) <= set(got.columns)
        for r in got.collect():
            w = words(r.text)
            runs = brute_runs(w)
            assert [tuple(x) for x in r.runs] == runs and r.n_words == len(w)
            assert r.collapsed == (None if r.text is None else collapsed(w, runs))
    assert periodic.periodic_runs(odd.limit(0)).count() == 0


def test_period_scales():
    """One run of every period on both sides of the scales' borders, in one long text."""
    import numpy as np
    rng = random.Random(3)
    for q in (1, 7, 8, 9, 15, 16, 17, 32, 33, 64, 65, 127, 128, 129, 1000):
        unit = [rng.randrange(10**9) for _ in range(q)]
        n = max(6, 4 * q)
        names = [*range(50), *(unit * 7)[:n], *range(100, 150)]
        assert periodic.find_runs(np.array(names), np.array([0, len(names)])).tolist() == [[50, n, q]]
        assert not len(periodic.find_runs(np.array(names[:50 + n - 1]), np.array([0, 50 + n - 1])))


def test_words_of_one_hash_stay_apart(monkeypatch):
    import numpy as np
    monkeypatch.setattr(periodic, "span_hashes", lambda buf, s, e: np.zeros(len(s), np.uint64))
    text = np.frombuffer(b"a bb a bb c", np.uint8)
    assert periodic.word_names(text, np.array([0, 2, 5, 7, 10]), np.array([1, 4, 6, 9, 11])).tolist() == [0, 1, 0, 1, 2]


def test_query_columns(spark, tmp_path):
    """The registered query, with the periodic tails of its contract."""
    texts = repeated_texts(9)
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, "a " * 9)], "doc_id long, text string").write.parquet(
        str(tmp_path / "documents.parquet"))
    got = {r.doc_id: tuple(r)[1:] for r in queries.op13_periodic_runs(spark, str(tmp_path)).collect()}
    planted = 0
    for i, t in [*enumerate(texts), (None, "a " * 9)]:
        w, h = words(t), zlib.crc32(b"" if i is None else str(i).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            planted += 1
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[x] if x < a else w[a + (x - a) % p] for x in range(n)]
        runs = brute_runs(w)
        top = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None, None, None)
        text = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert got[i] == (len(runs), *top, 1000 * top[1] // top[2] if runs else None,
                          hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(collapsed(w, runs).encode()).hexdigest())
    assert planted > 3
