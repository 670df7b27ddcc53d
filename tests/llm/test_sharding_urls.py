import math
import os
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewatch.llm.hilbert import hilbert_index, shard_documents, shard_ranges, write_shards
from ratewatch.llm.queries import QUERIES
from ratewatch.llm.urlrules import judge_urls


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_steps_to_neighbours(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    index = hilbert_index(grid, bits)
    assert sorted(index) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(index)], axis=0)).sum(axis=1) == 1).all()


def test_shards_are_even_and_gapless(odd, empty):
    rows = shard_documents(odd, shards=5).collect()
    assert len(rows) == odd.count()
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) == set(range(5)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n))
    expected = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in odd.collect())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == expected
    assert shard_documents(empty).count() == 0
    assert len({r.shard for r in shard_documents(odd.limit(3), shards=40).collect()}) == 3


def test_written_shards_hold_every_row_and_ranges_prune(odd, tmp_path, spark):
    sharded = shard_documents(odd, shards=4)
    write_shards(odd.select("doc_id", "text", "lang", "source"), sharded, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == odd.count()
    ranges = shard_ranges(sharded, ["lang", "size"]).collect()
    assert sum(r["rows"] for r in ranges) == odd.count() and all(r.min_size <= r.max_size for r in ranges)


def test_written_shards_are_the_planned_ones(spark, tmp_path):
    rows = [(i % 3, f"text {i % 3}", "en", "s", "own") for i in range(30)] + [(None, None, None, None, "own"), (None, "x", "de", "s", "own")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _c string").withColumns(
        {"shard": F.lit("mine"), "slot": F.lit("mine"), "row": F.lit(1), "_at": F.lit(2)}).repartition(3)
    sharded = shard_documents(docs, shards=4)
    write_shards(docs, sharded, str(tmp_path / "out"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert set(got.columns) == set(docs.columns)
    planned = Counter((r.shard, r.doc_id) for r in sharded.collect())
    assert Counter((int(r.shard), r.doc_id) for r in got.collect()) == planned
    assert sorted(Counter(s for s, _ in planned.elements()).values()) == [8, 8, 8, 8]
    assert {(r.slot, r._c) for r in got.collect()} == {("mine", "own")}


def test_rows_lie_in_curve_order(odd, prose_docs):
    """The order that is cut is the order of the curve index, then of checksum and doc_id, row by row."""
    docs = odd.select("doc_id", "text", "lang", "source").unionByName(prose_docs.select("doc_id", "text", "lang", "source"))
    rows = sorted(shard_documents(docs, shards=7).collect(), key=lambda r: (r.shard, r.slot))
    keys = [(r.curve, r.text_crc32, r.doc_id is not None, r.doc_id or 0) for r in rows]
    assert keys == sorted(keys)
    n, start = len(rows), [0]
    for r in rows:
        assert r.shard == (start[0] * 7) // n
        start[0] += 1
    # equal language, source and size share a cell; the cells of the sizes follow the sizes
    by = {}
    for r in rows:
        by.setdefault((r.lang, r.source, r["size"]), set()).add(r.curve)
    assert all(len(c) == 1 for c in by.values())


def brute_shards(docs, shards, bits=4):
    """Cells by quantile cuts of language, source and size, curve order, runs; row by row."""
    n, sizes = len(docs), [len((r.text or "").encode()) + 16 for r in docs]

    def ordinals(texts):
        data = [None if t is None else t.encode() for t in texts]
        known = [d for d in data if d is not None]
        shared = len(os.path.commonprefix([min(known, default=b""), max(known, default=b"")]))
        return [None if d is None else float(int.from_bytes(d[shared:shared + 7].ljust(7, b"\0"), "big")) for d in data]

    cells = []
    for values in (ordinals([r.lang for r in docs]), ordinals([r.source for r in docs]), [float(x) for x in sizes]):
        known = sorted(v for v in values if v is not None)
        cuts = {known[max(math.ceil(i / (1 << bits) * len(known)), 1) - 1] for i in range(1, 1 << bits)} if known else set()
        cells.append([0 if v is None else sum(v > c for c in cuts) for v in values])
    curve = hilbert_index(np.array(cells).T.reshape(-1, 3), bits).tolist()
    crc = [zlib.crc32((r.text or "").encode()) for r in docs]
    order = sorted(range(n), key=lambda i: (curve[i], crc[i], docs[i].doc_id is not None, docs[i].doc_id or 0))
    begin, out = Counter(), Counter()
    for rank, i in enumerate(order):
        shard = rank * shards // n
        out[(docs[i].doc_id, sizes[i], crc[i], "rows", shard, begin[shard], None, curve[i])] += 1
        begin[shard] += 1
    return out


def test_shards_query_like_brute_force(spark, odd, prose_docs, tmp_path):
    columns = ["doc_id", "text", "lang", "source"]
    odd.select(columns).unionByName(prose_docs.select(columns)).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet")).collect()
    got = Counter(tuple(r) for r in QUERIES["op1_hilbert_shards"](spark, str(tmp_path)).collect())
    assert got == brute_shards(docs, 40)


def brute_judge(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host = rest[:cut].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    path = rest[cut:].split("?")[0].split("#")[0]
    fit = [(len(h) + len(p), len(h), h + p, v) for v, h, p in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best[2] if best else None, best[3] if best else default


def test_url_rules_like_brute_force(spark):
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"),
             ("block", "a.example.net", "/en/x"), ("allow", "a.example.net", "/en/x/y"), ("block", "example.org", "/")]
    hosts = ["net", "example.net", "A.example.NET", "b.a.example.net", "badexample.net", "example.com", "m.example.com", "x.org",
             "example.org", "", "com", "net.", "example.net:80"]
    paths = ["", "/", "/en/", "/en/x", "/en/x/y/z?q=/en", "/de/1#top", "/fr/", "?q", "#f", "/en"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "no scheme", "http://", "a://b://net/", "http://net/\nx"] * 2
    urls += ["http://hot.example.net/en/1"] * 300
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    given = spark.createDataFrame(rules, "verdict string, host string, path string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, given).collect()}
    assert got == {i: brute_judge(u, rules) for i, u in enumerate(urls)}
    assert judge_urls(pages, given.limit(0)).where("rule is not null or verdict <> 'allow'").count() == 0
    assert judge_urls(pages.limit(0), given).count() == 0
