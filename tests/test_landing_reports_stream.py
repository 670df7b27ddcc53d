import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from ratewatch.plans import reports
from ratewatch.sources.landing import landing_to_pages, read_landing, write_landing
from ratewatch.streaming.landing_stream import start_landing_stream


def _pages(spark):
    docs = [{"data": {"products": [{"productId": "a"}]}, "links": {"next": ""}},
            {"data": {"products": [{"productId": "b", "fees": []}]}},
            "not json {"]
    rows = [(dt.date(2026, 2, 10), "prov 1", "banking:get-products", i + 1,
             d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "ingestion_date date, provider_id string, endpoint string, page_num long, content string")


def test_landing_round_trip(spark):
    root = tempfile.mkdtemp(prefix="landing-")
    src = _pages(spark)
    write_landing(src, root)
    assert os.path.isdir(os.path.join(root, "ingestion_date=2026-02-10", "provider=prov_1",
                                      "endpoint=banking_get-products", "page=0001"))
    back = read_landing(spark, root)
    got = sorted((r.page_num, r.content) for r in back.collect())
    assert got == sorted((r.page_num, r.content) for r in src.collect())
    pages = landing_to_pages(back).collect()
    assert sorted(r.http_status for r in pages) == [0, 200, 200]


def test_csv_and_summary(spark):
    out = tempfile.mkdtemp(prefix="report-")
    df = spark.createDataFrame([("p1", 'Brand "X"', None)], "provider_id string, brand_name string, tier_name string")
    assert reports.write_csv(df, f"{out}/rate_changes", one_file=True)
    text = "".join(open(os.path.join(f"{out}/rate_changes", f)).read()
                   for f in os.listdir(f"{out}/rate_changes") if f.endswith(".csv"))
    assert text == 'provider_id,brand_name,tier_name\np1,"Brand ""X""",\n'
    assert not reports.write_csv(df.limit(0), f"{out}/empty")
    cov = spark.createDataFrame([(1, 1)], "providers_discovered long, providers_ok long")
    lines = reports.pipeline_summary_lines(dt.date(2026, 2, 10), [], cov, None, None)
    assert "- Providers discovered: **1**" in lines
    reports.write_lines(spark, lines, f"{out}/summary")
    written = spark.read.text(f"{out}/summary").collect()
    assert [r.value for r in written][0] == "# Pipeline summary — 2026-02-10"


def test_stream_ingest(spark):
    root = tempfile.mkdtemp(prefix="landing-")
    out = tempfile.mkdtemp(prefix="stream-out-")
    ck = tempfile.mkdtemp(prefix="stream-ck-")
    write_landing(_pages(spark), root)
    q = start_landing_stream(spark, root, out, ck)
    q.awaitTermination(120)
    pages = spark.read.parquet(f"{out}/products_raw")
    assert pages.count() == 3
    fps = spark.read.parquet(f"{out}/schema_fingerprint")
    assert fps.count() == 2
    assert fps.select(F.countDistinct("fingerprint_hash")).first()[0] == 2


def test_landing_joined_to_call_log(spark):
    import hashlib
    root = tempfile.mkdtemp(prefix="landing-")
    src = _pages(spark)
    write_landing(src, root)
    body = json.dumps({"data": {"products": [{"productId": "a"}]}, "links": {"next": ""}})
    log = spark.createDataFrame(
        [("run-1", "prov 1", "banking:get-products", "https://x/p1", 200, 3, dt.datetime(2026, 2, 10, 1), None,
          hashlib.sha256(body.encode()).hexdigest())],
        "run_id string, provider_id string, endpoint string, url string, http_status int, responded_xv int, "
        "fetched_at timestamp, etag string, payload_hash string")
    rows = landing_to_pages(read_landing(spark, root), call_log=log).collect()
    hit = [r for r in rows if r.run_id == "run-1"]
    assert len(hit) == 1 and hit[0].provider_id == "prov 1" and hit[0].endpoint == "banking:get-products"
    assert hit[0].url == "https://x/p1" and hit[0].page_num == 1
    assert sum(1 for r in rows if r.run_id is None) == 2


def test_a_body_that_ends_in_a_newline_keeps_its_bytes(spark, tmp_path):
    folder = tmp_path / "ingestion_date=2026-02-10" / "provider=p" / "endpoint=e" / "page=0001"
    folder.mkdir(parents=True)
    (folder / "body.json").write_bytes(b'{"a": 1}\n')
    assert [r.content for r in read_landing(spark, str(tmp_path)).collect()] == ['{"a": 1}\n']
    out = str(tmp_path / "again")
    src = spark.createDataFrame([(dt.date(2026, 2, 10), "p", "e", 1, "x\n\n")],
                                "ingestion_date date, provider_id string, endpoint string, page_num long, content string")
    write_landing(src, out)
    assert [r.content for r in read_landing(spark, out).collect()] == ["x\n\n"]


def test_a_replayed_batch_gives_the_same_rows(spark):
    root, out, ck = (tempfile.mkdtemp(prefix=p) for p in ("landing-", "stream-out-", "stream-ck-"))
    write_landing(_pages(spark), root)

    def state():
        return [sorted(map(str, spark.read.parquet(f"{out}/{t}").drop("payload").collect()))
                for t in ("products_raw", "schema_fingerprint", "schema_drift_event")]

    start_landing_stream(spark, root, out, ck).awaitTermination(120)
    first = state()
    again = tempfile.mkdtemp(prefix="stream-ck-")
    start_landing_stream(spark, root, out, again).awaitTermination(120)     # batch 0 once more
    assert state() == first


def test_files_under_their_exact_names(spark):
    from ratewatch.sources.landing_files import land_files, read_files
    root = tempfile.mkdtemp(prefix="landing-")
    src = _pages(spark).unionByName(spark.createDataFrame([(dt.date(2026, 2, 11), "prov 1", "banking:get-products", 12345, "ñ\r\n\n"),
                                                           (dt.date(2026, 2, 11), "p/2", "banking:get-products", 1, None)], _pages(spark).schema))
    index = land_files(src, root).collect()
    one = os.path.join(root, "ingestion_date=2026-02-11", "provider=prov_1", "endpoint=banking_get-products", "page=12345.json")
    assert open(one, "rb").read() == "ñ\r\n\n".encode() and len(index) == 5
    names = [f for _, _, files in os.walk(root) for f in files if ".json" in f and f.endswith(".json") and not f.startswith(".page")]
    assert sorted(names) == ["page=0001.json", "page=0001.json", "page=0002.json", "page=0003.json", "page=12345.json"]
    want = sorted((r.page_num, r.content or "") for r in src.collect())
    assert sorted((r.page_num, r.content) for r in read_files(spark, root).collect()) == want
    # without the index too; Spark's file reader leaves empty files out
    assert sorted((r.page_num, r.content) for r in read_landing(spark, root).collect()) == [w for w in want if w[1]]
    # a date that is landed again replaces its part of the index
    land_files(src.filter("page_num = 12345"), root)
    assert read_files(spark, root).count() == 4 and read_files(spark, root, "ingestion_date = '2026-02-11'").count() == 1
