import datetime as dt
import tempfile

from pyspark.sql import functions as F

from ratewatch.plans import testbed
from ratewatch.plans.jobs import build_and_write, write_reports

SF = "/root/testdata/sf0.001"


def test_build_write_and_report(spark):
    out = tempfile.mkdtemp(prefix="models-")
    pages = testbed.landed_pricing_pages(spark, SF)
    build_and_write(pages, out)
    dim = spark.read.parquet(f"{out}/dim_products")
    assert dim.count() > 0
    mart = spark.read.parquet(f"{out}/mart_rate_changes")
    d = dt.date(1998, 1, 1)
    n_before = mart.filter(F.col("as_of_date") == F.lit(d)).count()
    n_total = mart.count()
    # incremental rebuild of one date leaves the other partitions alone
    build_and_write(pages, out, as_of=d)
    mart2 = spark.read.parquet(f"{out}/mart_rate_changes")
    assert mart2.count() == n_total
    assert mart2.filter(F.col("as_of_date") == F.lit(d)).count() == n_before
    lines = write_reports(spark, d, f"{out}/reports", rate_changes_path=f"{out}/mart_rate_changes",
                          coverage_path=None, drift_path=f"{out}/no_such_table")
    assert lines[0] == "# Pipeline summary — 1998-01-01"
    assert "- mart_provider_coverage not available (expected mart_provider_coverage)" in lines
    assert any(line.startswith("| Brand ") for line in lines)


def _page(day, rate, n=1):
    import json
    payload = {"data": {"products": [{"productId": "a", "depositRates": [{"depositRateType": "FIXED", "rate": rate}]}] * n}, "links": {}}
    return ("run", "p", "B", "banking:get-products", f"https://x/{day}", 1, 200, 3, dt.datetime.fromisoformat(f"{day}T01:00:00"), None,
            json.dumps(payload), "h", day)


PAGE = ("run_id string, provider_id string, brand_name string, endpoint string, url string, page_num long, http_status int, "
        "responded_xv int, fetched_at timestamp, etag string, payload string, payload_hash string, fetched_date string")


def test_a_correction_empties_its_partition(spark):
    d2 = dt.date(2026, 2, 10)
    for as_of in (None, d2):
        out = tempfile.mkdtemp(prefix="models-")
        build_and_write(spark.createDataFrame([_page("2026-02-09", "0.01"), _page("2026-02-10", "0.02")], PAGE), out)
        assert spark.read.parquet(f"{out}/mart_rate_changes").count() == 1
        build_and_write(spark.createDataFrame([_page("2026-02-09", "0.01"), _page("2026-02-10", "0.01")], PAGE), out, as_of=as_of)
        assert spark.read.schema("as_of_date string, provider_id string").parquet(f"{out}/mart_rate_changes").count() == 0
        assert spark.read.parquet(f"{out}/fct_product_rates").count() == 2


def test_a_date_build_reads_only_that_dates_pages(spark):
    from ratewatch.plans.jobs import _pages_of
    from ratewatch.plans.pipeline import build_models
    root = tempfile.mkdtemp(prefix="pages-")
    spark.createDataFrame([_page("2026-02-09", "0.01"), _page("2026-02-10", "0.02")], PAGE).write.mode("overwrite").partitionBy("fetched_date").parquet(root)
    day = _pages_of(spark.read.parquet(root), dt.date(2026, 2, 10), "fetched_date")
    plan = build_models(day).fct_product_rates._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fetched_date" in plan and "= 2026-02-10" in plan
    assert build_models(day).fct_product_rates.count() == 1


def test_all_marts_are_stored_and_reported(spark):
    out = tempfile.mkdtemp(prefix="models-")
    ev = testbed.read(spark, SF, "events")
    runs = testbed.event_runs(ev)
    build_and_write(testbed.event_pages(ev), out, runs=runs, brands=testbed.event_brands(ev, runs), call_log=testbed.event_call_log(ev))
    d = dt.date(2024, 1, 15)
    lines = write_reports(spark, d, f"{out}/reports", rate_changes_path=f"{out}/mart_rate_changes",
                          coverage_path=f"{out}/mart_provider_coverage", drift_path=f"{out}/schema_drift_event")
    assert any("Providers discovered" in x for x in lines)
    assert spark.read.parquet(f"{out}/schema_fingerprint").count() > 0


def _marts(spark, out):
    """All rows of the change mart and of the drift events, as plain values."""
    cols = {"mart_rate_changes": ["as_of_date", "provider_id", "product_id", "previous_as_of_date", "previous_rate", "current_rate"],
            "schema_drift_event": ["as_of_date", "provider_id", "endpoint", "old_fingerprint_hash", "new_fingerprint_hash", "observed_at"]}
    return {t: sorted(tuple(str(v) for v in r) for r in spark.read.parquet(f"{out}/{t}").select(*c).collect()) for t, c in cols.items()}


def _versions():
    """Pages of two providers: one lists every day, the other misses some; shapes change too."""
    import json
    rows = []
    for i, day in enumerate(["2026-02-09", "2026-02-10", "2026-02-11", "2026-02-12", "2026-02-13"]):
        for prov, days in (("p", range(5)), ("q", (0, 2, 4))):
            if i not in days:
                continue
            rate = {"depositRateType": "FIXED", "rate": f"0.0{i + 1}" if prov == "p" else "0.05"}
            product = {"productId": "a", "depositRates": [rate]}
            if i in (1, 2):
                product["extra"] = 1
            payload = json.dumps({"data": {"products": [product]}, "links": {}})
            rows.append((f"run-{i}", prov, "B", "banking:get-products", f"https://{prov}/{day}", 1, 200, 3,
                         dt.datetime.fromisoformat(f"{day}T01:00:00"), None, payload, "h", day))
    return rows


def test_dates_built_in_any_order_equal_a_full_build(spark):
    rows = _versions()
    pages = spark.createDataFrame(rows, PAGE)
    full = tempfile.mkdtemp(prefix="models-")
    build_and_write(pages, full)
    want = _marts(spark, full)
    assert len(want["mart_rate_changes"]) == 4 and len(want["schema_drift_event"]) == 4
    out = tempfile.mkdtemp(prefix="models-")
    done = []
    for day in ("2026-02-09", "2026-02-13", "2026-02-11", "2026-02-10", "2026-02-12", "2026-02-10"):
        done.append(day)
        build_and_write(spark.createDataFrame([r for r in rows if r[-1] in done], PAGE), out, as_of=dt.date.fromisoformat(day))
    assert _marts(spark, out) == want
    # a date that loses a provider: the provider's next date is compared with the one before
    some = [r for r in rows if (r[1], r[-1]) != ("p", "2026-02-11")]
    build_and_write(spark.createDataFrame(some, PAGE), out, as_of=dt.date(2026, 2, 11))
    again = tempfile.mkdtemp(prefix="models-")
    build_and_write(spark.createDataFrame(some, PAGE), again)
    assert _marts(spark, out) == _marts(spark, again)


def test_a_new_date_reads_the_fingerprint_state(spark):
    """The earlier fingerprints may be gone when a later date is built: the state has what is needed."""
    import shutil
    rows = _versions()
    out = tempfile.mkdtemp(prefix="models-")
    build_and_write(spark.createDataFrame([r for r in rows if r[-1] < "2026-02-13"], PAGE), out)
    events = len(_marts(spark, out)["schema_drift_event"])
    state = {(r.provider_id, r.endpoint): r.observed_at for r in spark.read.parquet(f"{out}/fingerprint_state").collect()}
    assert {p: t.day for (p, _), t in state.items()} == {"p": 12, "q": 11}
    shutil.move(f"{out}/schema_fingerprint/as_of_date=2026-02-11", f"{out}/gone")
    build_and_write(spark.createDataFrame(rows, PAGE), out, as_of=dt.date(2026, 2, 13))
    assert len(_marts(spark, out)["schema_drift_event"]) == events + 1      # q's shape of the 11th is not that of the 13th
    state = {r.provider_id: r.observed_at.day for r in spark.read.parquet(f"{out}/fingerprint_state").collect()}
    assert state == {"p": 13, "q": 13}


def test_a_date_build_picks_its_pages_once(spark):
    out = tempfile.mkdtemp(prefix="models-")
    pages = testbed.landed_pricing_pages(spark, SF)
    models = build_and_write(pages.drop("etag").withColumn("etag", F.lit(None)), out, as_of=dt.date(1998, 1, 1), drift=False)
    files = models.products.inputFiles()
    assert files and all("/day-" in f for f in files)          # the models read the date's own copy, not the page table
    want = pages.filter(F.to_date("fetched_at") == F.lit(dt.date(1998, 1, 1)))
    assert models.products.select("page_num", "provider_id").distinct().count() == want.select("page_num", "provider_id").distinct().count()


def test_the_fingerprint_state_is_not_one_tasks_work(spark, monkeypatch):
    """The state grows with the providers: its aggregate must not run in a single task, as under coalesce(1)."""
    from ratewatch.plans.jobs import build_drift
    seen = []
    plain = type(spark.range(0)).coalesce
    monkeypatch.setattr(type(spark.range(0)), "coalesce", lambda self, n: (seen.append(n), plain(self, n))[1])
    out, pages = tempfile.mkdtemp(prefix="models-"), testbed.landed_pricing_pages(spark, SF)
    days = [dt.date(1997, 1, 1), dt.date(1998, 1, 1)]
    build_drift(pages.filter(F.to_date("fetched_at") == F.lit(days[0])), out)
    build_drift(pages, out, as_of=days[1])
    two = pages.filter(F.to_date("fetched_at").isin(days)).select("provider_id", "endpoint").distinct().count()
    assert not seen and spark.read.parquet(f"{out}/fingerprint_state").count() == two
