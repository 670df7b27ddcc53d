import json

from pyspark.sql import functions as F

from ratewatch.operators import quality as Q
from ratewatch.operators.collect import limit_providers
from ratewatch.schemas import TABLES
from ratewatch.sources.tables import conform, create_tables_sql, resolve_relation


def test_resolve_relation(spark):
    spark.range(1).createOrReplaceTempView("mart_present")
    assert resolve_relation(spark, ["gold_missing_x", "mart_present"]) == "mart_present"
    assert resolve_relation(spark, ["gold_missing_x"]) is None


def test_drift_gate_enforced(spark):
    m = spark.createDataFrame([(0,), (3,)], "actual long")
    got = [(r.passed, r.threshold_value) for r in Q.drift_gate(m, enforce=True).collect()]
    assert got == [(True, 0.0), (False, 0.0)]
    off = Q.drift_gate(m, enforce=False).collect()
    assert [r.passed for r in off] == [True, True] and off[1].details == "observed=3.0; fail gate disabled"


def test_limit_providers_keeps_register_order(spark):
    df = spark.createDataFrame([(i, f"b{i}") for i in (5, 1, 3, 2)], "register_pos int, id string")
    assert [r.id for r in limit_providers(df, 2).collect()] == ["b1", "b2"]
    assert limit_providers(df, None).count() == 4


def test_ddl_and_conform(spark):
    sql = create_tables_sql("bronze")
    assert sql[0] == "CREATE DATABASE IF NOT EXISTS bronze"
    assert any("products_raw" in s and "payload variant" in s and "run_id string NOT NULL" in s for s in sql)
    row = ("r", "p", None, "e", "u", 1, 200, 3, None, None, json.dumps({"a": [1, 2]}), None)
    df = spark.createDataFrame([row], "run_id string, provider_id string, brand_name string, endpoint string, "
                               "url string, page_num int, http_status int, responded_xv int, fetched_at timestamp, "
                               "etag string, payload string, payload_hash string")
    c = conform(df, "products_raw")
    assert [f.name for f in c.schema.fields] == [f.name for f in TABLES["products_raw"].schema.fields]
    assert c.select(F.to_json("payload")).first()[0] == '{"a":[1,2]}'


def test_run_qa_missing_marts_fail(spark):
    import datetime as dt

    from ratewatch.plans.qa import run_qa
    pages = spark.createDataFrame([(dt.datetime(2026, 2, 10, 23, 0),)], "fetched_at timestamp")
    drift = spark.createDataFrame([], "observed_at timestamp")
    gates = run_qa(spark, dt.date(2026, 2, 10), pages=pages, drift_events=drift)
    got = {r.gate_name: r for r in gates.collect()}
    assert not got["providers_ok"].passed and got["providers_ok"].details.startswith("missing relation")
    assert not got["dim_products_rows"].passed and not got["rate_changes_rows"].passed
    fresh = got["products_freshness_hours"]
    assert fresh.passed and fresh.actual_value == 1.0 and fresh.details == "1.0h <= 36.0h"
    assert got["schema_drift_events"].passed and got["dbt_tests"].details == "skipped"
    assert Q.verdict(gates).first().exit_code == 1


def test_cluster_settings():
    from ratewatch.session import cluster_settings
    big = cluster_settings(100 * 10**12, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == -(-100 * 10**12 // (128 << 20))
    assert big["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "false"
    small = cluster_settings(10 << 20, 64)
    assert small["spark.sql.shuffle.partitions"] == "128"  # never fewer than 2 x cores


def test_a_gate_that_fails_at_run_time_leaves_the_others(spark, tmp_path):
    import datetime as dt

    from ratewatch.plans.qa import evaluate_qa, store_qa
    day = dt.date(2026, 2, 10)
    pages = spark.createDataFrame([(dt.datetime(2026, 2, 10, 23, 0),)], "fetched_at timestamp")
    dim = spark.createDataFrame([(day, "x")], "as_of_date date, v string")
    broken = dim.select(F.raise_error(F.lit("broken mart")).cast("date").alias("current_as_of_date"))
    got = {r.gate_name: r for r in evaluate_qa(spark, day, dim_products=dim, rate_changes=broken, pages=None).collect()}
    assert got["dim_products_rows"].passed and not got["rate_changes_rows"].passed
    assert got["rate_changes_rows"].details.startswith("query failed") and "broken mart" in got["rate_changes_rows"].details
    assert got["products_freshness_hours"].details == "missing relation: expected products_raw"
    for run in ("run-1", "run-2"):
        verdict = store_qa(spark, day, run, str(tmp_path), dim_products=dim, pages=pages, tests=[dim.filter("v is null")], tests_command="check").first()
        assert verdict.exit_code == 1
    stored = spark.read.parquet(str(tmp_path / "qa_gate_result"))
    assert stored.count() == 12 and {r.dbt_test_command for r in stored.collect()} == {"check"}
    lines = [r.value for r in spark.read.text(str(tmp_path / "qa_summary_2026-02-10")).collect()]
    assert lines[0] == "# QA summary - 2026-02-10" and "- Status: **FAIL**" in lines and "- dbt tests: **PASS** (`check`)" in lines
    assert "| dim_products_rows | yes | 1.0 | 1.0 | 1.0 >= 1.0 |" in lines


def test_timestamps_need_a_whole_date(spark):
    from ratewatch.functions.casting import bad_numbers, bad_timestamps, to_timestamptz
    df = spark.createDataFrame([("10:30",), ("2024",), ("2024-05",), ("2024-05-06",), ("2024-05-06T07:08:09Z",), ("",), (None,), ("x",)], "t string")
    got = [r.v for r in df.select(to_timestamptz("t").alias("v")).collect()]
    assert [v is not None for v in got] == [False, False, False, True, True, False, False, False]
    assert tuple(df.agg(bad_timestamps("t"), bad_numbers("t")).first()) == (4, 5)


def test_a_repeated_append_replaces_its_run(spark, tmp_path):
    from ratewatch.plans.qa import store_qa
    from ratewatch.session import utc_today
    from ratewatch.sources.tables import write_table
    pages = spark.createDataFrame([], "fetched_at timestamp")
    for run in ("run-1", "run-1", "run-2"):
        store_qa(spark, None, run, str(tmp_path), pages=pages)
    stored = spark.read.parquet(str(tmp_path / "qa_gate_result"))
    assert stored.count() == 12 and {r.qa_date for r in stored.collect()} == {utc_today()}
    log = ("r1", "p", "e", "u", 200, 3, None, None, None, None)
    cols = ("run_id string, provider_id string, endpoint string, url string, http_status int, responded_xv int, fetched_at timestamp, "
            "etag string, payload_hash string, error string")
    for rows in ([log], [log], [("r2", *log[1:])]):
        write_table(spark.createDataFrame(rows, cols), str(tmp_path / "log"), "api_call_log", run="run_id")
    assert sorted(r.run_id for r in spark.read.parquet(str(tmp_path / "log")).collect()) == ["r1", "r2"]


def test_rejects_and_accepted_rows(spark, tmp_path):
    import datetime as dt

    from ratewatch.sources.tables import read_accepted, read_rejected, write_checked
    t = dt.datetime(2026, 2, 10)
    row = ("r", t, t.date(), "banking", "banking", False, None)
    rows = [row, ("r", dt.datetime(2026, 2, 9), *row[2:]), (None, *row[1:]), (None, *row[1:]), ("q", None, *row[2:]), ("q", *row[1:])]
    df = spark.createDataFrame(rows, "run_id string, run_started_at timestamp, run_date date, register_industry string, "
                               "filter_industry string, fetch_product_details boolean, notes string")
    path = str(tmp_path / "runs")
    counts = {(r.fate, r.reject_reason): r.n_rows for r in write_checked(df, path, "pipeline_run", [F.col("run_started_at")]).collect()}
    assert counts == {("accepted", None): 2, ("rejected", "unique"): 1, ("rejected", "not_null:run_id"): 2, ("rejected", "not_null:run_started_at"): 1}
    assert {(r.run_id, r.run_started_at.day) for r in read_accepted(spark, path, "pipeline_run").collect()} == {("r", 9), ("q", 10)}
    assert read_rejected(spark, path).count() == 4


def test_foreign_keys_in_one_pass(spark):
    runs = spark.createDataFrame([("a",), ("b",)], "run_id string")
    kids = {"x": spark.createDataFrame([("a",), ("c",), ("c",), (None,), ("d",)], "run_id string"), "y": runs.union(runs), "z": runs.limit(0)}
    got = Q.run_fk_checks(kids, runs)
    assert {tuple(r) for r in got.collect()} == {("x", 5, 3, 2), ("y", 4, 0, 0), ("z", 0, 0, 0)}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = Q.run_fk_checks(kids, runs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Join") == 1 and "LeftAnti" not in plan
    assert plan.split("Union")[0].count("Exchange hashpartitioning(_key") <= 2


def test_details_to_ask_for_again(spark):
    import datetime as dt

    from ratewatch.operators.collect import detail_retry
    t = [dt.datetime(2026, 2, 10, h) for h in range(4)]
    asked = spark.createDataFrame([("r", "p", x) for x in "abc"], "run_id string, provider_id string, product_id string")
    done = spark.createDataFrame([("r", "p", "a", 500, t[0]), ("r", "p", "a", 200, t[1]), ("r", "p", "b", 304, t[1]), ("r", "p", "b", 500, t[2])],
                                 "run_id string, provider_id string, product_id string, http_status int, fetched_at timestamp")
    assert {tuple(r) for r in detail_retry(asked, done).collect()} == {("r", "p", "b", 2, 500), ("r", "p", "c", 0, None)}


def test_stored_models_by_name(spark, tmp_path):
    import datetime as dt

    from ratewatch.plans.qa import run_qa_by_name
    from ratewatch.sources.tables import register_stored, resolved
    day = dt.date(2026, 2, 10)
    spark.createDataFrame([("p", day)], "provider_id string, as_of_date date").write.partitionBy("as_of_date").parquet(str(tmp_path / "dim"))
    try:
        register_stored(spark, str(tmp_path), {"public_silver.dim_products": "dim"})
        assert resolved(spark, "dim_products").first().as_of_date == day and resolved(spark, "mart_rate_changes") is None
        got = {r.gate_name: r for r in run_qa_by_name(spark, day).collect()}
        assert got["dim_products_rows"].passed
        assert got["rate_changes_rows"].details == "missing relation: expected gold.mart_rate_changes or public_gold.mart_rate_changes"
    finally:
        spark.sql("DROP DATABASE IF EXISTS public_silver CASCADE")
