"""Metamorphic and plan properties that matter at scale."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ratewatch.operators.changes import rate_changes
from ratewatch.operators.sequence import previous_in_key

FACT = ("provider_id string, brand_name string, as_of_date date, product_id string, product_name string, "
        "product_category string, rate_kind string, rate_type string, tier_name string, "
        "tier_unit_of_measure string, tier_minimum_value decimal(28,10), tier_maximum_value decimal(28,10), "
        "rate decimal(28,10)")


def _facts(spark, hot_repeats=0):
    rows = []
    for d in range(3):
        day = dt.date(2026, 1, 1) + dt.timedelta(days=d)
        for p in range(40):
            rows.append(("prov", "B", day, f"p{p}", "P", "c", "deposit", "fixed", None, None, None, None,
                         Decimal(str((p * (d + 1)) % 7))))
    df = spark.createDataFrame(rows, FACT)
    if hot_repeats:
        hot = df.filter("product_id = 'p1'")
        reps = spark.range(hot_repeats).select(F.lit("p1").alias("_pid"))
        df = df.unionByName(hot.join(reps, hot["product_id"] == reps["_pid"]).drop("_pid"))
    return df


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_hot_key_repeats_do_not_change_result(spark):
    base = rate_changes(_facts(spark))
    hot = rate_changes(_facts(spark, hot_repeats=20000))
    assert _same(base, hot)


def test_input_partitioning_does_not_change_result(spark):
    f = _facts(spark)
    assert _same(rate_changes(f.repartition(7)), rate_changes(f.repartition(3, "product_id")))


def test_diff_exchanges_the_facts_once(spark, tmp_path):
    """With stored snapshot dates the only exchange is the one by entity and keys, above a partial
    aggregate; cancelling, ranking and pairing add none."""
    facts = _facts(spark)
    facts.select("provider_id", "as_of_date").distinct().write.parquet(str(tmp_path / "s"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = rate_changes(facts, snapshots=spark.read.parquet(str(tmp_path / "s")))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    main = plan.split("BroadcastExchange")[0]
    assert main.count("Exchange hashpartitioning") == 1
    assert "partial_collect_set" in main.split("Exchange hashpartitioning")[1]
    assert _same(rate_changes(facts), rate_changes(facts, snapshots=spark.read.parquet(str(tmp_path / "s"))))


def test_previous_in_key_bucket_invariance(spark):
    t0 = dt.datetime(2026, 2, 10)
    rows = [("k", t0 + dt.timedelta(minutes=7 * i), i, f"h{i // 3}") for i in range(200)]
    df = spark.createDataFrame(rows, "key string, ts timestamp, seq int, h string")
    a = previous_in_key(df, ["key"], ["ts", "seq"], "h", "prev", bucket=F.date_trunc("minute", "ts"))
    b = previous_in_key(df, ["key"], ["ts", "seq"], "h", "prev", bucket=F.date_trunc("day", "ts"))
    c = previous_in_key(df, ["key"], ["ts", "seq"], "h", "prev")
    assert _same(a, b) and _same(b, c)
    got = {r.seq: r.prev for r in c.collect()}
    assert got[0] is None and all(got[i] == f"h{(i - 1) // 3}" for i in range(1, 200))


def test_previous_in_key_splits_one_key_at_one_instant(spark):
    """All rows share the key and the time: ranges still cut them, and each task gets a share."""
    rows = [("k", dt.datetime(2026, 2, 10), i, f"h{i // 3}") for i in range(4000)]
    df = spark.createDataFrame(rows, "key string, ts timestamp, seq int, h string")
    out = previous_in_key(df, ["key"], ["ts", "seq"], "h", "prev")
    got = {r.seq: r.prev for r in out.collect()}
    assert got[0] is None and all(got[i] == f"h{(i - 1) // 3}" for i in range(1, 4000))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")    # small ranges would be joined
    try:
        ranges = df.repartitionByRange("key", "ts", "seq").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(ranges) > 1 and max(r["count"] for r in ranges) < 3000


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key_limits_before_shuffle(spark):
    import __spark_entry__ as E
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(E.queries()["dim_products"](spark, "/root/testdata/sf0.001"))
        report = _plan(E.queries()["rate_change_report"](spark, "/root/testdata/sf0.001"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    below = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in below  # partial top-1 runs map-side, before the shuffle
    assert "TakeOrderedAndProject" in report


def _without_aqe(spark, make):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return _plan(make())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_page_packing_exchanges_lines_only(spark):
    """Below the exchange are the lines' own columns: no products, and no partial aggregate that sorts every line."""
    from ratewatch.plans import testbed
    lineitem = testbed.read(spark, "/root/testdata/sf0.001", "lineitem")
    below = _without_aqe(spark, lambda: testbed.pricing_pages(lineitem)).split("Exchange hashpartitioning")[1]
    assert "Aggregate" not in below and "productId" not in below


def test_products_and_rates_are_made_by_compiled_code(spark):
    """A function over the elements of an array is interpreted: there is none on the way from lines to rates."""
    from ratewatch.operators import flatten
    from ratewatch.plans import testbed
    pages = testbed.pricing_pages(testbed.read(spark, "/root/testdata/sf0.001", "lineitem"))
    assert "transform(" not in _without_aqe(spark, lambda: flatten.rates(flatten.products(pages)))


def test_landed_payloads_stay_whole(spark, tmp_path):
    """Landed variants are not taken apart into a Parquet column per member."""
    import pyarrow.parquet as pq
    out = str(tmp_path / "pages")
    spark.range(10).select(F.parse_json(F.concat(F.lit('{"a":[{"b":"x'), "id", F.lit('"}]}'))).alias("payload")).write.parquet(out)
    assert {f.name for f in pq.read_schema(next((tmp_path / "pages").glob("*.parquet"))).field("payload").type} == {"value", "metadata"}


def test_packed_page_of_odd_lines(spark):
    """Products are ordered by their whole line, equal lines stay, and members without a value are left out of the text."""
    import json

    from ratewatch.plans import testbed
    at = dt.datetime(1995, 3, 4)
    line = (7, 3, 5, 2, 30.0, 10.0, 0.05, 0.0, "R", "F", at)
    rows = [line, line, (7, None, 5, 1, None, None, None, None, None, None, at)]
    lineitem = spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                                     "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                                     "l_linestatus string, l_shipdate timestamp")
    [page] = testbed.pricing_pages(lineitem).collect()
    doc = json.loads(page.payload)
    bare, one, two = doc["data"]["products"]
    assert doc["links"] == {"next": ""} and one == two and list(doc) == ["data", "links"]
    assert bare == {"productCategory": "RESIDENTIAL_MORTGAGES", "lastUpdated": "1995-03-04T00:00:00+10:00", "effectiveFrom": "",
                    "brand": "Brand 5", "brandGroup": "", "fees": [{"name": "Account fee", "feeType": "PERIODIC", "currency": "AUD"}]}
    assert one["lendingRates"] == [{"lendingRateType": "FIXED", "rate": "0.05", "applicationFrequency": "P1M", "additionalValue": "P2M",
                                    "tiers": [{"name": "Tier 3", "unitOfMeasure": "DOLLAR", "minimumValue": 30.00, "maximumValue": 39.99}]}]
    assert "depositRates" not in one and page.payload.startswith('{"data":{"products":[{')


def test_diff_without_stored_dates_exchanges_the_facts_once(spark):
    plan = _without_aqe(spark, lambda: rate_changes(_facts(spark)))
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan


def test_diff_sorts_once_for_the_least_description_and_the_neighbours(spark):
    plan = _without_aqe(spark, lambda: rate_changes(_facts(spark)))
    # values in date order; ranks; pairs
    assert sum(line.lstrip(" :+-*()0123456789").startswith("Sort ") for line in plan.splitlines()) == 3


def test_partition_targets_keep_tasks_small():
    """The sorts and windows of the snapshot diff hold tens of times the compressed bytes that a task reads."""
    from ratewatch.session import SCALE_SQL_CONF
    for name, most in (("adaptive.advisoryPartitionSizeInBytes", 16), ("files.maxPartitionBytes", 32)):
        assert int(SCALE_SQL_CONF[f"spark.sql.{name}"].rstrip("m")) <= most


def test_page_packing_groups_sorted_lines(spark):
    """The lines are sorted before the products are made of them, and grouped as they come."""
    from ratewatch.plans import testbed
    lineitem = testbed.read(spark, "/root/testdata/sf0.001", "lineitem")
    plan = _without_aqe(spark, lambda: testbed.pricing_pages(lineitem))
    assert "ObjectHashAggregate" not in plan and plan.count("Sort [") == 1 and "to_json" not in plan.split("Sort [")[1]


def test_diff_sorts_by_the_hash_of_the_key(spark):
    """Every sort begins with the hash, and neither keys nor descriptions are taken apart in between."""
    plan = _without_aqe(spark, lambda: rate_changes(_facts(spark)))
    sorts = [line.split("Sort [")[1] for line in plan.splitlines() if "Sort [" in line and "as_of_date" not in line.split("Sort [")[1].split(" ")[0]]
    diff = [s for s in sorts if not s.startswith("provider_id")]              # the snapshot dates' own
    assert len(diff) >= 3 and all(s.startswith("_h#") and s.split(" ASC")[1].split(", ")[1].startswith("_key#") for s in diff)


def test_diff_tells_a_null_sentinel_key_from_its_sentinel(spark):
    d1, d2 = dt.date(2026, 1, 1), dt.date(2026, 1, 2)
    rows = [("p", d1, "a", None, None, "1"), ("p", d2, "a", "", None, "2"), ("p", d1, "b", None, None, "3"), ("p", d2, "c", None, 5, "4"),
            ("p", d1, "d", "", -1, "5"), ("p", d2, "d", None, None, "6"), ("p", d2, "e", "t", -1, "7"), ("p", d2, "e", "t", None, "7")]
    df = spark.createDataFrame(rows, "e string, d date, k string, s string, n int, v string")
    from ratewatch.operators.changes import snapshot_changes
    out = snapshot_changes(df, entity="e", date="d", keys=["k"], sentinel_keys={"s": "", "n": -1}, value="v")
    assert {(r.k, r.s, r.n, r.previous_v, r.current_v) for r in out.collect()} == {
        ("a", "", None, "1", "2"), ("b", None, None, "3", None), ("c", None, 5, None, "4"), ("d", "", -1, "5", "6"), ("e", "t", -1, None, "7")}


def test_declared_tests_work_out_each_model_once(spark):
    from ratewatch.plans.qa import DECLARED_TESTS, declared_tests
    seen = {}
    models = {}
    for model in dict.fromkeys(m for m, _, _ in DECLARED_TESTS):
        names = list(dict.fromkeys(c for m, t, cols in DECLARED_TESTS if m == model for c in (cols[:1] if t == "accepted_values" else cols)))
        seen[model] = spark.sparkContext.accumulator(0)

        def counted(batches, n=seen[model]):
            for b in batches:
                n.add(b.num_rows)
                yield b

        rows = spark.createDataFrame([tuple("deposit" for _ in names), tuple(None for _ in names)], ", ".join(f"{c} string" for c in names))
        models[model] = rows.coalesce(1).mapInArrow(counted, rows.schema)
    got = {(r.model, r.test, r["columns"]): r.failing_rows for r in declared_tests(models).collect()}
    assert len(got) == 17 and all(n == (1 if test == "not_null" else 0) for (_, test, _), n in got.items())
    assert all(n.value == 2 for n in seen.values())


def test_snapshot_dates_are_broadcast_by_entity(spark, monkeypatch):
    """As many entities as pairs were broadcast before, each with several dates: no exchange by date, and the same rows as by
    the plain join, which is left for more."""
    from ratewatch.operators import changes
    days = [dt.date(2026, 1, 1) + dt.timedelta(days=d) for d in (0, 1, 5, 9)]
    rows = [(f"e{e}" if e else None, None if (e + i) % 7 == 6 else d, f"k{(e + i) % 3}", (e * i) % 4) for e in range(9) for i, d in enumerate(days) if e % 4 != i]
    df = spark.createDataFrame(rows + rows[:5], "e string, d date, k string, v int")
    stored = df.filter("d is not null and e is not null").select("e", "d").filter("d <> '2026-01-06' or e <> 'e3'")
    monkeypatch.setattr(changes, "BROADCAST_PAIRS", 9)

    def diff(**kw):
        return changes.snapshot_changes(df, entity="e", date="d", keys=["k"], value="v", **kw)

    plan = _without_aqe(spark, diff)
    assert "Exchange hashpartitioning(e#" not in plan.split("BroadcastExchange")[0] and "SortMergeJoin" not in plan
    got = [sorted(map(str, diff(**kw).collect())) for kw in ({}, {"snapshots": stored})]
    monkeypatch.setattr(changes, "MOST_DATES", 1)
    assert "BroadcastExchange" not in _without_aqe(spark, diff) or "_days" not in _without_aqe(spark, diff)
    assert [sorted(map(str, diff(**kw).collect())) for kw in ({}, {"snapshots": stored})] == got and got[0] != got[1] and got[0]
