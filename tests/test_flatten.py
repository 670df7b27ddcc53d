import json
from decimal import Decimal

from ratewatch.operators import flatten
from ratewatch.plans.pipeline import build_models

SAMPLE = {"data": {"products": [{
    "productId": "p1", "name": "Saver", "productCategory": "TRANS_AND_SAVINGS_ACCOUNTS",
    "lastUpdated": "2026-02-09T01:00:00+11:00", "isTailored": False,
    "fees": [{"name": "Monthly", "feeType": "PERIODIC", "amount": "4.00", "currency": "AUD"}],
    "depositRates": [{"depositRateType": "BONUS", "rate": "0.0125", "tiers": [
        {"name": "Low", "unitOfMeasure": "DOLLAR", "minimumValue": 0, "maximumValue": 9999.99}]},
        {"depositRateType": "FLOATING", "rate": "0.0010"}]}]},
    "links": {"next": "?page=2"}}

PAGE_SCHEMA = ("run_id string, provider_id string, brand_name string, endpoint string, url string, page_num long, "
               "http_status int, responded_xv int, fetched_at timestamp, etag string, payload string")


def _pages(spark, payloads, status=200):
    import datetime as dt
    rows = [("r1", "p", "B", "banking:get-products", f"https://x/{i}", i, status, 3,
             dt.datetime(2026, 2, 10, 1, 0), None, p) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, PAGE_SCHEMA)


def test_sample_page(spark):
    m = build_models(_pages(spark, [json.dumps(SAMPLE)]))
    assert m.products.count() == 1
    assert m.fees.count() == 1
    assert m.rates.count() == 2
    tiers = m.rate_tiers.orderBy("rate_type").collect()
    assert [(t.rate_type, t.tier_name, t.tier_maximum_value) for t in tiers] == [
        ("BONUS", "Low", Decimal("9999.99")), ("FLOATING", None, None)]
    p = m.products.first()
    assert p.is_tailored is False and p.product_brand_group is None


def test_non_200_pages_are_not_parsed(spark):
    m = build_models(_pages(spark, [json.dumps(SAMPLE)], status=500))
    assert m.products.count() == 0


def test_array_shapes(spark):
    # products: missing, [], null, {}, [null] -> 0, 0, 0, 0, 1 exploded element (dropped: no id)
    docs = ['{"data":{}}', '{"data":{"products":[]}}', '{"data":{"products":null}}',
            '{"data":{"products":{}}}', '{"data":{"products":[null]}}', "not json"]
    prods = flatten.products(_pages(spark, docs))
    assert prods.count() == 0
    # tiers: missing, [], null, {}, [null] -> one row each
    rates = [{"depositRateType": "X", "rate": "1"} | extra for extra in
             ({}, {"tiers": []}, {"tiers": None}, {"tiers": {}}, {"tiers": [None]})]
    doc = {"data": {"products": [{"productId": "a", "depositRates": rates}]}}
    m = build_models(_pages(spark, [json.dumps(doc)]))
    assert m.rate_tiers.count() == 5
    assert m.rate_tiers.filter("tier_name is not null").count() == 0


def test_product_id_empty_string_kept(spark):
    doc = {"data": {"products": [{"productId": ""}, {"productId": None}, {"name": "x"}]}}
    assert flatten.products(_pages(spark, [json.dumps(doc)])).count() == 1


def test_lending_rates_union(spark):
    doc = {"data": {"products": [{"productId": "a", "depositRates": [{"depositRateType": "D", "rate": "1"}],
                                  "lendingRates": [{"lendingRateType": "L", "rate": "2"}, {"rate": "3"}]}]}}
    rows = build_models(_pages(spark, [json.dumps(doc)])).rates.select("rate_kind", "rate_type").collect()
    assert sorted(map(tuple, rows)) == [("deposit", "D"), ("lending", "L")]


def test_rate_kinds_by_array(spark):
    """Elements of either array keep their kind, whatever the other array holds."""
    dep = [{"depositRateType": f"D{i}", "rate": str(i)} for i in range(3)]
    lend = [{"lendingRateType": "L0", "rate": "7"}]
    docs = [{"data": {"products": [{"productId": "a", "depositRates": dep, "lendingRates": lend},
                                   {"productId": "b", "depositRates": None, "lendingRates": lend},
                                   {"productId": "c", "depositRates": [None, dep[1]], "lendingRates": "x"},
                                   {"productId": "d", "depositRates": {}, "lendingRates": []}]}}]
    rows = build_models(_pages(spark, [json.dumps(d) for d in docs])).rates.select("product_id", "rate_kind", "rate_type").collect()
    assert sorted(map(tuple, rows)) == [("a", "deposit", "D0"), ("a", "deposit", "D1"), ("a", "deposit", "D2"), ("a", "lending", "L0"),
                                        ("b", "lending", "L0"), ("c", "deposit", "D1")]


def test_rate_fact_by_one_cast_has_the_rows_of_the_stages(spark):
    from ratewatch.operators import flatten
    tier = {"name": "T", "unitOfMeasure": "", "minimumValue": 1.50, "maximumValue": "x"}
    rate = {"depositRateType": "FIXED", "rate": "0.05", "additionalInfo": {"b": 1, "a": [True]}, "conditions": [{"k": 1}],
            "tiers": [tier, None, 7, {"name": None, "minimumValue": "-2"}]}
    products = [
        {"productId": "a", "name": 12, "productCategory": True, "depositRates": [rate, None, 5, {"rate": "1"}, {"lendingRateType": "L", "tiers": []}],
         "lendingRates": [{"lendingRateType": "V", "rate": 1e3, "tiers": {"name": "no array"}}]},
        {"productId": {"o": 1}, "depositRates": {"depositRateType": "no array"}, "lendingRates": [{"depositRateType": "D", "comparisonRate": "2.50"}]},
        {"productId": "", "lendingRates": [{"lendingRateType": ["x"], "tiers": None}]}, {"name": "no id", "depositRates": [rate]}, None, "text", [rate]]
    texts = [json.dumps({"data": {"products": products}}), json.dumps({"data": {"products": {"productId": "p"}}}), json.dumps({"data": 1}),
             "[]", "null", "no json"]
    pages = _pages(spark, texts).unionByName(_pages(spark, texts[:1], status=500))
    m = build_models(pages)
    staged = flatten.json_columns_as_text(flatten.rate_fact(m.rate_tiers))
    got = flatten.json_columns_as_text(m.fct_product_rates)
    assert got.columns == staged.columns and got.dtypes == staged.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, staged.collect())) and staged.count() == 8
    some = ["rate", "product_id", "tier_maximum_value"]
    narrow = m.rate_columns(*some)
    assert sorted(map(str, narrow.collect())) == sorted(map(str, staged.select(*some).collect()))
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert plan.count("try_variant_get") == 1 and "additionalInfo" not in plan
    assert m.rate_columns("provider_id", "as_of_date").count() == 8


def test_products_by_one_cast_have_the_rows_of_single_reads(spark):
    from ratewatch.operators import flatten
    products = [{"productId": "a", "name": 12.50, "description": {"b": 1, "a": None}, "productCategory": None, "lastUpdated": "2026-02-09T01:00:00+11:00",
                 "effectiveFrom": "", "effectiveTo": "soon", "brand": ["B"], "brandGroup": "", "isTailored": True, "fees": {"no": "array"},
                 "depositRates": [None, 1, {"depositRateType": "F"}], "lendingRates": None},
                None, 5, "text", ["x"], {"productId": None}, {"name": "no id"}, {"productId": 7, "isTailored": "maybe", "fees": [{"name": 1}, None, 2]}]
    pages = _pages(spark, [json.dumps({"data": {"products": products}}), json.dumps({"data": {"products": 3}}), "[]", "no json"])
    single = flatten.json_columns_as_text(flatten.products(pages))
    cast = flatten.json_columns_as_text(flatten.products(pages, columns=[*flatten.PRODUCT_COLUMNS, *flatten.PRODUCT_LINEAGE]))
    assert cast.dtypes == single.dtypes and single.count() == 2
    assert sorted(map(str, cast.collect())) == sorted(map(str, single.collect()))
    assert [r.product_pos for r in flatten.products(pages, columns=["product_pos"]).orderBy("product_pos").collect()] == [0, 7]
    m, kept = build_models(pages), build_models(pages, persist=True)
    for name in ("fees", "rates", "rate_tiers", "dim_products"):
        a, b = (flatten.json_columns_as_text(getattr(x, name)) for x in (m, kept))
        assert a.dtypes == b.dtypes and sorted(map(str, a.collect())) == sorted(map(str, b.collect())), name
    kept.products.unpersist()
