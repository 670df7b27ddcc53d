"""Registered queries: each callable takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver tables (or frames Spark derives from them), so its work grows
with the scale factor. Column names match the oracle SQL in ``ratewatch.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewatch.operators import flatten
from ratewatch.operators.changes import snapshot_changes
from ratewatch.plans import testbed
from ratewatch.plans.pipeline import build_models
from ratewatch.plans.reports import rate_change_report

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Report date used by the date-scoped queries (a snapshot date present at every scale factor).
REPORT_DATE = date(1998, 1, 1)


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _models(spark: SparkSession, sf_dir: str):
    return build_models(testbed.landed_pricing_pages(spark, sf_dir))


# ---- staging / silver / gold over lineitem pages -------------------------------------------

@register("stg_products")
def q_stg_products(spark, sf_dir):
    """MOD1: one row per product of every OK page (JSON columns left out; lineage kept)."""
    m = _models(spark, sf_dir)
    return m.products.select(*[c for c in flatten.PRODUCT_COLUMNS if not c.endswith("_json")],
                             "page_num", "product_pos")


@register("stg_fees")
def q_stg_fees(spark, sf_dir):
    """MOD2: one row per fee, fee JSON as compact text."""
    return flatten.json_columns_as_text(_models(spark, sf_dir).fees)


@register("stg_rates")
def q_stg_rates(spark, sf_dir):
    """MOD3: deposit and lending rates in one pass, kind-tagged."""
    return _models(spark, sf_dir).rates.drop("tiers_json", "conditions_json", "rate_json")


@register("stg_rate_tiers")
def q_stg_rate_tiers(spark, sf_dir):
    """MOD4: one row per (rate, tier); untiered rates keep one NULL-tier row."""
    return flatten.json_columns_as_text(_models(spark, sf_dir).rate_tiers)


@register("dim_products")
def q_dim_products(spark, sf_dir):
    """MOD5: latest product version per (provider, product, date)."""
    return _models(spark, sf_dir).dim_products


@register("fct_product_fees")
def q_fct_product_fees(spark, sf_dir):
    """MOD6: fee fact (projection, no dedupe)."""
    return flatten.json_columns_as_text(_models(spark, sf_dir).fct_product_fees)


@register("fct_product_rates")
def q_fct_product_rates(spark, sf_dir):
    """MOD7: rate fact (projection, rate_value renamed to rate)."""
    return flatten.json_columns_as_text(_models(spark, sf_dir).fct_product_rates)


@register("rate_changes")
def q_rate_changes(spark, sf_dir):
    """MOD8: rates added, removed or changed between each provider's consecutive snapshots."""
    return _models(spark, sf_dir).rate_changes()


@register("rate_changes_keyed")
def q_rate_changes_keyed(spark, sf_dir):
    """MOD8 where keys are unique in every snapshot (one rate per key): the mart's full outer join."""
    keys = ["provider_id", "as_of_date", "product_id", "rate_kind", "rate_type"]
    fact = _models(spark, sf_dir).rate_columns(*keys, "tier_name", "tier_minimum_value", "brand_name", "rate")
    one = (fact.withColumn("tier_name", F.coalesce("tier_name", F.lit("")))
           .withColumn("tier_minimum_value", F.coalesce("tier_minimum_value", F.lit(-1).cast("decimal(28,10)")))
           .groupBy(*keys, "tier_name", "tier_minimum_value").agg(F.max("brand_name").alias("brand_name"), F.max("rate").alias("rate")))
    return snapshot_changes(one, entity="provider_id", date="as_of_date", keys=["product_id", "rate_kind", "rate_type"],
                            sentinel_keys={"tier_name": "", "tier_minimum_value": -1}, value="rate", carry=["brand_name"])


@register("rate_changes_as_of")
def q_rate_changes_as_of(spark, sf_dir):
    """Same mart, pruned to one current date before the joins."""
    return _models(spark, sf_dir).rate_changes(as_of=REPORT_DATE)


@register("rate_change_report")
def q_rate_change_report(spark, sf_dir):
    """MOD10: top 200 changes on the report date by |delta|, NULL deltas last."""
    return rate_change_report(_models(spark, sf_dir).fct_product_rates, REPORT_DATE)


@register("rate_changes_flat")
def q_rate_changes_flat(spark, sf_dir):
    """The generic snapshot-diff operator straight on lineitem: supplier x year snapshots,
    keyed by (part, line status), value = discount."""
    li = testbed.read(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_partkey", "l_linestatus",
        F.to_date(F.date_trunc("year", "l_shipdate")).alias("as_of"),
        F.col("l_discount").cast("decimal(12,2)").alias("discount"))
    return snapshot_changes(li, entity="l_suppkey", date="as_of", keys=["l_partkey", "l_linestatus"],
                            value="discount")


# ---- events domain: coverage, drift, QA, upserts -------------------------------------------

QA_DATE = date(2024, 1, 15)
# Freshness "now" for the source-freshness test (fixed so the answer is reproducible).
FRESHNESS_NOW = "2024-02-03 00:00:00"


def _events(spark, sf_dir):
    return testbed.read(spark, sf_dir, "events")


def _coverage(spark, sf_dir):
    from ratewatch.operators.coverage import provider_coverage
    ev = _events(spark, sf_dir)
    runs = testbed.event_runs(ev)
    return provider_coverage(runs, testbed.event_brands(ev, runs), testbed.event_call_log(ev),
                             testbed.event_pages(ev), testbed.event_dim(ev))


@register("provider_coverage")
def q_provider_coverage(spark, sf_dir):
    """MOD9: pages OK, product rows, last status and error per run date and provider."""
    return _coverage(spark, sf_dir)


@register("coverage_report")
def q_coverage_report(spark, sf_dir):
    """MOD11: coverage rows of the QA date, ordered by brand (NULL last)."""
    from ratewatch.plans.reports import coverage_report
    return coverage_report(_coverage(spark, sf_dir), QA_DATE)


@register("coverage_summary")
def q_coverage_summary(spark, sf_dir):
    """MOD13: providers discovered and providers fetched OK on the QA date."""
    from ratewatch.plans.reports import coverage_summary
    return coverage_summary(_coverage(spark, sf_dir), QA_DATE)


@register("dim_latest")
def q_dim_latest(spark, sf_dir):
    """Latest event per (user, day): newest timestamp, then highest event id."""
    from ratewatch.operators.latest import latest_per_key
    ev = _events(spark, sf_dir).withColumn("as_of_date", F.to_date("ts"))
    return latest_per_key(ev, ["user_id", "as_of_date"], [F.col("ts").desc(), F.col("event_id").desc()],
                          ["user_id", "as_of_date", "event_id", "event_type", "value"])


def _fingerprints(spark, sf_dir):
    from ratewatch.operators.drift import fingerprints
    return fingerprints(testbed.event_pages(_events(spark, sf_dir)))


@register("fingerprints")
def q_fingerprints(spark, sf_dir):
    """DRF1-2: structural path set and SHA-256 fingerprint of every parsed page."""
    fp = _fingerprints(spark, sf_dir)
    return fp.select("provider_id", "endpoint", "fingerprint_hash",
                     F.array_join("fingerprint_paths", "|").alias("fingerprint_path_list"),
                     "observed_at", "run_id", "page_num")


@register("fingerprints_limited")
def q_fingerprints_limited(spark, sf_dir):
    """DRF1 with the limits of the original pipeline: the first three elements of arrays, four levels."""
    from ratewatch.operators.drift import fingerprints
    fp = fingerprints(testbed.event_pages(_events(spark, sf_dir)), max_depth=4, max_elems=3)
    return fp.withColumn("fingerprint_path_list", F.array_join("fingerprint_paths", "|")).drop("fingerprint_paths")


@register("drift_events")
def q_drift_events(spark, sf_dir):
    """DRF3: fingerprint changes between consecutive observations of a provider endpoint."""
    from ratewatch.operators.drift import drift_events
    return drift_events(_fingerprints(spark, sf_dir))


@register("drift_report")
def q_drift_report(spark, sf_dir):
    """MOD12: last 50 drift events observed on the QA date."""
    from ratewatch.operators.drift import drift_events
    from ratewatch.plans.reports import drift_report
    return drift_report(drift_events(_fingerprints(spark, sf_dir)), QA_DATE)


def _qa_inputs(spark, sf_dir) -> dict:
    from ratewatch.operators import quality as Q
    from ratewatch.operators.changes import rate_changes
    from ratewatch.operators.drift import drift_events
    from ratewatch.operators.drift import fingerprints
    from ratewatch.operators.coverage import provider_coverage
    # the six gates read the same inputs: keep the fetch rows once instead of recomputing them
    ev = _events(spark, sf_dir).persist()
    runs = testbed.event_runs(ev)
    pages = testbed.event_pages(ev)
    cov = provider_coverage(runs, testbed.event_brands(ev, runs), testbed.event_call_log(ev), pages,
                            testbed.event_dim(ev))
    dim = testbed.event_dim(ev)
    return {
        "coverage": cov, "dim_products": dim, "pages": pages,
        "rate_changes": lambda: rate_changes(testbed.event_rate_fact(ev), as_of=QA_DATE),
        "drift_events": lambda: drift_events(fingerprints(pages), bucket=F.date_trunc("minute", "observed_at")),
        "tests": [Q.unique_combo(dim, ["provider_id", "product_id", "as_of_date"]),
                  Q.not_null(dim, ["provider_id", "product_id", "as_of_date"]).filter(F.col("null_rows") > 0),
                  Q.unique_combo(cov, ["as_of_date", "provider_id"])]}


def _qa_gates(spark, sf_dir):
    from ratewatch.plans.qa import run_qa
    return run_qa(spark, QA_DATE, **_qa_inputs(spark, sf_dir))


@register("qa_gates")
def q_qa_gates(spark, sf_dir):
    """QAG1-10: the six QA gates for the QA date."""
    return _qa_gates(spark, sf_dir)


@register("declared_tests")
def q_declared_tests(spark, sf_dir):
    """DQT1-3: all 17 declared tests of the built models, with their failing rows. Rates repeat under
    the mart's key here, so its unique test fails."""
    from ratewatch.operators.changes import RATE_INPUT_COLUMNS, rate_changes
    from ratewatch.plans.qa import declared_tests
    from ratewatch.session import kept
    m = _models(spark, sf_dir)
    rates = kept(m.rate_columns(*RATE_INPUT_COLUMNS), "rates")     # the tests, the snapshot dates and the diff read them
    return declared_tests({"dim_products": m.dim_products, "fct_product_rates": rates,
                           "mart_rate_changes": rate_changes(rates), "mart_provider_coverage": _coverage(spark, sf_dir)})


@register("qa_gates_strict")
def q_qa_gates_strict(spark, sf_dir):
    """QAG1-10 where gates fail: thresholds out of reach, drift enforced, a missing relation."""
    from ratewatch.operators.drift import drift_events, fingerprints
    from ratewatch.plans.qa import run_qa
    ev = _events(spark, sf_dir)
    pages = testbed.event_pages(ev)
    return run_qa(spark, QA_DATE, coverage=None, dim_products=testbed.event_dim(ev), pages=pages, rate_changes=None,
                  drift_events=lambda: drift_events(fingerprints(pages), bucket=F.date_trunc("minute", "observed_at")),
                  min_products=10**9, max_freshness_hours=0.0, fail_on_schema_drift=True)


@register("qa_gates_by_name")
def q_qa_gates_by_name(spark, sf_dir):
    """SRC11, FLT14: the gates over whichever relation a model has in the catalog; the change mart has none."""
    from ratewatch.operators.drift import drift_events, fingerprints
    from ratewatch.plans.qa import run_qa_by_name
    from ratewatch.sources.tables import register_models
    ev = _events(spark, sf_dir)
    pages = testbed.event_pages(ev)
    register_models({"public_gold_mart_provider_coverage": _coverage(spark, sf_dir), "silver_dim_products": testbed.event_dim(ev),
                     "raw_products_raw": pages, "bronze_schema_drift_event": drift_events(fingerprints(pages))})
    return run_qa_by_name(spark, QA_DATE, separator="_")


@register("qa_verdict")
def q_qa_verdict(spark, sf_dir):
    """QAG11: PASS/FAIL and exit code over the gates."""
    from ratewatch.operators.quality import verdict
    return verdict(_qa_gates(spark, sf_dir))


@register("unique_combo")
def q_unique_combo(spark, sf_dir):
    """DQT1: duplicate (order, line number) combinations with their counts."""
    from ratewatch.operators.quality import unique_combo
    return unique_combo(testbed.read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("not_null")
def q_not_null(spark, sf_dir):
    """DQT2: NULL counts of the order columns, one pass."""
    from ratewatch.operators.quality import not_null
    return not_null(testbed.read(spark, sf_dir, "orders"),
                    ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])


@register("accepted_values")
def q_accepted_values(spark, sf_dir):
    """DQT3: order statuses outside the accepted set."""
    from ratewatch.operators.quality import accepted_values
    return accepted_values(testbed.read(spark, sf_dir, "orders"), "o_orderstatus", ["F", "O"]).select(
        "o_orderkey", "o_orderstatus")


@register("fk_orphans")
def q_fk_orphans(spark, sf_dir):
    """Call-log rows whose run is missing (the run table is derived from the same events, so the
    expected answer is empty) plus orders whose customer is missing."""
    from ratewatch.operators.quality import fk_orphans
    ev = _events(spark, sf_dir)
    calls = fk_orphans(testbed.event_call_log(ev), testbed.event_runs(ev), "run_id").select(
        F.lit("api_call_log").alias("child"), F.col("url").alias("child_key"))
    orders = fk_orphans(testbed.read(spark, sf_dir, "orders"), testbed.read(spark, sf_dir, "customer"),
                        "o_custkey", "c_custkey").select(F.lit("orders").alias("child"),
                                                         F.col("o_orderkey").cast("string").alias("child_key"))
    return calls.unionByName(orders)


@register("source_freshness")
def q_source_freshness(spark, sf_dir):
    """DQT4: age of the newest fetch per raw source and its pass/warn/error status."""
    from ratewatch.operators.quality import freshness
    ev = _events(spark, sf_dir)
    calls = testbed.event_call_log(ev)
    now = F.lit(FRESHNESS_NOW).cast("timestamp")
    pages = freshness(testbed.event_pages(ev), "fetched_at", now).select(F.lit("products_raw").alias("source"), "*")
    detail = freshness(calls.filter(F.col("endpoint") == testbed.DETAIL_ENDPOINT), "fetched_at", now).select(
        F.lit("product_detail_raw").alias("source"), "*")
    return pages.unionByName(detail)


def _writes(spark, sf_dir):
    ev = _events(spark, sf_dir)
    cut = F.lit(QA_DATE).cast("timestamp")
    cols = ["user_id", "event_type", "event_id", "ts", "value", "props"]
    return ev.filter(F.col("ts") < cut).select(*cols), ev.filter(F.col("ts") >= cut).select(*cols)


@register("insert_ignore")
def q_insert_ignore(spark, sf_dir):
    """Events before the QA date are the table; later events insert with ON CONFLICT DO NOTHING
    on (user, event type); incoming rows are applied in (ts, event_id) order."""
    from ratewatch.operators.upsert import insert_ignore
    target, incoming = _writes(spark, sf_dir)
    base = insert_ignore(None, target, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")])
    return insert_ignore(base, incoming, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")])


@register("upsert_all")
def q_upsert_all(spark, sf_dir):
    """SNK3: as insert_ignore's split, but the last write per key replaces every column."""
    from ratewatch.operators.upsert import upsert
    target, incoming = _writes(spark, sf_dir)
    base = upsert(None, target, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")])
    return upsert(base, incoming, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")])


@register("upsert_partial")
def q_upsert_partial(spark, sf_dir):
    """As upsert_all, but ``event_id`` and ``props`` keep the first write's value."""
    from ratewatch.operators.upsert import upsert
    target, incoming = _writes(spark, sf_dir)
    kf = ["event_id", "props"]
    order = [F.col("ts"), F.col("event_id")]
    base = upsert(None, target, ["user_id", "event_type"], order, keep_first=kf)
    return upsert(base, incoming, ["user_id", "event_type"], order, keep_first=kf)


@register("atomic_groups")
def q_atomic_groups(spark, sf_dir):
    """Per-provider-day all-or-nothing: keep a user's day only if none of its calls failed (5xx)."""
    from ratewatch.operators.upsert import atomic_groups
    calls = testbed.event_call_log(_events(spark, sf_dir)).withColumn("as_of_date", F.to_date("fetched_at"))
    kept = atomic_groups(calls, ["provider_id", "as_of_date"], F.col("http_status") >= 500)
    return kept.select("provider_id", "as_of_date", "url", "http_status")


# ---- collection bookkeeping -----------------------------------------------------------------

def _discovered(spark, sf_dir):
    from ratewatch.operators.collect import discover_providers
    return discover_providers(testbed.register_documents(testbed.read(spark, sf_dir, "customer")))


BRAND_COLUMNS = ["run_id", "data_holder_brand_id", "brand_name", "brand_group", "industries",
                 "public_base_uri", "product_base_uri", "logo_uri", "last_updated"]


@register("discover_providers")
def q_discover_providers(spark, sf_dir):
    """COL1: register documents -> banking providers with an id."""
    from ratewatch.operators.collect import brand_rows
    return brand_rows(_discovered(spark, sf_dir)).select(*BRAND_COLUMNS)


@register("discovery_counts")
def q_discovery_counts(spark, sf_dir):
    """COL1/AGG13: discovered, kept and skipped-for-missing-id counts per run."""
    from ratewatch.operators.collect import discovery_counts
    return discovery_counts(_discovered(spark, sf_dir), ["run_id"])


@register("first_page_requests")
def q_first_page_requests(spark, sf_dir):
    """COL2: first product-list request per provider (base URI fallback, one slash)."""
    from ratewatch.operators.collect import brand_rows, first_page_requests
    return first_page_requests(brand_rows(_discovered(spark, sf_dir)))


@register("detail_requests")
def q_detail_requests(spark, sf_dir):
    """COL3: one detail request per distinct product id of a provider, in id order."""
    from ratewatch.operators.collect import detail_requests
    prods = _models(spark, sf_dir).products
    return detail_requests(prods, testbed.supplier_brands(testbed.read(spark, sf_dir, "supplier")))


@register("version_choice")
def q_version_choice(spark, sf_dir):
    """COL4-5: attempt used per request and the version it answered with."""
    from ratewatch.operators.collect import choose_version
    return choose_version(testbed.event_attempts(_events(spark, sf_dir)))


@register("call_log")
def q_call_log(spark, sf_dir):
    """COL8: call-log rows with body hash and error text, from the responses."""
    from ratewatch.operators.collect import call_log_rows
    return call_log_rows(testbed.event_responses(_events(spark, sf_dir)))


@register("run_totals")
def q_run_totals(spark, sf_dir):
    """COL10: products listed (duplicates counted) and pages per run and provider."""
    from ratewatch.operators.collect import run_totals
    return run_totals(testbed.landed_pricing_pages(spark, sf_dir))


# ---- scalar functions on whole tables ------------------------------------------------------

@register("text_functions")
def q_text_functions(spark, sf_dir):
    """STR2-6: hashing, clipping, page labels, path-safe names and error text on whole documents."""
    from ratewatch.functions.text import clip_text, error_text, page_label, safe_path_component, sha256_hex
    d = testbed.read(spark, sf_dir, "documents")
    clipped = clip_text(F.col("text"), 4000)
    return d.select(
        "doc_id", sha256_hex("text").alias("text_sha256"),
        F.length(clipped).alias("clipped_length"), F.sha2(clipped, 256).alias("clipped_sha256"),
        page_label("doc_id").alias("page_label"),
        F.sha2(safe_path_component(F.concat("source", F.lit(":"), "lang", F.lit("/"), "text")), 256)
         .alias("safe_name_sha256"),
        F.sha2(error_text(F.lit(500), F.col("text")), 256).alias("error_sha256"),
        error_text(F.lit(404), F.lit("")).alias("error_empty"))


@register("url_functions")
def q_url_functions(spark, sf_dir):
    """URL1-3, STR2: path-safe URLs, next-link resolution, URL join and template fill."""
    from ratewatch.functions.text import fill_template, resolve_url, safe_path_component, url_join
    p = testbed.read(spark, sf_dir, "pages")
    href = F.regexp_extract("html", 'href="([^"]*)"', 1)
    origin = F.regexp_extract("url", r"\A([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    return p.select(
        "page_id", safe_path_component("url").alias("safe_url"),
        resolve_url(F.col("url"), href).alias("next_url"),
        url_join(F.concat(origin, F.lit("/cds/")), F.lit("/banking/products")).alias("products_url"),
        fill_template(F.lit("/banking/products/{productId}"), F.col("page_id").cast("string")).alias("detail_path"))


@register("safe_casts")
def q_safe_casts(spark, sf_dir):
    """NUM1, BOL1, TIM1: safe numeric, boolean and timestamp casts on generated text forms."""
    from ratewatch.functions.casting import to_bool_pg, to_numeric, to_timestamptz
    li = testbed.read(spark, sf_dir, "lineitem")
    n = F.col("l_linenumber")
    num_text = (F.when(n == 1, F.format_string("%.2f", F.col("l_extendedprice")))
                 .when(n == 2, F.concat(F.lit("+"), n.cast("string")))
                 .when(n == 3, F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit("%")))
                 .when(n == 4, F.concat(F.lit(" "), n.cast("string")))
                 .when(n == 5, F.concat(F.lit("-"), F.format_string("%.2f", F.col("l_discount"))))
                 .when(n == 6, F.format_string("%de-3", n))
                 .otherwise(F.lit("")))
    words = F.array(*[F.lit(w) for w in ["true", "T", "on", "off", "yes", "0", "", "maybe", "OF", " No "]])
    bool_text = F.element_at(words, (F.col("l_partkey") % 10 + 1).cast("int"))
    s = F.col("l_suppkey") % 4
    ts_text = (F.when(s == 0, F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'+11:00'"))
                .when(s == 1, F.date_format("l_shipdate", "yyyy-MM-dd"))
                .when(s == 2, F.lit("")).otherwise(F.lit("garbage")))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     num_text.alias("num_text"), to_numeric(num_text).alias("num_value"),
                     bool_text.alias("bool_text"), to_bool_pg(bool_text).alias("bool_value"),
                     ts_text.alias("ts_text"), to_timestamptz(ts_text).alias("ts_value"))


@register("json_extract")
def q_json_extract(spark, sf_dir):
    """JSN2 + NUM1 on stored JSON text (events.props)."""
    from ratewatch.functions.casting import to_numeric
    from ratewatch.functions.jsonpath import json_text, parse_json_lenient
    ev = testbed.read(spark, sf_dir, "events")
    v = parse_json_lenient("props")
    return ev.select("event_id", json_text(v, "k").alias("k_text"), to_numeric(json_text(v, "k")).alias("k_value"),
                     json_text(v, "missing").alias("missing_text"))


@register("landed_pages")
def q_landed_pages(spark, sf_dir):
    """SRC1: landed bodies with their calls, one row per body; equal bodies recur on pages and days."""
    from ratewatch.sources.landing import landing_to_pages
    pages = landing_to_pages(*testbed.landed_bodies(_events(spark, sf_dir)))
    return pages.select("run_id", "provider_id", "endpoint", "url", "page_num", "http_status", "fetched_at", "payload_hash",
                        F.col("payload").isNotNull().alias("parsed"))


@register("landed_files")
def q_landed_files(spark, sf_dir):
    """SNK1: bodies landed as ``page=NNNN.json`` files and read back by their index."""
    from ratewatch.sources.landing_files import land_files, read_files
    bodies, _ = testbed.landed_bodies(_events(spark, sf_dir))
    root = _scratch(spark, "landing")
    land_files(bodies.withColumnRenamed("provider", "provider_id"), root)
    return read_files(spark, root).select("ingestion_date", "provider", "endpoint", "page_num", F.sha2("content", 256).alias("content_sha256"))


@register("parse_error_calls")
def q_parse_error_calls(spark, sf_dir):
    """JSN4: error rows for OK calls whose body is no JSON."""
    from ratewatch.sources.landing import parse_error_calls
    return parse_error_calls(*testbed.landed_bodies(_events(spark, sf_dir))).drop("etag")


def _two_runs(df):
    """The frame for two runs, every row twice: as a link table looks after a repeated collection."""
    runs = F.explode(F.array(F.lit("run-1"), F.lit("run-2"), F.lit("run-1"), F.lit("run-2")))
    return df.withColumn("run_id", runs)


@register("page_chain")
def q_page_chain(spark, sf_dir):
    """COL6: whole page walks of two runs over links that are stored twice, with loop audit rows."""
    from ratewatch.operators.chain import follow_links
    starts, links = testbed.event_links(_events(spark, sf_dir))
    return follow_links(_two_runs(starts), _two_runs(links), keys=["run_id", "provider_id"])


@register("page_chain_capped")
def q_page_chain_capped(spark, sf_dir):
    """COL7: pages visited per provider plus loop / limit audit rows, with a cap of 200 pages."""
    from ratewatch.operators.chain import follow_links
    starts, links = testbed.event_links(_events(spark, sf_dir))
    return follow_links(starts, links, cap=200)


@register("rate_change_markdown")
def q_rate_change_markdown(spark, sf_dir):
    """Markdown table rows of the top 20 changes in the summary report."""
    from ratewatch.plans.reports import rate_change_table_lines
    rep = rate_change_report(_models(spark, sf_dir).fct_product_rates, REPORT_DATE)
    return rate_change_table_lines(rep, 20).select("line")


def _tables(spark, sf_dir):
    """The eight declared tables over the events."""
    from ratewatch.operators.drift import drift_events, fingerprints
    from ratewatch.operators.quality import gate_records
    from ratewatch.plans.qa import run_qa
    ev = _events(spark, sf_dir)
    runs, pages = testbed.event_runs(ev), testbed.event_pages(ev)
    prints = fingerprints(pages)
    return {"products_raw": pages, "api_call_log": testbed.event_call_log(ev), "pipeline_run": runs,
            "data_holder_brand": testbed.event_brands(ev, runs), "product_detail_raw": testbed.event_details(ev),
            "schema_fingerprint": prints, "schema_drift_event": drift_events(prints),
            "qa_gate_result": gate_records(run_qa(spark, QA_DATE, pages=pages), "qa-1", QA_DATE)}


@register("table_checks")
def q_table_checks(spark, sf_dir):
    """Declared keys and NOT NULL columns of all eight tables (DDL contract)."""
    from ratewatch.operators.quality import table_checks
    out = None
    for spec, df in _tables(spark, sf_dir).items():
        c = table_checks(df, spec)
        out = c if out is None else out.unionByName(c)
    return out


@register("run_fk_checks")
def q_run_fk_checks(spark, sf_dir):
    """JOI10, DQT7: orphans of the six tables that reference a run, in one pass; the runs of two days are missing."""
    from ratewatch.operators.quality import run_fk_checks
    from ratewatch.schemas import TABLES
    tables = _tables(spark, sf_dir)
    runs = tables["pipeline_run"].filter(~F.col("run_date").isin(QA_DATE, date(2024, 1, 17)))
    return run_fk_checks({n: df for n, df in tables.items() if TABLES[n].run_fk}, runs)


# ---- stored tables: publish, merge, contracts at the write ----------------------------------------

def _scratch(spark, name: str) -> str:
    import uuid

    from ratewatch.session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/stored/{name}-{uuid.uuid4().hex}"


@register("provider_publish")
def q_provider_publish(spark, sf_dir):
    """SNK9: two collections over the days before and after the QA date, two days in both. A provider that fails
    midway publishes nothing of that run; one that is collected again replaces its rows."""
    from ratewatch.sources import store
    ev = _events(spark, sf_dir)
    pages = testbed.event_pages(ev).select("run_id", "provider_id", "page_num", "http_status", "payload", F.to_date("fetched_at").alias("d"))
    day = F.lit(QA_DATE)
    root, group = _scratch(spark, "pages"), ["run_id", "provider_id"]
    first = pages.filter(F.col("d") <= day).withColumn("attempt", F.lit(1))
    again = pages.filter((F.col("d") >= F.date_sub(day, 2)) & ~F.coalesce(F.col("payload").contains('"meta"'), F.lit(False)))
    again = again.withColumn("attempt", F.lit(2))
    failed = F.col("http_status") >= 500
    store.publish_groups(first, root, group, failed=first.filter(failed))
    failed = failed | ((F.col("page_num") % 5 == 0) & F.col("payload").contains('"fees"'))
    store.publish_groups(again, root, group, failed=again.filter(failed))
    return store.read_published(spark, root, first.schema).select(*group, "page_num", "http_status", "attempt")


def _merged(spark, rows, name, key, columns):
    """``rows`` merged into a stored table: first those before the QA date, then the others."""
    from ratewatch.sources import store
    root = _scratch(spark, name)
    early = F.col("fetched_at") < F.lit(QA_DATE).cast("timestamp")
    for part in (rows.filter(early), rows.filter(~early)):
        store.merge_into(part, root, key, order=[F.col("fetched_at"), F.col("fetch_id")], keep_first=["brand_name", "url"])
    return store.read_stored(spark, root, rows.schema).select(*columns)


@register("merge_products_raw")
def q_merge_products_raw(spark, sf_dir):
    """SNK4: page fetches of monthly runs upserted into the stored page table; four page numbers per provider and run."""
    month = F.concat(F.lit("run-"), F.date_format("fetched_at", "yyyy-MM"))
    rows = testbed.event_pages(_events(spark, sf_dir)).withColumn("fetch_id", F.col("page_num")).withColumns(
        {"run_id": month, "page_num": F.col("page_num") % 4})
    return _merged(spark, rows, "products_raw", ["run_id", "provider_id", "endpoint", "page_num"],
                   ["run_id", "provider_id", "brand_name", "endpoint", "url", "page_num", "http_status", "responded_xv", "fetched_at", "etag",
                    "payload", "payload_hash"])


@register("merge_details")
def q_merge_details(spark, sf_dir):
    """SNK5: detail fetches of monthly runs upserted into the stored detail table."""
    month = F.concat(F.lit("run-"), F.date_format("fetched_at", "yyyy-MM"))
    rows = testbed.event_details(_events(spark, sf_dir)).withColumn("run_id", month)
    return _merged(spark, rows, "product_detail_raw", ["run_id", "provider_id", "product_id"],
                   ["run_id", "provider_id", "brand_name", "product_id", "url", "http_status", "responded_xv", "fetched_at", "etag", "payload",
                    "payload_hash"])


@register("rejects")
def q_rejects(spark, sf_dir):
    """SRC12, DQT5-6 at the write: pages without a URL, and pages whose key an earlier one has, with their reasons."""
    from ratewatch.sources.tables import read_rejected, write_checked
    rows = testbed.event_pages(_events(spark, sf_dir)).withColumn("fetch_id", F.col("page_num")).withColumns(
        {"page_num": F.col("page_num") % 2, "url": F.when(F.col("page_num") % 11 != 0, F.col("url"))})
    path = _scratch(spark, "checked")
    write_checked(rows, path, "products_raw", [F.col("fetched_at"), F.col("fetch_id")])
    return read_rejected(spark, path).select("run_id", "provider_id", "endpoint", "page_num", "url", "fetched_at", "reject_reason")


# ---- the detail endpoint ----------------------------------------------------------------------------

@register("detail_retry")
def q_detail_retry(spark, sf_dir):
    """COL3, COL10: requested details that no attempt answered with 200."""
    from ratewatch.operators.collect import detail_retry
    d = testbed.event_details(_events(spark, sf_dir))
    return detail_retry(d, d)


@register("run_totals_details")
def q_run_totals_details(spark, sf_dir):
    """AGG12, COL10: products listed, pages and details answered with 200, per run and provider."""
    from ratewatch.operators.collect import run_totals
    ev = _events(spark, sf_dir)
    return run_totals(testbed.event_pages(ev), testbed.event_details(ev))


def _both_endpoints(spark, sf_dir):
    ev = _events(spark, sf_dir)
    cols = ["run_id", "provider_id", "endpoint", "page_num", "http_status", "fetched_at", "payload"]
    return testbed.event_pages(ev).select(*cols).unionByName(testbed.event_details(ev).withColumnRenamed("fetch_id", "page_num").select(*cols))


@register("endpoint_drift")
def q_endpoint_drift(spark, sf_dir):
    """DRF4: drift events of both endpoints, listing pages and product details."""
    from ratewatch.operators.drift import drift_events, fingerprints
    return drift_events(fingerprints(_both_endpoints(spark, sf_dir)))


# ---- stored builds, appends and reports -------------------------------------------------------------

def _drift_tables(spark, sf_dir) -> str:
    """The drift tables of all days: first all but the QA date and the last day, then the last day (which goes by the
    stored state), then the QA date, which is late."""
    from ratewatch.plans.jobs import build_drift
    root = _scratch(spark, "drift")
    pages = _both_endpoints(spark, sf_dir).persist()
    last = pages.agg(F.max(F.to_date("fetched_at"))).first()[0]
    late = [d for d in (last, QA_DATE) if d is not None]
    build_drift(pages.filter(~F.to_date("fetched_at").isin(late)), root)
    for day in late:
        build_drift(pages, root, as_of=day)
    return root


@register("drift_events_stored")
def q_drift_events_stored(spark, sf_dir):
    """SRC8, SNK7, DRF3-4: drift events of both endpoints as stored by three builds, the last one of a late day."""
    return spark.read.parquet(f"{_drift_tables(spark, sf_dir)}/schema_drift_event").drop("as_of_date")


@register("drift_state")
def q_drift_state(spark, sf_dir):
    """SRC8: the latest fingerprint of every provider and endpoint, advanced by the same three builds."""
    return spark.read.parquet(f"{_drift_tables(spark, sf_dir)}/fingerprint_state").select(
        "provider_id", "endpoint", "fingerprint_hash", "observed_at")


@register("rate_changes_late")
def q_rate_changes_late(spark, sf_dir):
    """SNK10, MOD8: the change mart stored by builds of any order. A snapshot that was half collected is built again, and
    one comes late; each also changes what its providers' next snapshots are compared with."""
    from ratewatch.operators.changes import RATE_CHANGE_COLUMNS
    from ratewatch.plans.jobs import build_and_write
    pages, root = testbed.landed_pricing_pages(spark, sf_dir), _scratch(spark, "models")
    year = F.year("fetched_at")
    build_and_write(pages.filter((year != 1995) & ((year != 1994) | (F.col("page_num") % 2 == 0))), root, drift=False)
    for y in (1994, 1995):
        build_and_write(pages, root, as_of=date(y, 1, 1), drift=False)
    mart = spark.read.parquet(f"{root}/mart_rate_changes").withColumn("current_as_of_date", F.col("as_of_date").cast("date"))
    return mart.select(*RATE_CHANGE_COLUMNS)


@register("call_log_stored")
def q_call_log_stored(spark, sf_dir):
    """SNK6: call logs appended run by run. The run of the QA date is first stored with half its calls; its retry
    replaces it and the earlier runs stay."""
    from ratewatch.sources.tables import read_table, write_table
    calls, path = testbed.event_call_log(_events(spark, sf_dir)), f"{_scratch(spark, 'calls')}/api_call_log"
    day = F.to_date("fetched_at")
    write_table(calls.filter((day < QA_DATE) | ((day == QA_DATE) & (F.col("http_status") == 200))), path, "api_call_log", run="run_id")
    write_table(calls.filter(day >= QA_DATE), path, "api_call_log", run="run_id")
    return read_table(spark, path, "api_call_log")


def _stored_qa(spark, sf_dir) -> str:
    """A QA run that is stored twice: first before the models are there, then with all of them."""
    from ratewatch.plans.qa import store_qa
    root, given = _scratch(spark, "qa"), _qa_inputs(spark, sf_dir)
    store_qa(spark, QA_DATE, "qa-1", root, pages=given["pages"])
    store_qa(spark, QA_DATE, "qa-1", root, tests_command="declared tests", **given)
    return root


@register("qa_stored")
def q_qa_stored(spark, sf_dir):
    """SNK8: the stored gate results of a QA run that was repeated: six rows, of the second time."""
    from ratewatch.sources.tables import read_table
    return read_table(spark, f"{_stored_qa(spark, sf_dir)}/qa_gate_result", "qa_gate_result").drop("evaluated_at")


@register("qa_summary_stored")
def q_qa_summary_stored(spark, sf_dir):
    """SNK13: lines of the QA summary file."""
    return spark.read.text(f"{_stored_qa(spark, sf_dir)}/qa_summary_{QA_DATE.isoformat()}").select(F.col("value").alias("line"))


@register("rate_change_csv")
def q_rate_change_csv(spark, sf_dir):
    """SNK11: the rate-change report written as CSV and read back."""
    from ratewatch.plans.reports import write_csv
    report = rate_change_report(_models(spark, sf_dir).fct_product_rates, REPORT_DATE).persist()
    path = f"{_scratch(spark, 'reports')}/rate_changes"
    if not write_csv(report, path, one_file=True):
        return report
    return spark.read.schema(report.schema).option("header", True).option("escape", '"').csv(path)


@register("provider_limit")
def q_provider_limit(spark, sf_dir):
    """SRT5: the first 25 providers of the register, by name."""
    from ratewatch.operators.collect import brand_rows, limit_providers
    return limit_providers(brand_rows(_discovered(spark, sf_dir)), 25, ("brand_name", "data_holder_brand_id")).select(*BRAND_COLUMNS)
