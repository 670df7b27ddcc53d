"""Driver tables -> pricing-shaped inputs.

The driver's TPC-H-like tables stand in for the pricing domain so every operator runs on data
that grows with the scale factor:

* lineitem -> product pages (``products_raw``): provider = supplier, page = the supplier's lines
  of one order in one year, product = part, one fee from the tax, one deposit or lending rate
  from the discount, a tier when the quantity is 25 or more. Snapshot date = 1 January of the
  ship year; fetch time = that midnight + order key microseconds.
* events -> runs, provider registers, call log and page fetches (coverage inputs): provider =
  user, run = event day, status from the event type.

Pages are packed into JSON text here, their products with ``to_json`` (a page holds at most one order's lines,
so the per-page ``collect_list`` is bounded by construction).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewatch.functions.jsonpath import json_text

PRODUCTS_ENDPOINT = "banking:get-products"
DETAIL_ENDPOINT = "banking:get-product-detail"

# Fixed values of the test bed (must agree with the oracle SQL in __spark_entry__.py).
CATEGORY_BY_RETURNFLAG = {"A": "TRANS_AND_SAVINGS_ACCOUNTS", "N": "TERM_DEPOSITS"}
CATEGORY_OTHER = "RESIDENTIAL_MORTGAGES"
STATUS_BY_EVENT_TYPE = {"view": 200, "click": 200, "purchase": 200, "signup": 304, "error": 500}


# Order of products inside a page.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount",
              "l_tax", "l_returnflag", "l_linestatus"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _money_text(x: Column) -> Column:
    """Two-decimal text of a double (e.g. 0.05 -> '0.05')."""
    return x.cast("decimal(12,2)").cast("string")


def _category(flag: Column) -> Column:
    c = F.lit(CATEGORY_OTHER)
    for k, v in reversed(list(CATEGORY_BY_RETURNFLAG.items())):
        c = F.when(flag == k, F.lit(v)).otherwise(c)
    return c


def _rate_array(line: Mapping[str, Column], type_field: str) -> Column:
    q = line["l_quantity"]
    band = F.floor(q / 10)
    tier = F.struct(
        F.concat(F.lit("Tier "), band.cast("string")).alias("name"),
        F.lit("DOLLAR").alias("unitOfMeasure"),
        (band * 10).cast("decimal(12,2)").alias("minimumValue"),
        (band * 10 + F.lit(9.99).cast("decimal(4,2)")).cast("decimal(12,2)").alias("maximumValue"),
    )
    rate = F.struct(
        F.when(line["l_linestatus"] == "F", F.lit("FIXED")).otherwise(F.lit("VARIABLE")).alias(type_field),
        _money_text(line["l_discount"]).alias("rate"),
        F.lit("P1M").alias("applicationFrequency"),
        F.concat(F.lit("P"), line["l_linenumber"].cast("string"), F.lit("M")).alias("additionalValue"),
        F.when(q >= 25, F.array(tier)).alias("tiers"),
    )
    return F.array(rate)


# Bump when the page packing changes: landed copies live under a versioned folder.
TESTBED_VERSION = "v2"


def landed_pricing_pages(spark: SparkSession, sf_dir: str, namespace: str | None = None) -> DataFrame:
    """``products_raw`` for ``sf_dir``, landed once as parquet in the shared checkpoint folder.

    In the pipeline the page table is at rest before any model runs; landing the packed pages
    once (instead of re-packing them in every query) mirrors that. The copy is keyed by the
    test-bed version and the input's file listing (names, sizes, times, read through Spark, so on
    any file system), and it counts only once its write has committed (``_SUCCESS``).
    """
    import hashlib
    import os

    from ratewatch.session import checkpoint_dir
    lineitem = read(spark, sf_dir, "lineitem")
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def listed(path: str) -> str:
        p = jvm.org.apache.hadoop.fs.Path(path)
        s = p.getFileSystem(conf).getFileStatus(p)
        return f"{path}|{s.getLen()}|{s.getModificationTime()}"

    key = hashlib.sha1("\n".join(listed(f) for f in sorted(lineitem.inputFiles())).encode()).hexdigest()[:16]
    ns = namespace or os.environ.get("RATEWATCH_LANDING_NAMESPACE", "shared")
    path = f"{checkpoint_dir(spark).rstrip('/')}/landed/{TESTBED_VERSION}/{ns}/{key}/products_raw"
    done = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not done.getFileSystem(conf).exists(done):
        # payload is stored parsed (VARIANT, the counterpart of jsonb): readers never re-parse text
        (pricing_pages(lineitem).withColumn("payload", F.try_parse_json("payload"))
            .write.mode("overwrite").option("compression", "zstd").option("parquet.compression.codec.zstd.level", "3").parquet(path))
    return spark.read.parquet(path)


def _product(line: Mapping[str, Column], suppkey: Column) -> Column:
    """The product struct of one line."""
    amount = F.when(line["l_tax"] == 0, F.lit("")).otherwise(_money_text(line["l_tax"]))
    return F.struct(
        line["l_partkey"].cast("string").alias("productId"),
        F.concat(F.lit("Product "), line["l_partkey"].cast("string")).alias("name"),
        _category(line["l_returnflag"]).alias("productCategory"),
        F.concat(F.replace(line["l_shipdate"].cast("string"), F.lit(" "), F.lit("T")),
                 F.lit("+10:00")).alias("lastUpdated"),
        F.when(line["l_linestatus"] == "F", F.to_date(line["l_shipdate"]).cast("string"))
         .otherwise(F.lit("")).alias("effectiveFrom"),
        F.concat(F.lit("Brand "), suppkey.cast("string")).alias("brand"),
        F.lit("").alias("brandGroup"),
        (line["l_quantity"] > 25).alias("isTailored"),
        F.array(F.struct(F.lit("Account fee").alias("name"), F.lit("PERIODIC").alias("feeType"),
                         amount.alias("amount"), F.lit("AUD").alias("currency"))).alias("fees"),
        F.when(line["l_returnflag"] != "R", _rate_array(line, "depositRateType")).alias("depositRates"),
        F.when(line["l_returnflag"] == "R", _rate_array(line, "lendingRateType")).alias("lendingRates"),
    )


def pricing_pages(lineitem: DataFrame) -> DataFrame:
    """``products_raw``-shaped page rows built from lineitem (payload as JSON text).

    Only the lines' own columns are exchanged, before the grouping (pages hold few lines, so a partial aggregate would
    sort every line for nothing). The products, several times as wide, are made behind the exchange, line by line and as text:
    there they are compiled code, in a function over the grouped lines they are interpreted."""
    page = ["l_suppkey", "l_orderkey", "_yr"]
    yr = F.date_trunc("year", F.col("l_shipdate")).cast("timestamp")
    lines = lineitem.select("l_suppkey", "l_orderkey", yr.alias("_yr"), *LINE_ORDER).repartition(*page).sortWithinPartitions(*page, *LINE_ORDER)
    product = F.to_json(_product({c: F.col(c) for c in LINE_ORDER}, F.col("l_suppkey")))
    lines = lines.select(*page, F.struct(*LINE_ORDER, product.alias("_product")).alias("_line"))
    # products of a page are ordered by the whole line (line numbers alone can repeat)
    pages = lines.groupBy(*page).agg(F.array_sort(F.collect_list("_line")).alias("_lines"))
    payload = F.concat(F.lit('{"data":{"products":['), F.array_join(F.col("_lines")["_product"], ","), F.lit(']},"links":{"next":""}}'))
    supp = F.col("l_suppkey").cast("string")
    return pages.select(
        F.concat(F.lit("run-"), F.year("_yr").cast("string")).alias("run_id"),
        F.concat(F.lit("prov-"), supp).alias("provider_id"),
        F.concat(F.lit("Brand "), supp).alias("brand_name"),
        F.lit(PRODUCTS_ENDPOINT).alias("endpoint"),
        F.concat(F.lit("https://prov-"), supp, F.lit(".example.com/cds-au/v1/banking/products?page="),
                 F.col("l_orderkey").cast("string")).alias("url"),
        F.col("l_orderkey").cast("long").alias("page_num"),
        F.lit(200).alias("http_status"),
        F.lit(3).alias("responded_xv"),
        F.timestamp_micros(F.unix_micros("_yr") + F.col("l_orderkey")).alias("fetched_at"),
        F.lit(None).cast("string").alias("etag"),
        payload.alias("payload"),
    ).withColumn("payload_hash", F.sha2("payload", 256))


# ---- events -> runs, registers, call log and page fetches ------------------------------------

# Page payload templates by event type (%s = the event's "k" value). A click page
# lists four products (the fourth carries an extra member); a purchase page nests fees.
PAYLOAD_BY_EVENT_TYPE = {
    "view": '{"data":{"products":[{"productId":"v%s"}]},"links":{"next":""}}',
    "click": ('{"data":{"products":[{"productId":"a%s"},{"productId":"b%s"},{"productId":"c%s"},'
              '{"productId":"d%s","extra":1}]},"links":{"next":""},"meta":{"k":%s}}'),
    "purchase": '{"data":{"products":[{"productId":"p%s","fees":[{"amount":"1.00"}]}]},"links":{"next":""}}',
}


def _status(event_type: Column) -> Column:
    st = F.lit(None).cast("int")
    for k, v in STATUS_BY_EVENT_TYPE.items():
        st = F.when(event_type == k, F.lit(v)).otherwise(st)
    return st


def _event_payload(event_type: Column, k: Column) -> Column:
    out = F.lit(None).cast("string")
    for t, tpl in PAYLOAD_BY_EVENT_TYPE.items():
        out = F.when(event_type == t, F.format_string(tpl, *([k] * tpl.count("%s")))).otherwise(out)
    return out


def event_runs(events: DataFrame) -> DataFrame:
    """``pipeline_run``: one run per event day, started at the day's first event."""
    d = events.groupBy(F.to_date("ts").alias("run_date")).agg(F.min("ts").cast("timestamp").alias("run_started_at"))
    return d.select(
        F.concat(F.lit("run-"), F.date_format("run_date", "yyyy-MM-dd")).alias("run_id"),
        "run_started_at", "run_date", F.lit("banking").alias("register_industry"),
        F.lit("banking").alias("filter_industry"), F.lit(False).alias("fetch_product_details"),
        F.lit(None).cast("string").alias("notes"))


def event_brands(events: DataFrame, runs: DataFrame) -> DataFrame:
    """``data_holder_brand``: a run registers every user active that day or the day before."""
    days = (events.select(F.to_date("ts").alias("run_date"), "user_id")
            .union(events.select(F.date_add(F.to_date("ts"), 1).alias("run_date"), "user_id"))
            .distinct())
    days = days.join(runs.select("run_id", "run_date", "run_started_at"), "run_date")
    u = F.col("user_id").cast("string")
    return days.select(
        "run_id", F.concat(F.lit("user-"), u).alias("data_holder_brand_id"),
        F.when(F.col("user_id") % 10 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("User "), u)).alias("brand_name"),
        F.lit(None).cast("string").alias("brand_group"), F.lit('["banking"]').alias("industries"),
        F.concat(F.lit("https://user-"), u, F.lit(".example.com")).alias("public_base_uri"),
        F.when(F.col("user_id") % 3 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("https://api.user-"), u, F.lit(".example.com/cds"))).alias("product_base_uri"),
        F.lit(None).cast("string").alias("logo_uri"), F.lit(None).cast("string").alias("last_updated"),
        F.col("run_started_at").alias("extracted_at"))


def _event_fetches(events: DataFrame, *own: str) -> DataFrame:
    from ratewatch.functions.text import error_text, sha256_hex
    u = F.col("user_id").cast("string")
    st = _status(F.col("event_type"))
    k = json_text(F.try_parse_json("props"), "k")
    payload = F.when(st == 200, _event_payload(F.col("event_type"), k))
    body = F.when(st == 200, payload).when(st == 500, F.col("props"))
    return events.select(
        F.concat(F.lit("run-"), F.date_format(F.to_date("ts"), "yyyy-MM-dd")).alias("run_id"),
        F.concat(F.lit("user-"), u).alias("provider_id"),
        F.when(F.col("user_id") % 10 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("User "), u)).alias("brand_name"),
        F.when(F.col("event_type") == "signup", F.lit(DETAIL_ENDPOINT))
         .otherwise(F.lit(PRODUCTS_ENDPOINT)).alias("endpoint"),
        F.concat(F.lit("https://api.user-"), u, F.lit(".example.com/cds/banking/products?page="),
                 F.col("event_id").cast("string")).alias("url"),
        F.col("event_id").alias("page_num"), st.alias("http_status"), F.lit(3).alias("responded_xv"),
        F.col("ts").cast("timestamp").alias("fetched_at"), F.lit(None).cast("string").alias("etag"),
        payload.alias("payload"), sha256_hex(body).alias("payload_hash"),
        error_text(st, body).alias("error"), F.col("event_type"), F.col("value"), *own)


def event_call_log(events: DataFrame) -> DataFrame:
    """``api_call_log``: one call per event."""
    return _event_fetches(events).select("run_id", "provider_id", "endpoint", "url", "http_status",
                                         "responded_xv", "fetched_at", "etag", "payload_hash", "error")


def event_pages(events: DataFrame) -> DataFrame:
    """``products_raw``: one listing page per non-signup event (payload only for status 200)."""
    return _event_fetches(events).filter(F.col("endpoint") == PRODUCTS_ENDPOINT).select(
        "run_id", "provider_id", "brand_name", "endpoint", "url", "page_num", "http_status",
        "responded_xv", "fetched_at", "etag", "payload", "payload_hash")


def event_responses(events: DataFrame) -> DataFrame:
    """Responses behind ``event_call_log``: one per event, with the body instead of its hash and error text."""
    st = _status(F.col("event_type"))
    k = json_text(F.try_parse_json("props"), "k")
    body = F.when(st == 200, _event_payload(F.col("event_type"), k)).when(st == 500, F.col("props"))
    return _event_fetches(events.withColumn("_body", body), "_body").select(
        "run_id", "provider_id", "endpoint", "url", "http_status", "responded_xv", "fetched_at", "etag", F.col("_body").alias("body"))


# Statuses of detail fetches by event id modulo 3.
DETAIL_STATUS = {0: 200, 1: 500, 2: 304}


def event_details(events: DataFrame) -> DataFrame:
    """``product_detail_raw``-shaped fetches: one attempt per signup event, for one of seven products of the user's
    run. A third answers 200, with one of two payload shapes."""
    e = events.filter(F.col("event_type") == "signup")
    u, n = F.col("user_id").cast("string"), F.col("event_id")
    product = F.concat(F.lit("prod-"), (n % 7).cast("string"))
    st = F.lit(None).cast("int")
    for rest, status in DETAIL_STATUS.items():
        st = F.when(n % 3 == rest, F.lit(status)).otherwise(st)
    fees = F.when(n % 2 == 0, F.lit(',"fees":[{"amount":"1.00"}]')).otherwise(F.lit(""))
    payload = F.when(st == 200, F.concat(F.lit('{"data":{"productId":"'), product, F.lit('"'), fees, F.lit("}}")))
    return e.select(
        F.concat(F.lit("run-"), F.date_format(F.to_date("ts"), "yyyy-MM-dd")).alias("run_id"),
        F.concat(F.lit("user-"), u).alias("provider_id"),
        F.when(F.col("user_id") % 10 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("User "), u)).alias("brand_name"),
        product.alias("product_id"), F.lit(DETAIL_ENDPOINT).alias("endpoint"),
        F.concat(F.lit("https://api.user-"), u, F.lit(".example.com/cds/banking/products/"), product, F.lit("?try="), n.cast("string")).alias("url"),
        st.alias("http_status"), F.lit(3).alias("responded_xv"), F.col("ts").cast("timestamp").alias("fetched_at"),
        F.lit(None).cast("string").alias("etag"), payload.alias("payload"), F.sha2(payload, 256).alias("payload_hash"),
        n.alias("fetch_id"))


def landed_bodies(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Landed response bodies of the listing pages and the call log of their fetches. Bodies repeat
    over days and pages, every seventh ends in a newline, and those of error events are no JSON."""
    from ratewatch.functions.text import safe_path_component, sha256_hex
    f = _event_fetches(events.filter(F.col("event_type") != "signup"))
    k = events.select(F.col("event_id").alias("page_num"), json_text(F.try_parse_json("props"), "k").alias("k"))
    f = f.join(k, "page_num")
    body = F.when(F.col("event_type") == "error", F.concat(F.lit('{"k":'), "k")).otherwise(F.col("payload"))
    f = f.withColumn("content", F.concat(body, F.when(F.col("page_num") % 7 == 0, F.lit("\n")).otherwise(F.lit(""))))
    landed = f.select(F.to_date("fetched_at").cast("string").alias("ingestion_date"),
                      safe_path_component(F.col("provider_id")).alias("provider"),
                      safe_path_component(F.col("endpoint")).alias("endpoint"), "page_num", "content",
                      F.lit(None).cast("string").alias("path"))
    log = f.select("run_id", "provider_id", "endpoint", "url", F.lit(200).alias("http_status"), "responded_xv",
                   "fetched_at", "etag", sha256_hex(F.col("content")).alias("payload_hash"))
    return landed, log


def event_dim(events: DataFrame) -> DataFrame:
    """Product rows of the events domain: latest (provider, event type, day) among OK pages."""
    from ratewatch.operators.latest import latest_per_key
    f = _event_fetches(events).filter((F.col("endpoint") == PRODUCTS_ENDPOINT) & (F.col("http_status") == 200))
    f = f.select("provider_id", "brand_name", F.to_date("fetched_at").alias("as_of_date"),
                 F.col("event_type").alias("product_id"), "fetched_at", "page_num")
    return latest_per_key(f, ["provider_id", "product_id", "as_of_date"],
                          [F.col("fetched_at").desc(), F.col("page_num").desc()],
                          ["provider_id", "brand_name", "as_of_date", "product_id"])


def event_rate_fact(events: DataFrame) -> DataFrame:
    """Rate-fact rows of the events domain: user x day snapshots, event type as product, value as rate."""
    f = _event_fetches(events).filter((F.col("endpoint") == PRODUCTS_ENDPOINT) & (F.col("http_status") == 200))
    return f.select(
        "provider_id", "brand_name", F.to_date("fetched_at").alias("as_of_date"),
        F.col("event_type").alias("product_id"), F.col("event_type").alias("product_name"),
        F.lit(None).cast("string").alias("product_category"), F.lit("deposit").alias("rate_kind"),
        F.lit("FIXED").alias("rate_type"), F.lit(None).cast("string").alias("tier_name"),
        F.lit(None).cast("string").alias("tier_unit_of_measure"),
        F.lit(None).cast("decimal(28,10)").alias("tier_minimum_value"),
        F.lit(None).cast("decimal(28,10)").alias("tier_maximum_value"),
        F.col("value").cast("decimal(28,10)").alias("rate"))


# ---- customer -> provider register documents; supplier -> brands --------------------------

REGISTER_RUN_ID = "run-register"


def register_documents(customer: DataFrame) -> DataFrame:
    """Register documents ``{"data": [brand, ...]}``: one per (nation, block of 100 customer keys),
    brands in key order. Negative balances are outside banking; balances below -900 lack an id."""
    k = F.col("c_custkey").cast("string")
    industries = F.when(F.col("c_acctbal") >= 0, F.array(F.lit("Banking"), F.lower("c_mktsegment"))) \
                  .otherwise(F.array(F.lower("c_mktsegment")))
    brand = F.struct(
        F.when(F.col("c_acctbal") < -900, F.lit("")).otherwise(F.concat(F.lit("cust-"), k)).alias("dataHolderBrandId"),
        F.col("c_name").alias("brandName"),
        industries.alias("industries"),
        F.concat(F.lit("https://cust-"), k, F.lit(".example.com")).alias("publicBaseUri"),
        F.when(F.col("c_acctbal") > 5000, F.concat(F.lit("https://api.cust-"), k, F.lit(".example.com/cds/")))
         .otherwise(F.lit("")).alias("productBaseUri"),
    )
    docs = customer.groupBy("c_nationkey", F.floor(F.col("c_custkey") / 100).alias("_blk")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("c_custkey").alias("k"), brand.alias("b")))).alias("_items"))
    return docs.select(F.lit(REGISTER_RUN_ID).alias("run_id"), "c_nationkey",
                       F.to_json(F.struct(F.transform("_items", lambda x: x["b"]).alias("data"))).alias("doc"))


def supplier_brands(supplier: DataFrame) -> DataFrame:
    """Brand rows for the pricing providers (one per supplier)."""
    k = F.col("s_suppkey").cast("string")
    return supplier.select(
        F.lit(REGISTER_RUN_ID).alias("run_id"), F.concat(F.lit("prov-"), k).alias("data_holder_brand_id"),
        F.concat(F.lit("Brand "), k).alias("brand_name"),
        F.concat(F.lit("https://www.prov-"), k, F.lit(".example.com")).alias("public_base_uri"),
        F.concat(F.lit("https://prov-"), k, F.lit(".example.com")).alias("product_base_uri"))


def event_attempts(events: DataFrame) -> DataFrame:
    """Attempt log for version negotiation: one request per user and day, attempts in event order.
    error -> the attempt raised (no status), signup -> 406, others -> 200. Requested version from
    the event id; the response header is the version for clicks, a non-number for views."""
    u = F.col("user_id").cast("string")
    st = (F.when(F.col("event_type") == "error", F.lit(None).cast("int"))
           .when(F.col("event_type") == "signup", F.lit(406)).otherwise(F.lit(200)))
    xv = (F.col("event_id") % 3 + 1).cast("int")
    header = (F.when(F.col("event_type") == "click", xv.cast("string"))
               .when(F.col("event_type") == "view", F.lit("v3")))
    return events.select(
        F.concat(F.lit("https://api.user-"), u, F.lit(".example.com/cds/"),
                 F.date_format(F.to_date("ts"), "yyyy-MM-dd")).alias("url"),
        F.col("event_id").alias("attempt"), xv.alias("xv"), st.alias("http_status"),
        header.alias("responded_header"))


# ---- events -> linked page chains ------------------------------------------------------------

CHAIN_BLOCK = 300
CHAIN_STOP_VALUE = 250


def event_links(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(starts, links): blocks of 300 consecutive event ids form one provider's page chain.

    Each page links to the next event id of its block (the last page has no link). Above value
    250, a signup page has no next link, a purchase page links back to the block's first page
    (a loop) and an error page is a failed fetch (status 500).
    """
    blk = F.floor(F.col("event_id") / CHAIN_BLOCK)
    prov = F.concat(F.lit("blk-"), blk.cast("string"))

    def page_url(eid):
        return F.concat(F.lit("https://"), prov, F.lit(".example.com/cds/banking/products?page="), eid.cast("string"))

    hi = F.col("value") > CHAIN_STOP_VALUE
    last = F.floor((F.col("event_id") + 1) / CHAIN_BLOCK) != blk
    nxt = (F.when((F.col("event_type") == "signup") & hi, F.lit(""))
            .when((F.col("event_type") == "purchase") & hi, page_url(blk * CHAIN_BLOCK))
            .when(last, F.lit(""))
            .otherwise(page_url(F.col("event_id") + 1)))
    usable = ~((F.col("event_type") == "error") & hi)
    links = events.select(prov.alias("provider_id"), page_url(F.col("event_id")).alias("url"),
                          nxt.alias("next_url"), usable.alias("usable"))
    # each chain starts at the first page of its block
    first = events.groupBy(blk.alias("_blk")).agg(F.min("event_id").alias("_first"))
    sprov = F.concat(F.lit("blk-"), F.col("_blk").cast("string"))
    starts = first.select(sprov.alias("provider_id"),
                          F.concat(F.lit("https://"), sprov, F.lit(".example.com/cds/banking/products?page="),
                                   F.col("_first").cast("string")).alias("url"))
    return starts, links
