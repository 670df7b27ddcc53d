"""Collection bookkeeping as table jobs: discovery, request lists, version choice, run totals.

The fetching itself is outside Spark; these operators apply the pipeline's rules to landed
register documents, page tables and attempt logs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewatch.functions.casting import first_truthy, nullif_empty
from ratewatch.functions.jsonpath import as_variant, json_array, json_member, json_text
from ratewatch.functions.text import fill_template, url_join

# Endpoint names and request paths.
PRODUCTS_ENDPOINT = "banking:get-products"
DETAIL_ENDPOINT = "banking:get-product-detail"
PRODUCTS_PATH = "/cds-au/v1/banking/products"
PRODUCT_DETAIL_PATH = "/cds-au/v1/banking/products/{productId}"
NOT_ACCEPTABLE = 406


def discover_providers(register: DataFrame, doc: str = "doc", filter_industry: str = "banking") -> DataFrame:
    """Register documents ``{"data": [brand, ...]}`` -> one row per brand in the industry.

    Keeps the register position (``register_pos``: document order, then element order) and a
    ``missing_id`` flag; ``brand_rows`` drops the flagged rows, ``discovery_counts`` counts them.
    """
    filt = filter_industry.lower().strip()
    base = register.select("*", F.posexplode(json_array(as_variant(register, doc), "data")).alias("register_pos", "_b"))
    b = F.col("_b")
    inds = F.transform(F.coalesce(json_array(b, "industries"), F.array().cast("array<variant>")),
                       lambda x: F.lower(F.coalesce(F.try_variant_get(x, "$", "string"), F.lit("None"))))
    out = base.filter(F.array_contains(inds, F.lit(filt)))
    keep = [c for c in register.columns if c != doc]
    return out.select(
        *keep, "register_pos",
        json_text(b, "dataHolderBrandId").alias("data_holder_brand_id"),
        json_text(b, "brandName").alias("brand_name"),
        json_text(b, "brandGroup").alias("brand_group"),
        F.coalesce(F.to_json(json_member(b, "industries")), F.lit("[]")).alias("industries"),
        json_text(b, "publicBaseUri").alias("public_base_uri"),
        json_text(b, "productBaseUri").alias("product_base_uri"),
        json_text(b, "logoUri").alias("logo_uri"),
        json_text(b, "lastUpdated").alias("last_updated"),
        nullif_empty(json_text(b, "dataHolderBrandId")).isNull().alias("missing_id"),
    )


def brand_rows(discovered: DataFrame) -> DataFrame:
    return discovered.filter(~F.col("missing_id")).drop("missing_id")


def discovery_counts(discovered: DataFrame, by: list[str]) -> DataFrame:
    """Per run: brands discovered in the industry, kept, and skipped for a missing id."""
    return discovered.groupBy(*by).agg(F.count(F.lit(1)).alias("discovered"),
                                       F.count_if(~F.col("missing_id")).alias("kept"),
                                       F.count_if(F.col("missing_id")).alias("skipped_missing_id"))


def first_page_requests(brands: DataFrame, path: str = PRODUCTS_PATH) -> DataFrame:
    """First product-list request per provider; providers without id or base URI are skipped."""
    base = first_truthy("product_base_uri", "public_base_uri")
    ok = nullif_empty(F.col("data_holder_brand_id")).isNotNull() & base.isNotNull()
    return brands.filter(ok).select(
        "run_id", F.col("data_holder_brand_id").alias("provider_id"), "brand_name",
        F.lit(PRODUCTS_ENDPOINT).alias("endpoint"), url_join(base, F.lit(path)).alias("url"),
        F.lit(1).alias("page_num"))


def detail_requests(product_ids: DataFrame, brands: DataFrame, template: str = PRODUCT_DETAIL_PATH) -> DataFrame:
    """One detail request per distinct non-empty product id of a provider, in id order."""
    ids = (product_ids.filter(nullif_empty(F.col("product_id")).isNotNull())
           .select("provider_id", "product_id").distinct())
    b = brands.select(F.col("data_holder_brand_id").alias("provider_id"),
                      first_truthy("product_base_uri", "public_base_uri").alias("_base")).filter(
        F.col("_base").isNotNull())
    j = ids.join(b, "provider_id")
    return (j.select("provider_id", "product_id", F.lit(DETAIL_ENDPOINT).alias("endpoint"),
                     url_join(F.col("_base"), fill_template(F.lit(template), F.col("product_id"))).alias("url"))
             .orderBy("provider_id", "product_id"))


def choose_version(attempts: DataFrame, key: str = "url", attempt: str = "attempt", xv: str = "xv",
                   status: str = "http_status", header: str = "responded_header") -> DataFrame:
    """Per request: the attempt whose response is used, trying versions in order.

    The first attempt that returned a response other than 406 wins; if every response was 406
    the last 406 is used (reported against the preferred, i.e. first, version); if no attempt got
    a response the request failed. ``status`` NULL marks an attempt that raised.
    """
    st = F.col(status)
    usable = st.isNotNull() & (st != NOT_ACCEPTABLE)
    na = st == NOT_ACCEPTABLE
    rec = F.struct(F.col(attempt).alias("attempt"), F.col(xv).alias("xv"), st.alias("status"),
                   F.col(header).alias("header"))
    g = attempts.groupBy(key).agg(
        F.min_by(rec, F.when(usable, F.col(attempt))).alias("_ok"),
        F.max_by(rec, F.when(na, F.col(attempt))).alias("_na"),
        F.min_by(F.col(xv), F.col(attempt)).alias("_preferred"),
        F.count(F.lit(1)).alias("attempts"))
    chosen = F.coalesce(F.col("_ok"), F.col("_na"))
    fallback_xv = F.when(F.col("_ok").isNotNull(), F.col("_ok.xv")).otherwise(F.col("_preferred"))
    return g.select(
        key, "attempts",
        chosen["attempt"].alias("chosen_attempt"),
        chosen["status"].alias("http_status"),
        F.when(chosen.isNotNull(), F.coalesce(chosen["header"].try_cast("int"), fallback_xv)).alias("responded_xv"),
        F.when(F.col("_ok").isNotNull(), F.lit("ok"))
         .when(F.col("_na").isNotNull(), F.lit("not_acceptable"))
         .otherwise(F.lit("failed")).alias("outcome"))


def run_totals(pages: DataFrame, details: DataFrame | None = None, by: tuple[str, ...] = ("run_id", "provider_id"),
               payload: str = "payload") -> DataFrame:
    """Products listed on parsed pages (duplicates counted) and detail fetches with status 200."""
    n = F.size(F.coalesce(json_array(as_variant(pages, payload), "data.products"), F.array().cast("array<variant>")))
    t = pages.groupBy(*by).agg(F.sum(n).cast("long").alias("products_listed"),
                               F.count(F.lit(1)).alias("pages"))
    if details is None:
        return t
    d = details.groupBy(*by).agg(F.count_if(F.col("http_status") == 200).alias("details_ok"))
    return t.join(d, list(by), "full_outer").select(
        *by, F.coalesce("products_listed", F.lit(0)).alias("products_listed"),
        F.coalesce("pages", F.lit(0)).alias("pages"), F.coalesce("details_ok", F.lit(0)).alias("details_ok"))


def detail_retry(requests: DataFrame, fetched: DataFrame, key: tuple[str, ...] = ("run_id", "provider_id", "product_id")) -> DataFrame:
    """Requested details that no fetch answered with 200: the next round's requests, with the attempts made so far and
    the last status (None: never tried). Fetches are summed per key before the join."""
    tried = fetched.groupBy(*key).agg(F.count(F.lit(1)).alias("attempts"), F.count_if(F.col("http_status") == 200).alias("_ok"),
                                      F.max_by("http_status", F.struct("fetched_at", "http_status")).alias("last_status"))
    wanted = requests.select(*key).distinct()
    return (wanted.join(tried, list(key), "left").filter(F.coalesce(F.col("_ok"), F.lit(0)) == 0)
            .select(*key, F.coalesce("attempts", F.lit(0)).alias("attempts"), "last_status"))


def call_log_rows(responses: DataFrame, body: str = "body") -> DataFrame:
    """Call-log rows from responses: SHA-256 of the body (NULL when empty) and the error text; the body itself stays out."""
    from ratewatch.functions.text import error_text, sha256_hex
    return responses.select("*", sha256_hex(F.col(body)).alias("payload_hash"),
                            error_text(F.col("http_status"), F.col(body)).alias("error")).drop(body)



def limit_providers(brands: DataFrame, n: int | None, order: tuple[str, ...] = ("register_pos",)) -> DataFrame:
    """The first ``n`` providers in register order (all of them when ``n`` is empty or <= 0)."""
    if not n or n <= 0:
        return brands
    return brands.orderBy(*order).limit(n)
