"""Page payloads -> products -> fees / rates -> rate tiers (the staging models).

One parse per page (JSON text -> VARIANT); every later step reads VARIANT members, so nested
arrays are exploded without re-parsing. Bad shapes never fail the job: a missing, null or
non-array member yields no rows (one NULL-tier row for tiers), unparseable casts yield NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewatch.functions.casting import nullif_empty, to_bool_pg, to_numeric, to_timestamptz
from ratewatch.functions.jsonpath import as_variant, json_array, json_member, json_text, json_typed, struct_type

PRODUCT_COLUMNS = [
    "run_id", "provider_id", "brand_name", "fetched_at", "as_of_date", "endpoint", "url",
    "responded_xv", "product_id", "product_name", "product_description", "product_category",
    "product_last_updated", "effective_from", "effective_to", "product_brand",
    "product_brand_group", "is_tailored", "fees_json", "deposit_rates_json", "lending_rates_json",
]
# lineage columns carried next to the model columns (deterministic tie-breaks downstream)
PRODUCT_LINEAGE = ["page_num", "product_pos"]

PRODUCT_KEYS = ["provider_id", "brand_name", "as_of_date", "product_id", "product_name", "product_category"]


# Members that the columns of a product are read from.
PRODUCT_MEMBERS = {
    "product_id": "productId", "product_name": "name", "product_description": "description", "product_category": "productCategory",
    "product_last_updated": "lastUpdated", "effective_from": "effectiveFrom", "effective_to": "effectiveTo", "product_brand": "brand",
    "product_brand_group": "brandGroup", "is_tailored": "isTailored", "fees_json": ("fees", "variant"),
    "deposit_rates_json": ("depositRates", "variant"), "lending_rates_json": ("lendingRates", "variant"),
}
PRODUCT_READ = {"product_last_updated": to_timestamptz, "effective_from": to_timestamptz, "effective_to": to_timestamptz,
                "product_brand_group": nullif_empty, "is_tailored": to_bool_pg}


def products(pages: DataFrame, payload: str = "payload", ok_status: int = 200, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per product element of every OK page (``stg_products_raw``). With ``columns`` only these, by one cast of
    a page to their members; else every column is read by itself, if it is used."""
    src = (pages.filter(F.col("http_status") == ok_status)  # before parsing: bad pages are never parsed
           .select("run_id", "provider_id", "brand_name", "endpoint", "url", "page_num",
                   "responded_xv", "fetched_at", F.to_date("fetched_at").alias("as_of_date"),
                   as_variant(pages, payload).alias("_payload")))
    wanted = [*PRODUCT_COLUMNS, *PRODUCT_LINEAGE] if columns is None else list(columns)
    members = {c: m for c, m in PRODUCT_MEMBERS.items() if c in wanted or c == "product_id"}
    if columns is None:
        elements = json_array("_payload", "data.products")
    else:
        elements = json_typed("_payload", "data.products", f"array<{struct_type(members.values())}>")
    exploded = src.select("*", F.posexplode(elements).alias("product_pos", "_product"))
    p = F.col("_product")

    def read(c):
        if c not in members:
            return F.col(c)
        name, get = (members[c], json_text) if isinstance(members[c], str) else (members[c][0], json_member)
        value = get(p, name) if columns is None else p[name]
        return PRODUCT_READ.get(c, lambda v: v)(value).alias(c)

    if columns is None:
        return exploded.select(*[read(c) for c in wanted]).filter(F.col("product_id").isNotNull())
    return exploded.filter(p["productId"].isNotNull()).select(*[read(c) for c in wanted])


def fees(prods: DataFrame) -> DataFrame:
    """One row per fee element (``stg_fees_raw``)."""
    ex = prods.select(*PRODUCT_KEYS, F.explode(json_array("fees_json")).alias("fee"))
    f = F.col("fee")
    return ex.select(
        *PRODUCT_KEYS,
        json_text(f, "name").alias("fee_name"),
        json_text(f, "feeType").alias("fee_type"),
        json_text(f, "additionalInfo").alias("additional_info"),
        json_text(f, "additionalInfoUri").alias("additional_info_uri"),
        to_numeric(json_text(f, "amount")).alias("amount"),
        nullif_empty(json_text(f, "currency")).alias("currency"),
        F.col("fee").alias("fee_json"),
    )


RATE_COLUMNS = PRODUCT_KEYS + [
    "rate_kind", "rate_type", "rate_value", "comparison_rate", "calculation_frequency",
    "application_frequency", "additional_value", "additional_info", "additional_info_uri",
    "tiers_json", "conditions_json", "rate_json",
]


def rates(prods: DataFrame) -> DataFrame:
    """One row per deposit or lending rate, tagged with its kind (``stg_rates_raw``).

    Both arrays are exploded in a single pass, one behind the other: elements up to the number of deposit rates are these
    (no second scan, no union, and no function over the elements, which would be interpreted).
    """
    none = F.array().cast("array<variant>")
    both = prods.select(*PRODUCT_KEYS, F.coalesce(json_array("deposit_rates_json"), none).alias("_deposit"),
                        F.coalesce(json_array("lending_rates_json"), none).alias("_lending"))
    ex = both.select(*PRODUCT_KEYS, F.size("_deposit").alias("_n"), F.posexplode(F.concat("_deposit", "_lending")).alias("_i", "_rate"))
    r = F.col("_rate")
    rate_type = F.coalesce(json_text(r, "depositRateType"), json_text(r, "lendingRateType"))
    out = ex.select(
        *PRODUCT_KEYS,
        F.when(F.col("_i") < F.col("_n"), F.lit("deposit")).otherwise(F.lit("lending")).alias("rate_kind"),
        rate_type.alias("rate_type"),
        to_numeric(json_text(r, "rate")).alias("rate_value"),
        to_numeric(json_text(r, "comparisonRate")).alias("comparison_rate"),
        json_text(r, "calculationFrequency").alias("calculation_frequency"),
        json_text(r, "applicationFrequency").alias("application_frequency"),
        json_text(r, "additionalValue").alias("additional_value"),
        json_text(r, "additionalInfo").alias("additional_info"),
        json_text(r, "additionalInfoUri").alias("additional_info_uri"),
        json_member(r, "tiers").alias("tiers_json"),
        json_member(r, "conditions").alias("conditions_json"),
        r.alias("rate_json"),
    )
    return out.filter(F.col("rate_type").isNotNull())


TIER_COLUMNS = PRODUCT_KEYS + [
    "rate_kind", "rate_type", "rate_value", "comparison_rate", "calculation_frequency",
    "application_frequency", "additional_value", "additional_info", "additional_info_uri",
    "tier_name", "tier_unit_of_measure", "tier_minimum_value", "tier_maximum_value",
    "tier_rate_application_method", "tier_applicability", "tier_additional_info",
    "tier_additional_info_uri", "conditions_json",
]


def rate_tiers(rts: DataFrame) -> DataFrame:
    """One row per (rate, tier); a rate without tiers keeps one row with NULL tier columns."""
    keep = [c for c in TIER_COLUMNS[:15]] + ["conditions_json"]
    ex = rts.select(*keep, F.explode_outer(json_array("tiers_json")).alias("tier"))
    t = F.col("tier")
    return ex.select(
        *TIER_COLUMNS[:15],
        nullif_empty(json_text(t, "name")).alias("tier_name"),
        nullif_empty(json_text(t, "unitOfMeasure")).alias("tier_unit_of_measure"),
        to_numeric(json_text(t, "minimumValue")).alias("tier_minimum_value"),
        to_numeric(json_text(t, "maximumValue")).alias("tier_maximum_value"),
        json_text(t, "rateApplicationMethod").alias("tier_rate_application_method"),
        json_text(t, "applicability").alias("tier_applicability"),
        json_text(t, "additionalInfo").alias("tier_additional_info"),
        json_text(t, "additionalInfoUri").alias("tier_additional_info_uri"),
        "conditions_json",
    )


DIM_PRODUCT_COLUMNS = [
    "provider_id", "brand_name", "as_of_date", "product_id", "product_name", "product_description",
    "product_category", "product_last_updated", "effective_from", "effective_to", "product_brand",
    "product_brand_group", "is_tailored",
]

FEE_FACT_COLUMNS = [
    "provider_id", "brand_name", "as_of_date", "product_id", "fee_name", "fee_type", "amount",
    "currency", "additional_info", "additional_info_uri", "fee_json",
]

RATE_FACT_COLUMNS = [
    "provider_id", "brand_name", "as_of_date", "product_id", "product_name", "product_category",
    "rate_kind", "rate_type", "tier_name", "tier_unit_of_measure", "tier_minimum_value",
    "tier_maximum_value", "rate", "comparison_rate", "calculation_frequency",
    "application_frequency", "additional_value", "additional_info", "additional_info_uri",
    "conditions_json",
]


def fee_fact(fs: DataFrame) -> DataFrame:
    """``fct_product_fees``: projection, no dedupe."""
    return fs.select(*FEE_FACT_COLUMNS)


def rate_fact(tiers: DataFrame) -> DataFrame:
    """``fct_product_rates``: projection with ``rate_value`` renamed to ``rate``, no dedupe."""
    return tiers.withColumnRenamed("rate_value", "rate").select(*RATE_FACT_COLUMNS)


# Members that the columns of the rate fact are read from, by level.
FACT_PRODUCT_MEMBERS = {"product_name": "name", "product_category": "productCategory"}
FACT_RATE_MEMBERS = {"rate": "rate", "comparison_rate": "comparisonRate", "calculation_frequency": "calculationFrequency",
                     "application_frequency": "applicationFrequency", "additional_value": "additionalValue",
                     "additional_info": "additionalInfo", "additional_info_uri": "additionalInfoUri",
                     "conditions_json": ("conditions", "variant")}
FACT_TIER_MEMBERS = {"tier_name": "name", "tier_unit_of_measure": "unitOfMeasure", "tier_minimum_value": "minimumValue",
                     "tier_maximum_value": "maximumValue"}
FACT_NUMBERS = {"rate", "comparison_rate", "tier_minimum_value", "tier_maximum_value"}
FACT_NOT_EMPTY = {"tier_name", "tier_unit_of_measure"}


def rate_fact_of_pages(pages: DataFrame, columns: Sequence[str] = RATE_FACT_COLUMNS, payload: str = "payload",
                       ok_status: int = 200) -> DataFrame:
    """``rate_fact(rate_tiers(rates(products(pages))))``, of it ``columns``: the same rows by one cast of each page. It reads
    the members of ``columns`` alone; the staged models copy every product, rate and tier to read from it, and each member that
    is read costs as much as its neighbours, so readers name what they need."""
    def members(of):
        return [m for c, m in of.items() if c in columns]

    tier = struct_type(members(FACT_TIER_MEMBERS) or ["name"])
    rate = struct_type(["depositRateType", "lendingRateType", *members(FACT_RATE_MEMBERS), ("tiers", f"array<{tier}>")])
    product = struct_type(["productId", *members(FACT_PRODUCT_MEMBERS), ("depositRates", f"array<{rate}>"), ("lendingRates", f"array<{rate}>")])
    src = pages.filter(F.col("http_status") == ok_status).select(
        "provider_id", "brand_name", F.to_date("fetched_at").alias("as_of_date"), as_variant(pages, payload).alias("_payload"))
    owner = ["provider_id", "brand_name", "as_of_date"]
    p = F.col("_product")
    none = F.array().cast(f"array<{rate}>")
    prods = src.select(*owner, F.explode(json_typed("_payload", "data.products", f"array<{product}>")).alias("_product"))
    prods = prods.filter(p["productId"].isNotNull()).select(
        *owner, p["productId"].alias("product_id"), *[p[m].alias(c) for c, m in FACT_PRODUCT_MEMBERS.items() if c in columns],
        F.coalesce(p["depositRates"], none).alias("_deposit"), F.coalesce(p["lendingRates"], none).alias("_lending"))
    keep = [c for c in prods.columns if not c.startswith("_")]
    r = F.col("_rate")
    rts = prods.select(*keep, F.size("_deposit").alias("_n"), F.posexplode(F.concat("_deposit", "_lending")).alias("_i", "_rate")).select(
        *keep, F.when(F.col("_i") < F.col("_n"), F.lit("deposit")).otherwise(F.lit("lending")).alias("rate_kind"),
        F.coalesce(r["depositRateType"], r["lendingRateType"]).alias("rate_type"), r.alias("_rate")).filter(F.col("rate_type").isNotNull())
    rows = rts.select("*", F.explode_outer(r["tiers"]).alias("_tier"))

    def read(c):
        if c in rows.columns:
            return F.col(c)
        level, of = (r, FACT_RATE_MEMBERS) if c in FACT_RATE_MEMBERS else (F.col("_tier"), FACT_TIER_MEMBERS)
        value = level[of[c] if isinstance(of[c], str) else of[c][0]]
        value = to_numeric(value) if c in FACT_NUMBERS else nullif_empty(value) if c in FACT_NOT_EMPTY else value
        return value.alias(c)

    return rows.select(*[read(c) for c in columns])


def json_columns_as_text(df: DataFrame) -> DataFrame:
    """VARIANT columns -> compact JSON text (for grouping, comparing or writing as text)."""
    from pyspark.sql.types import VariantType
    return df.select(*[F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, VariantType)
                       else F.col(f.name) for f in df.schema.fields])
