"""The staging -> silver -> gold models as one lazily built set of DataFrames.

The product parse is shared by four readers (products, fees, rates, tiers); ``build_models``
persists it once instead of re-parsing the payloads for each model. The rate fact, which most marts read,
comes from the pages by one cast instead of the four stages; it has the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewatch.operators import flatten
from ratewatch.operators.changes import RATE_INPUT_COLUMNS, rate_changes
from ratewatch.operators.latest import latest_per_key


def dim_products(prods: DataFrame) -> DataFrame:
    """Latest version of each (provider, product, date): newest fetch, then page URL and position."""
    return latest_per_key(
        prods, ["provider_id", "product_id", "as_of_date"],
        [F.col("fetched_at").desc_nulls_last(), F.col("url").asc_nulls_last(),
         F.col("product_pos").asc_nulls_last()],
        flatten.DIM_PRODUCT_COLUMNS)


@dataclass
class Models:
    products: DataFrame
    fees: DataFrame
    rates: DataFrame
    rate_tiers: DataFrame
    dim_products: DataFrame
    fct_product_fees: DataFrame
    fct_product_rates: DataFrame
    pages: DataFrame

    def rate_columns(self, *columns: str) -> DataFrame:
        """These columns of ``fct_product_rates``; no other member of the pages is read."""
        return flatten.rate_fact_of_pages(self.pages, columns)

    def rate_changes(self, as_of: date | None = None) -> DataFrame:
        return rate_changes(self.rate_columns(*RATE_INPUT_COLUMNS), as_of=as_of)


def build_models(pages: DataFrame, persist: bool = False) -> Models:
    prods = flatten.products(pages)
    if persist:
        prods = prods.persist(StorageLevel.MEMORY_AND_DISK)

    def of_products(*columns):
        """Products with what one reader needs of them."""
        return prods if persist else flatten.products(pages, columns=columns)

    fs = flatten.fees(of_products(*flatten.PRODUCT_KEYS, "fees_json"))
    rts = flatten.rates(of_products(*flatten.PRODUCT_KEYS, "deposit_rates_json", "lending_rates_json"))
    tiers = flatten.rate_tiers(rts)
    dim = dim_products(of_products(*flatten.DIM_PRODUCT_COLUMNS, "fetched_at", "url", "product_pos"))
    return Models(
        products=prods, fees=fs, rates=rts, rate_tiers=tiers, dim_products=dim,
        fct_product_fees=flatten.fee_fact(fs), fct_product_rates=flatten.rate_fact_of_pages(pages), pages=pages)
