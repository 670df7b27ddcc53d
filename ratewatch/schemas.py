"""Declared table schemas, primary keys and NOT NULL columns (the pipeline's storage contract).

Types follow the declared DDL: uuid/text -> string, int -> int, timestamptz -> timestamp (UTC
session), jsonb payloads -> VARIANT (parsed binary JSON at rest; readers also accept JSON text),
other jsonb columns -> JSON text, numeric -> decimal(28,10). ``page_num`` is widened to bigint so page numbers derived from large keys fit.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

NUMERIC = T.DecimalType(28, 10)


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    key: tuple[str, ...]
    not_null: tuple[str, ...] = field(default=())
    # columns that reference pipeline_run(run_id)
    run_fk: str | None = None


def _st(*cols: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in cols])


S, I, L, B, D, TS, DT, V = (T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType(),
                            T.DoubleType(), T.TimestampType(), T.DateType(), T.VariantType())

PIPELINE_RUN = TableSpec(
    "pipeline_run",
    _st(("run_id", S, False), ("run_started_at", TS, False), ("run_date", DT, False),
        ("register_industry", S, False), ("filter_industry", S, False),
        ("fetch_product_details", B, False), ("notes", S, True)),
    key=("run_id",),
)

DATA_HOLDER_BRAND = TableSpec(
    "data_holder_brand",
    _st(("run_id", S, False), ("data_holder_brand_id", S, False), ("brand_name", S, True),
        ("brand_group", S, True), ("industries", S, True), ("public_base_uri", S, True),
        ("product_base_uri", S, True), ("logo_uri", S, True), ("last_updated", S, True),
        ("extracted_at", TS, False)),
    key=("run_id", "data_holder_brand_id"), run_fk="run_id",
)

API_CALL_LOG = TableSpec(
    "api_call_log",
    _st(("run_id", S, False), ("provider_id", S, False), ("endpoint", S, False), ("url", S, False),
        ("http_status", I, False), ("responded_xv", I, True), ("fetched_at", TS, False),
        ("etag", S, True), ("payload_hash", S, True), ("error", S, True)),
    key=("run_id", "provider_id", "endpoint", "url"), run_fk="run_id",
)

SCHEMA_FINGERPRINT = TableSpec(
    "schema_fingerprint",
    _st(("provider_id", S, False), ("endpoint", S, False), ("fingerprint_hash", S, False),
        ("fingerprint_paths", T.ArrayType(S), False), ("observed_at", TS, False), ("run_id", S, False)),
    key=("provider_id", "endpoint", "observed_at"), run_fk="run_id",
)

SCHEMA_DRIFT_EVENT = TableSpec(
    "schema_drift_event",
    _st(("provider_id", S, False), ("endpoint", S, False), ("old_fingerprint_hash", S, True),
        ("new_fingerprint_hash", S, False), ("observed_at", TS, False), ("run_id", S, False),
        ("note", S, True)),
    key=("provider_id", "endpoint", "observed_at"), run_fk="run_id",
)

PRODUCTS_RAW = TableSpec(
    "products_raw",
    _st(("run_id", S, False), ("provider_id", S, False), ("brand_name", S, True), ("endpoint", S, False),
        ("url", S, False), ("page_num", L, False), ("http_status", I, False), ("responded_xv", I, True),
        ("fetched_at", TS, False), ("etag", S, True), ("payload", V, True), ("payload_hash", S, True)),
    key=("run_id", "provider_id", "endpoint", "page_num"), run_fk="run_id",
)

PRODUCT_DETAIL_RAW = TableSpec(
    "product_detail_raw",
    _st(("run_id", S, False), ("provider_id", S, False), ("brand_name", S, True), ("product_id", S, False),
        ("url", S, False), ("http_status", I, False), ("responded_xv", I, True), ("fetched_at", TS, False),
        ("etag", S, True), ("payload", V, True), ("payload_hash", S, True)),
    key=("run_id", "provider_id", "product_id"), run_fk="run_id",
)

QA_GATE_RESULT = TableSpec(
    "qa_gate_result",
    _st(("qa_run_id", S, False), ("qa_date", DT, False), ("evaluated_at", TS, False), ("gate_name", S, False),
        ("passed", B, False), ("actual_value", D, True), ("threshold_value", D, True), ("details", S, True),
        ("dbt_test_ran", B, False), ("dbt_test_passed", B, False), ("dbt_test_command", S, True)),
    key=("qa_run_id", "gate_name"),
)

TABLES: dict[str, TableSpec] = {t.name: t for t in (
    PIPELINE_RUN, DATA_HOLDER_BRAND, API_CALL_LOG, SCHEMA_FINGERPRINT, SCHEMA_DRIFT_EVENT,
    PRODUCTS_RAW, PRODUCT_DETAIL_RAW, QA_GATE_RESULT)}

for _t in TABLES.values():
    object.__setattr__(_t, "not_null", tuple(f.name for f in _t.schema.fields if not f.nullable))
