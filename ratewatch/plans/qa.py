"""QA run: six gates over the built models for one QA date, the declared data tests, stored results.

A gate is a row of ``GATES``: which input it reads, how its metric is computed and how the metric is
held against a threshold. Missing inputs and metrics that can't be planned are failed gates;
``evaluate_qa`` also computes each gate on its own, so one that fails at run time is a failed gate
too and the others stand.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewatch.operators import quality as Q
from ratewatch.operators.coverage import provider_ok
from ratewatch.session import kept, utc_today


def _rows_on(column: str, condition: Callable | None = None):
    def metric(df: DataFrame, day: date) -> DataFrame:
        kept = df.filter(F.col(column).cast("date") == F.lit(day))
        return Q.count_metric(kept if condition is None else kept.filter(condition(kept)))
    return metric


@dataclass(frozen=True)
class Gate:
    name: str
    source: str                 # keyword of run_qa
    relation: str               # what the source is called in messages
    metric: Callable[[DataFrame, date], DataFrame]
    kind: str                   # min, max, or drift
    default: float
    unit: str = ""


# Gate names, their order and default thresholds.
GATES = (
    Gate("providers_ok", "coverage", "mart_provider_coverage", _rows_on("as_of_date", provider_ok), "min", Q.DEFAULT_MIN_PROVIDERS_OK),
    Gate("dim_products_rows", "dim_products", "dim_products", _rows_on("as_of_date"), "min", Q.DEFAULT_MIN_PRODUCTS),
    Gate("rate_changes_rows", "rate_changes", "mart_rate_changes", _rows_on("current_as_of_date"), "min", Q.DEFAULT_MIN_RATE_CHANGES),
    Gate("products_freshness_hours", "pages", "products_raw", Q.freshness_metric, "max", Q.DEFAULT_MAX_FRESHNESS_HOURS, "h"),
    Gate("schema_drift_events", "drift_events", "schema_drift_event", _rows_on("observed_at"), "drift", 0.0),
)

# The declared data tests of the built models.
DECLARED_TESTS = (
    ("dim_products", "unique_combo", ("provider_id", "product_id", "as_of_date")),
    ("dim_products", "not_null", ("provider_id", "product_id", "as_of_date")),
    ("fct_product_rates", "not_null", ("provider_id", "product_id", "as_of_date", "rate_kind", "rate_type", "rate")),
    ("fct_product_rates", "accepted_values", ("rate_kind", "deposit", "lending")),
    ("mart_rate_changes", "unique_combo", ("provider_id", "product_id", "current_as_of_date", "rate_kind", "rate_type",
                                           "tier_name", "tier_unit_of_measure", "tier_minimum_value", "tier_maximum_value")),
    ("mart_rate_changes", "not_null", ("provider_id", "product_id")),
    ("mart_provider_coverage", "unique_combo", ("as_of_date", "provider_id")),
    ("mart_provider_coverage", "not_null", ("provider_id", "as_of_date")),
)


def declared_tests(models: dict[str, DataFrame]) -> DataFrame:
    """One row per declared test: (model, test, columns, failing_rows). Unique tests count the key
    combinations that occur more than once; NOT NULL columns of a model are counted in one pass. A model is worked out
    once for all its tests: of it the tested columns are kept."""
    tested: dict[str, list[str]] = {}
    for model, test, cols in DECLARED_TESTS:
        tested.setdefault(model, []).extend(cols[:1] if test == "accepted_values" else cols)
    frames = {model: kept(models[model].select(*dict.fromkeys(cols)), "tested") for model, cols in tested.items()}
    out = None
    for model, test, cols in DECLARED_TESTS:
        df = frames[model]
        if test == "not_null":
            rows = Q.not_null(df, list(cols)).select(F.col("column_name").alias("columns"), F.col("null_rows").alias("failing_rows"))
        elif test == "unique_combo":
            rows = Q.unique_combo(df, list(cols)).agg(F.count(F.lit(1)).alias("failing_rows")).select(
                F.lit(",".join(cols)).alias("columns"), "failing_rows")
        else:
            rows = Q.accepted_values(df, cols[0], list(cols[1:])).agg(F.count(F.lit(1)).alias("failing_rows")).select(
                F.lit(cols[0]).alias("columns"), "failing_rows")
        rows = rows.select(F.lit(model).alias("model"), F.lit(test).alias("test"), "columns", "failing_rows")
        out = rows if out is None else out.unionByName(rows)
    return out


def _gate_frame(spark: SparkSession, gate: Gate, source, qa_date: date, threshold: float, enforce: bool) -> DataFrame:
    limit = None if gate.kind == "drift" and not enforce else float(threshold)
    if source is None:
        return Q.failed_gate(spark, gate.name, limit, f"missing relation: expected {gate.relation}")

    def build() -> DataFrame:
        return gate.metric(source() if callable(source) else source, qa_date)

    if gate.kind != "drift":
        return Q.gate_from(spark, gate.name, build, threshold, gate.kind, gate.unit)
    try:
        return Q.drift_gate(build(), enforce)
    except PySparkException as e:
        return Q.failed_gate(spark, gate.name, limit, f"query failed: {e}")


def _frames(spark: SparkSession, qa_date: date, inputs: dict, tests, thresholds: dict, enforce: bool) -> list[tuple[str, DataFrame]]:
    frames = []
    for gate in GATES:
        given = thresholds.get(gate.name)
        frames.append((gate.name, _gate_frame(spark, gate, inputs.get(gate.source), qa_date,
                                              gate.default if given is None else given, enforce)))
    return [*frames, ("dbt_tests", Q.tests_gate(spark, tests))]


def _settings(kw: dict) -> tuple[dict, dict, bool]:
    inputs = {g.source: kw.pop(g.source, None) for g in GATES}
    enforce = kw.pop("fail_on_schema_drift", None)
    names = {"min_providers_ok": "providers_ok", "min_products": "dim_products_rows",
             "min_rate_changes": "rate_changes_rows", "max_freshness_hours": "products_freshness_hours"}
    unknown = set(kw) - set(names)
    if unknown:
        raise TypeError(f"unknown QA settings: {sorted(unknown)}")
    return inputs, {names[k]: v for k, v in kw.items()}, Q.DEFAULT_FAIL_ON_SCHEMA_DRIFT if enforce is None else enforce


def run_qa(spark: SparkSession, qa_date: date, *, tests: list[DataFrame] | None = None, **kw) -> DataFrame:
    """Gate rows (gate_name, passed, actual_value, threshold_value, details), lazily.

    Inputs (coverage, dim_products, rate_changes, pages, drift_events) are DataFrames or zero-argument
    callables returning one; ``tests`` are frames of failing rows. Thresholds: min_providers_ok,
    min_products, min_rate_changes, max_freshness_hours, fail_on_schema_drift; unset ones take the
    defaults.
    """
    inputs, thresholds, enforce = _settings(dict(kw))
    frames = [f for _, f in _frames(spark, qa_date, inputs, tests, thresholds, enforce)]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def run_qa_by_name(spark: SparkSession, qa_date: date, *, separator: str = ".", **kw) -> DataFrame:
    """``run_qa`` over the relations that the catalog has: each input goes by the first of its names that exists, and
    a gate whose relation is absent fails and says which names were tried."""
    from ratewatch.sources.tables import candidates, resolved
    relations = {g.source: resolved(spark, g.relation, separator) for g in GATES}
    gates = run_qa(spark, qa_date, **{**relations, **kw})
    missing = F.col("details")
    for g in GATES:
        if relations[g.source] is None and g.source not in kw:
            names = " or ".join(candidates(g.relation, separator))
            missing = F.when(F.col("gate_name") == g.name, F.lit(f"missing relation: expected {names}")).otherwise(missing)
    return gates.withColumn("details", missing)


def evaluate_qa(spark: SparkSession, qa_date: date, *, tests: list[DataFrame] | None = None, **kw) -> DataFrame:
    """``run_qa`` with every gate computed on its own (one row each reaches the driver)."""
    inputs, thresholds, enforce = _settings(dict(kw))
    done = None
    for name, frame in _frames(spark, qa_date, inputs, tests, thresholds, enforce):
        try:
            row = spark.createDataFrame([tuple(frame.first())], Q.GATE_SCHEMA)
        except PySparkException as e:
            row = Q.failed_gate(spark, name, None, f"query failed: {e}")
        done = row if done is None else done.unionByName(row)
    return done


def store_qa(spark: SparkSession, qa_date: date | None, qa_run_id: str, out_root: str, *, tests: Sequence[DataFrame] | None = None,
             tests_command: str | None = None, **kw) -> DataFrame:
    """Evaluate the gates, append them to ``out_root/qa_gate_result`` (a retry of the run replaces its rows), write the Markdown summary and
    return the verdict row. Without a date it is today's, UTC."""
    from ratewatch.plans.reports import qa_summary, write_lines
    from ratewatch.sources.tables import write_table
    qa_date = qa_date or utc_today()
    gates = evaluate_qa(spark, qa_date, tests=None if tests is None else list(tests), **kw)
    ran = tests is not None
    passed = gates.filter((F.col("gate_name") == "dbt_tests") & ~F.col("passed")).isEmpty()
    write_table(Q.gate_records(gates, qa_run_id, qa_date, ran, passed, tests_command), f"{out_root}/qa_gate_result", "qa_gate_result",
                run="qa_run_id")
    write_lines(spark, qa_summary(gates, qa_date, qa_run_id, ran, tests_command), f"{out_root}/qa_summary_{qa_date.isoformat()}")
    return Q.verdict(gates)
