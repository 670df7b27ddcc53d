"""Report queries and writers: rate-change and coverage CSVs, Markdown summaries."""

from __future__ import annotations

from datetime import date, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewatch.functions.text import py_float_text
from ratewatch.operators.changes import rate_changes

RATE_REPORT_COLUMNS = [
    "provider_id", "brand_name", "product_id", "product_name", "product_category", "rate_kind",
    "rate_type", "tier_name", "previous_as_of_date", "current_as_of_date", "previous_rate",
    "current_rate", "delta",
]

COVERAGE_REPORT_COLUMNS = [
    "as_of_date", "provider_id", "brand_name", "expected_base_uri", "products_pages_ok",
    "products_rows", "last_http_status", "last_error",
]

DRIFT_REPORT_COLUMNS = ["provider_id", "endpoint", "old_fingerprint_hash", "new_fingerprint_hash", "observed_at"]


def rate_change_report(rate_fact: DataFrame, report_date: date, limit: int = 200) -> DataFrame:
    """Largest rate changes on ``report_date``: top ``limit`` by |delta|, NULL deltas last.

    The mart is pruned to the report date before its joins; ties are broken by the mart key so
    the cut at ``limit`` is deterministic. Catalyst plans this as TakeOrderedAndProject.
    """
    ch = rate_changes(rate_fact, as_of=report_date)
    ch = ch.filter(F.col("current_as_of_date") == F.lit(report_date))
    delta = F.col("current_rate") - F.col("previous_rate")
    ch = ch.withColumn("delta", delta)
    order = [F.abs(F.col("delta")).desc_nulls_last()] + [
        F.col(c).asc_nulls_last() for c in (
            "provider_id", "product_id", "rate_kind", "rate_type", "tier_name", "tier_unit_of_measure",
            "tier_minimum_value", "tier_maximum_value", "previous_rate", "current_rate")]
    return ch.orderBy(*order).limit(limit).select(*RATE_REPORT_COLUMNS)


def coverage_report(cov: DataFrame, report_date: date) -> DataFrame:
    """Coverage rows of one date, by brand name (NULL names last)."""
    return (cov.filter(F.col("as_of_date") == F.lit(report_date))
               .orderBy(F.col("brand_name").asc_nulls_last(), F.col("provider_id").asc())
               .select(*COVERAGE_REPORT_COLUMNS))


def coverage_summary(cov: DataFrame, report_date: date) -> DataFrame:
    """Providers discovered and providers with an OK product fetch on one date."""
    from ratewatch.operators.coverage import provider_ok
    day = cov.filter(F.col("as_of_date") == F.lit(report_date))
    return day.agg(F.count(F.lit(1)).alias("providers_discovered"),
                   F.count_if(provider_ok(day)).alias("providers_ok"))


def drift_report(events: DataFrame, report_date: date, limit: int = 50) -> DataFrame:
    """Latest ``limit`` drift events observed on one date."""
    return (events.filter(F.to_date("observed_at") == F.lit(report_date))
                  .orderBy(F.col("observed_at").desc(), F.col("provider_id").asc(), F.col("endpoint").asc(),
                           F.col("new_fingerprint_hash").asc())
                  .limit(limit).select(*DRIFT_REPORT_COLUMNS))


# ---- writers ---------------------------------------------------------------------------------

def write_csv(df: DataFrame, path: str, one_file: bool = False) -> bool:
    """CSV with a header, written only if there are rows. Quotes are doubled inside quoted
    fields and NULL is an empty field. ``one_file`` is for reports of a bounded number of rows; others
    keep their partitions, in order."""
    if df.isEmpty():
        return False
    ((df.coalesce(1) if one_file else df).write.mode("overwrite").option("header", True).option("emptyValue", "")
       .option("escape", '"').csv(path))
    return True


def _number(c: str) -> F.Column:
    """A decimal without padding zeros (0.0100000000 -> 0.01); NULL -> 'None'."""
    text = F.col(c).cast("string")
    short = F.when(text.contains("."), F.regexp_replace(F.regexp_replace(text, "0+$", ""), r"\.$", "")).otherwise(text)
    return F.coalesce(F.when(F.col(c) == 0, F.lit("0")).otherwise(short), F.lit("None"))


def _text(c: str) -> F.Column:
    """Value as Python would print it in the summary (NULL -> 'None')."""
    return F.coalesce(F.col(c).cast("string"), F.lit("None"))


def rate_change_table_lines(report: DataFrame, n: int = 20) -> DataFrame:
    """Markdown rows of the top ``n`` rate changes: brand, product (name else id), category,
    kind/type, tier, previous, current, delta. ``report`` must already be in report order."""
    top = report.limit(n)
    line = F.concat_ws(" | ", _text("brand_name"),
                       F.coalesce(F.when(F.col("product_name") != "", F.col("product_name")), F.col("product_id")),
                       F.coalesce(F.col("product_category"), F.lit("")),
                       F.concat(_text("rate_kind"), F.lit("/"), _text("rate_type")),
                       F.coalesce(F.col("tier_name"), F.lit("")),
                       _number("previous_rate"), _number("current_rate"), _number("delta"))
    return top.select(F.concat(F.lit("| "), line, F.lit(" |")).alias("line"),
                      "provider_id", "product_id", "rate_kind", "rate_type", "tier_name")


def _zoned(t) -> str:
    """An instant in ISO form with its UTC offset."""
    return (t if t.tzinfo else t.replace(tzinfo=timezone.utc)).isoformat()


def pipeline_summary_lines(report_date: date, notes: list[str], coverage_counts: DataFrame | None,
                           change_lines: DataFrame | None, drift: DataFrame | None, drift_rows: int = 10) -> list:
    """Markdown lines of the pipeline summary, built from small, already-aggregated frames."""
    out = [f"# Pipeline summary — {report_date.isoformat()}", ""]
    if notes:
        out += ["## Notes", ""] + [f"- {n}" for n in notes] + [""]
    if coverage_counts is not None:
        c = coverage_counts.first()
        if c and c["providers_discovered"]:
            out += ["## Coverage", "", f"- Providers discovered: **{c['providers_discovered']}**",
                    f"- Providers with OK product fetch: **{c['providers_ok']}**", ""]
    if change_lines is not None:
        rows = [r["line"] for r in change_lines.collect()]  # at most 20 rows
        if rows:
            out += ["## Top rate changes (max 20)", "",
                    "| Brand | Product | Category | Rate type | Tier | Previous | Current | Δ |",
                    "|---|---|---|---|---:|---:|---:|---:|"] + rows + [""]
    if drift is not None:
        rows = drift.limit(drift_rows).collect()
        if rows:
            out += [f"## Schema drift events (last {drift_rows})", ""] + [
                f"- {_zoned(r['observed_at'])} — provider={r['provider_id']} endpoint={r['endpoint']} "
                f"old={r['old_fingerprint_hash']} new={r['new_fingerprint_hash']}" for r in rows] + [""]
    return out


def _plain(c: str) -> F.Column:
    """A number as the summary tables print it; NULL is empty."""
    return F.coalesce(py_float_text(F.col(c)), F.lit(""))


def qa_summary(gates: DataFrame, qa_date: date, qa_run_id: str, tests_ran: bool = False,
               tests_command: str | None = None) -> list:
    """Markdown lines of the QA summary, rendered from the gate rows and their totals."""
    word = F.when(F.col("passed"), "yes").otherwise("no")
    rows = gates.select("passed", "gate_name", F.concat(
        F.lit("| "), F.concat_ws(" | ", "gate_name", word, _plain("actual_value"), _plain("threshold_value"), "details"), F.lit(" |")).alias("line"))
    lines = rows.collect()                           # one row per gate
    state = {True: "PASS", False: "FAIL"}
    tests_ok = all(r["passed"] for r in lines if r["gate_name"] == "dbt_tests")
    how = f"`{tests_command}`" if tests_ran else "skipped"
    # Headings of the summary
    head = [f"# QA summary - {qa_date.isoformat()}", "", f"- Status: **{state[all(r['passed'] for r in lines)]}**",
            f"- QA run id: `{qa_run_id}`", f"- dbt tests: **{state[tests_ok]}** ({how})", "",
            "| Gate | Passed | Actual | Threshold | Details |", "|---|---|---:|---:|---|"]
    return head + [r["line"] for r in lines]


def write_lines(spark, lines: list, path: str) -> None:
    """Write a small report (a few dozen lines) as one text file through Spark, so the target can
    be any filesystem the cluster writes to."""
    df = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    df.coalesce(1).sortWithinPartitions("i").select("line").write.mode("overwrite").text(path)
