"""The landing zone: one raw response body per page under
``ingestion_date=<d>/provider=<p>/endpoint=<e>/page=NNNN[.json]``.

Bodies are read as exact bytes (``binaryFile``), so hashes of the landed content equal the hashes
taken at fetch time. Only files that Spark's text writer made (``part-*.txt``) end in a line separator
of its own, and only there it is taken off. Partition values stay strings (type inference is off in
the session).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewatch.functions.text import page_label, safe_path_component, sha256_hex

PAGE_IN_PATH = r"page=([0-9]+)"
# Files of Spark's text writer.
TEXT_WRITER_FILE = r"/part-[^/]*\.txt$"
PARSE_ERROR = "JSON parse error"


def write_landing(pages: DataFrame, root: str, content: str = "content") -> None:
    """Write one body per (ingestion_date, provider, endpoint, page); re-landing a date rewrites
    only the partitions it contains (dynamic partition overwrite)."""
    out = pages.select(
        F.col("ingestion_date").cast("string").alias("ingestion_date"),
        safe_path_component(F.col("provider_id")).alias("provider"),
        safe_path_component(F.col("endpoint")).alias("endpoint"),
        page_label(F.col("page_num")).alias("page"),
        F.coalesce(F.col(content), F.lit("")).alias("value"))
    (out.repartition("ingestion_date", "provider", "endpoint", "page")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingestion_date", "provider", "endpoint", "page").text(root))


def landed_body(content, path):
    """The landed bytes as text, without the line separator that Spark's text writer adds."""
    body = content.cast("string")
    return F.when(path.rlike(TEXT_WRITER_FILE), F.regexp_replace(body, r"\n\z", "")).otherwise(body)


def read_landing(spark: SparkSession, root: str) -> DataFrame:
    """Landed bodies: (ingestion_date, provider, endpoint, page_num, content, path)."""
    raw = (spark.read.format("binaryFile").option("recursiveFileLookup", "false")
           .option("pathGlobFilter", "*").load(root))
    body = landed_body(F.col("content"), F.col("path"))
    cols = set(raw.columns)
    return raw.select(
        F.col("ingestion_date") if "ingestion_date" in cols else F.lit(None).cast("string").alias("ingestion_date"),
        F.col("provider") if "provider" in cols else F.lit(None).cast("string").alias("provider"),
        F.col("endpoint") if "endpoint" in cols else F.lit(None).cast("string").alias("endpoint"),
        F.regexp_extract(F.col("path"), PAGE_IN_PATH, 1).cast("long").alias("page_num"),
        body.alias("content"), F.col("path"))


def landing_to_pages(landed: DataFrame, call_log: DataFrame | None = None, run_id: str | None = None) -> DataFrame:
    """Landed bodies -> ``products_raw``-shaped rows.

    With a call log, status, URL, fetch time and run come from the call of the same (sanitised)
    provider and endpoint on the ingestion date whose payload hash equals the body's hash, and of the
    same page where the log has page numbers; of several such calls the last one counts. So every
    landed body gives one row. Without a log, a body that parses is status 200 and the fetch time is
    the ingestion date.
    """
    parsed = F.try_parse_json(F.col("content"))
    base = landed.select("*", sha256_hex(F.col("content")).alias("payload_hash"),
                         parsed.isNotNull().alias("_ok"))
    if call_log is None:
        return base.select(
            F.lit(run_id).cast("string").alias("run_id"), F.col("provider").alias("provider_id"),
            F.lit(None).cast("string").alias("brand_name"), "endpoint", "path",
            F.col("path").alias("url"), "page_num",
            F.when(F.col("_ok"), F.lit(200)).otherwise(F.lit(0)).alias("http_status"),
            F.lit(None).cast("int").alias("responded_xv"),
            F.to_timestamp(F.col("ingestion_date")).alias("fetched_at"), F.lit(None).cast("string").alias("etag"),
            F.when(F.col("_ok"), F.col("content")).alias("payload"), "payload_hash").drop("path")
    own = ["provider", "endpoint", "payload_hash", "_date"]
    if "page_num" in call_log.columns:
        own.append("page_num")
    call = F.struct("fetched_at", "run_id", "url", "provider_id", F.col("endpoint").alias("endpoint_name"),
                    "http_status", "responded_xv", "etag")
    calls = (call_log.select(
        safe_path_component(F.col("provider_id")).alias("provider"), safe_path_component(F.col("endpoint")).alias("_endpoint"),
        "payload_hash", F.to_date("fetched_at").cast("string").alias("_date"),
        *[c for c in ("page_num",) if c in own], call.alias("call"))
        .withColumnRenamed("_endpoint", "endpoint").groupBy(*own).agg(F.max("call").alias("call")))
    j = base.withColumn("_date", F.col("ingestion_date").cast("string")).join(calls, own, "left")
    return j.select(
        "call.run_id", "call.provider_id", F.lit(None).cast("string").alias("brand_name"),
        F.col("call.endpoint_name").alias("endpoint"), "call.url", "page_num", "call.http_status", "call.responded_xv",
        "call.fetched_at", "call.etag", F.when(F.col("_ok"), F.col("content")).alias("payload"), "payload_hash")


def parse_error_calls(landed: DataFrame, call_log: DataFrame) -> DataFrame:
    """Call-log rows for landed bodies of OK calls that are no JSON: the call again, with the error."""
    pages = landing_to_pages(landed, call_log)
    bad = (F.col("http_status") == 200) & F.col("payload").isNull() & F.col("payload_hash").isNotNull()
    return pages.filter(bad).select(
        "run_id", "provider_id", "endpoint", "url", "http_status", "responded_xv", "fetched_at", "etag",
        "payload_hash", F.lit(PARSE_ERROR).alias("error"))
