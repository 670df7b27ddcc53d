"""SparkSession construction and the SQL settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings the operators depend on for correct results (not tuning knobs).
REQUIRED_SQL_CONF = {
    # Dates are derived from instants; keep them independent of the machine zone.
    "spark.sql.session.timeZone": "UTC",
    # Landing paths like provider=00123 must stay strings.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Duplicate JSON object keys keep the last value (like jsonb) instead of failing the parse.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Re-running a day rewrites only the partitions it touches.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Execution settings chosen for large inputs; safe to override per cluster. Rows grow twenty- to fortyfold from compressed
# shuffle or Parquet bytes to what sorts and windows hold of them, so a task's share of these bytes is small.
SCALE_SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "32m",
    # Where rows already come in the order of a grouping, they are grouped as they come: a hash aggregate of arrays would sort them again.
    "spark.sql.execution.replaceHashWithSortAgg": "true",
    # Whole pages are written and read: taking each variant apart into a Parquet column per member, and putting it together
    # again for every reader, takes longer than all the rest of landing it.
    "spark.sql.variant.inferShreddingSchema": "false",
}


def utc_today() -> date:
    """The date of runs that name none."""
    return datetime.now(timezone.utc).date()


def apply_settings(spark: SparkSession) -> SparkSession:
    for k, v in REQUIRED_SQL_CONF.items():
        spark.conf.set(k, v)
    for k, v in SCALE_SQL_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def build_session(master: str | None = None, app_name: str = "ratewatch",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Get or create a session with the required settings.

    On a cluster, leave ``master`` unset so spark-submit decides. The Spark UI stays off:
    these are batch jobs and nothing should open a web port.
    """
    b = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**REQUIRED_SQL_CONF, **SCALE_SQL_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    return apply_settings(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; we only fall back to a local scratch folder when
    nothing is configured (local tests), and record it in the session so later calls agree.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="ratewatch-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def kept(df: DataFrame, name: str) -> DataFrame:
    """Rows worked out once: written to the checkpoint folder and read from there by all that follows."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    void = [c for c, kind in df.dtypes if kind == "void"]        # Parquet has no columns without a type
    stored = df.drop(*void)
    stored.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(stored.schema).parquet(path).withColumns({c: F.lit(None) for c in void}).select(*df.columns)


def cluster_settings(input_bytes: int, total_cores: int, target_partition_bytes: int = 128 << 20) -> dict:
    """Shuffle sizing for a large cluster run.

    The initial shuffle partition count covers the larger of the input size / target partition
    size and twice the cores, so no reducer starts with more than ~128 MB per input byte read;
    AQE then coalesces small partitions toward the advisory size (size first, not parallelism
    first) and splits skewed join partitions. Example: 100 TB on 1000 executors x 8 cores ->
    ~750k initial partitions, coalesced at run time.
    """
    initial = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
