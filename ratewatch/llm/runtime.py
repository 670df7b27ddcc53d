"""Session helpers shared by the operators: Arrow batch size, shared scratch folder, cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of an Arrow batch handed to Python: whole texts travel in them, so it stays small.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def tune(spark: SparkSession) -> SparkSession:
    """Settings of text-carrying jobs: small Arrow batches (a smaller own setting is kept), and shuffle
    files that go when the query that wrote them has ended. Operators write their steps as tables, so
    no later step reads those files, and many steps don't pile up on the executors' disks."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(key).rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor sees: spark.checkpoint.dir, or a set checkpoint folder. Only a local
    session may fall back to a temporary folder of this machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        opt = spark.sparkContext._jsc.sc().getCheckpointDir()
        if opt.isDefined():
            return opt.get()
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile
        found = tempfile.mkdtemp(prefix="llm-checkpoints-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: later steps neither recompute
    it nor depend on executor disks. The folder is left for the caller's usual clean-up."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``checkpoint()`` into the shared folder (keeps partition layout and row order)."""
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def row_key():
    """64-bit hash of the text next to doc_id: rows that repeat a doc_id stay apart by it."""
    return F.xxhash64(F.lit(7), F.col("text"))


def packed(docs: DataFrame, **own: Column) -> DataFrame:
    """All columns of ``docs`` as the struct ``row``, next to an operator's own columns: names in the
    input can't clash with these."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       *[c.alias(name) for name, c in own.items()])


def unpacked(df: DataFrame, columns: list[str], **set_: Column) -> DataFrame:
    """The columns again, with those in ``set_`` added, or replaced in their place."""
    return df.select(*[(set_[c] if c in set_ else F.col("row")[c]).alias(c) for c in columns],
                     *[c.alias(name) for name, c in set_.items() if name not in columns])
