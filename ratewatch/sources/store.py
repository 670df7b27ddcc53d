"""Stored tables under a manifest: staged writes that are published per group, and merges that rewrite
only the files that hold incoming keys.

A table is a folder. ``data/batch=<id>/`` holds Parquet files that are written once and never changed;
``manifest/v=<n>/`` is a small Parquet table that says what readers of version n see. A write first stages its
files, which nobody sees, and then commits the next version by one rename that fails if the version exists:
readers see all of a write or nothing of it, a lost executor or driver leaves only files that no version
names, and two writers that began from the same version can't both win (``ConcurrentWrite``).

``publish_groups``: a manifest row names a group (provider and run, say) and the batch that holds its rows. Groups with a
failure are left out, so what was published of them before stays; a group that is published again
replaces its earlier rows.

``merge_into``: a manifest row names a file with its number of rows and the least and greatest key. Files whose key range
misses the incoming keys are never opened; of the others the key columns are read, and only files that hold
an incoming key are rewritten. All others keep their names.

The driver handles file and batch names, never rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ratewatch.operators.upsert import insert_ignore, upsert
from ratewatch.session import checkpoint_dir

DATA_FILE = r"(data/batch=[^/]+/[^/]+)$"


class ConcurrentWrite(RuntimeError):
    """Another writer committed the version that this write wanted to commit."""


# ---- versions -----------------------------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def latest_version(spark: SparkSession, root: str) -> int:
    """The newest committed version, 0 for a table that has none."""
    p, fs = _fs(spark, f"{root}/manifest")
    if not fs.exists(p):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return max([int(n[2:]) for n in names if n.startswith("v=")], default=0)


def manifest(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """The manifest rows of a version, by default the newest; None if there is none."""
    version = latest_version(spark, root) if version is None else version
    return spark.read.parquet(f"{root}/manifest/v={version:010d}") if version else None


def _commit(spark: SparkSession, root: str, entries: DataFrame, base: int) -> int:
    """Make ``entries`` the version after ``base``."""
    staged = f"{root}/manifest/.staged-{uuid.uuid4().hex}"
    entries.write.parquet(staged)
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    to, fs = _fs(spark, f"{root}/manifest/v={base + 1:010d}")
    if fs.exists(to):
        raise ConcurrentWrite(f"{root}: version {base + 1} exists")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri(), sc._jsc.hadoopConfiguration())
    plain = sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(jvm.org.apache.hadoop.fs.Path(staged), to, plain)   # fails where the version exists
    except Exception as e:
        if fs.exists(to):
            raise ConcurrentWrite(f"{root}: version {base + 1} exists") from e
        raise
    return base + 1


def _stage(df: DataFrame, root: str) -> str:
    """Write rows where no version names them yet; the batch id."""
    batch = uuid.uuid4().hex
    df.write.parquet(f"{root}/data/batch={batch}")
    return batch


# ---- groups ---------------------------------------------------------------------------------------

def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in columns:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


def publish_groups(rows: DataFrame, root: str, group: Sequence[str], failed: DataFrame | None = None) -> int:
    """Stage all rows, then publish the groups that aren't in ``failed`` (their group columns) in one commit. Returns the
    new version. Null group values are a group of their own."""
    spark, group = rows.sparkSession, list(group)
    base = latest_version(spark, root)
    batch = _stage(rows, root)
    staged = spark.read.schema(rows.schema).parquet(f"{root}/data/batch={batch}")
    fresh = staged.select(*group).distinct()
    if failed is not None:
        bad = failed.select(*group).distinct()
        fresh = fresh.join(bad, _same(fresh, bad, group), "left_anti")
    fresh = fresh.withColumn("batch", F.lit(batch))
    old = manifest(spark, root, base)
    if old is not None:
        kept = old.join(fresh, _same(old, fresh, group), "left_anti")
        fresh = kept.unionByName(fresh)
    return _commit(spark, root, fresh, base)


def read_published(spark: SparkSession, root: str, schema: StructType, version: int | None = None) -> DataFrame:
    """The rows of all published groups, as of a version."""
    entries = manifest(spark, root, version)
    if entries is None:
        return spark.createDataFrame([], schema)
    group = [c for c in entries.columns if c != "batch"]
    batches = [r.batch for r in entries.select("batch").distinct().collect()]
    if not batches:
        return spark.createDataFrame([], schema)
    with_batch = StructType([*schema.fields, StructField("batch", StringType())])
    data = (spark.read.schema(with_batch).option("basePath", f"{root}/data")
            .parquet(*[f"{root}/data/batch={b}" for b in batches]))
    return data.join(entries, _same(data, entries, [*group, "batch"]), "left_semi").drop("batch")


# ---- merges ---------------------------------------------------------------------------------------

def _entries(spark: SparkSession, root: str, batch: str, schema: StructType, key: Sequence[str]) -> DataFrame:
    """Manifest rows of the files of a batch: from the key columns alone."""
    files = spark.read.schema(schema).parquet(f"{root}/data/batch={batch}")
    return (files.groupBy(F.regexp_extract(F.col("_metadata.file_path"), DATA_FILE, 1).alias("file"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.min(F.struct(*key)).alias("low"), F.max(F.struct(*key)).alias("high")))


def _overlapping(entries: DataFrame, incoming: DataFrame, key: Sequence[str]) -> list[str]:
    """Files whose key range meets the range of the incoming keys."""
    bounds = incoming.agg(F.min(F.struct(*key)).alias("_least"), F.max(F.struct(*key)).alias("_most"))
    near = entries.join(bounds, (F.col("low") <= F.col("_most")) & (F.col("high") >= F.col("_least")))   # one row of bounds
    return [r.file for r in near.select("file").collect()]


def _files(spark: SparkSession, root: str, files: list[str], schema: StructType) -> DataFrame:
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{f}" for f in files])


def merge_into(incoming: DataFrame, root: str, key: Sequence[str], *, order: Sequence[Column] = (), keep_first: Sequence[str] = (),
               update: bool = True) -> int:
    """INSERT .. ON CONFLICT into the stored table: DO UPDATE (all columns but ``keep_first``) or, without ``update``, DO
    NOTHING. Several incoming rows of one key are applied in ``order``. Returns the new version.

    Keys must not be null, as the declared primary keys aren't.
    """
    spark, key, schema = incoming.sparkSession, list(key), incoming.schema
    base = latest_version(spark, root)
    entries = manifest(spark, root, base)
    checkpoint_dir(spark)
    one = upsert(None, incoming, key, order, keep_first) if update else insert_ignore(None, incoming, key, order)
    one = one.checkpoint()
    missing = F.lit(False)
    for k in key:
        missing = missing | F.col(k).isNull()
    if not one.filter(missing).isEmpty():
        raise ValueError(f"null in the key {key}")
    near = [] if entries is None else _overlapping(entries, one, key)
    touched: list[str] = []
    if update:
        if near:
            held = _files(spark, root, near, schema).select(*key, F.regexp_extract(F.col("_metadata.file_path"), DATA_FILE, 1).alias("_file"))
            touched = [r._file for r in held.join(one.select(*key), key, "left_semi").select("_file").distinct().collect()]
        out = upsert(_files(spark, root, touched, schema), one, key, (), keep_first)
    else:
        out = one.join(_files(spark, root, near, schema).select(*key), key, "left_anti").select(*schema.names)
    batch = _stage(out.repartitionByRange(*key), root)
    fresh = _entries(spark, root, batch, schema, key)
    if entries is not None:
        gone = spark.createDataFrame([(f,) for f in touched], "file string")
        fresh = entries.join(gone, "file", "left_anti").select(*fresh.columns).unionByName(fresh)
    return _commit(spark, root, fresh, base)


def read_stored(spark: SparkSession, root: str, schema: StructType, version: int | None = None) -> DataFrame:
    """The rows of a merged table, as of a version."""
    entries = manifest(spark, root, version)
    files = [] if entries is None else [r.file for r in entries.select("file").collect()]
    return _files(spark, root, files, schema)


def stored_files(spark: SparkSession, root: str, version: int | None = None) -> set[str]:
    """Names of the files that a version of a merged table consists of."""
    entries = manifest(spark, root, version)
    return set() if entries is None else {r.file for r in entries.select("file").collect()}
