"""Payload structure fingerprints and drift events.

The path set of a document: level by level, objects contribute ``parent.key`` paths and arrays ``parent[]``. A
frontier of (path, node) goes down ``LEVELS`` levels inside the row with higher-order functions (no explode, no
shuffle). Documents that reach deeper hand their remaining nodes to the next round as rows, which goes down as many
levels again, until no node is left; rounds are written, so the plan has the same size for any depth and
only documents that deep are touched again. By default every element of every array is descended to the bottom; a
caller may pass ``max_depth`` and ``max_elems`` to look at less. The fingerprint is SHA-256 of the sorted distinct paths
joined by newlines (an empty set hashes the empty string).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewatch.functions.jsonpath import as_variant
from ratewatch.operators.sequence import previous_in_key
from ratewatch.session import checkpoint_dir

DRIFT_NOTE = "Schema/path fingerprint changed"
#: Levels that a round goes down inside the row.
LEVELS = 6
_EMPTY_NODES = "array<struct<path:string,node:variant>>"


def _child_path(parent: Column, key: Column) -> Column:
    return F.when(parent == "", key).otherwise(F.concat(parent, F.lit("."), key))


def _as_map(node: Column) -> Column:
    return F.try_variant_get(node, "$", "map<string,variant>")


def _as_array(node: Column) -> Column:
    return F.try_variant_get(node, "$", "array<variant>")


def _info(n: Column) -> Column:
    """A node with its object view (map) and array view, each converted once."""
    return F.struct(n["path"].alias("path"), _as_map(n["node"]).alias("m"), _as_array(n["node"]).alias("a"))


def _emitted(i: Column) -> Column:
    keys = F.transform(F.coalesce(F.map_keys(i["m"]), F.array().cast("array<string>")),
                       lambda k: _child_path(i["path"], k))
    arr = F.when(i["a"].isNotNull(), F.array(F.concat(i["path"], F.lit("[]"))))
    return F.concat(keys, F.coalesce(arr, F.array().cast("array<string>")))


def _children(i: Column, max_elems: int | None) -> Column:
    obj = F.transform(F.map_entries(i["m"]),
                      lambda e: F.struct(_child_path(i["path"], e["key"]).alias("path"), e["value"].alias("node")))
    arr = F.transform(i["a"] if max_elems is None else F.slice(i["a"], 1, max_elems),
                      lambda x: F.struct(F.concat(i["path"], F.lit("[]")).alias("path"), x.alias("node")))
    empty = F.array().cast(_EMPTY_NODES)
    return F.concat(F.coalesce(obj, empty), F.coalesce(arr, empty))


def _descend(x: DataFrame, levels: int, max_elems: int | None, last: bool) -> DataFrame:
    """Take the frontier ``_lvl`` down ``levels`` levels: ``_paths`` grows by what these emit. With ``last`` the
    nodes below are not looked at any more, else the objects and arrays among them are the new frontier."""
    for depth in range(levels):
        x = x.withColumn("_info", F.transform("_lvl", _info))
        x = x.withColumn("_paths", F.concat("_paths", F.flatten(F.transform("_info", _emitted))))
        if not (last and depth == levels - 1):
            x = x.withColumn("_lvl", F.flatten(F.transform("_info", lambda i: _children(i, max_elems))))
    x = x.withColumn("_paths", F.array_distinct("_paths")).drop("_info")
    if last:
        return x.drop("_lvl")
    return x.withColumn("_lvl", F.filter("_lvl", lambda n: _as_map(n["node"]).isNotNull() | _as_array(n["node"]).isNotNull()))


def _root(df: DataFrame, node: Column) -> DataFrame:
    return df.withColumn("_lvl", F.array(F.struct(F.lit("").alias("path"), node.alias("node")))).withColumn(
        "_paths", F.array().cast("array<string>"))


def _deeper(x: DataFrame, max_elems: int | None) -> DataFrame | None:
    """(_row, _deep): the paths below the first ``LEVELS`` levels, or None if no document reaches there."""
    spark = x.sparkSession
    rest = x.filter(F.size("_lvl") > 0).select("_row", F.inline("_lvl"))
    folder = None
    while not rest.isEmpty():
        folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/paths-{uuid.uuid4().hex}"
        step = rest.select("_row", F.array(F.struct("path", "node")).alias("_lvl"), F.array().cast("array<string>").alias("_paths"))
        step = _descend(step, LEVELS, max_elems, last=False).checkpoint()
        step.select("_row", F.explode("_paths").alias("path")).distinct().write.mode("append").parquet(folder)
        rest = step.filter(F.size("_lvl") > 0).select("_row", F.inline("_lvl"))
    if folder is None:
        return None
    return spark.read.schema("_row long, path string").parquet(folder).groupBy("_row").agg(F.collect_set("path").alias("_deep"))


def with_fingerprint(df: DataFrame, payload: str, max_depth: int | None = None, max_elems: int | None = None,
                     paths_col: str = "fingerprint_paths", hash_col: str = "fingerprint_hash", keep_payload: bool = True) -> DataFrame:
    """Add the sorted structural path set and its SHA-256 fingerprint for ``payload``. Without ``max_depth`` the
    result is computed when this is called."""
    cols = [c for c in df.columns if keep_payload or c != payload]
    x = _root(df, as_variant(df, payload)).drop(*[c for c in df.columns if c not in cols])
    if max_depth is not None:
        x = _descend(x, max_depth + 1, max_elems, last=True)
    else:
        checkpoint_dir(df.sparkSession)
        x = _descend(x.withColumn("_row", F.monotonically_increasing_id()), LEVELS, max_elems, last=False).checkpoint()
        deep = _deeper(x, max_elems)
        if deep is not None:
            x = x.join(deep, "_row", "left").withColumn("_paths", F.concat("_paths", F.coalesce("_deep", F.array().cast("array<string>"))))
    x = x.withColumn(paths_col, F.array_sort(F.array_distinct("_paths")))
    x = x.withColumn(hash_col, F.sha2(F.array_join(F.col(paths_col), "\n"), 256))
    return x.select(*cols, paths_col, hash_col)


def fingerprints(pages: DataFrame, *, payload: str = "payload", observed_at: str = "fetched_at",
                 ok_status: int = 200, max_depth: int | None = None, max_elems: int | None = None) -> DataFrame:
    """One fingerprint row per parsed page (``schema_fingerprint``): only pages whose payload parsed."""
    extra = [c for c in ("page_num",) if c in pages.columns]
    p = pages.filter(F.col("http_status") == ok_status).select(
        "provider_id", "endpoint", observed_at, "run_id", *extra, as_variant(pages, payload).alias("_v"))
    fp = with_fingerprint(p.filter(F.col("_v").isNotNull()), "_v", max_depth, max_elems, keep_payload=False)
    return fp.select("provider_id", "endpoint", "fingerprint_hash", "fingerprint_paths",
                     F.col(observed_at).alias("observed_at"), "run_id", *extra)


def drift_events(fps: DataFrame, history: DataFrame | None = None,
                 order_tiebreak: tuple[str, ...] = ("page_num",), bucket: Column | None = None) -> DataFrame:
    """Drift event for every observation whose previous fingerprint (same provider and endpoint)
    exists and differs. ``history`` (stored fingerprints) seeds the previous value of a new batch.
    ``bucket``: see ``previous_in_key``."""
    tie = [c for c in order_tiebreak if c in fps.columns]
    cur = fps.select("provider_id", "endpoint", "fingerprint_hash", "observed_at", "run_id", *tie,
                     F.lit(1).alias("_new"))
    if history is not None:
        seed = (history.groupBy("provider_id", "endpoint")
                .agg(F.max_by("fingerprint_hash", F.struct("observed_at", *[c for c in tie if c in history.columns],
                                                           "fingerprint_hash")).alias("fingerprint_hash"),
                     F.max("observed_at").alias("observed_at"))
                .select("provider_id", "endpoint", "fingerprint_hash", "observed_at",
                        F.lit(None).cast("string").alias("run_id"),
                        *[F.lit(None).cast(fps.schema[c].dataType).alias(c) for c in tie],
                        F.lit(0).alias("_new")))
        cur = cur.unionByName(seed)
    order = ["observed_at", "_new", *tie]
    x = previous_in_key(cur, ["provider_id", "endpoint"], order, "fingerprint_hash", "old_fingerprint_hash", bucket)
    x = x.filter((F.col("_new") == 1) & F.col("old_fingerprint_hash").isNotNull()
                 & (F.col("old_fingerprint_hash") != F.col("fingerprint_hash")))
    return x.select("provider_id", "endpoint", "old_fingerprint_hash",
                    F.col("fingerprint_hash").alias("new_fingerprint_hash"), "observed_at", "run_id",
                    F.lit(DRIFT_NOTE).alias("note"))
