"""Operator 1, sharding: Hilbert-curve order over several metadata dimensions, cut into runs.

Each dimension is quantised by cut points near its quantiles, the cells are numbered along a Hilbert
curve, rows are sorted by curve index and the order is cut into shards whose row counts differ by
one at most. Neighbouring cells stay together, so each shard spans narrow ranges of *every*
dimension and ``shard_ranges`` lets a reader skip most shards for a filter on any of them.

Only a narrow frame (keys, size, checksum, curve index) is sorted; texts never move. The order is a
range-partitioned sort, so a hot value, one third of all rows in one cell say, spreads over tasks:
ties go on to checksum and key. Ranks come from per-partition counts, no task sees all rows.

Nulls: a null dimension value is the lowest cell; null text has no bytes and the checksum of empty
text. Equal rows are interchangeable and take neighbouring slots. An empty table gives no rows.
Columns of other names pass by unread; output columns are fixed, so clashing names cannot occur.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import checkpointed, cut, packed

#: Bytes added to each text for its size.
ROW_OVERHEAD = 16
#: Accuracy of the approximate quantiles (relative rank error 1 / this).
QUANTILE_ACCURACY = 2000


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Curve positions of integer cells, one row per point and one column per dimension.

    Works from the top bit down: each step undoes the rotation and reflection that the sub-cube
    entered so far has against the whole, then the Gray code of the steps is decoded.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for d in range(dims):
            flip = (x[d] >> b & 1).astype(bool)
            swap = np.where(flip, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> b & 1, (1 << b) - 1, 0)
    x ^= turn
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            index = index << 1 | (x[d] >> b & 1)
    return index


def _ordinal(df: DataFrame, name: str, shared_prefix: int):
    """A number whose order follows the column: itself, or seven bytes after the prefix that all
    values of a string column share."""
    if isinstance(df.schema[name].dataType, T.StringType):
        head = F.substring(F.encode(F.col(name), "UTF-8"), shared_prefix + 1, 7)
        return F.conv(F.rpad(F.hex(head), 14, "0"), 16, 10).cast("double")
    return F.col(name).cast("double")


def quantised(df: DataFrame, dims: list[str], bits: int) -> DataFrame:
    """Add ``cells``: per dimension the number of cut points below the value (nulls: 0)."""
    text = [d for d in dims if isinstance(df.schema[d].dataType, T.StringType)]
    prefix = dict.fromkeys(dims, 0)
    if text:
        ends = df.agg(*[f(F.encode(F.col(d), "UTF-8")).alias(f"{f.__name__}{i}")
                        for i, d in enumerate(text) for f in (F.min, F.max)]).first()
        for i, d in enumerate(text):
            lo, hi = bytes(ends[f"min{i}"] or b""), bytes(ends[f"max{i}"] or b"")
            prefix[d] = next((k for k, (a, b) in enumerate(zip(lo, hi)) if a != b), min(len(lo), len(hi)))
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    nums = [_ordinal(df, d, prefix[d]) for d in dims]
    found = df.agg(*[F.percentile_approx(c, shares, QUANTILE_ACCURACY).alias(f"c{i}")
                     for i, c in enumerate(nums)]).first()
    cells = []
    for i, c in enumerate(nums):
        cuts = sorted(set(found[i] or []))        # at most 2**bits - 1 numbers, whatever the input
        cells.append(sum((F.when(c > F.lit(x), 1).otherwise(0) for x in cuts), F.lit(0)))
    return df.withColumn("cells", F.array(*cells))


def hilbert_order(df: DataFrame, dims: list[str], ties: list[str], bits: int = 4) -> DataFrame:
    """Add ``curve`` (Hilbert index) and ``rank`` (gapless from 0 in curve order, then ``ties``)."""

    @F.pandas_udf("long")
    def curve(cells: pd.Series) -> pd.Series:
        if not len(cells):
            return pd.Series([], dtype="int64")
        return pd.Series(hilbert_index(np.stack(cells.to_numpy()), bits))

    placed = quantised(df, dims, bits).withColumn("curve", curve("cells")).drop("cells")
    order = ["curve", *ties]
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    # partition number in the upper bits, place within the sorted partition in the lower 33
    placed = checkpointed(placed.withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    counts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    before, total = {}, 0                          # one number per partition
    for r in sorted(counts):
        before[r["part"]], total = total, total + r["n"]
    offsets = df.sparkSession.createDataFrame(list(before.items()) or [(0, 0)], "part long, before long")
    return (placed.withColumn("part", part).join(F.broadcast(offsets), "part")
            .withColumn("rank", F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)))
            .withColumn("rows_total", F.lit(total).cast("long")).drop("part", "before", "at"))


def cut_runs(ranked: DataFrame, shards: int) -> DataFrame:
    """Cut the order into runs: counts differ by one at most. Adds ``shard`` and ``slot``."""
    shard = F.expr(f"rank * {shards} div rows_total")
    first = F.expr(f"(shard * rows_total + {shards - 1}) div {shards}")
    return (ranked.withColumn("shard", shard).withColumn("slot", F.col("rank") - first)
            .withColumn("shard", F.col("shard").cast("int")).drop("rows_total"))


def shard_documents(docs: DataFrame, shards: int = 40, bits: int = 4) -> DataFrame:
    """Documents into ``shards`` by language, source and size: one row per document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        "doc_id", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
        (F.octet_length(text) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    ranked = hilbert_order(narrow, ["lang", "source", "size"], ["text_crc32", "doc_id"], bits)
    return cut_runs(ranked, shards)


def shard_ranges(sharded: DataFrame, dims: list[str]) -> DataFrame:
    """Per shard the rows and the least and greatest value of each dimension, for file pruning."""
    return sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), *[
        f(d).alias(f"{f.__name__}_{d}") for d in dims for f in (F.min, F.max)])


def write_shards(docs: DataFrame, sharded: DataFrame, path: str) -> None:
    """Whole documents as files by shard, in curve order: ``path/shard=N``. Rows that share doc_id, size and checksum
    are numbered on both sides, so each gets a slot of its own. A column of the documents named ``shard``
    gives way to the shard."""
    from pyspark.sql import Window
    text = F.coalesce(F.col("text"), F.lit(""))
    own = [F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("_id"), F.col("doc_id").isNull().alias("_none")]
    keys = sharded.select(*own, F.col("size").alias("_size"), F.col("text_crc32").alias("_crc"), F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    same = ["_id", "_none", "_size", "_crc"]
    keys = keys.withColumn("_nth", F.row_number().over(Window.partitionBy(*same).orderBy("_shard", "_slot")))
    rows = packed(docs, _id=own[0], _none=own[1], _size=(F.octet_length(text) + F.lit(ROW_OVERHEAD)).cast("long"),
                  _crc=F.crc32(F.encode(text, "UTF-8")), _at=F.monotonically_increasing_id())
    # whole texts aren't sorted for the numbers: only their keys are
    rows = cut(rows, "rows")
    nth = F.row_number().over(Window.partitionBy(*same).orderBy("_at"))
    place = rows.select(*same, "_at").withColumn("_nth", nth).join(keys, [*same, "_nth"]).select("_at", "_shard", "_slot")
    kept = [c for c in docs.columns if c != "shard"]
    placed = rows.join(place, "_at").repartitionByRange("_shard", "_slot").sortWithinPartitions("_shard", "_slot")
    placed.select(*[F.col("row")[c].alias(c) for c in kept], F.col("_shard").alias("shard")).write.partitionBy("shard").parquet(path)
