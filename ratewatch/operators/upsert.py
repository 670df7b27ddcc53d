"""Key-based writes on plain tables: insert-ignore, full upsert, partial upsert, atomic groups.

Plain parquet has no MERGE, so each write is expressed as: union(target, incoming) -> one
aggregate per key that picks the winning value(s) with min_by / max_by over a write sequence.
The aggregate combines map-side, so a hot key costs one row per task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sequenced(target: DataFrame | None, incoming: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Target rows come first (source 0), incoming rows after, in ``order``. ``target=None`` is an
    empty table (the result is then the incoming writes applied to nothing)."""
    i = incoming.withColumn("_src", F.lit(1))
    if target is None:
        u = i
    else:
        u = target.withColumn("_src", F.lit(0)).unionByName(i.select(*target.columns, "_src"))
    return u.withColumn("_seq", F.struct(F.col("_src"), *order))


def insert_ignore(target: DataFrame | None, incoming: DataFrame, key: Sequence[str],
                  order: Sequence[Column] = ()) -> DataFrame:
    """INSERT ... ON CONFLICT DO NOTHING: existing rows win, then the first incoming row per key."""
    cols = (target if target is not None else incoming).columns
    u = _sequenced(target, incoming, order)
    rest = [c for c in cols if c not in key]
    g = u.groupBy(*key).agg(F.min_by(F.struct(*rest), "_seq").alias("_w"))
    return g.select(*key, *[F.col(f"_w.{c}").alias(c) for c in rest]).select(*cols)


def upsert(target: DataFrame | None, incoming: DataFrame, key: Sequence[str], order: Sequence[Column] = (),
           keep_first: Sequence[str] = ()) -> DataFrame:
    """INSERT ... ON CONFLICT DO UPDATE: the last write per key replaces every non-key column,
    except ``keep_first`` columns, which keep the value of the first write."""
    cols = (target if target is not None else incoming).columns
    u = _sequenced(target, incoming, order)
    first = [c for c in cols if c in keep_first]
    last = [c for c in cols if c not in key and c not in keep_first]
    aggs = [F.max_by(F.struct(*last), "_seq").alias("_l")]
    if first:
        aggs.append(F.min_by(F.struct(*first), "_seq").alias("_f"))
    g = u.groupBy(*key).agg(*aggs)
    return g.select(*key, *[F.col(f"_l.{c}").alias(c) for c in last],
                    *[F.col(f"_f.{c}").alias(c) for c in first]).select(*cols)


def atomic_groups(rows: DataFrame, group: Sequence[str], failed: Column) -> DataFrame:
    """All-or-nothing per group: keep only groups in which no row is marked ``failed``."""
    bad = rows.filter(failed).select(*group).distinct()
    return rows.join(bad, list(group), "left_anti")
