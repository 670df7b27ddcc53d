"""Latest row per key (DISTINCT ON ... ORDER BY ...), with a total order for ties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                   columns: Sequence[str] | None = None) -> DataFrame:
    """Keep the first row of each ``keys`` group under ``order``.

    ``order`` should end in columns that make it total (otherwise the winner of a tie is
    arbitrary). Catalyst plans ``row_number() = 1`` with a partial WindowGroupLimit before the
    shuffle, so each map task sends at most one row per key, even for a very hot key.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    return out.select(*columns) if columns else out
