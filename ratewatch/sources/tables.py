"""Table access: declared schemas, relation resolution and schema-checked reads/writes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratewatch.schemas import TABLES, TableSpec


def resolve_relation(spark: SparkSession, candidates: Sequence[str]) -> str | None:
    """First candidate name that exists in the catalog (e.g. ``gold.x`` then ``public_gold.x``)."""
    return next((n for n in candidates if spark.catalog.tableExists(n)), None)


# The names a relation may have, in the order in which they are tried.
RELATIONS = {
    "mart_provider_coverage": ("gold.mart_provider_coverage", "public_gold.mart_provider_coverage"),
    "mart_rate_changes": ("gold.mart_rate_changes", "public_gold.mart_rate_changes"),
    "dim_products": ("silver.dim_products", "public_silver.dim_products"),
    "products_raw": ("raw.products_raw",),
    "schema_drift_event": ("bronze.schema_drift_event",),
}


def candidates(model: str, separator: str = ".") -> list[str]:
    """Names of a model's relation; another separator than the dot gives names of temporary views."""
    return [n.replace(".", separator) for n in RELATIONS[model]]


def resolved(spark: SparkSession, model: str, separator: str = ".") -> DataFrame | None:
    """The relation of a model, by the first of its names that exists; None if none does."""
    name = resolve_relation(spark, candidates(model, separator))
    return None if name is None else spark.table(name)


def register_models(frames: Mapping[str, DataFrame]) -> None:
    """Make frames known to the catalog as temporary views."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def register_stored(spark: SparkSession, out_root: str, models: Mapping[str, str]) -> None:
    """Make stored models known as views: name (``gold.mart_rate_changes``) -> folder under ``out_root``. A partition
    column ``as_of_date`` is a date again."""
    for name, folder in models.items():
        if "." in name:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
        stored = spark.read.parquet(f"{out_root}/{folder}")
        cols = ", ".join(f"CAST(`{c}` AS DATE) AS `{c}`" if c == "as_of_date" else f"`{c}`" for c in stored.columns)
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {cols} FROM parquet.`{out_root}/{folder}`")


def conform(df: DataFrame, spec: TableSpec | str) -> DataFrame:
    """Select and cast ``df`` to the declared schema of ``spec`` (column order included)."""
    from pyspark.sql.types import StringType, VariantType
    spec = TABLES[spec] if isinstance(spec, str) else spec

    def one(f):
        src = df.schema[f.name].dataType
        if isinstance(f.dataType, VariantType) and isinstance(src, StringType):
            return F.try_parse_json(F.col(f.name)).alias(f.name)  # JSON text -> parsed payload
        return F.col(f.name).cast(f.dataType).alias(f.name)
    return df.select(*[one(f) for f in spec.schema.fields])


def read_table(spark: SparkSession, path_or_name: str, spec: TableSpec | str) -> DataFrame:
    """Read a stored table (parquet path or catalog name) with its declared schema."""
    spec = TABLES[spec] if isinstance(spec, str) else spec
    if "/" in path_or_name:
        return spark.read.schema(spec.schema).parquet(path_or_name)
    return conform(spark.table(path_or_name), spec)


def create_tables_sql(database: str) -> list[str]:
    """``CREATE TABLE IF NOT EXISTS`` statements for every declared table (parquet)."""
    out = [f"CREATE DATABASE IF NOT EXISTS {database}"]
    for t in TABLES.values():
        cols = ", ".join(f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
                         for f in t.schema.fields)
        out.append(f"CREATE TABLE IF NOT EXISTS {database}.{t.name} ({cols}) USING parquet")
    return out


def write_table(df: DataFrame, path: str, spec: TableSpec | str, mode: str = "append",
                partition_by: Sequence[str] = (), run: str | None = None) -> None:
    """Append (or overwrite) rows conformed to the declared schema of ``spec``. With ``run`` (a column, the run's id)
    the append can be repeated: rows of the same runs are replaced, all others stay."""
    df = conform(df, spec)
    if run is not None:
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(run, *[c for c in partition_by if c != run]).parquet(path))
        return
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def split_rejects(df: DataFrame, spec: TableSpec | str, order: Sequence[Column] = ()) -> DataFrame:
    """The rows with ``reject_reason``: the first NOT NULL column that is null (``not_null:<column>``), or ``unique`` for
    a row whose primary key an earlier one (in ``order``) has; null for rows that keep the contract."""
    spec = TABLES[spec] if isinstance(spec, str) else spec
    null = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"not_null:{c}")) for c in spec.not_null])
    rank = F.row_number().over(Window.partitionBy(*spec.key, "_null").orderBy(*(order or [F.lit(0)])))
    flagged = df.withColumn("_null", null).withColumn("_rank", rank)
    reason = F.when(F.col("_null").isNotNull(), F.col("_null")).when(F.col("_rank") > 1, F.lit("unique"))
    return flagged.withColumn("reject_reason", reason).drop("_null", "_rank")


def write_checked(df: DataFrame, path: str, spec: TableSpec | str, order: Sequence[Column] = ()) -> DataFrame:
    """Write rows that keep the declared contract under ``fate=accepted`` and the others under ``fate=rejected`` and
    their reason, in one job. Returns the number of rows by reason, read off the written files."""
    spec = TABLES[spec] if isinstance(spec, str) else spec
    flagged = split_rejects(df, spec, order)
    own = conform(flagged, spec).columns
    out = flagged.select(*own, "reject_reason", F.when(F.col("reject_reason").isNull(), F.lit("accepted")).otherwise(F.lit("rejected")).alias("fate"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("fate", "reject_reason").parquet(path)
    stored = df.sparkSession.read.parquet(path)
    return stored.groupBy("fate", "reject_reason").agg(F.count(F.lit(1)).alias("n_rows"))


def read_accepted(spark: SparkSession, path: str, spec: TableSpec | str) -> DataFrame:
    """The accepted rows of ``write_checked``; only their folder is read."""
    spec = TABLES[spec] if isinstance(spec, str) else spec
    return conform(spark.read.parquet(path).filter("fate = 'accepted'"), spec)


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).filter("fate = 'rejected'").drop("fate")
