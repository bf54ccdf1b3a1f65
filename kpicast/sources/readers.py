"""Reading source tables."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import session
from ..config import ExtractRules, Tenant
from ..functions.clean import first_column


class EmptyExtract(ValueError):
    """An extract returned no row; carries the arguments it was run with."""

    def __init__(self, name: str, arguments: dict):
        super().__init__(f"extract {name!r} returned no rows for {arguments}")
        self.arguments = arguments


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, columns: list[str] | None = None
) -> DataFrame:
    """CSV with a header in every file. Every column of ``schema`` that a file has is
    read as text, for lenient typing by the cleaning step; columns that no file has are
    left out. Files may order their columns differently: those with one header are
    read together, and their rows are matched by name."""
    first = (
        spark.read.text(path)
        .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value")
        .withColumn("line", F.monotonically_increasing_id())
        .filter("at = 0")
        .groupBy("file")
        .agg(F.min_by("value", "line").alias("header"))
    )
    # One row a file; the driver lists the files of a read anyway.
    files: dict[str, list[str]] = {}
    for row in first.collect():
        files.setdefault(row["header"], []).append(row["file"])
    parts = []
    for header in sorted(files):
        names = spark.read.option("header", True).csv(files[header][:1]).columns
        text = T.StructType([T.StructField(name, T.StringType()) for name in names])
        # A header that is not the one read for the group is an error, not a mix-up.
        parts.append(spark.read.schema(text).option("header", True).option("enforceSchema", False).csv(files[header]))
    if not parts:
        return spark.createDataFrame([], T.StructType([]))
    df = parts[0]
    for part in parts[1:]:
        df = df.unionByName(part, allowMissingColumns=True)
    wanted = columns or [field.name for field in schema]
    return df.select(*[name for name in wanted if name in df.columns])


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    timeout_seconds: int = 600,
    **options: str,
) -> DataFrame:
    """Database table. Filters on the frame are pushed into the database; a
    partition column splits the read over tasks."""
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("fetchsize", fetch_size)
        .option("queryTimeout", timeout_seconds)
        .option("pushDownPredicate", True)
        .options(**options)
    )
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", partitions)
        )
    return reader.load()


def tenant_table(
    read: Callable[[str], DataFrame], tenant: Tenant, suffix: str
) -> DataFrame:
    """Table of one tenant through any reader that takes a table name."""
    return read(tenant.table(suffix))


def tenant_metrics(df: DataFrame, tenant: Tenant, horizon: str) -> DataFrame:
    """The tenant's conversion and revenue columns under their common names."""
    daily = horizon == "24h"
    revenue = tenant.daily_revenue if daily else tenant.hourly_revenue
    conversions = tenant.daily_conversions if daily else tenant.hourly_conversions
    return df.withColumns(
        {"tracker_revenue": F.col(revenue), "tracker_conversions": F.col(conversions)}
    )


def resolve_columns(df: DataFrame) -> DataFrame:
    """Common metric names for a file, decided from its header."""
    found = {
        "tracker_conversions": first_column(
            df.columns, ["conversions", "tracker_conversions", "tracker_conversion"]
        ),
        "tracker_revenue": first_column(df.columns, ["conversions_value", "tracker_revenue"]),
    }
    renames = {name: source for name, source in found.items() if source and source != name}
    out = df.drop(*[name for name in renames if name in df.columns])
    return out.withColumnsRenamed({source: name for name, source in renames.items()})


def require_non_empty(df: DataFrame, name: str, **arguments) -> DataFrame:
    """The frame written once, or :class:`EmptyExtract` when it has no row. Whatever
    reads the result doesn't run the extract again."""
    df = session.written(df, name)
    if df.isEmpty():
        raise EmptyExtract(name, arguments)
    return df


def extract_with_fallback(
    extract: Callable[[int, int], DataFrame],
    lookback_days: int = ExtractRules.daily_lookback_days,
    ads_per_account: int = ExtractRules.ads_per_account,
    attempts: tuple | None = ExtractRules.daily_attempts,
    retry_on: tuple[type[Exception], ...] = (EmptyExtract,),
) -> tuple[DataFrame, dict]:
    """The first attempt with rows, and the days and the limit it was made with.

    One attempt unless others are asked for. Only the errors in ``retry_on`` (an empty
    extract; name a timeout to add it) lead to the next one; any other is raised."""
    attempts = attempts or ((lookback_days, ads_per_account),)
    for n, (days, limit) in enumerate(attempts, 1):
        used = {"lookback_days": days, "ads_per_account": limit}
        try:
            return require_non_empty(extract(days, limit), "daily", **used), used
        except retry_on:
            if n == len(attempts):
                raise
    raise AssertionError("unreachable")
