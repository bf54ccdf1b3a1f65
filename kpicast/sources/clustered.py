"""Tables stored by key, so that builds on them need no shuffle.

Rows are dealt to buckets by a hash of the key and sorted inside; a bucket is one file.
A window or a sum by that key, and a join of two tables with equal buckets, then read
each bucket in a task of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ROWS_PER_BUCKET = 4_000_000


def bucket_count(rows: int, at_least: int = 8) -> int:
    """A power of two, so that tables of different sizes still divide one another."""
    count = at_least
    while rows > count * ROWS_PER_BUCKET:
        count *= 2
    return count


def write_clustered(
    df: DataFrame, name: str, path: str, key: list[str], order: list[str], buckets: int
) -> DataFrame:
    """``df`` as the catalog table ``name`` at ``path``, and that table."""
    (
        df.repartition(buckets, *key)
        .write.bucketBy(buckets, *key)
        .sortBy(*key, *order)
        .option("path", path)
        .mode("overwrite")
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


def open_clustered(
    spark: SparkSession, name: str, path: str, schema: str, key: list[str], order: list[str], buckets: int
) -> DataFrame:
    """A table that another session has written, under the catalog name ``name``."""
    quoted = lambda names: ", ".join(f"`{n}`" for n in names)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{name}` ({schema}) USING parquet "
        f"CLUSTERED BY ({quoted(key)}) SORTED BY ({quoted([*key, *order])}) INTO {buckets} BUCKETS "
        f"LOCATION '{path}'"
    )
    return spark.table(name)
