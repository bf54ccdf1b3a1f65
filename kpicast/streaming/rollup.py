"""Hourly rollup of reports as they arrive.

Every micro-batch is rolled up and written under its batch number; reading merges
the parts with one more sum. This is the partial and final step of the batch
rollup spread over time: late reports are whole, no state is kept, and a batch
that runs again replaces its own part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import localtime
from ..names import ENTITY, HOURLY_METRICS
from ..operators.rollup import clean_hourly, hourly_rollup


def start_hourly_rollup(reports: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Rolls up what a stream of reports holds so far and stops."""

    def write_part(batch: DataFrame, number: int) -> None:
        part = hourly_rollup(clean_hourly(batch)).drop("local_ts")
        part.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        reports.writeStream.foreachBatch(write_part)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_hourly_rollup(spark: SparkSession, path: str) -> DataFrame:
    """The rollup over all batches so far."""
    parts = spark.read.option("basePath", path).parquet(path)
    return (
        parts.groupBy("hour_idx", "timezone", *ENTITY)
        .agg(*[F.sum(name).alias(name) for name in HOURLY_METRICS])
        .withColumn("local_ts", localtime.wall_clock(F.col("hour_idx")))
    )
