"""Dense calendars per ad, built without a join.

Every row opens the gap up to the next row of its ad: ``lead`` finds the next
slot and ``explode(sequence(..))`` fills it. Ids and timezone carry forward with
the opening row and the filled slots hold 0, so the result is the calendar left
join with forward fill. The hash partitioning by ad survives, so the feature
windows that follow need no second shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..names import ENTITY, METRICS
from .rollup import keep_last, last_rows


def _by_day():
    return Window.partitionBy("ad_id").orderBy("local_date")


def _fill_days(rows: DataFrame, metrics: list[str], carry: list[str]) -> DataFrame:
    until = F.coalesce(F.date_sub(F.lead("local_date").over(_by_day()), 1), F.col("local_date"))
    opened = rows.withColumn("_until", until)
    days = F.explode(F.sequence("local_date", "_until")).alias("_day")
    own = F.col("_day") == F.col("local_date")
    return opened.select("*", days).select(
        F.col("_day").alias("local_date"),
        *carry,
        *[F.when(own, F.col(name)).otherwise(0.0).alias(name) for name in metrics],
    )


def dense_days(daily: DataFrame, metrics: list[str] = METRICS) -> DataFrame:
    """Every day of every ad between its first and its last row."""
    return _fill_days(keep_last(daily, "local_date"), metrics, ["timezone", *ENTITY])


def scoring_days(
    daily: DataFrame, history_rows: int | None = 16, metrics: list[str] = METRICS
) -> DataFrame:
    """Dense days of each ad's last ``history_rows`` rows plus the day to
    forecast: an all-zero row one day after the last one. ``history_rows=None``
    keeps the whole history."""
    rows = keep_last(daily, "local_date")
    newest = Window.partitionBy("ad_id").orderBy(F.col("local_date").desc())
    rows = rows.withColumn("_n", F.row_number().over(newest))
    if history_rows is not None:
        rows = rows.filter(F.col("_n") <= history_rows)
    # The newest row is followed by the day to forecast.
    offsets = F.when(F.col("_n") == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.select("*", F.explode(offsets).alias("_ahead"))
    future = F.col("_ahead") == 1
    rows = rows.select(
        F.date_add("local_date", F.col("_ahead")).alias("local_date"),
        "timezone",
        *ENTITY,
        F.when(future, F.col("local_date")).alias("history_cutoff_local_date"),
        *[F.when(future, 0.0).otherwise(F.col(name)).alias(name) for name in metrics],
    )
    return _fill_days(rows, metrics, ["timezone", *ENTITY, "history_cutoff_local_date"])


def latest_and_next(daily: DataFrame) -> DataFrame:
    """Last row per ad with the day it leads to."""
    return last_rows(keep_last(daily, "local_date"), 1).withColumn(
        "forecast_local_date", F.date_add("local_date", 1)
    )
