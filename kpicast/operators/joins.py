"""Lookups that hold up when one key carries a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

_SALT = "_salt"


def spread_lookup(
    rows: DataFrame,
    table: DataFrame,
    on: list[str],
    spread_by: list[str],
    how: str = "left",
    copies: int = 16,
) -> DataFrame:
    """Join ``rows`` with a keyed ``table`` of at most one row per key.

    The rows of one key are spread over ``copies`` tasks by a hash of
    ``spread_by``; the table is repeated once per copy. No side is hinted: when
    the table turns out small, adaptive execution broadcasts it by its measured
    size."""
    salted = rows.withColumn(
        _SALT, F.pmod(F.xxhash64(*spread_by), F.lit(copies)).cast("int")
    )
    repeated = table.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return salted.join(repeated, [*on, _SALT], how).drop(_SALT)


HITTERS = 256


def hot_keys(counts: DataFrame, on: list[str], count: str = "n") -> DataFrame:
    """Keys that hold more than 1 / ``HITTERS`` of all rows, and in how many copies their
    side of a join is to be dealt. ``counts`` has the rows of every key. However large the
    table, there are fewer than ``HITTERS`` such keys."""
    total = counts.agg(F.sum(count)).scalar()
    share = F.col(count) * HITTERS / total
    return counts.filter(share > 1).select(*on, F.ceil(share).cast("int").alias("_copies"))


def measured_lookup(
    rows: DataFrame,
    table: DataFrame,
    counts: DataFrame,
    on: list[str],
    spread_by: list[str],
    how: str = "left",
) -> DataFrame:
    """:func:`spread_lookup` with copies of hot keys alone. ``counts`` (``on``, n), a
    written table, has the rows of every key; a key that holds no more than its share is
    neither salted nor repeated. Null keys stay where they are."""
    hot = F.broadcast(hot_keys(counts, on))  # fewer than HITTERS rows
    salt = F.pmod(F.xxhash64(*spread_by), F.coalesce("_copies", F.lit(1))).cast("int")
    salted = rows.join(hot, on, "left").withColumn(_SALT, salt).drop("_copies")
    last = F.coalesce("_copies", F.lit(1)) - 1
    repeated = table.join(hot, on, "left").withColumn(_SALT, F.explode(F.sequence(F.lit(0), last))).drop("_copies")
    return salted.join(repeated, [*on, _SALT], how).drop(_SALT)


def fits(table: DataFrame, max_rows: int) -> bool:
    """Whether ``table`` has at most ``max_rows`` rows; reads no more than that."""
    return table.limit(max_rows + 1).count() <= max_rows


def dimension_lookup(
    rows: DataFrame,
    table: DataFrame,
    on: list[str],
    spread_by: list[str],
    how: str = "left",
    broadcast_rows: int = 0,
) -> DataFrame:
    """Join the facts with a stored dimension. It is broadcast only after a count
    shows that it fits; a larger one takes the spread shuffle join."""
    if broadcast_rows and fits(table, broadcast_rows):
        return rows.join(F.broadcast(table), on, how)
    return spread_lookup(rows, table, on, spread_by, how)
