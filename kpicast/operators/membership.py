"""A Bloom filter as a column: which rows may have their key in a table.

The bits are set by an aggregation and reach the rows as one array of fixed size, so rows
are dropped where they are scanned, before anything is shuffled. What passes is joined
exactly afterwards: the filter only saves work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BITS = 22  # 2 ** 22 bits are 512 KB; good for a few hundred thousand keys
_HASHES = 3
_WORD = 64


def _places(keys: list[str], bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(*keys, F.lit(k)), F.lit(1 << bits)) for k in range(_HASHES)]


def filter_words(table: DataFrame, keys: list[str], bits: int = BITS) -> Column:
    """The filter of a table's keys: an array of 2 ** bits / 64 words, as a scalar. Rows
    with a null in a key set a place as well, but no join finds them."""
    place = table.select(F.explode(F.array(*_places(keys, bits))).alias("p"))
    word = F.expr(f"p DIV {_WORD}").alias("w")
    some = place.groupBy(word).agg(F.expr(f"bit_or(shiftleft(1L, CAST(p % {_WORD} AS int)))").alias("b"))
    # Words without a bit are there too, so that a word's place is its number.
    every = table.sparkSession.range((1 << bits) // _WORD).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("b"))
    whole = some.unionByName(every).groupBy("w").agg(F.expr("bit_or(b)").alias("b"))
    listed = F.array_sort(F.collect_list(F.struct("w", "b")))
    return whole.agg(F.transform(listed, lambda x: x["b"]).alias("words")).scalar()


def may_be_in(rows: DataFrame, table: DataFrame, keys: list[str], bits: int = BITS) -> DataFrame:
    """``rows`` without most of those whose keys are not in ``table``, which should be a
    written one: it is read for the filter and again for the join that has to follow."""
    held = rows.withColumns(
        {"_words": filter_words(table, keys, bits)} | {f"_p{k}": p for k, p in enumerate(_places(keys, bits))}
    )
    bit = "(shiftrightunsigned(element_at(_words, CAST({0} DIV {1} AS int) + 1), CAST({0} % {1} AS int)) & 1L) = 1L"
    names = [f"_p{k}" for k in range(_HASHES)]
    return held.filter(" AND ".join(bit.format(n, _WORD) for n in names)).drop("_words", *names)
