"""Mix sources to target weights by repeating documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kpicast.llm.common import WORD

MAX_RATE = 3.0


def text_size(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def source_totals(sized: DataFrame, source: str = "source", size: str = "size") -> DataFrame:
    """One row per source; sums combine before the shuffle, so a source that holds
    most rows is no hot group."""
    return sized.groupBy(F.col(source).alias("source")).agg(
        F.sum(size).cast("long").alias("source_size")
    )


def source_targets(totals: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """source, source_size, target for a table of one row per source.

    Sources sorted by code point, null last, weigh 1, 2, 3, 1, 2, 3 ... The total is
    shared by weight; a source takes at most ``max_rate`` times its size and the
    excess is shared among the others by weight until none is above. Sources meet
    their limit in the order of limit per weight, so the level of the others is found
    from running sums instead of rounds. Only the table of sources, never documents,
    is ordered here.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    limit = max_rate * F.col("source_size")
    weighed = (
        totals.withColumn("weight", (F.row_number().over(by_name) - 1) % 3 + 1)
        .withColumn("limit", limit)
        .withColumn("order", F.col("limit") / F.col("weight"))
    )
    all_rows = Window.partitionBy()
    before = Window.orderBy("order", F.col("source").isNull(), F.col("source").cast("binary"))
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    left = (
        weighed.withColumn("total", F.sum("source_size").over(all_rows))
        .withColumn("weights", F.sum("weight").over(all_rows))
        .withColumn("taken", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("gone", F.coalesce(F.sum("weight").over(before), F.lit(0)))
        # The level if exactly the sources before this one are at their limit.
        .withColumn("level", (F.col("total") - F.col("taken")) / (F.col("weights") - F.col("gone")))
        .withColumn("level", F.max(F.when(F.col("order") >= F.col("level"), F.col("level"))).over(all_rows))
    )
    share = F.coalesce(F.least("limit", F.col("level") * F.col("weight")), F.col("limit"))
    return left.select("source", "source_size", share.alias("target"))


def copies(rate: Column, doc_id: Column, seed: int) -> Column:
    """floor(rate) plus one with the probability of the fraction, drawn from a hash
    of seed and id: reruns and recomputed partitions agree."""
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), doc_id.cast("string"))), 1, 13)
    draw = F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))
    whole = F.floor(rate)
    return (whole + F.when(draw < rate - whole, 1).otherwise(0)).cast("long")


def planned(docs: DataFrame, seed: int = 11, max_rate: float = MAX_RATE) -> DataFrame:
    """doc_id, _size, _source_size, _target, _copies and the whole row as _row.

    Null or blank texts have size 0 and follow the rate of their source; a source of
    size 0 has rate 0. Rows repeated with one id share one draw.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    sized = docs.select("doc_id", "source", text_size(F.col("text")).alias("_size"), whole)
    targets = source_targets(source_totals(sized, size="_size"), max_rate).select(
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("_key"),
        F.col("source_size").alias("_source_size"),
        F.col("target").alias("_target"),
    )
    # One row per source: Spark broadcasts it by its measured size or splits skew.
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    rate = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(0.0)
    return (
        sized.withColumn("_key", key)
        .join(targets, "_key")
        .drop("_key")
        .withColumn("_copies", copies(rate, F.col("doc_id"), seed))
        .drop("source")
    )


def mix_sources(docs: DataFrame, seed: int = 11, max_rate: float = MAX_RATE) -> DataFrame:
    """Every document as often as the mix takes it, with the columns of ``docs``."""
    rows = planned(docs, seed, max_rate).filter("_copies > 0")
    each = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_copies")))
    return each.select("_row.*")
