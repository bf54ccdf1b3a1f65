"""Exact quantiles of groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .joins import spread_lookup

SKETCH = 4096
# Around a quantile: what the sketch's error allows, and twice much wider.
_WIDEN = (1, 8, 64)
_INNER = len(_WIDEN)
_ZONES = 2 * _INNER + 1


def sketch_of(value: Column, size: int = SKETCH) -> Column:
    """Mergeable KLL sketch of a column of doubles."""
    return F.call_function("kll_sketch_agg_double", value, F.lit(size))


def merged(sketch: Column) -> Column:
    """One sketch from those of parts."""
    return F.call_function("kll_merge_agg_double", sketch)


def thresholds(sketch: Column, probs: dict[str, float], size: int = SKETCH) -> Column:
    """For every quantile the values between which the sketch sees it: three on either
    side, one after the other. The innermost two hold it in 99 of 100 cases."""
    error = 2.3 / size**0.97
    ranks = []
    for p in probs.values():
        ranks += [max(p - error * w, 0.0) for w in reversed(_WIDEN)]
        ranks += [min(p + error * w, 1.0) for w in _WIDEN]
    return F.call_function("kll_sketch_get_quantile_double", sketch, F.array(*map(F.lit, ranks)))


def _zone(value: Column, limits: Column, which: int) -> Column:
    """0 to 6: between which thresholds of a quantile a value lies; 3 is the innermost."""
    at = [limits[2 * _INNER * which + k] for k in range(2 * _INNER)]
    reached = [value >= x for x in at[:_INNER]] + [value > x for x in at[_INNER:]]
    total = reached[0].cast("long")
    for r in reached[1:]:
        total = total + r.cast("long")
    return total


def select_quantiles(
    rows: DataFrame,
    cells: list[str],
    groups: list[tuple[Column, Column]],
    probs: dict[str, float],
    few_keys: bool,
) -> DataFrame:
    """(_key, n, one column per quantile) of the values ``_v`` of ``rows``.

    ``groups`` has, for every group that a row is in, its key (a struct made from the
    columns ``cells``) and the thresholds of its quantiles. A row is compared once with
    each of them; rows that lie between the same thresholds leave a task as one count,
    but for those in an innermost zone, which are counted by value. Zones and counts
    tell for certain where a rank is. If the sketch was wrong, so that it is in another
    zone, the values of that zone are read once more: that part of the plan has no rows
    otherwise and is dropped when it runs."""
    value, width = F.col("_v"), len(probs)
    zones = [_zone(value, limits, i) for _, limits in groups for i in range(width)]
    zoned = rows.select(*cells, "_v", *(z.alias(f"_z{k}") for k, z in enumerate(zones)))
    code, inside = F.lit(0).cast("long"), F.lit(False)
    for k in range(len(zones)):
        code = code + F.col(f"_z{k}") * F.lit(_ZONES**k)
        inside = inside | (F.col(f"_z{k}") == _INNER)
    counted = (
        zoned.groupBy(*cells, code.alias("_code"), F.when(inside, value).alias("_kept"))
        .agg(F.count(F.lit(1)).alias("_count"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    )
    digit = lambda k: F.expr(f"_code DIV {_ZONES**k} % {_ZONES}")
    entries = [
        F.struct(
            key.alias("_key"),
            F.lit(name).alias("_name"),
            F.lit(p).alias("_p"),
            digit(g * width + i).alias("_zone"),
            F.when(digit(g * width + i) == _INNER, F.col("_kept")).alias("_at"),
        )
        for g, (key, _) in enumerate(groups)
        for i, (name, p) in enumerate(probs.items())
    ]
    each = counted.select(F.inline(F.array(*entries)), "_count", "_least", "_most")
    each = each.groupBy("_key", "_name", "_p", "_zone", "_at").agg(
        F.sum("_count").alias("_count"), F.min("_least").alias("_least"), F.max("_most").alias("_most")
    )
    whole = Window.partitionBy("_key", "_name")
    upward = whole.orderBy("_zone", "_at").rowsBetween(Window.unboundedPreceding, 0)
    c = F.col
    ranked = each.withColumn("_upto", F.sum("_count").over(upward)).withColumn("n", F.sum("_count").over(whole))
    position = (c("n") - 1) * c("_p")
    begin, end = c("_upto") - c("_count"), c("_upto")

    def at(rank: Column) -> Column:
        """The value of a rank, or between which values it is to be looked up."""
        known = F.coalesce(
            c("_at"), F.when(rank == begin, c("_least")), F.when(rank == end - 1, c("_most"))
        )
        found = F.struct(known.alias("value"), c("_least").alias("low"), c("_most").alias("high"), (rank - begin).alias("skip"))
        return F.max(F.when((rank >= begin) & (rank < end), found))

    found = ranked.groupBy("_key", "_name", "_p", "n").agg(
        at(F.floor(position)).alias("_lower"), at(F.ceil(position)).alias("_upper")
    )
    ends = F.array(*(F.struct(F.lit(e).alias("_end"), c(e).alias("_x")) for e in ("_lower", "_upper")))
    missed = found.select("_key", "_name", F.inline(ends)).select("_key", "_name", "_end", "_x.*")
    missed = missed.filter("value IS NULL").drop("value")
    keyed = rows.select(F.explode(F.array(*(key for key, _ in groups))).alias("_key"), "_v")
    # At most two rows per key and quantile.
    keyed = keyed.join(F.broadcast(missed) if few_keys else missed, "_key").filter("_v BETWEEN low AND high")
    tally = keyed.groupBy("_key", "_name", "_end", "skip", "_v").agg(F.count(F.lit(1)).alias("_count"))
    rising = Window.partitionBy("_key", "_name", "_end").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    tally = tally.withColumn("_upto", F.sum("_count").over(rising))
    again = tally.groupBy("_key", "_name").agg(
        *(
            F.min(F.when((c("_end") == e) & (c("_upto") > c("skip")), c("_v"))).alias(f"{e}_again")
            for e in ("_lower", "_upper")
        )
    )
    found = found.join(again, ["_key", "_name"], "left")
    low, high = (F.coalesce(c(f"{e}.value"), c(f"{e}_again")) for e in ("_lower", "_upper"))
    valued = low + (high - low) * (position - F.floor(position))
    wide = [F.max(F.when(c("_name") == name, valued)).alias(name) for name in probs]
    return found.groupBy("_key", "n").agg(*wide)


def exact_quantiles(
    rows: DataFrame,
    keys: list[str],
    value: str,
    probs: dict[str, float],
    spread_by: list[str],
    size: int = SKETCH,
    few_keys: bool = False,
) -> DataFrame:
    """Linearly interpolated quantiles per key, one column per entry of ``probs``,
    and ``n``, the number of values; null and NaN are no values.

    The built-in exact percentile keeps all distinct values of a group in one
    task. Here a mergeable sketch of ``size`` tells between which values a quantile
    lies; a second pass counts what lies below and above and sorts only what lies
    between, about ``5 n / size`` values (see :func:`select_quantiles`).

    ``spread_by`` names columns that split the rows of one key over tasks.
    ``few_keys`` is for callers that know the keys to be a fixed, short list: what is
    known of them is then broadcast."""
    number = F.col(value).cast("double")
    rows = rows.filter(number.isNotNull() & ~F.isnan(number)).select(*keys, *spread_by, number.alias("_v"))
    limits = rows.groupBy(*keys).agg(thresholds(sketch_of(F.col("_v"), size), probs, size).alias("_limits"))
    if keys and few_keys:
        marked = rows.join(F.broadcast(limits), keys)
    elif keys:
        marked = spread_lookup(rows, limits, keys, spread_by, how="inner")
    else:
        some = rows.agg(F.when(F.count("_v") > 0, sketch_of(F.col("_v"), size)).alias("_s"))
        limits = some.select(F.when(F.col("_s").isNotNull(), thresholds(F.col("_s"), probs, size)).alias("_limits"))
        marked = rows.withColumn("_limits", limits.scalar())
    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("_all"))
    found = select_quantiles(marked, keys, [(key, F.col("_limits"))], probs, few_keys or not keys)
    return found.select(*(F.col("_key")[k].alias(k) for k in keys), "n", *probs)
