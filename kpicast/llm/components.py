"""Connected components by alternating stars, in joins and sums of edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kpicast.session import written


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id of ``edges`` (a, b); component is the smallest id
    reachable. Each round hangs neighbours on the smallest one they share and is
    written, so chains shrink fast and a lost executor costs one round. Neighbours
    are never gathered: each step is a minimum per id and a join, which adaptive
    execution splits for an id with very many neighbours."""
    now = edges.filter("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct()
    now = written(now, "edges")
    mark = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").selectExpr("b AS a", "m AS b").filter("a <> b")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(least, "a")
        small = hung.selectExpr("b AS a", "m AS b").unionByName(hung.selectExpr("a", "m AS b"))
        now = written(small.filter("a <> b").distinct(), "edges")
        new = _mark(now)
        if new == mark:
            break
        mark = new
    roots = now.select(F.col("b").alias("id")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        roots.select("id", F.col("id").alias("component"))
    )
