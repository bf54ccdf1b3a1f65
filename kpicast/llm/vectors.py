"""Helpers for tables of vectors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F


def usable(rows: DataFrame, keys: list[str], vector: str = "embedding") -> DataFrame:
    """One row (keys, vec) per vec_id with a usable vector: not null or zero, all
    components finite. A repeated id keeps its smallest row. Vectors become doubles."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    vec = F.col(f"`{vector}`").cast("array<double>")
    picked = rows.select(*keys, vec.alias("vec")).filter("vec_id IS NOT NULL")
    good = F.forall("vec", finite) & F.exists("vec", lambda x: x != 0)
    picked = picked.filter(F.coalesce(good, F.lit(False)))
    others = [k for k in keys if k != "vec_id"]
    best = picked.groupBy("vec_id").agg(F.min(F.struct(*others, "vec")).alias("r"))
    return best.select("vec_id", *(F.col(f"r.{k}") for k in others), F.col("r.vec").alias("vec"))


def of_common_length(rows: DataFrame) -> DataFrame:
    """``rows`` (vec) of the most common length, the shorter of two that are as common."""
    size = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows if size is None else rows.filter(F.size("vec") == size["n"])


def sample(rows: DataFrame, most: int) -> np.ndarray:
    """Vectors of the ``most`` rows that come first in hash order."""
    first = rows.select("vec_id", "vec").orderBy(F.xxhash64("vec_id"), "vec_id").limit(most)
    found = first.select("vec").toPandas()["vec"]
    return np.stack(found.to_list()).astype(float) if len(found) else np.zeros((0, 0))
