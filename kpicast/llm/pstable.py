"""Nearest neighbours by multiprobe p-stable hashing.

A table has ``HASHES`` functions floor((a.v + b) / width) with normal a. Besides its own
bucket a query visits the buckets that differ by one step in some functions, in the
order of the estimated chance to hold a neighbour: the sum of squared distances to the
boundaries crossed. Candidates of all tables are merged and ranked by exact distance.

The index is dealt by id: a shard keeps the tables of its own rows, so no bucket, however
full, makes a large task. Queries go to the shards in blocks and the best of each shard
are merged.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from kpicast.llm.common import mix
from kpicast.llm.vectors import of_common_length, sample
from kpicast.session import written

TABLES, HASHES, PROBES = 10, 8, 120
WIDTH = 2.0  # times the spread of the vectors
MAX_SAMPLE = 4096
SHARD_ROWS, BLOCK_QUERIES = 16_384, 1024


@dataclass
class Tables:
    centre: np.ndarray
    direction: np.ndarray  # dimension x (tables * hashes)
    shift: np.ndarray
    width: float
    tables: int
    hashes: int
    probes: int

    def places(self, vectors: np.ndarray) -> np.ndarray:
        """Place of every vector along every function, in steps."""
        out = (vectors - self.centre) @ self.direction / self.width + self.shift
        return out.reshape(len(vectors), self.tables, self.hashes)

    def keys(self, steps: np.ndarray) -> np.ndarray:
        """One number per bucket (last axis: the functions)."""
        key = np.zeros(steps.shape[:-1], np.uint64)
        for j in range(steps.shape[-1]):
            key = mix(key + steps[..., j].astype(np.int64).view(np.uint64) + np.uint64(j + 1))
        return key.view(np.int64)

    def probe_keys(self, vector: np.ndarray) -> np.ndarray:
        """(tables, probes) buckets of a query, likeliest first."""
        place = self.places(vector[None])[0]
        base = np.floor(place).astype(np.int64)
        steps = [base[t] + perturbations(place[t] - base[t], self.probes) for t in range(self.tables)]
        return self.keys(np.stack(steps))


def perturbations(inside: np.ndarray, most: int) -> np.ndarray:
    """(most, functions) steps of -1, 0, 1 in order of the squared distances to the
    boundaries they cross. Sets of boundaries, sorted by distance, are enumerated from
    a heap: a set leads to the one whose last member is the next boundary, and to the
    one that has that as well."""
    n = len(inside)
    cost = np.concatenate([inside, 1 - inside]) ** 2
    order = np.argsort(cost, kind="stable")
    sorted_cost = cost[order].tolist()
    out, heap = [np.zeros(n, np.int64)], [(sorted_cost[0], (0,))]
    while heap and len(out) < most:
        total, chosen = heapq.heappop(heap)
        functions = [int(order[k]) % n for k in chosen]
        if len(set(functions)) == len(functions):  # not both ways along one function
            step = np.zeros(n, np.int64)
            for k in chosen:
                step[order[k] % n] = -1 if order[k] < n else 1
            out.append(step)
        last = chosen[-1]
        if last + 1 < 2 * n:
            moved = total - sorted_cost[last] + sorted_cost[last + 1]
            heapq.heappush(heap, (moved, (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (total + sorted_cost[last + 1], (*chosen, last + 1)))
    while len(out) < most:
        out.append(out[0])
    return np.stack(out)


def fit(rows: DataFrame, tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES,
        width: float = WIDTH, max_sample: int = MAX_SAMPLE, seed: int = 5) -> Tables | None:
    """Centre and spread come from at most ``max_sample`` vectors of the most common
    length; None without any."""
    some = sample(of_common_length(rows), max_sample)
    if not len(some):
        return None
    rng = np.random.default_rng(seed)
    centre = some.mean(0)
    spread = math.sqrt(float(((some - centre) ** 2).sum(1).mean())) or 1.0
    direction = rng.standard_normal((some.shape[1], tables * hashes))
    return Tables(centre, direction, rng.uniform(0, 1, tables * hashes), width * spread, tables, hashes, probes)


def _nearest(ids: np.ndarray, distance: np.ndarray, k: int) -> np.ndarray:
    if len(ids) > k:
        # Ties at the k-th distance all stay until ids decide.
        kept = np.flatnonzero(distance <= np.partition(distance, k - 1)[k - 1])
    else:
        kept = np.arange(len(ids))
    return kept[np.lexsort((ids[kept], distance[kept]))][:k]


def _search(rows: pd.DataFrame, queries: pd.DataFrame, index: Tables | None, k: int) -> pd.DataFrame:
    out = []
    if len(rows) and len(queries):
        ids = rows["vec_id"].to_numpy(np.int64)
        vectors = np.stack(rows["vec"].to_list()).astype(float)
        if index is not None:
            keys = index.keys(np.floor(index.places(vectors)).astype(np.int64))
            order = np.argsort(keys, axis=0, kind="stable")
            sorted_keys = np.take_along_axis(keys, order, 0)
        for query, vector, probes in zip(queries["vec_id"], queries["vec"], queries["keys"]):
            if index is None:
                found = np.flatnonzero(ids != query)
            else:
                hit = np.zeros(len(ids), bool)
                for t, wanted in enumerate(np.asarray(probes, np.int64).reshape(index.tables, -1)):
                    low = np.searchsorted(sorted_keys[:, t], wanted, "left")
                    high = np.searchsorted(sorted_keys[:, t], wanted, "right")
                    for a, b in zip(low[high > low].tolist(), high[high > low].tolist()):
                        hit[order[a:b, t]] = True
                hit[ids == query] = False
                found = np.flatnonzero(hit)
            distance = np.sqrt(((vectors[found] - np.asarray(vector, float)) ** 2).sum(1))
            best = _nearest(ids[found], distance, k)
            out.append(pd.DataFrame({"query_id": query, "vec_id": ids[found][best], "score": distance[best]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def _fan_out(rows: DataFrame, queries: DataFrame, index: Tables | None, k: int,
             shard_rows: int, block_queries: int) -> DataFrame:
    """Best of every (shard, block), merged."""
    shards = max(1, -(-rows.count() // shard_rows))
    blocks = max(1, -(-queries.count() // block_queries))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")).withColumn("block", every(blocks))
    right = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn("shard", every(shards))
    found = (
        left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block"))
        .applyInPandas(lambda a, b: _search(a, b, index, k), "query_id long, vec_id long, score double")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(rows: DataFrame, queries: DataFrame, index: Tables | None, k: int = 10,
           shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance) of the ``k`` nearest found in
    ``rows`` (vec_id, vec) to ``queries`` (vec_id, vec), ties to the smaller id.

    A row of the query's own id is no candidate. Vectors of a length other than the
    index was fitted on take no part, neither as rows nor as queries. A query whose buckets hold fewer than
    ``k`` candidates is compared with all rows, so it has fewer only if the table has.
    """

    if index is not None:
        rows, queries = (df.filter(F.size("vec") == len(index.centre)) for df in (rows, queries))

    def probed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            keys = [index.probe_keys(np.asarray(v, float)).ravel() if index else np.zeros(0, np.int64) for v in part["vec"]]
            yield pd.DataFrame({"vec_id": part["vec_id"], "vec": part["vec"], "keys": keys})

    asked = queries.mapInPandas(probed, "vec_id long, vec array<double>, keys array<long>")
    best = _fan_out(rows, asked, index, k, shard_rows, block_queries)
    if index is None:
        return best
    best = written(best, "nearest")
    full = best.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"))
    short = written(asked.join(full, "vec_id", "left_anti"), "short")
    if short.isEmpty():
        return best
    rest = _fan_out(rows, short, None, k, shard_rows, block_queries)
    return best.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(rest)
