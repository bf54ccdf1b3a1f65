"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

A rotation of the principal axes is learned so that the signs of the rotated vectors
lose little: signs and rotation are fitted in turns. The code of a vector is cut into
``TABLES`` substrings and each is a table. By the pigeonhole rule vectors that differ in
fewer bits than there are tables share a bucket in one of them, and most that differ in
a few more do. Where pairs at the edge differ in many bits (vectors around a common
mean), the bits are cut in further orders, each with tables of its own, until sampled
pairs at the edge share a bucket as often as asked for. Inside a bucket whole codes are compared by Hamming distance; what lies
within the radius is reranked by exact cosine of the original vectors. The radius is the
largest distance seen among sampled pairs made to lie exactly at the cosine asked for.

Full buckets are cut into blocks and pairs of blocks, each the work of one task, so a
label or a group of copies that holds a third of all rows is spread. Tasks return
counts and spanning links of what they find, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from kpicast.llm.common import n_shards
from kpicast.llm.components import components
from kpicast.llm.vectors import sample, usable
from kpicast.session import written

LEAST = 0.93
BITS, TABLES, ROUNDS = 64, 8, 50
MAX_SAMPLE = 8192
BLOCK = 1024
SHARD_ROWS = 16_384
# Share of sampled pairs at the edge that have to meet, and cuts tried for it.
RECALL, MAX_CUTS = 0.97, 6


@dataclass
class Codes:
    centre: np.ndarray
    turn: np.ndarray  # dimension x bits: principal axes and rotation
    orders: tuple[np.ndarray, ...] = ()  # of the bits in further cuts

    def bits(self, vectors: np.ndarray) -> np.ndarray:
        return (vectors - self.centre) @ self.turn > 0

    def substrings(self, vectors: np.ndarray, tables: int = TABLES) -> np.ndarray:
        """(rows, tables of all cuts) numbers of at most 8 bits for 64 bits and 8 tables."""
        bits = self.bits(vectors)
        cuts = [bits, *(bits[:, order] for order in self.orders)]
        parts = [p for cut in cuts for p in np.array_split(cut, tables, axis=1)]
        return np.stack([p @ (1 << np.arange(p.shape[1])) for p in parts], 1).astype(np.int64)


def learn(vectors: np.ndarray, bits: int = BITS, rounds: int = ROUNDS, seed: int = 6) -> Codes:
    """Iterative quantisation on a matrix of vectors."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    centre = unit.mean(0)
    width = min(bits, unit.shape[1])
    _, axes = np.linalg.eigh(np.cov((unit - centre).T, bias=True).reshape(unit.shape[1], -1))
    axes = axes[:, ::-1][:, :width]
    low = (unit - centre) @ axes
    turn = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, width)))[0]
    for _ in range(rounds):
        signs = np.where(low @ turn > 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(signs.T @ low)
        turn = v.T @ u.T
    return Codes(centre, axes @ turn)


def packed(substrings: np.ndarray) -> np.ndarray:
    """One 64-bit number per row of 8-bit substrings."""
    shifts = np.uint64(8) * np.arange(substrings.shape[1], dtype=np.uint64)
    return np.bitwise_or.reduce(substrings.astype(np.uint64) << shifts, axis=1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of all packed codes of ``a`` to all of ``b``."""
    return np.bitwise_count(a[:, None] ^ b[None, :])


def edge_pairs(vectors: np.ndarray, least: float, seed: int = 6) -> list[tuple[np.ndarray, np.ndarray]]:
    """Unit vectors and the same turned away to cosine ``least``: towards another vector,
    the way the data spread, and in any direction."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    draw = np.random.default_rng(seed)
    out = []
    for towards in (unit[draw.permutation(len(unit))], draw.standard_normal(unit.shape)):
        aside = towards - (towards * unit).sum(1, keepdims=True) * unit
        length = np.linalg.norm(aside, axis=1, keepdims=True)
        apart = length[:, 0] > 1e-9
        if apart.any():
            turned = least * unit[apart] + np.sqrt(1 - least**2) * aside[apart] / length[apart]
            out.append((unit[apart], turned))
    return out


def fit_tables(
    codes: Codes, vectors: np.ndarray, least: float, recall: float = RECALL, most: int = MAX_CUTS, seed: int = 6
) -> tuple[Codes, int]:
    """``codes`` with as many cuts as pairs at the edge need, and the radius that holds
    all of them."""
    pairs = edge_pairs(vectors, least)
    draw = np.random.default_rng(seed)

    def met() -> float:
        shares = [(codes.substrings(a) == codes.substrings(b)).any(1).mean() for a, b in pairs]
        return min(shares, default=1.0)

    while len(codes.orders) + 1 < most and met() < recall:
        codes = replace(codes, orders=(*codes.orders, draw.permutation(codes.turn.shape[1])))
    apart = [int((codes.bits(a) != codes.bits(b)).sum(1).max()) for a, b in pairs]
    return codes, max(apart, default=0)


def _spanning(n: int, pairs: tuple[np.ndarray, np.ndarray]) -> list[tuple[int, int]]:
    """Links that join what ``pairs`` of places join: one per place at most."""
    root = np.arange(n)
    while True:
        least = root.copy()
        np.minimum.at(least, pairs[0], root[pairs[1]])
        np.minimum.at(least, pairs[1], root[pairs[0]])
        least = least[least]
        if (least == root).all():
            moved = np.flatnonzero(root != np.arange(n))
            return list(zip(moved.tolist(), root[moved].tolist()))
        root = least


def _compare(group: pd.DataFrame, least: float, radius: int) -> pd.DataFrame:
    """Rows (vec_id, n_links, other): counts of new links by vector, and spanning links
    with n_links 0. A pair counts in the first table in which it shares a bucket."""
    ids = group["vec_id"].to_numpy(np.int64)
    unit = np.stack(group["vec"].to_list()).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    codes = np.stack(group["codes"].to_list()).astype(np.int64)
    whole = packed(codes[:, :TABLES])
    block = group["own"].to_numpy()
    counts = np.zeros(len(ids), np.int64)
    links: set[tuple[int, int]] = set()
    cells = group.groupby(["label", "part", "value", "i", "j"], sort=False).indices
    for (_, table, _, i, j), at in cells.items():
        if i == j:
            a = b = at
        else:
            a, b = at[block[at] == i], at[block[at] == j]
        if not len(a) or not len(b):
            continue
        close = distances(whole[a], whole[b]) <= radius
        if i == j:
            close = np.triu(close, 1)
        # Only rows and columns with a candidate are reranked.
        rows, columns = close.any(1), close.any(0)
        a, b, close = a[rows], b[columns], close[rows][:, columns]
        x, y = np.nonzero(close & (unit[a] @ unit[b].T >= least))
        if not len(x):
            continue
        x, y = a[x], b[y]
        new = ~(codes[x, :table] == codes[y, :table]).any(1)
        x, y = x[new], y[new]
        np.add.at(counts, x, 1)
        np.add.at(counts, y, 1)
        local, places = np.unique(np.concatenate([x, y]), return_inverse=True)
        for p, q in _spanning(len(local), (places[: len(x)], places[len(x) :])):
            links.add((int(ids[local[p]]), int(ids[local[q]])))
    linked = np.flatnonzero(counts)
    return pd.DataFrame({
        "vec_id": np.concatenate([ids[linked], np.array([p for p, _ in links], np.int64)]),
        "n_links": np.concatenate([counts[linked], np.zeros(len(links), np.int64)]),
        "other": np.concatenate([ids[linked], np.array([q for _, q in links], np.int64)]),
    })


def links(rows: DataFrame, least: float = LEAST, max_sample: int = MAX_SAMPLE) -> DataFrame | None:
    """(vec_id, n_links, other) as tasks find them, for rows (vec_id, label, vec); None
    for an empty table. Counts add up by vec_id; vec_id and other are linked."""
    fitted = sample(rows, max_sample)
    if not len(fitted):
        return None
    codes, radius = fit_tables(learn(fitted), fitted, least)
    tables = TABLES * (1 + len(codes.orders))

    def coded(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if len(part):
                unit = np.stack(part["vec"].to_list()).astype(float)
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                yield part.assign(codes=list(codes.substrings(unit)))

    schema = f"vec_id long, label {rows.schema['label'].dataType.simpleString()}, vec array<double>, codes array<long>"
    found = written(rows.select("vec_id", "label", "vec").mapInPandas(coded, schema), "codes")
    placed = found.select("vec_id", "label", "vec", "codes", F.posexplode("codes").alias("part", "value"))
    bucket = ["label", "part", "value"]
    sizes = placed.groupBy(*bucket).count().withColumn("blocks", F.ceil(F.col("count") / BLOCK).cast("int")).drop("count")
    own = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")
    paired = (
        placed.join(sizes, bucket).withColumn("own", own)
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("own", "with")).withColumn("j", F.greatest("own", "with"))
    )
    shards = n_shards(rows.sparkSession, tables * found.count(), SHARD_ROWS)
    shard = F.pmod(F.xxhash64(*bucket, "i", "j"), F.lit(shards)).cast("int")
    dealt = paired.withColumn("shard", shard).select("shard", "vec_id", "vec", "codes", *bucket, "own", "i", "j")
    return dealt.groupBy("shard").applyInPandas(
        lambda group: _compare(group, least, radius), "vec_id long, n_links long, other long"
    )


def near_duplicates(rows: DataFrame, least: float = LEAST) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``rows`` (vec_id, label,
    embedding).

    Only vectors of one label are compared. Vectors that are null, zero or hold null or
    non-finite components, and those without label, link with nothing. Rows that repeat
    an id are one vector (the smallest row) and share its result; a null id stands
    alone. Vectors of a dimension other than the most common one link with nothing.
    """
    keyed = rows.select("vec_id", "label", "embedding")
    good = usable(keyed.filter("label IS NOT NULL"), ["vec_id", "label"])
    size = good.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    none = keyed.select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
        F.lit(True).alias("kept"),
    )
    if size is None:
        return none
    found = links(good.filter(F.size("vec") == size["n"]), least)
    found = written(found, "links")
    counts = found.filter("n_links > 0").groupBy("vec_id").agg(F.sum("n_links").alias("n_links"))
    groups = components(found.filter("vec_id <> other").selectExpr("vec_id AS a", "other AS b"))
    component = F.coalesce("component", "vec_id")
    return (
        keyed.select("vec_id").join(counts, "vec_id", "left")
        .join(groups.withColumnRenamed("id", "vec_id"), "vec_id", "left")
        .select(
            "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
            F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
        )
    )
