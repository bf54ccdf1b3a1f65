"""Hamming codes at the edge of the similarity asked for, against brute force."""

import numpy as np
import pytest

from kpicast.llm import itq


def planted(mean: float, pairs: int = 300, dimension: int = 64, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors around a common mean; row ``pairs + k`` lies at the cosine
    ``edge[k]`` of row k, turned towards another vector."""
    draw = np.random.default_rng(seed)
    base = mean * np.ones(dimension) / np.sqrt(dimension) + draw.standard_normal((pairs, dimension)) / np.sqrt(dimension)
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    other = np.roll(base, 1, axis=0)
    aside = other - (other * base).sum(1, keepdims=True) * base
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    edge = np.repeat([0.9301, 0.94, 0.95], pairs // 3)[:, None]
    return np.concatenate([base, edge * base + np.sqrt(1 - edge**2) * aside]), edge[:, 0]


def brute(x: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Links per vector and the smallest place each reaches."""
    near = x @ x.T >= least
    np.fill_diagonal(near, False)
    root = np.arange(len(x))
    while True:
        low = np.minimum(root, np.where(near, root[None, :], len(x)).min(1))
        if (low == root).all():
            return near.sum(1), root
        root = low


def test_distances_count_bits():
    draw = np.random.default_rng(1)
    parts = draw.integers(0, 256, (20, 8))
    bits = np.unpackbits(parts.astype(np.uint8), axis=1)
    want = (bits[:, None, :] != bits[None, :, :]).sum(2)
    codes = itq.packed(parts)
    assert (itq.distances(codes, codes) == want).all()


@pytest.mark.parametrize("mean", [0.0, 1.2])
def test_radius_covers_pairs_at_the_edge(mean):
    x, _ = planted(mean)
    codes, radius = itq.fit_tables(itq.learn(x), x, itq.LEAST)
    assert bool(codes.orders) == (mean > 0)
    n = len(x) // 2
    apart = (codes.bits(x[:n]) != codes.bits(x[n:])).sum(1)
    assert (apart <= radius).mean() > 0.995 and radius < 40


@pytest.mark.parametrize("mean", [0.0, 1.2])
def test_planted_pairs_and_components(spark, mean):
    x, edge = planted(mean)
    n = len(edge)
    rows = spark.createDataFrame([(k, "a", v.tolist()) for k, v in enumerate(x)], "vec_id long, label string, embedding array<double>")
    got = {r["vec_id"]: r for r in itq.near_duplicates(rows).collect()}
    counts, roots = brute(x, itq.LEAST)
    found = np.array([got[k]["n_links"] for k in range(len(x))])
    assert (found <= counts).all()
    for cosine in np.unique(edge):
        at = np.flatnonzero(edge == cosine)
        assert found[n + at].sum() >= 0.9 * counts[n + at].sum()
    whole = np.array([got[k]["component_id"] for k in range(len(x))])
    # A link that is missing leaves a component in parts, it never joins two.
    assert (roots[whole] == roots).all() and (whole == roots).mean() >= 0.9
    assert all(got[k]["kept"] == (whole[k] == k) for k in range(len(x)))
