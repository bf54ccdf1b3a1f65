"""Peer benchmarks for ads with too little history."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import add, label_case
from ..names import ENTITY
from .. import session
from .joins import measured_lookup, spread_lookup

LEVELS = ["adset", "campaign", "account"]
INSUFFICIENT = "insufficient_history"


def peer_totals(frame: DataFrame, values: dict[str, str], within: list[str]) -> DataFrame:
    """Sum and count of the positive values per adset, with those of its campaign
    and account beside them, and ``n``, its rows: one row per adset.

    Each level is summed from the level below it, so an account that holds a
    third of all ads is never gathered in one place."""
    keys = [*within, *ENTITY[:3]]
    parts = {}
    for name, column in values.items():
        parts[f"{name}_adset_sum"] = f"sum(CASE WHEN {column} > 0 THEN {column} ELSE 0D END)"
        parts[f"{name}_adset_n"] = f"count_if({column} > 0)"
    parts["n"] = "count(*)"
    adsets = frame.groupBy(*keys).agg(*[F.expr(sql).alias(n) for n, sql in parts.items()])
    campaigns = _sum_up(adsets, [*within, *ENTITY[:2]], values, "adset", "campaign")
    accounts = _sum_up(campaigns, [*within, ENTITY[0]], values, "campaign", "account")
    campaigns = spread_lookup(campaigns, accounts, [*within, ENTITY[0]], ["campaign_id"])
    return spread_lookup(adsets, campaigns, [*within, *ENTITY[:2]], ["adset_id"])


def _sum_up(rows: DataFrame, keys: list[str], values, lower: str, upper: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        *[
            F.expr(f"sum({name}_{lower}_{part})").alias(f"{name}_{upper}_{part}")
            for name in values
            for part in ("sum", "n")
        ]
    )


def peer_means(
    frame: DataFrame,
    values: dict[str, str],
    min_peers: int = 2,
    within: list[str] | None = None,
) -> DataFrame:
    """Mean of the other ads' positive values in the same adset, campaign and
    account, as ``<name>_<level>_peer``; null with fewer than ``min_peers``
    others. ``within`` adds keys the peers must share, such as the day.

    The frame is written once, as its features are read for the totals and again for the
    means; how many rows an adset has is known from the totals, so only adsets that hold
    more than their share are spread over tasks."""
    within, on = within or [], [*(within or []), *ENTITY[:3]]
    frame = session.written(frame, "features")
    totals = session.written(peer_totals(frame, values, within), "peer-totals")
    joined = measured_lookup(frame, totals.drop("n"), totals.select(*on, "n"), on, ["ad_id"])
    means, used = {}, []
    for name, column in values.items():
        own = f"CASE WHEN {column} > 0 THEN {column} ELSE 0D END"
        for level in LEVELS:
            others = f"({name}_{level}_n - CASE WHEN {column} > 0 THEN 1 ELSE 0 END)"
            rest = f"greatest({name}_{level}_sum - {own}, 0D)"
            means[f"{name}_{level}_peer"] = (
                f"CASE WHEN {others} >= {min_peers} THEN {rest} / {others} END"
            )
            used += [f"{name}_{level}_sum", f"{name}_{level}_n"]
    return add(joined, means).drop(*used)


def fallback_value(name: str) -> str:
    """First level that has enough peers, else 0."""
    return f"coalesce({', '.join(f'{name}_{level}_peer' for level in LEVELS)}, 0D)"


def fallback_source(name: str) -> str:
    return label_case(
        [
            (f"{name}_{level}_peer IS NOT NULL", f"{level}_same_window_benchmark")
            for level in LEVELS
        ],
        INSUFFICIENT,
    )


def choose_hierarchical(
    frame: DataFrame,
    prediction: str,
    history: str,
    needs_fallback: str,
    out: str,
    min_peers: int = 2,
    within: list[str] | None = None,
) -> DataFrame:
    """``prediction`` where history suffices, else the peer benchmark of
    ``history``; ``<out>_source`` names the benchmark level that would serve."""
    peers = peer_means(frame, {out: history}, min_peers, within)
    chosen = (
        f"CASE WHEN {needs_fallback} THEN {fallback_value(out)} "
        f"ELSE coalesce({prediction}, 0D) END"
    )
    return add(peers, {f"{out}_source": fallback_source(out), out: chosen}).drop(
        *[f"{out}_{level}_peer" for level in LEVELS]
    )
