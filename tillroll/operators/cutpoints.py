"""Exact cut points of several orderings at once, for quintile scores.

The rows at the wanted ranks of all orderings — (value, key) for rank quintiles,
value alone for value-edge quintiles — come from :mod:`tillroll.operators.selection`:
two actions, nothing sorted or written, the same plan at any size. They become
literals of one projection over the table, so no row of the wide table moves.

For n rows with unique ranks, bucket k of 5 of rank r is
``1 + #{j in 1..4: r > floor(j (n-1) / 5) + 1}``: the rows at those four ranks
are the cuts, and a row is past a cut when (value, key) is greater.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators import binning
from tillroll.operators.selection import Ordering, order_statistics

Q = 5


@dataclass
class Score:
    """One quintile score to add: ``kind`` "rank" (quintile of the unique rank of
    (value, key)) or "value" (value-edge quintile); label k-1 is bucket k's."""

    kind: str
    value: str
    key: str
    out: str
    labels: list[int]


def _ranks(score: Score, n: int) -> set[int]:
    """0-based ranks of the rows that the score's cuts or edges are read from."""
    if score.kind == "rank":
        return {k * (n - 1) // Q for k in range(1, Q)}
    return {f(float(n - 1) * p) for p in binning.quantile_probs(Q) for f in (math.floor, math.ceil)}


def _ordering(score: Score) -> Ordering:
    ends = (0.0, 1.0) if score.kind == "value" else ()
    near = tuple(sorted({*ends, *binning.quantile_probs(Q)[1:-1]}))
    return Ordering(score.value, score.key if score.kind == "rank" else None, lambda n: _ranks(score, n) if n > 1 else set(), near)


def _bucket(score: Score, n: int, rows: dict[int, tuple[Any, Any]], dtype: str, on_duplicate_edges: str) -> Column:
    v, key = F.col(score.value), F.col(score.key)
    if n <= 1:
        raise ValueError(f"cannot bin {score.out}: fewer than two rows")
    if score.kind == "rank":
        bucket = F.lit(1)
        for k in range(1, Q):
            cut, cut_key = rows[k * (n - 1) // Q]
            cut = F.lit(cut).cast(dtype)
            past = (v > cut) | ((v == cut) & (key > F.lit(cut_key)))
            bucket = bucket + F.when(past, 1).otherwise(0)
        return bucket
    edges = []
    for p in binning.quantile_probs(Q):
        place = float(n - 1) * p
        lo, hi = float(rows[math.floor(place)][0]), float(rows[math.ceil(place)][0])
        edges.append(lo + (place - math.floor(place)) * (hi - lo))
    if on_duplicate_edges == binning.RAISE and len(set(edges)) < len(edges):
        raise ValueError(f"bin edges of {score.value} are not unique; use on_duplicate_edges='collapse'")
    return binning.bin_by_edges(v, F.array(*(F.lit(e) for e in edges)), Q, binning.COLLAPSE, what=score.value)


def add_scores(df: DataFrame, scores: Sequence[Score], on_duplicate_edges: str = binning.RAISE) -> DataFrame:
    """Every score column in one projection over ``df`` (read twice for the cut
    points and once by the result; give a written table)."""
    if on_duplicate_edges not in (binning.RAISE, binning.COLLAPSE):
        raise ValueError(f"unknown duplicate-edge policy {on_duplicate_edges!r}")
    types = dict(df.dtypes)
    found = order_statistics(df, [_ordering(s) for s in scores])
    outs = [
        binning.label(_bucket(s, n, rows, types[s.value], on_duplicate_edges), s.labels).alias(s.out)
        for s, (n, rows) in zip(scores, found)
    ]
    return df.select("*", *outs)
