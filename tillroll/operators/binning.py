"""Quantile binning with the semantics of value-edge quintiles.

* :func:`bin_by_edges` — bins ``(e[k-1], e[k]]`` over edges at the linear
  quantiles 0, 1/q, ..., 1; the first bin includes the minimum; equal values
  always share a bin. This is not ``ntile`` (which splits ties by position).
* duplicate edges: ``on_duplicate_edges="raise"`` (default) fails the query, as
  the original does; ``"collapse"`` lets tied edges share the lowest bin.
* labels: bucket k -> ``labels[k-1]`` (direct, inverted or weights).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RAISE = "raise"
COLLAPSE = "collapse"


def quantile_probs(q: int) -> list[float]:
    return [k / q for k in range(q + 1)]


def bin_by_edges(
    value: Column,
    edges: Column,
    q: int = 5,
    on_duplicate_edges: str = RAISE,
    what: str = "value",
) -> Column:
    """Bucket 1..q of ``value`` against the array column ``edges`` (q + 1 entries)."""
    v = value.cast("double")
    bucket = F.lit(1)
    for k in range(2, q + 1):  # interior edges e[1] .. e[q-1]
        bucket = bucket + F.when(v > F.element_at(edges, k), 1).otherwise(0)
    bucket = F.when(v.isNotNull(), bucket)  # no value, no bin
    if on_duplicate_edges == COLLAPSE:
        return bucket
    if on_duplicate_edges != RAISE:
        raise ValueError(f"unknown duplicate-edge policy {on_duplicate_edges!r}")
    dup = None
    for k in range(1, q + 1):
        d = F.element_at(edges, k) == F.element_at(edges, k + 1)
        dup = d if dup is None else (dup | d)
    return F.when(
        dup,
        F.raise_error(F.lit(f"bin edges of {what} are not unique; use on_duplicate_edges='collapse'")),
    ).otherwise(bucket)


def label(bucket: Column, labels: Sequence[int]) -> Column:
    """Bucket k -> labels[k-1] as an int."""
    return F.element_at(F.array(*[F.lit(int(x)) for x in labels]), bucket).cast("int")


DIRECT = [1, 2, 3, 4, 5]
INVERTED = [5, 4, 3, 2, 1]
