"""Exact, linearly interpolated quantiles (the 'linear' rule: position
(n - 1) * p, interpolate between the neighbouring order statistics).

A column is first reduced to a (value, count) table; the order statistics are
read off a distributed running count, overall or per group. (The cut
points of quintile scores come from :mod:`tillroll.operators.cutpoints`.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators import ranking
from tillroll.session import materialize


def value_counts_table(df: DataFrame, value: str, by: str | None = None) -> DataFrame:
    """([by,] _v, _w): distinct non-null values as doubles with their row counts,
    written once. Map-side combined: a value of most rows is one row a map task."""
    keys = [by] if by else []
    x = F.col(value).cast("double")
    return materialize(
        df.where(x.isNotNull()).groupBy(*keys, x.alias("_v")).agg(F.count(F.lit(1)).alias("_w")), "value_counts"
    )


def edges_of_counts(counts: DataFrame, probs: Sequence[float], by: str | None = None) -> DataFrame:
    """One row (per ``by`` group) with the quantiles as ``edges`` and the row count
    ``n``, from a :func:`value_counts_table`.

    A running count over the sorted values (distributed, restarting per group)
    locates the order statistics at positions floor/ceil((n-1)p); the
    interpolation is lo + frac * (hi - lo)."""
    keys = [by] if by else []
    cum = ranking.global_running_sum(counts, ["_v"], "_w", "_cum", "_n", by=keys)
    start = F.col("_cum") - F.col("_w")  # 0-based index of the value's first copy
    pos = [(F.col("_n") - 1).cast("double") * F.lit(float(p)) for p in probs]
    lo = [F.floor(p) for p in pos]
    hi = [F.ceil(p) for p in pos]

    def holds(i):
        return (start <= i) & (i < F.col("_cum"))

    wanted = F.lit(False)
    aggs: list[Column] = [F.max("_n").alias("n")]
    for i, (a, b) in enumerate(zip(lo, hi, strict=True)):
        wanted = wanted | holds(a) | holds(b)
        aggs += [
            F.max(F.when(holds(a), F.col("_v"))).alias(f"_lo{i}"),
            F.max(F.when(holds(b), F.col("_v"))).alias(f"_hi{i}"),
            F.max(pos[i] - F.floor(pos[i])).alias(f"_fr{i}"),
        ]
    row = cum.where(wanted).groupBy(*keys).agg(*aggs)
    edges = [
        F.col(f"_lo{i}") + F.col(f"_fr{i}") * (F.col(f"_hi{i}") - F.col(f"_lo{i}")) for i in range(len(probs))
    ]
    return row.select(*keys, "n", F.array(*edges).alias("edges"))


def value_count_edges(df: DataFrame, value: str, probs: Sequence[float], by: str | None = None) -> DataFrame:
    """Exact linear quantiles of a column with any number of distinct values,
    overall or per ``by`` group: one row (per group) with ``edges``."""
    return edges_of_counts(value_counts_table(df, value, by), probs, by).drop("n")
