"""Distributed running sums.

A window without PARTITION BY moves every row into one task. Here the frame is
range-partitioned on the ordering, sorted within partitions, tagged with its
partition and written once to the shared checkpoint folder (so every later read
sees the same rows and tags even if an executor is lost); per-partition sums give
each partition's offset. The same plan serves any size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import materialize


def global_running_sum(
    df: DataFrame,
    order: Sequence[Column | str],
    weight: str,
    cum_col: str = "cum",
    total_col: str = "total",
    by: Sequence[str] = (),
) -> DataFrame:
    """Add ``cum_col`` = running sum of ``weight`` along ``order`` (inclusive,
    unique ordering) restarting for each ``by`` group, and ``total_col`` = the
    group's total.

    Range-partition on (by, order) — a group with many rows spans
    several partitions — tag and write once; per (partition, group) sums give
    each partition's offset inside its group (a window over that small table);
    the running sum inside a partition is a window keyed by (partition, group).
    """
    keys = list(by)
    cols = [F.col(k).asc() for k in keys] + [F.col(o) if isinstance(o, str) else o for o in order]
    tagged = materialize(
        df.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("_pid", F.spark_partition_id()),
        "running",
    )
    sums = tagged.groupBy("_pid", *keys).agg(F.sum(weight).alias("_s"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "_pid",
        *keys,
        F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_off"),
        F.sum("_s").over(Window.partitionBy(*keys)).alias(total_col),
    )
    # one row per (partition, group): bounded by the partition count when there
    # is no grouping key, so broadcast; otherwise let the planner size it
    offsets = F.broadcast(offsets) if not keys else offsets
    local = F.sum(weight).over(
        Window.partitionBy("_pid", *keys).orderBy(*[F.col(o) if isinstance(o, str) else o for o in order]).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        tagged.withColumn("_local", local)
        .join(offsets, ["_pid", *keys])
        .withColumn(cum_col, F.col("_off") + F.col("_local"))
        .drop("_pid", "_off", "_local")
    )
