"""Exact distinct counts of several columns without expanding the rows.

A single aggregate with several distinct counts emits every row once for each of
them. Here each column is reduced on its own — a columnar scan reads only that
column — and the one-row counts are put side by side.

* Values of any type: a grouping whose rows are the distinct values of a map task,
  so a value of most rows is one row a task.
* Whole numbers of at most 32 bits: bitmaps of 32,768 ids, merged by OR
  (``bitmap_construct_agg``): 4 KB a bucket of ids instead of a row for each id.
  The type bounds the buckets (131,073) whatever the number of rows.

Whole rows are told apart by a digest of 128 bits: the exchange carries digests, not
rows. Only rows whose digest occurs more than once are compared themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tillroll.operators.scalars import attach_one_row
from tillroll.session import materialize

_SMALL = ("tinyint", "smallint", "int")


def distinct_count(df: DataFrame, column: str, out: str) -> DataFrame:
    """One row: the number of distinct non-null values of ``column`` as ``out``."""
    held = df.where(F.col(column).isNotNull())
    if dict(df.dtypes)[column] not in _SMALL:
        return held.groupBy(column).agg(F.lit(1)).agg(F.count(F.lit(1)).alias(out))
    x = F.col(column).cast("bigint")
    maps = held.groupBy(F.bitmap_bucket_number(x).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(x)).alias("ids"))
    return maps.agg(F.coalesce(F.sum(F.bitmap_count("ids")), F.lit(0)).cast("long").alias(out))


def side_by_side(first: DataFrame, *others: DataFrame) -> DataFrame:
    """One-row frames as one row."""
    for other in others:
        first = attach_one_row(first, other)
    return first


def row_digests(columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of a row that tell NULLs by their place."""
    cells = [c for name in columns for c in (F.col(f"`{name}`").isNull(), F.col(f"`{name}`"))]
    return [F.xxhash64(F.lit(seed), *cells) for seed in (11, 29)]


def distinct_row_counts(df: DataFrame, counts: dict[str, Column] | None = None, digests: Sequence[Column] | None = None) -> DataFrame:
    """One row: ``rows`` (all of them), ``distinct_rows``, and for each of ``counts``
    (conditions on a row, never NULL) the distinct rows that meet it.

    Rows of a digest (and conditions) that occurs once are counted as the repeated ones
    are written; those few are joined back, grouped by all their columns and so
    compared exactly, whatever the digests. An empty frame counts zeros."""
    counts = counts or {}
    digest = ["_digest1", "_digest2"]
    tags = [f"_is{i}" for i in range(len(counts))]
    keys = [c.alias(n) for c, n in zip([*(digests or row_digests(df.columns)), *counts.values()], [*digest, *tags])]
    groups = df.select(*keys).groupBy(*digest, *tags).agg(F.count(F.lit(1)).alias("_rows"))
    once = F.col("_rows") == 1
    seen = Observation()
    watched = groups.observe(seen, F.count_if(once).alias("once"), *(F.count_if(once & F.col(t)).alias(t) for t in tags))
    repeated = materialize(watched.where(F.col("_rows") > 1).select(*digest, *tags), "repeated_rows", observe={})
    found = seen.get  # nothing where a plan without rows was cut off above the observation
    single = [F.lit(int(found.get(n) or 0)).cast("long") for n in ("once", *tags)]
    names = ["rows", "distinct_rows", *counts]
    if not repeated._observed["rows"]:
        return df.sparkSession.range(1).select(*(c.alias(n) for c, n in zip([single[0], *single], names)))
    again = df.select("*", *keys).join(repeated, [*digest, *tags], "left_semi")
    exact = again.groupBy(*(F.col(f"`{c}`") for c in df.columns), *tags).agg(F.count(F.lit(1)).alias("_rows"))
    more = exact.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("_all"), F.count(F.lit(1)).alias("_some"), *(F.count_if(F.col(t)).alias(t) for t in tags)
    )
    values = [F.col(c) + s for c, s in zip(["_all", "_some", *tags], [single[0], *single])]
    return more.select(*(v.alias(n) for v, n in zip(values, names)))
