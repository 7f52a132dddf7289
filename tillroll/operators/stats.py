"""Descriptive building blocks: value counts, equal-width histograms, box-plot
summaries, zero-filled pivots, conditional counts, describe, nulls, duplicates.

All are single aggregations (plus at most a one-row broadcast of global
bounds); none collects data to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.money import ratio, round_even, round_to
from tillroll.operators import quantiles
from tillroll.operators.distinct import distinct_row_counts
from tillroll.operators.scalars import attach_one_row
from tillroll.session import materialize, observed


def value_counts(df: DataFrame, key: str, count_col: str = "count", share_col: str | None = None) -> DataFrame:
    """Rows per value, most frequent first (ties by value); optional share of all
    rows (count / total, the total as a one-row broadcast)."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(count_col))
    if share_col:
        total = counts.agg(F.sum(count_col).alias("_total"))
        counts = attach_one_row(counts, total).withColumn(
            share_col, ratio(F.col(count_col), F.col("_total"))
        ).drop("_total")
    return counts.orderBy(F.col(count_col).desc(), F.col(key).asc())


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """ORDER BY ... LIMIT k (planned as a per-partition top-k, then a merge)."""
    return df.orderBy(*order).limit(k)


def histogram(
    df: DataFrame,
    value: str,
    bins: int,
    by: str | None = None,
    lo: float | None = None,
    hi: float | None = None,
    out: str = "count",
) -> DataFrame:
    """Equal-width histogram: ``bins`` bins over [lo, hi] (the data's min and
    max unless given); bin = least(bins-1, floor((x - lo) * bins / (hi - lo))),
    so the maximum falls in the last bin; rows outside [lo, hi] are dropped.
    Output: [by,] bin, bin_start, bin_end, count — non-empty bins only.
    """
    keys = [by] if by else []
    x = F.col(value).cast("double")
    base = df.where(x.isNotNull()).select(*keys, x.alias("_v"))
    if lo is not None and hi is not None:
        low, high = float(lo), float(hi)
        counts = base.where((F.col("_v") >= F.lit(low)) & (F.col("_v") <= F.lit(high))).withColumn("_w", F.lit(1).cast("long"))
    else:
        # the rows are read once, into (value, count); the bounds come with that write
        counts = materialize(
            base.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_w")), "histogram", {"lo": F.min("_v"), "hi": F.max("_v")}
        )
        low, high = observed(counts)["lo"], observed(counts)["hi"]
    bounded = counts.withColumns({"_lo": F.lit(low).cast("double"), "_hi": F.lit(high).cast("double")})
    width = F.col("_hi") - F.col("_lo")
    idx = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.lit(bins - 1), F.floor((F.col("_v") - F.col("_lo")) * F.lit(float(bins)) / width).cast("int"))
    )
    g = bounded.withColumn("bin", idx.cast("int")).groupBy(*keys, "bin", "_lo", "_hi").agg(F.sum("_w").alias(out))
    return g.select(
        *keys,
        "bin",
        (F.col("_lo") + F.col("bin") * width / F.lit(float(bins))).alias("bin_start"),
        (F.col("_lo") + (F.col("bin") + 1) * width / F.lit(float(bins))).alias("bin_end"),
        out,
    )


def box_summary(df: DataFrame, value: str, by: str | None = None) -> DataFrame:
    """Quartiles (linear), IQR, whiskers at the most extreme values inside
    1.5 x IQR of the box, and the number of values outside the whiskers,
    overall or per group. The rows are read once, into a (value, count) table;
    all figures are exact and come from it."""
    keys = [by] if by else []
    counts = quantiles.value_counts_table(df, value, by)
    q = quantiles.edges_of_counts(counts, [0.25, 0.5, 0.75], by).select(
        *keys,
        "n",
        F.col("edges")[0].alias("q1"),
        F.col("edges")[1].alias("median"),
        F.col("edges")[2].alias("q3"),
    ).withColumn("iqr", F.col("q3") - F.col("q1"))
    lo_fence = F.col("q1") - F.lit(1.5) * F.col("iqr")
    hi_fence = F.col("q3") + F.lit(1.5) * F.col("iqr")
    v = F.col("_v")
    joined = counts.join(q, keys) if keys else attach_one_row(counts, q)
    return joined.groupBy(*keys, "n", "q1", "median", "q3", "iqr").agg(
        F.min(F.when(v >= lo_fence, v)).alias("whisker_low"),
        F.max(F.when(v <= hi_fence, v)).alias("whisker_high"),
        F.coalesce(F.sum(F.when((v < lo_fence) | (v > hi_fence), F.col("_w"))), F.lit(0)).alias("outliers"),
    )


def zero_filled_pivot(
    df: DataFrame, row_key: str, col_key: str, values: Sequence[int], row_values: Sequence[int], prefix: str
) -> DataFrame:
    """Count matrix row_key x col_key over fixed value lists, missing cells 0.

    The full grid of row values is generated and left-joined, so absent rows
    appear with zeros; columns are the fixed ``values``.
    """
    spark: SparkSession = df.sparkSession
    counts = df.groupBy(row_key).pivot(col_key, list(values)).count()
    counts = counts.select(row_key, *[F.col(str(v)).alias(f"{prefix}{v}") for v in values])
    grid = spark.createDataFrame([(int(r),) for r in row_values], f"{row_key} int")
    out = grid.join(counts, row_key, "left")
    return out.select(
        row_key, *[F.coalesce(F.col(f"{prefix}{v}"), F.lit(0)).cast("long").alias(f"{prefix}{v}") for v in values]
    )


def null_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: missing count and percentage of rows (2 decimals); one pass."""
    cols = list(columns or df.columns)
    agg = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_m{i}") for i, c in enumerate(cols)],
    )
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.col(f"_m{i}").alias("missing"))
            for i, c in enumerate(cols)
        ]
    )
    return agg.select("_rows", F.inline(rows)).select(
        "position",
        "column",
        "missing",
        round_even(F.col("missing").cast("double") * F.lit(100.0) / F.col("_rows").cast("double"), 2).alias(
            "missing_pct"
        ),
    )


def duplicate_report(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each identical full-row group, count and %."""
    both = distinct_row_counts(df)
    return both.select(
        "rows",
        (F.col("rows") - F.col("distinct_rows")).alias("duplicates"),
        round_even(
            (F.col("rows") - F.col("distinct_rows")).cast("double") * F.lit(100.0) / F.nullif(F.col("rows").cast("double"), F.lit(0.0)), 2
        ).alias("duplicate_pct"),
    )


def _long(df: DataFrame, columns: Sequence[str], dtype: str) -> DataFrame:
    """(position, value) of every cell of ``columns``."""
    cells = [F.struct(F.lit(i).alias("position"), F.col(f"`{c}`").cast(dtype).alias("value")) for i, c in enumerate(columns)]
    return df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*").where("value IS NOT NULL")


def describe_numeric(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """count, mean, sample std, min, quartiles (linear), max per column, one
    row per column; floating results rounded to ``digits`` decimals. Two passes:
    one aggregate, and one (column, value) count for the exact quartiles of all
    columns."""
    edges = quantiles.value_count_edges(_long(df, columns, "double"), "value", [0.25, 0.5, 0.75], by="position")
    aggs, rows = [], []
    for i, c in enumerate(columns):
        x = F.col(f"`{c}`")
        xd = x.cast("double")
        parts = {"count": F.count(x), "mean": exact_mean_or_null(x), "std": F.stddev_samp(xd), "min": F.min(xd), "max": F.max(xd)}
        aggs += [v.alias(f"{k}_{i}") for k, v in parts.items()]
        rows.append(F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), *(F.col(f"{k}_{i}").alias(k) for k in parts)))
    return df.agg(*aggs).select(F.inline(F.array(*rows))).join(edges, "position", "left").select(
        "position",
        "column",
        "count",
        round_to(F.col("mean"), digits).alias("mean"),
        round_to(F.col("std"), digits).alias("std"),
        "min",
        round_to(F.col("edges")[0], digits).alias("p25"),
        round_to(F.col("edges")[1], digits).alias("p50"),
        round_to(F.col("edges")[2], digits).alias("p75"),
        "max",
    )


def exact_mean_or_null(c: Column) -> Column:
    return F.sum(c).cast("double") / F.nullif(F.count(c).cast("double"), F.lit(0.0))


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count (non-null), unique, top (most frequent, ties by smallest value), freq; one pass."""
    counts = _long(df, columns, "string").groupBy("position", "value").agg(F.count(F.lit(1)).alias("_f"))
    found = counts.groupBy("position").agg(
        F.sum("_f").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct((-F.col("_f")).alias("nf"), F.col("value"))).alias("top"),
        F.max("_f").alias("freq"),
    )
    names = df.sparkSession.createDataFrame(list(enumerate(columns)), "position int, column string")
    return names.join(found, "position", "left").select(
        "position",
        "column",
        F.coalesce("count", F.lit(0)).alias("count"),
        F.coalesce("unique", F.lit(0)).alias("unique"),
        "top",
        "freq",
    )
