"""Order-line cleaning: full-row duplicates, missing customer, cancellation
invoices ('C' prefix), non-positive quantity or price — in that order — with
the number of rows each step removes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.distinct import distinct_row_counts
from tillroll.schemas import ORDER_COLUMNS

STEPS = ["duplicates", "missing_customer", "cancellations", "non_positive"]


def _not_cancelled():
    return ~F.coalesce(F.col("invoice").startswith("C"), F.lit(False))


def _positive():
    return (F.col("quantity") > 0) & (F.col("price") > 0)


def clean_orders(orders: DataFrame) -> DataFrame:
    """Duplicates dropped over the full row, then the three filters."""
    return (
        orders.select(*ORDER_COLUMNS)
        .dropDuplicates()
        .where(F.col("customer_id").isNotNull())
        .where(_not_cancelled())
        .where(_positive())
    )


def cleaning_report(orders: DataFrame) -> DataFrame:
    """Rows removed by each step and rows left: (step, removed, remaining), steps in
    pipeline order. Digests of the lines are exchanged, not the lines."""
    has_cust = F.col("customer_id").isNotNull()
    keep_c = has_cust & _not_cancelled()
    keep_p = keep_c & F.coalesce(_positive(), F.lit(False))
    s = distinct_row_counts(orders.select(*ORDER_COLUMNS), {"d1": has_cust, "d2": keep_c, "d3": keep_p})
    s = s.withColumnsRenamed({"rows": "total", "distinct_rows": "d0"})
    steps = F.array(
        F.struct(F.lit(1).alias("step_no"), F.lit(STEPS[0]).alias("step"), (F.col("total") - F.col("d0")).alias("removed"), F.col("d0").alias("remaining")),
        F.struct(F.lit(2).alias("step_no"), F.lit(STEPS[1]).alias("step"), (F.col("d0") - F.col("d1")).alias("removed"), F.col("d1").alias("remaining")),
        F.struct(F.lit(3).alias("step_no"), F.lit(STEPS[2]).alias("step"), (F.col("d1") - F.col("d2")).alias("removed"), F.col("d2").alias("remaining")),
        F.struct(F.lit(4).alias("step_no"), F.lit(STEPS[3]).alias("step"), (F.col("d2") - F.col("d3")).alias("removed"), F.col("d3").alias("remaining")),
    )
    return s.select(F.inline(steps))
