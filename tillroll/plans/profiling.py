"""Data profiling of order lines: shape and types, describe, missing values,
duplicates, distinct counts, distributions in display ranges, outlier counts,
amount, date range, lines per customer, exploration segment summary.

Each function is one or two aggregations over the lines; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import dates, money
from tillroll.operators import distinct, stats
from tillroll.schemas import ORDER_COLUMNS

NUMERIC_COLUMNS = ["quantity", "price", "customer_id"]
TEXT_COLUMNS = ["invoice", "stock_code", "description", "country"]

# ---------------------------------------------------------------------------
# FIXED VALUES (display ranges and bin count of the original profiling plots)
# ---------------------------------------------------------------------------
PRICE_RANGE = (0, 50)
QUANTITY_RANGE = (0, 100)
HISTOGRAM_BINS = 50
TOP_COUNTRY_ROWS = 10
EXPLORATION_LIMITS = {"recency": None, "frequency": 50, "monetary": 5000}
# ---------------------------------------------------------------------------


def column_profile(orders: DataFrame) -> DataFrame:
    """Per column: position, name, type, non-null count, row count."""
    df = orders.select(*ORDER_COLUMNS)
    types = dict(df.dtypes)
    agg = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(f"_n{i}") for i, c in enumerate(ORDER_COLUMNS)])
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(c).alias("col_name"),
                F.lit(types[c]).alias("dtype"),
                F.col(f"_n{i}").alias("non_null"),
            )
            for i, c in enumerate(ORDER_COLUMNS)
        ]
    )
    return agg.select(F.col("_rows").alias("rows"), F.inline(rows))


def describe_numeric(orders: DataFrame) -> DataFrame:
    return stats.describe_numeric(orders, NUMERIC_COLUMNS).withColumnRenamed("column", "col_name")


def describe_text(orders: DataFrame) -> DataFrame:
    return stats.describe_text(orders, TEXT_COLUMNS).withColumnRenamed("column", "col_name")


def missing_values(orders: DataFrame) -> DataFrame:
    return stats.null_report(orders.select(*ORDER_COLUMNS)).withColumnRenamed("column", "col_name")


def duplicates(orders: DataFrame) -> DataFrame:
    return stats.duplicate_report(orders.select(*ORDER_COLUMNS))


def distinct_counts(orders: DataFrame) -> DataFrame:
    """Each column counted on its own; no row is expanded."""
    names = {"customer_id": "customers", "invoice": "invoices", "country": "countries"}
    missing = orders.agg(F.count_if(F.col("customer_id").isNull()).alias("rows_without_customer"))
    counts = distinct.side_by_side(missing, *(distinct.distinct_count(orders, c, n) for c, n in names.items()))
    return counts.select("customers", "rows_without_customer", "invoices", "countries")


def top_countries_by_rows(orders: DataFrame, k: int = TOP_COUNTRY_ROWS) -> DataFrame:
    counts = orders.where(F.col("country").isNotNull()).groupBy("country").agg(F.count(F.lit(1)).alias("rows"))
    return stats.top_k(counts, [F.col("rows").desc(), F.col("country")], k)


def _in_range(orders: DataFrame, col: str, rng: tuple[float, float]) -> DataFrame:
    return orders.where(F.col(col).between(rng[0], rng[1]))


def price_histogram(orders: DataFrame, bins: int = HISTOGRAM_BINS, rng: tuple[float, float] = PRICE_RANGE) -> DataFrame:
    return stats.histogram(_in_range(orders, "price", rng), "price", bins, out="lines")


def quantity_histogram(orders: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    return stats.histogram(_in_range(orders, "quantity", QUANTITY_RANGE), "quantity", bins, out="lines")


def price_histogram_full(orders: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Same histogram over every price (no display range)."""
    return stats.histogram(orders, "price", bins, out="lines")


def price_box_full(orders: DataFrame) -> DataFrame:
    return _rounded_box(stats.box_summary(orders, "price"))


def _rounded_box(df: DataFrame) -> DataFrame:
    return df.select(
        "n",
        *[money.round_to(F.col(c), 6).alias(c) for c in ("q1", "median", "q3", "iqr")],
        "whisker_low",
        "whisker_high",
        "outliers",
    )


def price_box(orders: DataFrame, rng: tuple[float, float] = PRICE_RANGE) -> DataFrame:
    return _rounded_box(stats.box_summary(_in_range(orders, "price", rng), "price"))


def quantity_box(orders: DataFrame) -> DataFrame:
    return _rounded_box(stats.box_summary(_in_range(orders, "quantity", QUANTITY_RANGE), "quantity"))


def anomaly_counts(orders: DataFrame) -> DataFrame:
    d = F.col("description")
    return orders.agg(
        F.count_if(F.col("quantity") < 0).alias("negative_quantity"),
        F.count_if(F.col("price") <= 0).alias("non_positive_price"),
        F.count_if(F.col("customer_id").isNull()).alias("missing_customer"),
        F.count_if(d.isNull() | (F.trim(d) == "")).alias("empty_description"),
    )


def amount_stats(orders: DataFrame) -> DataFrame:
    a = money.amount()
    return orders.select(a.alias("amount")).agg(
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
        money.exact_mean(F.col("amount")).alias("mean_amount"),
        money.money_sum(F.col("amount")).alias("total_amount"),
    )


def date_range(orders: DataFrame) -> DataFrame:
    r = orders.agg(F.min("invoice_date").alias("first_date"), F.max("invoice_date").alias("last_date"))
    return r.withColumn("span_days", dates.whole_days(F.col("first_date"), F.col("last_date")))


def lines_per_customer(orders: DataFrame) -> DataFrame:
    per = orders.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(F.count(F.lit(1)).alias("_n"))
    return per.agg(
        F.min("_n").alias("min_lines"),
        F.max("_n").alias("max_lines"),
        money.exact_mean(F.col("_n")).alias("mean_lines"),
    )


def segment_summary(rfm: DataFrame) -> DataFrame:
    """Mean recency / frequency / monetary per segment (1 decimal), largest
    mean monetary first."""
    return rfm.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"),
        money.round_even(money.exact_mean(F.col("recency")), 1).alias("recency"),
        money.round_even(money.exact_mean(F.col("frequency")), 1).alias("frequency"),
        money.round_even(money.exact_mean(F.col("monetary")), 1).alias("monetary"),
    ).orderBy(F.col("monetary").desc(), F.col("segment"))


def segment_recency_box(rfm: DataFrame) -> DataFrame:
    return stats.box_summary(rfm, "recency", by="segment")


def exploration_histogram(rfm: DataFrame, value: str, bins: int = HISTOGRAM_BINS, limit: float | None = None) -> DataFrame:
    """Histogram of one exploration score input, up to its display limit (or ``limit``)."""
    limit = EXPLORATION_LIMITS[value] if limit is None else limit
    rows = rfm if limit is None else rfm.where(F.col(value) <= limit)
    return stats.histogram(rows, value, bins, out="customers")


def exploration_describe(rfm: DataFrame) -> DataFrame:
    return stats.describe_numeric(rfm, ["recency", "frequency", "monetary"]).withColumnRenamed("column", "col_name")


def exploration_shares(rfm: DataFrame) -> DataFrame:
    """Customers per segment and their share in percent (one decimal, half to even)."""
    counts = stats.value_counts(rfm, "segment", "customers", "_share")
    return counts.select("segment", "customers", money.round_even(F.col("_share") * F.lit(100.0), 1).alias("share_pct"))
