"""Datasets behind the dashboard screens (drawing is not part of this package).

Each function takes the order lines or a mart and returns a DataFrame; top-k
lists always break ties on the key so they are deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import dates, labels, money
from tillroll.operators import distinct, stats
from tillroll.operators.scalars import attach_one_row

# ---------------------------------------------------------------------------
# FIXED VALUES (the sizes and display names of the original screens)
# ---------------------------------------------------------------------------
TOP_COUNTRIES = 10  # countries by distinct customers
TOP_PRODUCTS = 10  # products by revenue
TOP_MARKETS = 10  # markets by priority rank
CHURN_HIGH_RISK_ROWS = 50  # high-risk churn list
CLV_TOP_ROWS = 30  # lifetime-value top list
SEGMENT_HISTOGRAM_BINS = 50  # recency / monetary histograms by segment
CHURN_HISTOGRAM_BINS = 30  # churn score histogram
DETAIL_NAMES = {
    "customer_id": "ID",
    "recency": "Récence (j)",
    "frequency": "Fréquence",
    "monetary": "Montant (€)",
    "r_score": "R",
    "f_score": "F",
    "m_score": "M",
    "rfm_score": "RFM",
    "segment": "Segment",
}
# ---------------------------------------------------------------------------

KPI_COLUMNS = ["total_orders", "total_customers", "total_revenue", "total_products"]

# --- overview (raw lines) ---------------------------------------------------


def kpis(orders: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct invoices, distinct customers, revenue of lines with quantity > 0
    (no price or customer filter), distinct products. Each column is counted on its
    own (``operators.distinct``), no row is expanded.

    ``approx=True`` uses HyperLogLog++ sketches (about 1% error): one pass and no
    shuffle of distinct values, for very large line tables.
    """
    revenue = money.money_sum(F.when(F.col("quantity") > 0, money.amount())).alias("total_revenue")
    names = {"invoice": "total_orders", "customer_id": "total_customers", "stock_code": "total_products"}
    if approx:
        return orders.agg(revenue, *(F.approx_count_distinct(c, 0.01).alias(n) for c, n in names.items())).select(*KPI_COLUMNS)
    # invoices and revenue in one pass: the sums of the distinct invoices add up
    per_invoice = orders.groupBy("invoice").agg(revenue)
    totals = per_invoice.agg(F.count("invoice").alias("total_orders"), money.money_sum(F.col("total_revenue")).alias("total_revenue"))
    counts = [distinct.distinct_count(orders, c, names[c]) for c in ("customer_id", "stock_code")]
    return distinct.side_by_side(totals, *counts).select(*KPI_COLUMNS)


def top_countries(orders: DataFrame, k: int = TOP_COUNTRIES) -> DataFrame:
    counts = (
        orders.where(F.col("customer_id").isNotNull())
        .groupBy("country")
        .agg(F.count_distinct("customer_id").alias("nb_clients"))
    )
    return stats.top_k(counts, [F.col("nb_clients").desc(), F.col("country").asc_nulls_last()], k)


def monthly_revenue(orders: DataFrame) -> DataFrame:
    return (
        orders.where(F.col("quantity") > 0)
        .groupBy(dates.month_start("invoice_date").alias("mois"))
        .agg(money.money_sum(money.amount()).alias("revenue"))
        .orderBy("mois")
    )


# --- customer segments (RFM mart) -------------------------------------------


def filter_bounds(rfm: DataFrame) -> DataFrame:
    """Least and most recency and monetary: what the range filters can be set to."""
    return rfm.agg(
        F.min("recency").alias("recency_min"),
        F.max("recency").alias("recency_max"),
        F.min("monetary").cast("double").alias("monetary_min"),
        F.max("monetary").cast("double").alias("monetary_max"),
    )


def filter_rfm(
    rfm: DataFrame,
    segments: Sequence[str] | None = None,
    recency: tuple[int, int] | None = None,
    monetary: tuple[float, float] | None = None,
) -> DataFrame:
    """Segment list plus inclusive recency and monetary ranges (None = no bound)."""
    cond = F.lit(True)
    if segments is not None:
        cond = cond & F.col("segment").isin(list(segments))
    if recency is not None:
        cond = cond & F.col("recency").between(recency[0], recency[1])
    if monetary is not None:
        cond = cond & F.col("monetary").between(F.lit(monetary[0]), F.lit(monetary[1]))
    return rfm.where(cond)


def segment_kpis(rfm: DataFrame) -> DataFrame:
    s = F.col("segment")
    return rfm.agg(
        F.count_if(s == labels.SEG_CHAMPIONS).alias("champions"),
        F.count_if(s == labels.SEG_AT_RISK).alias("at_risk"),
        F.count_if(s == labels.SEG_LOST).alias("lost"),
    )


def segment_distribution(rfm: DataFrame) -> DataFrame:
    return stats.value_counts(rfm, "segment", "customers", "share")


def segment_stats(rfm: DataFrame) -> DataFrame:
    """Per segment: customers, mean recency / frequency / monetary, total
    monetary, rounded to 1 decimal, largest total first."""
    g = rfm.groupBy("segment").agg(
        F.count(F.lit(1)).alias("clients"),
        money.round_even(money.exact_mean(F.col("recency")), 1).alias("recence_moy"),
        money.round_even(money.exact_mean(F.col("frequency")), 1).alias("frequence_moy"),
        money.round_even(money.exact_mean(F.col("monetary")), 1).alias("montant_moy"),
        money.round_even(F.sum("monetary"), 1).alias("montant_total"),
    )
    return g.orderBy(F.col("montant_total").desc(), F.col("segment"))


def rfm_points(rfm: DataFrame) -> DataFrame:
    """Point sets of the R x F and F x M scatter plots (size = monetary)."""
    return rfm.select("customer_id", "recency", "frequency", "monetary", "segment")


def segment_histogram(rfm: DataFrame, value: str, bins: int = SEGMENT_HISTOGRAM_BINS) -> DataFrame:
    return stats.histogram(rfm, value, bins, by="segment", out="customers")


def rf_heatmap(rfm: DataFrame) -> DataFrame:
    """5 x 5 R x F customer counts, zero-filled, R from 5 down to 1."""
    grid = stats.zero_filled_pivot(rfm, "r_score", "f_score", [1, 2, 3, 4, 5], [5, 4, 3, 2, 1], "f_")
    return grid.orderBy(F.col("r_score").desc())




def rfm_detail(rfm: DataFrame) -> DataFrame:
    """Display table: renamed columns, largest monetary first."""
    return rfm.orderBy(F.col("monetary").desc(), F.col("customer_id")).select(
        *[F.col(k).alias(v) for k, v in DETAIL_NAMES.items()]
    )


def detail_counts(filtered: DataFrame, rfm: DataFrame) -> DataFrame:
    return attach_one_row(
        filtered.agg(F.count(F.lit(1)).alias("shown")), rfm.agg(F.count(F.lit(1)).alias("total"))
    )


# --- products ---------------------------------------------------------------


def product_kpis(products: DataFrame) -> DataFrame:
    p = F.col("performance")
    return products.agg(
        F.count_if(p == labels.PERF_STAR).alias("stars"),
        F.count_if(p == labels.PERF_ORPHAN).alias("orphans"),
        F.count(F.lit(1)).alias("total_products"),
    )


def performance_distribution(products: DataFrame) -> DataFrame:
    return stats.value_counts(products, "performance", "products")


def top_products(products: DataFrame, k: int = TOP_PRODUCTS) -> DataFrame:
    return stats.top_k(
        products.select("stock_code", "product_name", "performance", "monetary", "total_customers"),
        [F.col("monetary").desc(), F.col("stock_code")],
        k,
    )


def product_listing(products: DataFrame) -> DataFrame:
    return products.select(
        "stock_code", "product_name", "performance", "recency", "total_customers",
        "monetary", "avg_price", "total_quantity", "r_score", "f_score", "m_score",
    ).orderBy(F.col("monetary").desc(), F.col("stock_code"))


# --- churn ------------------------------------------------------------------


def churn_bands(churn: DataFrame) -> DataFrame:
    s = F.col("churn_score")
    return churn.agg(
        F.count_if(s >= 80).alias("high"),
        F.count_if((s >= 60) & (s < 80)).alias("medium"),
        F.count_if((s >= 40) & (s < 60)).alias("low"),
        F.count_if(s < 40).alias("very_low"),
    )


def churn_histogram(churn: DataFrame, bins: int = CHURN_HISTOGRAM_BINS) -> DataFrame:
    return stats.histogram(churn, "churn_score", bins, out="customers")


def churn_high_risk(churn: DataFrame, k: int = CHURN_HIGH_RISK_ROWS) -> DataFrame:
    return stats.top_k(
        churn.where(F.col("churn_score") >= 80),
        [F.col("churn_score").desc(), F.col("customer_id")],
        k,
    )


# --- markets ----------------------------------------------------------------


def market_class_counts(geo: DataFrame) -> DataFrame:
    m = F.col("market_growth_potential")
    return geo.agg(
        F.count_if(m.contains("Established")).alias("established"),
        F.count_if(m.contains("Growing")).alias("growing"),
        F.count_if(m.contains("Emerging")).alias("emerging"),
    )


def top_markets(geo: DataFrame, k: int = TOP_MARKETS) -> DataFrame:
    return stats.top_k(geo, [F.col("priority_rank")], k)


def market_listing(geo: DataFrame) -> DataFrame:
    return geo.orderBy("priority_rank")


# --- lifetime value -----------------------------------------------------------


def clv_totals(clv: DataFrame) -> DataFrame:
    return clv.agg(
        money.round_to(money.exact_sum(F.col("clv_12months")), 2).alias("total_clv_12"),
        money.round_to(money.exact_sum(F.col("clv_24months")), 2).alias("total_clv_24"),
        money.round_to(money.exact_sum(F.col("clv_12months")).cast("double") / F.count("clv_12months"), 2).alias("avg_clv_12"),
        F.count_if(F.col("forecast_confidence") == labels.CONF_HIGH).alias("high_confidence"),
    )


def clv_by_segment(clv: DataFrame) -> DataFrame:
    return clv.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"),
        money.round_to(money.exact_sum(F.col("clv_12months")), 2).alias("clv_12_total"),
        money.round_to(money.exact_sum(F.col("clv_24months")), 2).alias("clv_24_total"),
    ).orderBy(F.col("clv_24_total").desc(), F.col("segment"))


def clv_top(clv: DataFrame, k: int = CLV_TOP_ROWS) -> DataFrame:
    return stats.top_k(clv, [F.col("clv_24months").desc(), F.col("customer_id")], k)


# --- run summaries ------------------------------------------------------------


def churn_summary(churn: DataFrame) -> DataFrame:
    return churn.agg(F.count_if(F.col("churn_risk") == labels.CHURN_HIGH).alias("high_risk_customers"))


def geo_top3(geo: DataFrame) -> DataFrame:
    return stats.top_k(geo.select("priority_rank", "country", "total_revenue"), [F.col("priority_rank")], 3)


def clv_summary(clv: DataFrame) -> DataFrame:
    return clv.agg(
        money.round_to(money.exact_sum(F.col("clv_24months")), 2).alias("total_clv_24"),
        money.round_to(money.exact_sum(F.col("clv_12months")).cast("double") / F.count("clv_12months"), 2).alias("avg_clv_12"),
    )


# --- values to choose from (filters) ------------------------------------------


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values of a column, sorted."""
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)
