"""The query library over the marts (product, churn, market, lifetime value).

Three deliberate fixes against the original texts: the market-class filters
use the labels the analysis actually writes (with their emoji), the best-bets
query selects ``clv_24months`` (the original names a missing column), and
every LIMIT has a total order (key as the last sort column).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions import labels, money
from tillroll.operators import stats


# ---------------------------------------------------------------------------
# FIXED VALUES (list sizes and thresholds of the original query texts)
# ---------------------------------------------------------------------------
STAR_ROWS = 10
ORPHAN_ROWS = 20
RANK_ROWS = 20
HIGH_RISK_ROWS = 50
HIGH_RISK_SCORE = 80
INACTIVE_DAYS = 180
INACTIVE_MAX_FREQUENCY = 5
INACTIVE_ROWS = 30
MEDIUM_RISK_RANGE = (60, 79)
MEDIUM_RISK_ROWS = 100
TOP_COUNTRY_ROWS = 5
TOP_CLV_ROWS = 20
BEST_BET_ROWS = 50
FORECAST_VS_ACTUAL_ROWS = 30
CHAMPION_ROWS = 30
# ---------------------------------------------------------------------------


def star_products(products: DataFrame) -> DataFrame:  # top-10 stars by revenue
    return stats.top_k(
        products.where(F.col("performance") == labels.PERF_STAR).select(
            "stock_code", "product_name", "performance", "total_customers", "total_quantity",
            "monetary", "r_score", "f_score", "m_score",
        ),
        [F.col("monetary").desc(), F.col("stock_code")],
        STAR_ROWS,
    )


def orphan_products(products: DataFrame, orders: DataFrame) -> DataFrame:
    """Orphans with their total order-line count (0 when none), 20 with the
    fewest customers. The correlated count is a left join on a per-product
    aggregate: one pass over the lines."""
    sales = orders.groupBy("stock_code").agg(F.count(F.lit(1)).alias("total_sales"))
    orphans = products.where(F.col("performance") == labels.PERF_ORPHAN).select(
        "stock_code", "product_name", "performance", "total_customers", "monetary"
    )
    joined = orphans.join(sales, "stock_code", "left").withColumn(
        "total_sales", F.coalesce(F.col("total_sales"), F.lit(0)).cast("long")
    )
    return stats.top_k(joined, [F.col("total_customers").asc(), F.col("stock_code")], ORPHAN_ROWS)


def performance_summary(products: DataFrame) -> DataFrame:
    return products.groupBy("performance").agg(
        F.count(F.lit(1)).alias("product_count"),
        money.exact_mean(F.col("monetary")).alias("avg_revenue"),
        money.money_sum(F.col("monetary")).alias("total_revenue"),
        money.exact_mean(F.col("total_customers")).alias("avg_customers"),
    ).orderBy(F.col("total_revenue").desc(), F.col("performance"))


def revenue_rank(products: DataFrame, k: int = RANK_ROWS) -> DataFrame:
    """rank() by revenue, first ``k`` (by rank, then stock code).

    Exact without ranking the whole catalogue in one task: a row's rank is
    1 + the number of rows with strictly higher revenue, and all of those
    come before it in the (revenue desc, stock code) order, so they are all
    inside the distributed top-k. The window then runs over k rows only.
    """
    top = stats.top_k(
        products.select("stock_code", "product_name", "monetary", "total_customers", "performance"),
        [F.col("monetary").desc(), F.col("stock_code")],
        k,
    )
    ranked = top.withColumn("rank", F.rank().over(Window.orderBy(F.col("monetary").desc())))
    return ranked.select("rank", "stock_code", "product_name", "monetary", "total_customers", "performance").orderBy(
        "rank", "stock_code"
    )


def high_risk_customers(churn: DataFrame) -> DataFrame:
    return stats.top_k(
        churn.where(F.col("churn_score") >= HIGH_RISK_SCORE).select(
            "customer_id", "churn_score", "churn_risk", "recency", "frequency", "recommendation"
        ),
        [F.col("churn_score").desc(), F.col("customer_id")],
        HIGH_RISK_ROWS,
    )


def churn_distribution(churn: DataFrame) -> DataFrame:
    return churn.groupBy("churn_risk").agg(
        F.count(F.lit(1)).alias("customer_count"),
        money.round_to(money.exact_sum(F.col("churn_score")).cast("double") / F.count("churn_score"), 1).alias("avg_score"),
        F.min("churn_score").alias("min_score"),
        F.max("churn_score").alias("max_score"),
    ).orderBy(F.col("customer_count").desc(), F.col("churn_risk"))


def recommendation_breakdown(churn: DataFrame) -> DataFrame:
    return churn.groupBy("recommendation").agg(
        F.count(F.lit(1)).alias("customer_count"),
        money.round_to(money.exact_sum(F.col("churn_score")).cast("double") / F.count("churn_score"), 1).alias("avg_score"),
    ).orderBy(F.col("customer_count").desc(), F.col("recommendation"))


def long_inactive(churn: DataFrame) -> DataFrame:
    return stats.top_k(
        churn.where((F.col("recency") > INACTIVE_DAYS) & (F.col("frequency") < INACTIVE_MAX_FREQUENCY)).select(
            "customer_id", "recency", "frequency", "months_active",
            "purchase_frequency_per_month", "churn_score",
        ),
        [F.col("recency").desc(), F.col("customer_id")],
        INACTIVE_ROWS,
    )


def medium_risk_targets(churn: DataFrame) -> DataFrame:
    return stats.top_k(
        churn.where(F.col("churn_score").between(*MEDIUM_RISK_RANGE)).select(
            "customer_id", "churn_score", "recency", "frequency", "recommendation"
        ),
        [F.col("churn_score").desc(), F.col("customer_id")],
        MEDIUM_RISK_ROWS,
    )


def top_countries_by_revenue(geo: DataFrame) -> DataFrame:
    return stats.top_k(
        geo.select(
            "priority_rank", "country", "total_customers", "total_orders", "total_revenue",
            "avg_order_value", "avg_customer_value", "market_growth_potential",
        ),
        [F.col("priority_rank")],
        TOP_COUNTRY_ROWS,
    )


def growth_opportunities(geo: DataFrame) -> DataFrame:
    return geo.where(
        F.col("market_growth_potential").isin(labels.MARKET_GROWING, labels.MARKET_EMERGING)
    ).select(
        "priority_rank", "country", "total_customers", "total_revenue", "market_growth_potential",
        "recency_avg", "frequency_avg", "monetary_avg",
    ).orderBy(F.col("total_revenue").desc(), F.col("country"))


def declining_markets(geo: DataFrame) -> DataFrame:
    return geo.where(F.col("market_growth_potential") == labels.MARKET_DECLINING).select(
        "country", "total_customers", "total_revenue", "market_growth_potential",
        F.col("recency_avg").alias("days_since_last_order"),
    ).orderBy(F.col("total_revenue").desc(), F.col("country"))


def countries_ranked(geo: DataFrame) -> DataFrame:
    return geo.select(
        "priority_rank",
        "country",
        F.col("total_customers").alias("cust_count"),
        F.col("total_orders").alias("orders"),
        F.round(F.col("total_revenue"), 2).cast("decimal(38,2)").alias("revenue"),
        money.round_to(F.col("avg_customer_value"), 2).alias("avg_cust_value"),
        "market_growth_potential",
    ).orderBy("priority_rank")


def market_benchmark(geo: DataFrame) -> DataFrame:
    return geo.groupBy("market_growth_potential").agg(
        F.count(F.lit(1)).alias("country_count"),
        money.round_to(money.exact_mean(F.col("total_customers")), 0).alias("avg_customers"),
        money.round_to(money.exact_mean(F.col("total_revenue")), 0).alias("avg_revenue"),
        money.round_to(money.exact_sum(F.col("avg_customer_value")).cast("double") / F.count("avg_customer_value"), 2).alias("avg_customer_value"),
    ).orderBy(F.col("avg_revenue").desc(), F.col("market_growth_potential"))


def top_clv(clv: DataFrame) -> DataFrame:
    return stats.top_k(clv, [F.col("clv_24months").desc(), F.col("customer_id")], TOP_CLV_ROWS)


def clv_segment_summary(clv: DataFrame) -> DataFrame:
    return clv.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customer_count"),
        money.round_to(money.exact_mean(F.col("historical_value")), 2).alias("avg_historical"),
        money.round_to(money.exact_sum(F.col("clv_12months")).cast("double") / F.count("clv_12months"), 2).alias("avg_12m"),
        money.round_to(money.exact_sum(F.col("clv_24months")).cast("double") / F.count("clv_24months"), 2).alias("avg_24m"),
        money.round_to(money.exact_sum(F.col("clv_24months")), 0).alias("total_24m_forecast"),
        money.round_to(money.exact_sum(F.col("growth_rate")).cast("double") / F.count("growth_rate"), 2).alias("avg_growth"),
    ).orderBy(F.col("total_24m_forecast").desc(), F.col("segment"))


def best_bets(clv: DataFrame) -> DataFrame:
    return stats.top_k(
        clv.where(F.col("forecast_confidence") == labels.CONF_HIGH).select(
            "customer_id", "segment", "clv_24months", "forecast_confidence", "growth_rate"
        ),
        [F.col("clv_24months").desc(), F.col("customer_id")],
        BEST_BET_ROWS,
    )


def forecast_vs_actual(clv: DataFrame, rfm: DataFrame) -> DataFrame:
    j = clv.join(rfm.select("customer_id", "monetary"), "customer_id").where(F.col("monetary") > 0)
    out = j.select(
        "customer_id",
        "segment",
        F.col("monetary").alias("historical_actual"),
        F.col("clv_12months").alias("forecast_12m"),
        F.col("clv_24months").alias("forecast_24m"),
        money.round_to(money.ratio(F.col("clv_12months"), F.col("monetary")), 2).alias("growth_multiplier"),
    )
    return stats.top_k(out, [F.col("growth_multiplier").desc(), F.col("customer_id")], FORECAST_VS_ACTUAL_ROWS)


def champions_premium(clv: DataFrame) -> DataFrame:
    return stats.top_k(
        clv.where(
            (F.col("segment") == labels.SEG_CHAMPIONS) & (F.col("forecast_confidence") == labels.CONF_HIGH)
        ).select("customer_id", "clv_24months", "growth_rate", "forecast_confidence"),
        [F.col("clv_24months").desc(), F.col("customer_id")],
        CHAMPION_ROWS,
    )


def total_forecast(clv: DataFrame) -> DataFrame:
    return clv.agg(
        money.exact_sum(F.col("clv_12months")).cast("decimal(15,2)").alias("total_revenue_12m"),
        money.exact_sum(F.col("clv_24months")).cast("decimal(15,2)").alias("total_revenue_24m"),
        F.count(F.lit(1)).alias("total_customers"),
        (money.exact_sum(F.col("clv_24months")).cast("double") / F.count(F.lit(1))).cast("decimal(10,2)").alias("avg_clv_per_customer"),
    )
