"""Customer lifetime value forecast.

Customers of the RFM table joined to their positive lines (quantity > 0,
price > 0). Historical value is gross positive revenue (not the RFM net
monetary). Months active = max(1, whole days first->last / 30); monthly value
x 12 or 24 x segment growth factor; confidence from history and months.

The lines are aggregated per customer *before* the join, so the join is 1:1
at customer grain (no line-level shuffle by customer, no hot-customer skew in
the join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import dates, labels
from tillroll.plans.customers import customer_base

CLV_COLUMNS = [
    "customer_id",
    "segment",
    "historical_value",
    "avg_monthly_value",
    "clv_12months",
    "clv_24months",
    "growth_rate",
    "forecast_confidence",
]


def clv_forecast(rfm: DataFrame, orders: DataFrame) -> DataFrame:
    """:func:`clv_from_base` on a customer table built from ``orders``."""
    return clv_from_base(rfm, customer_base(orders, with_invoices=False))


def clv_from_base(rfm: DataFrame, base: tuple[DataFrame, int]) -> DataFrame:
    """The forecast of every customer of ``rfm`` with a positive line, from the
    shared customer table (no pass over the lines). A customer whose positive
    lines have no date keeps the history; lifetime, monthly value and forecasts
    are NULL."""
    table, _ = base
    per_customer = table.where(F.col("gross_amount").isNotNull()).select(
        "customer_id",
        F.col("gross_amount").alias("historical_value"),
        F.col("first_sale").alias("_first"),
        F.col("last_sale").alias("_last"),
    )
    return _forecast(rfm.select("customer_id", "segment").join(per_customer, "customer_id"))


def _forecast(df: DataFrame) -> DataFrame:
    months = dates.whole_days(F.col("_first"), F.col("_last")).cast("double") / F.lit(float(labels.DAYS_PER_MONTH))
    months = F.when(months < 1.0, F.lit(1.0)).otherwise(months)  # clipped from below; NULL stays NULL
    df = (
        df.withColumn("_months", months)
        .withColumn("avg_monthly_value", F.col("historical_value").cast("double") / F.col("_months"))
        .withColumn("growth_rate", labels.growth_rate(F.col("segment")))
    )
    return df.select(
        "customer_id",
        "segment",
        "historical_value",
        "avg_monthly_value",
        (F.col("avg_monthly_value") * F.lit(12.0) * F.col("growth_rate")).alias("clv_12months"),
        (F.col("avg_monthly_value") * F.lit(24.0) * F.col("growth_rate")).alias("clv_24months"),
        "growth_rate",
        labels.forecast_confidence(F.col("_months"), F.col("historical_value")).alias(
            "forecast_confidence"
        ),
    )
