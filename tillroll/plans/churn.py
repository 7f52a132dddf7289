"""Churn risk per customer.

Lines with a customer (returns included). ``frequency`` is the number of
lines. ``days_since_first_purchase`` is measured from the customer's first
purchase to the *latest first purchase of any customer*. Score =
0.6 x recency weight + 0.4 x purchase-rate weight, each a value quintile,
computed in integers (exactly the same values: all weights are multiples of 5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import dates, labels
from tillroll.operators import binning
from tillroll.operators.cutpoints import Score, add_scores
from tillroll.plans.common import require_rows, with_latest
from tillroll.plans.customers import customer_base

CHURN_COLUMNS = [
    "customer_id",
    "recency",
    "frequency",
    "days_since_first_purchase",
    "purchase_frequency_per_month",
    "months_active",
    "churn_score",
    "churn_risk",
    "recommendation",
]


def churn_risk(
    orders: DataFrame,
    on_duplicate_edges: str = binning.RAISE,
    base: tuple[DataFrame, int] | None = None,
) -> DataFrame:
    """``base``: a :func:`customer_base` already built from the same orders."""
    per_customer, rows = base if base is not None else customer_base(orders, with_invoices=False)
    require_rows(rows, "churn")
    days = dates.whole_days(F.col("first_purchase"), F.col("_latest_first"))
    # a customer whose dates are all missing has no recency: left out before scoring
    dated = per_customer.where(F.col("last_purchase").isNotNull())
    df = with_latest(dated, per_customer, _ref="last_purchase", _latest_first="first_purchase").select(
        "customer_id",
        dates.whole_days(F.col("last_purchase"), F.col("_ref")).alias("recency"),
        F.col("lines").alias("frequency"),
        days.alias("days_since_first_purchase"),
    )
    d = F.col("days_since_first_purchase")
    months = d.cast("double") / F.lit(float(labels.DAYS_PER_MONTH))
    df = df.withColumn("months_active", F.floor(months).cast("int")).withColumn(
        "purchase_frequency_per_month",
        F.col("frequency").cast("double") / F.when(d == 0, F.lit(1.0)).otherwise(months),
    )
    df = add_scores(
        df,
        [
            Score("value", "recency", "customer_id", "_rw", labels.CHURN_RECENCY_WEIGHTS),
            Score("value", "purchase_frequency_per_month", "customer_id", "_fw", labels.CHURN_FREQUENCY_WEIGHTS),
        ],
        on_duplicate_edges,
    )
    score = (
        (F.lit(labels.CHURN_RECENCY_SHARE) * F.col("_rw") + F.lit(labels.CHURN_FREQUENCY_SHARE) * F.col("_fw"))
        / F.lit(10)
    ).cast("double")
    return (
        df.withColumn("churn_score", score)
        .withColumn("churn_risk", labels.churn_class(F.col("churn_score")))
        .withColumn("recommendation", labels.churn_recommendation(F.col("churn_score")))
        .select(*CHURN_COLUMNS)
    )
