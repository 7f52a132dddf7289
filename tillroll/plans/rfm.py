"""Customer RFM scoring and segmentation.

customer_rfm  — every line with a customer, returns and cancellations included
                (net money), recency against the latest line date, frequency =
                distinct invoices, keep customers whose net monetary is > 0,
                then R = value quintile of recency (inverted), F = quintile of
                the unique rank of frequency (ties by customer id), M = value
                quintile of monetary; eight-way segment.
rfm_exploration — the stricter exploratory variant: clean the lines first
                (duplicates, missing customer, cancellations, non-positive
                quantity/price), reference date = latest date + 1 day, seven-way
                segment on R and F.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import dates, labels
from tillroll.operators import binning
from tillroll.plans.customers import customer_base
from tillroll.plans import cleaning
from tillroll.operators.cutpoints import Score, add_scores
from tillroll.plans.common import require_rows, with_latest

RFM_COLUMNS = [
    "customer_id",
    "recency",
    "frequency",
    "monetary",
    "r_score",
    "f_score",
    "m_score",
    "rfm_score",
    "segment",
]


def customer_metrics(
    lines: DataFrame, reference_shift_days: int = 0, base: tuple[DataFrame, int] | None = None
) -> DataFrame:
    """Per customer: recency (whole days to the reference date), frequency
    (distinct invoices), monetary (exact sum of price x quantity).

    Derived from the shared customer-grain table (one pass over the lines,
    written once); the reference date is its latest last purchase (= the
    latest line date), known since the table was written. An empty input fails.
    """
    table, rows = base if base is not None else customer_base(lines)
    ref = F.col("_ref")
    if reference_shift_days:
        ref = dates.plus_days(ref, reference_shift_days)
    require_rows(rows, "customer RFM")
    # a customer whose dates are all missing has no recency: left out before scoring
    metrics = with_latest(table.where(F.col("last_purchase").isNotNull()), table, _ref="last_purchase").select(
        "customer_id",
        dates.whole_days(F.col("last_purchase"), ref).alias("recency"),
        F.col("invoices").alias("frequency"),
        F.col("net_amount").alias("monetary"),
    )
    return metrics


def score_rfm(
    metrics: DataFrame,
    on_duplicate_edges: str = binning.RAISE,
) -> DataFrame:
    """R, F, M scores (1..5) and the concatenated ``rfm_score``."""
    df = add_scores(
        metrics,
        [
            Score("rank", "frequency", "customer_id", "f_score", binning.DIRECT),
            Score("value", "monetary", "customer_id", "m_score", binning.DIRECT),
            Score("value", "recency", "customer_id", "r_score", binning.INVERTED),
        ],
        on_duplicate_edges,
    )
    return df.withColumn(
        "rfm_score",
        F.concat(
            F.col("r_score").cast("string"), F.col("f_score").cast("string"), F.col("m_score").cast("string")
        ),
    )


def customer_rfm(
    orders: DataFrame,
    on_duplicate_edges: str = binning.RAISE,
    base: tuple[DataFrame, int] | None = None,
) -> DataFrame:
    """The customer RFM table (one row per customer with net monetary > 0).
    ``base``: a :func:`customer_base` already built from the same orders."""
    metrics = customer_metrics(orders, base=base)
    scored = score_rfm(metrics.where(F.col("monetary") > 0), on_duplicate_edges)
    return scored.withColumn(
        "segment", labels.customer_segment(F.col("r_score"), F.col("f_score"), F.col("m_score"))
    ).select(*RFM_COLUMNS)


def rfm_exploration(orders: DataFrame, on_duplicate_edges: str = binning.RAISE) -> DataFrame:
    """Exploratory RFM on cleaned lines, reference date = latest date + 1 day."""
    clean = cleaning.clean_orders(orders)
    metrics = customer_metrics(clean, reference_shift_days=1, base=customer_base(clean, "clean_customers"))
    scored = score_rfm(metrics.where(F.col("monetary") > 0), on_duplicate_edges)
    return scored.withColumn(
        "segment", labels.exploration_segment(F.col("r_score"), F.col("f_score"))
    ).select(*RFM_COLUMNS)
