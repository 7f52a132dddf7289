"""Product RFM: per stock code, recency, distinct customers, revenue; all three
scores are quintiles of unique ranks (ties by stock code), recency inverted;
performance class from the mean score.

``frequency`` is written as the distinct-customer count (same value as
``total_customers``), as the original table does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import dates, labels, money
from tillroll.operators import binning
from tillroll.operators.cutpoints import Score, add_scores
from tillroll.plans.common import positive_sales, require_rows, with_amount, with_latest
from tillroll.session import materialize, observed

PRODUCT_COLUMNS = [
    "stock_code",
    "product_name",
    "recency",
    "frequency",
    "monetary",
    "r_score",
    "f_score",
    "m_score",
    "total_customers",
    "avg_price",
    "total_quantity",
    "performance",
]


def _pick_description(pairs: DataFrame) -> DataFrame:
    """(stock_code, product_name) from the (stock_code, description, first
    date) grain: the description first seen, ties by the smallest text."""
    return pairs.groupBy("stock_code").agg(
        F.min_by("description", F.struct(F.col("_first"), F.col("description"))).alias("product_name")
    )


def product_table(lines: DataFrame) -> DataFrame:
    """Per stock code: last date, distinct customers, revenue, mean line price,
    quantity; written once. One distinct count only, so no line is emitted twice.
    Hardly any two lines of a task have one product and customer, so the lines' five
    columns travel to that key, not sums several times as wide, held in memory for
    each line; then products."""
    narrow = lines.select("stock_code", "customer_id", "invoice_date", "price", "quantity")
    return materialize(
        with_amount(narrow.repartition("stock_code", "customer_id"))
        .groupBy("stock_code")
        .agg(
            F.max("invoice_date").alias("_last"),
            F.count_distinct("customer_id").cast("int").alias("total_customers"),
            money.money_sum(F.col("amount")).alias("monetary"),
            money.exact_mean(F.col("price")).alias("avg_price"),
            F.sum("quantity").cast("long").alias("total_quantity"),
        ),
        "products",
        {"_last": F.max("_last")},
    )


def product_names(lines: DataFrame) -> DataFrame:
    """(stock_code, product_name): a pass over three columns of the lines that
    leaves one row for each (product, description) of a map task."""
    described = lines.where(F.col("description").isNotNull())
    return _pick_description(described.groupBy("stock_code", "description").agg(F.min("invoice_date").alias("_first")))


def product_rfm(orders: DataFrame) -> DataFrame:
    lines = positive_sales(orders)
    per_product = product_table(lines)
    require_rows(observed(per_product)["rows"], "product RFM")
    # a product whose dates are all missing has no recency: left out before scoring
    df = with_latest(per_product.where(F.col("_last").isNotNull()), per_product, _ref="_last").withColumn(
        "recency", dates.whole_days(F.col("_last"), F.col("_ref"))
    )
    df = add_scores(
        df,
        [
            Score("rank", "recency", "stock_code", "r_score", binning.INVERTED),
            Score("rank", "total_customers", "stock_code", "f_score", binning.DIRECT),
            Score("rank", "monetary", "stock_code", "m_score", binning.DIRECT),
        ],
    )
    return df.join(product_names(lines), "stock_code", "left").select(
        "stock_code",
        "product_name",
        "recency",
        F.col("total_customers").alias("frequency"),
        "monetary",
        "r_score",
        "f_score",
        "m_score",
        "total_customers",
        "avg_price",
        "total_quantity",
        labels.product_performance(F.col("r_score"), F.col("f_score"), F.col("m_score")).alias(
            "performance"
        ),
    )
