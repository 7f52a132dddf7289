"""Market analysis by country.

Lines with customer, quantity > 0, price > 0. Per country: distinct
customers, distinct invoices, revenue, revenue per order and per customer,
and the mean over the country's customers of their recency (truncated to
whole days), invoice count and revenue. A customer buying in two countries
counts in both. Class from the revenue 75th percentile and recency 25th /
50th percentiles across countries; priority rank by revenue (ties by name).

Plan: one pass over the lines to the finest grain, (country, customer, invoice),
written once and rolled up twice: to customers of a country (whose invoices are
then rows) and to the distinct invoices of a country. The grain shuffles after
map-side combining on all three keys, so a country holding most rows is spread
over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions import dates, labels, money
from tillroll.plans.common import positive_sales, require_rows, with_amount, with_latest
from tillroll.session import materialize, observed

GEO_COLUMNS = [
    "country",
    "total_customers",
    "total_orders",
    "total_revenue",
    "avg_order_value",
    "avg_customer_value",
    "recency_avg",
    "frequency_avg",
    "monetary_avg",
    "market_growth_potential",
    "priority_rank",
]


def geographic_analysis(orders: DataFrame) -> DataFrame:
    lines = with_amount(positive_sales(orders))
    # the unnamed country is part of the grain, so the reference date covers every line
    grain = materialize(
        lines.groupBy("country", "customer_id", "invoice").agg(
            F.max("invoice_date").alias("_last"), money.money_sum(F.col("amount")).alias("_amount")
        ),
        "country_invoices",
        {"_last": F.max("_last")},
    )
    require_rows(observed(grain)["rows"], "geographic analysis")
    named = grain.where(F.col("country").isNotNull())
    per_customer = with_latest(
        named.groupBy("country", "customer_id").agg(
            F.max("_last").alias("_last"), F.count("invoice").alias("_freq"), money.money_sum(F.col("_amount")).alias("_mon")
        ),
        grain,
        _ref="_last",
    ).select("country", "_freq", "_mon", dates.whole_days(F.col("_last"), F.col("_ref")).alias("_rec"))
    per_country = per_customer.groupBy("country").agg(
        F.count(F.lit(1)).alias("total_customers"),
        money.money_sum(F.col("_mon")).alias("total_revenue"),
        (F.sum("_rec") / F.count("_rec")).cast("int").alias("recency_avg"),
        money.exact_mean(F.col("_freq")).alias("frequency_avg"),
        money.exact_mean(F.col("_mon")).alias("monetary_avg"),
    )
    # distinct in the country, even if an invoice spans customers
    orders_per_country = named.groupBy("country").agg(F.count_distinct("invoice").alias("total_orders"))
    geo = per_country.join(orders_per_country, "country")
    # class thresholds: exact percentiles across countries, beside each country (one
    # window over as many rows as there are countries, so their figures are taken once)
    every = Window.partitionBy()
    thresholds = {
        "_rev75": F.percentile(F.col("total_revenue").cast("double"), F.lit(0.75)).over(every),
        "_rec": F.percentile(F.col("recency_avg").cast("double"), F.array(F.lit(0.25), F.lit(0.5))).over(every),
    }
    geo = geo.withColumns(thresholds).select(
        *[c for c in GEO_COLUMNS if c not in ("avg_order_value", "avg_customer_value", "market_growth_potential", "priority_rank")],
        money.ratio(F.col("total_revenue"), F.col("total_orders")).alias("avg_order_value"),
        money.ratio(F.col("total_revenue"), F.col("total_customers")).alias("avg_customer_value"),
        labels.market_class(
            F.col("total_revenue").cast("double"),
            F.col("recency_avg"),
            F.col("_rev75"),
            F.col("_rec")[0],
            F.col("_rec")[1],
        ).alias("market_growth_potential"),
        F.row_number().over(Window.orderBy(F.col("total_revenue").desc(), F.col("country").asc())).alias("priority_rank"),
    )
    return geo.select(*GEO_COLUMNS)
