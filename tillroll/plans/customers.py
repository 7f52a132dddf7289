"""One customer-grain table shared by the customer analyses.

A single pass over the lines that have a customer computes everything the RFM
scores (net money, distinct invoices, last purchase), the churn model (line
count, first purchase) and the lifetime-value forecast (gross money and first
/ last date over positive lines only, as conditional aggregates) need. It is
written once (:func:`materialize`), so the three analyses — and the reference
dates they take from it — never scan or shuffle the lines again. Every
aggregate has a fixed-width buffer, so the plan is a hash aggregate with
map-side partial aggregation (a customer holding a third of all lines costs
one partial row per map task, not one giant task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import money
from tillroll.plans.common import valid_customer, with_amount
from tillroll.session import materialize, observed
from tillroll.sources.layout import CustomerLayout


def _latest() -> dict[str, Column]:
    return {c: F.max(c) for c in ("last_purchase", "first_purchase")}


def customer_grain(orders: DataFrame, with_invoices: bool = True) -> DataFrame:
    """The customer table, lazy (columns as :func:`customer_base`)."""
    lines = with_amount(valid_customer(orders))
    pos = (F.col("quantity") > 0) & (F.col("price") > 0)
    date = F.col("invoice_date")
    invoices = F.count_distinct("invoice").cast("int") if with_invoices else F.lit(None).cast("int")
    return lines.groupBy("customer_id").agg(
        F.max(date).alias("last_purchase"),
        F.min(date).alias("first_purchase"),
        invoices.alias("invoices"),
        F.count(date).cast("int").alias("lines"),
        money.money_sum(F.col("amount")).alias("net_amount"),
        money.money_sum(F.when(pos, F.col("amount"))).alias("gross_amount"),
        F.min(F.when(pos, date)).alias("first_sale"),
        F.max(F.when(pos, date)).alias("last_sale"),
    )


def base_of_layout(layout: CustomerLayout, name: str = "customers", with_invoices: bool = True) -> tuple[DataFrame, int]:
    """:func:`customer_base` of lines laid out by customer: no line of a customer
    that is not hot moves; a customer is in one of the two parts only."""
    both = customer_grain(layout.usual(), with_invoices).unionByName(customer_grain(layout.heavy(), with_invoices))
    base = materialize(both, name, _latest())
    return base, observed(base)["rows"]


def customer_base(
    orders: DataFrame, name: str = "customers", with_invoices: bool = True
) -> tuple[DataFrame, int]:
    """(table, row count), the count and the latest dates observed as the table is
    written. Columns: customer_id, last_purchase, first_purchase,
    invoices, lines, net_amount, gross_amount, first_sale, last_sale.

    ``with_invoices=False`` leaves ``invoices`` NULL and skips the distinct
    count (one shuffle level instead of two) for callers that do not use it.
    """
    base = materialize(
        customer_grain(orders, with_invoices),
        name,
        _latest(),
    )
    return base, observed(base)["rows"]
