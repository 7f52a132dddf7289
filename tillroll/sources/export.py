"""CSV export: plain (header, ',' separated) for result sets, and the raw
order-line layout (';', decimal comma, 'd/M/yyyy H:mm') for hand-off to tools
that expect the original files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)
    return path


def day_first(ts: Column) -> Column:
    """TIMESTAMP_NTZ -> 'd/M/yyyy H:mm' from its fields (no time-zone step)."""
    return F.concat(
        F.dayofmonth(ts).cast("string"), F.lit("/"), F.month(ts).cast("string"), F.lit("/"),
        F.year(ts).cast("string"), F.lit(" "), F.hour(ts).cast("string"), F.lit(":"),
        F.lpad(F.minute(ts).cast("string"), 2, "0"),
    )


def to_raw_layout(orders: DataFrame) -> DataFrame:
    """Order lines -> raw CSV columns as text (decimal comma, day-first dates)."""
    return orders.select(
        F.col("invoice").alias("Invoice"),
        F.col("stock_code").alias("StockCode"),
        F.col("description").alias("Description"),
        F.col("quantity").cast("string").alias("Quantity"),
        day_first(F.col("invoice_date")).alias("InvoiceDate"),
        F.regexp_replace(F.col("price").cast("string"), r"\.", ",").alias("Price"),
        F.col("customer_id").cast("string").alias("Customer ID"),
        F.col("country").alias("Country"),
    )


def export_raw_orders(orders: DataFrame, path: str, mode: str = "overwrite") -> str:
    """A file for each partition; a quote in a field is doubled, an empty text is
    written as \"\" and a missing one as nothing."""
    write_raw(to_raw_layout(orders), path, mode)
    return path


def write_raw(raw: DataFrame, path: str, mode: str = "overwrite") -> None:
    out = raw.write.mode(mode).option("sep", ";").option("header", True).option("encoding", "UTF-8")
    out.option("escape", '"').option("emptyValue", '""').csv(path)
