"""Shared steps of the analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import money
from tillroll.operators.scalars import attach_one_row
from tillroll.session import observed


def valid_customer(df: DataFrame) -> DataFrame:
    """Rows with a customer (the key every customer analysis groups on)."""
    return df.where(F.col("customer_id").isNotNull())


def positive_sales(df: DataFrame) -> DataFrame:
    """Customer present, quantity > 0 and price > 0."""
    return df.where(
        F.col("customer_id").isNotNull() & (F.col("quantity") > 0) & (F.col("price") > 0)
    )


def with_amount(df: DataFrame) -> DataFrame:
    return df.withColumn("amount", money.amount())


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """See :func:`tillroll.operators.scalars.attach_one_row`."""
    return attach_one_row(df, one_row)


def with_latest(df: DataFrame, table: DataFrame, **latest: str) -> DataFrame:
    """Attach the latest timestamp of columns of ``table`` ({name: column}): as
    literals where they came with the write of ``table``, else as a one-row broadcast."""
    known = observed(table)
    if known is None or any(c not in known for c in latest.values()):
        return with_scalars(df, table.agg(*(F.max(c).alias(n) for n, c in latest.items())))
    text = {n: known[c] and known[c].isoformat(" ") for n, c in latest.items()}
    return df.withColumns({n: F.lit(t).cast("timestamp_ntz") for n, t in text.items()})


def require_rows(rows: int, what: str) -> None:
    """Fail on an empty input (``rows``: the count of a written grain table)."""
    if not rows:
        raise ValueError(f"no rows for {what}")
