"""Order lines laid out by customer, so that customer analyses do not shuffle them.

The lines are written once as a bucketed table on the customer key: a scan of it is
already partitioned by customer, and every aggregate by customer, distinct invoices
included, runs without an exchange. A bucket is one task, so customers with many
lines do not belong in one: those with more than ``1 / (HOT * buckets)`` of all
lines (fewer than ``HOT * buckets`` of them, whatever the data) are kept in a plain
table beside it, spread over its files, and aggregated with partial sums and an
exchange of those. Lines without a customer are in neither: no customer analysis
reads them; ``rest`` holds them for a whole scan.

Bucketed tables need a catalog entry; the files are in the folder that is given (or
the shared checkpoint folder), and the entry is dropped with :func:`forget`.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import scratch_path

#: A customer is hot with more than one HOT-th of a bucket's mean share of the lines.
HOT = 4


@dataclass
class CustomerLayout:
    table: str
    hot: str
    rest: str
    buckets: int
    spark: SparkSession

    def usual(self) -> DataFrame:
        """Lines of all customers that are not hot, partitioned by customer."""
        return self.spark.table(self.table)

    def heavy(self) -> DataFrame:
        """Lines of the hot customers, spread."""
        return self.spark.read.parquet(self.hot)

    def lines(self) -> DataFrame:
        """Every line, with or without a customer."""
        return self.usual().unionByName(self.heavy()).unionByName(self.spark.read.parquet(self.rest))


def hot_customers(orders: DataFrame, buckets: int) -> list[int]:
    """Customers with more than ``1 / (HOT * buckets)`` of all lines."""
    counts = orders.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    hot = counts.crossJoin(F.broadcast(total)).where(F.col("n") * (HOT * buckets) > F.col("total"))  # one row
    return sorted(r["customer_id"] for r in hot.select("customer_id").collect())


def lay_out(orders: DataFrame, buckets: int, folder: str | None = None) -> CustomerLayout:
    """Write ``orders`` by customer: every bucket is one sorted file."""
    spark = orders.sparkSession
    root = (folder or scratch_path(spark, "by_customer")).rstrip("/")
    name = f"lines_by_customer_{uuid.uuid4().hex[:12]}"
    hot = hot_customers(orders, buckets)
    key = F.col("customer_id")
    is_hot = key.isin(hot) if hot else F.lit(False)
    usual = orders.where(key.isNotNull() & ~is_hot)
    usual.repartition(buckets, "customer_id").write.bucketBy(buckets, "customer_id").sortBy("customer_id").option(
        "path", f"{root}/buckets"
    ).format("parquet").saveAsTable(name)
    orders.where(key.isNotNull() & is_hot).write.parquet(f"{root}/hot")
    orders.where(key.isNull()).write.parquet(f"{root}/rest")
    return CustomerLayout(name, f"{root}/hot", f"{root}/rest", buckets, spark)


def forget(layout: CustomerLayout) -> None:
    """Drop the catalog entry; the files stay where they are."""
    layout.spark.sql(f"DROP TABLE IF EXISTS {layout.table}")
