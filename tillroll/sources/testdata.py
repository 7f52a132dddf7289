"""Adapter from the star-schema test tables to the order-line shape.

One order line per ``lineitem`` row:
  invoice      = order key as text
  stock_code   = part key as text, description = part name
  quantity     = line quantity, negative for returned lines (return flag 'R')
  invoice_date = order date
  price        = list price x (1 - discount), exact DECIMAL(18,4)
  customer_id  = order's customer, country = customer's nation name

The joins are written plainly; the planner picks broadcast for dimensions whose
measured size is under the threshold and sort-merge joins otherwise, and AQE
splits skewed join partitions at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


# Session setting for the number of partitions of the order lines.
INPUT_PARTITIONS = "tillroll.input.partitions"

# Declared schemas of the star-schema tables the adapter reads: reading with a
# schema skips the footer-inference job a schema-less read starts per table.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if name in SCHEMAS:
        return spark.read.schema(SCHEMAS[name]).parquet(path)
    return spark.read.parquet(path)


def orders_view(spark: SparkSession, sf_dir: str, cancel_prefix: bool = False) -> DataFrame:
    """Order lines in the ``raw_orders`` shape.

    ``cancel_prefix=True`` marks returned lines as cancellation invoices
    ('C' + order key), which is how the real data flags them.
    """
    # dealt by the join key into as many partitions as a shuffle has (or the setting
    # says), whatever the files' layout; a shuffled join on that key reuses it
    parts = spark.conf.get(INPUT_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")
    li = (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_partkey", "l_quantity", "l_discount", "l_returnflag")
        .repartition(int(parts), "l_orderkey")
    )
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    joined = (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(c, o.o_custkey == c.c_custkey)
        .join(n, c.c_nationkey == n.n_nationkey)
        .join(p, li.l_partkey == p.p_partkey)
    )
    is_return = F.col("l_returnflag") == "R"
    invoice = F.col("o_orderkey").cast("string")
    if cancel_prefix:
        invoice = F.when(is_return, F.concat(F.lit("C"), invoice)).otherwise(invoice)
    price = (
        F.col("p_retailprice").cast("decimal(12,2)")
        * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
    ).cast("decimal(18,4)")
    return joined.select(
        invoice.alias("invoice"),
        F.col("l_partkey").cast("string").alias("stock_code"),
        F.col("p_name").alias("description"),
        F.when(is_return, -F.col("l_quantity"))
        .otherwise(F.col("l_quantity"))
        .cast("int")
        .alias("quantity"),
        F.col("o_orderdate").alias("invoice_date"),
        price.alias("price"),
        F.col("o_custkey").alias("customer_id"),
        F.col("n_name").alias("country"),
    )
