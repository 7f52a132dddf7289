"""Incremental upkeep of the shared customer table (plans/customers.py) from a
stream of order-line files.

Each micro-batch (``foreachBatch``, exactly-once through the stream checkpoint
and batch-numbered output folders):

1. aggregates only its own lines, read and parsed once, per (customer, invoice)
   and those per customer (max/min dates, line count, net and gross money,
   first/last positive sale — all mergeable);
2. finds its (customer, invoice) pairs that no earlier batch has seen (anti
   join against the stored pair table) and counts them per customer, so the
   distinct-invoice count stays exact across batches;
3. merges into the previous customer table with a full outer join (greatest /
   least of dates, sums of counts and money) and writes the next version.

A re-run of a batch after a failure overwrites its own outputs and merges from
the version before it, so the result is the same. The customer table is
equal, row for row, to ``customer_base`` over every line seen so far.

Cost per batch: the batch's own lines, one scan of the stored pair table for
the anti join (its size is the number of distinct invoices ever seen — much
smaller than the line history, which is never re-read) and one rewrite of the
customer table (customer grain).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import money
from tillroll.plans.common import valid_customer, with_amount
from tillroll.session import materialize, release
from tillroll.sources import tables
from tillroll.streaming.folder_ingest import orders_stream

BASE_COLUMNS = [
    "customer_id", "last_purchase", "first_purchase", "invoices", "lines",
    "net_amount", "gross_amount", "first_sale", "last_sale",
]


def _invoice_grain(lines: DataFrame) -> DataFrame:
    """Mergeable figures by customer and invoice (a missing one included)."""
    pos = (F.col("quantity") > 0) & (F.col("price") > 0)
    date = F.col("invoice_date")
    return lines.groupBy("customer_id", "invoice").agg(
        F.max(date).alias("last_purchase"),
        F.min(date).alias("first_purchase"),
        F.count(date).alias("lines"),
        money.money_sum(F.col("amount")).alias("net_amount"),
        money.money_sum(F.when(pos, F.col("amount"))).alias("gross_amount"),
        F.min(F.when(pos, date)).alias("first_sale"),
        F.max(F.when(pos, date)).alias("last_sale"),
    )


def _batch_aggregates(grain: DataFrame) -> DataFrame:
    return grain.groupBy("customer_id").agg(
        F.max("last_purchase").alias("last_purchase"),
        F.min("first_purchase").alias("first_purchase"),
        F.sum("lines").cast("int").alias("lines"),
        money.money_sum(F.col("net_amount")).alias("net_amount"),
        money.money_sum(F.col("gross_amount")).alias("gross_amount"),
        F.min("first_sale").alias("first_sale"),
        F.max("last_sale").alias("last_sale"),
    )


def _add(a: Column, b: Column) -> Column:
    """Sum that stays NULL only when both sides are NULL (like SUM over the union)."""
    return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(
        F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
    )


def merge(old: DataFrame | None, batch: DataFrame) -> DataFrame:
    """Customer table after adding ``batch`` (same columns as BASE_COLUMNS)."""
    if old is None:
        return batch.select(*BASE_COLUMNS)
    o, n = old.alias("o"), batch.alias("n")
    c = lambda side, name: F.col(f"{side}.{name}")
    return o.join(n, "customer_id", "full_outer").select(
        "customer_id",
        F.greatest(c("o", "last_purchase"), c("n", "last_purchase")).alias("last_purchase"),
        F.least(c("o", "first_purchase"), c("n", "first_purchase")).alias("first_purchase"),
        (F.coalesce(c("o", "invoices"), F.lit(0)) + F.coalesce(c("n", "invoices"), F.lit(0))).cast("int").alias("invoices"),
        (F.coalesce(c("o", "lines"), F.lit(0)) + F.coalesce(c("n", "lines"), F.lit(0))).cast("int").alias("lines"),
        _add(c("o", "net_amount"), c("n", "net_amount")).cast(money.SUM_TYPE).alias("net_amount"),
        _add(c("o", "gross_amount"), c("n", "gross_amount")).cast(money.SUM_TYPE).alias("gross_amount"),
        F.least(c("o", "first_sale"), c("n", "first_sale")).alias("first_sale"),
        F.greatest(c("o", "last_sale"), c("n", "last_sale")).alias("last_sale"),
    )


def _paths(state: str, batch_id: int) -> tuple[str, str, str]:
    root = state.rstrip("/")
    return f"{root}/customers", f"{root}/pairs/batch={batch_id:010d}", f"{root}/pairs"


def apply_batch(spark: SparkSession, batch: DataFrame, batch_id: int, state: str) -> None:
    """Fold one micro-batch of order lines into the stored customer table."""
    base_dir, pairs_out, pairs_dir = _paths(state, batch_id)
    grain = materialize(_invoice_grain(with_amount(valid_customer(batch))), "batch_invoices")
    pairs = grain.where(F.col("invoice").isNotNull()).select("customer_id", "invoice")
    seen = None
    earlier = [
        p for p in _batch_folders(spark, pairs_dir) if p < batch_id
    ]
    if earlier:
        seen = spark.read.parquet(*[f"{pairs_dir}/batch={b:010d}" for b in earlier])
    fresh = pairs if seen is None else pairs.join(seen, ["customer_id", "invoice"], "left_anti")
    fresh.write.mode("overwrite").parquet(pairs_out)
    new_invoices = spark.read.parquet(pairs_out).groupBy("customer_id").agg(
        F.count(F.lit(1)).cast("int").alias("invoices")
    )
    agg = _batch_aggregates(grain).join(new_invoices, "customer_id", "left").withColumn(
        "invoices", F.coalesce(F.col("invoices"), F.lit(0))
    )
    previous = [v for v in tables.versions(spark, base_dir) if v <= batch_id]
    old = spark.read.parquet(f"{base_dir}/{tables.VERSION_PREFIX}{previous[-1]:08d}") if previous else None
    out = f"{base_dir}/{tables.VERSION_PREFIX}{batch_id + 1:08d}"
    merge(old, agg.select(*BASE_COLUMNS)).write.mode("overwrite").parquet(out)
    release(grain)


def _batch_folders(spark: SparkSession, pairs_dir: str) -> list[int]:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(pairs_dir)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    out = []
    for st in fs.listStatus(hpath):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("batch="):
            out.append(int(name[len("batch="):]))
    return sorted(out)


def update_customers(
    spark: SparkSession, landing: str, state: str, checkpoint: str
) -> tuple[DataFrame, int]:
    """Fold every not-yet-seen file under ``landing`` into the customer table
    at ``state``; returns (current table, row count) — the ``base`` argument
    of the customer analyses."""
    query = (
        orders_stream(spark, landing)
        .writeStream.foreachBatch(lambda df, bid: apply_batch(spark, df, bid, state))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    table = tables.read_current(spark, f"{state.rstrip('/')}/customers")
    if table is None:
        raise ValueError(f"no order lines under {landing}")
    return table, table.count()
