import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, line
from tillroll.plans import customers
from tillroll.session import scratch_path
from tillroll.sources import csv_orders, export
from tillroll.sources.testdata import orders_view
from tillroll.streaming import customer_state

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")


def test_incremental_customer_table_equals_batch(spark):
    orders = orders_view(spark, SF_SMALL, cancel_prefix=True)
    landing, state, ckpt = (scratch_path(spark, n) for n in ("t-landing", "t-state", "t-ckpt"))
    for i in range(3):  # three deliveries, three runs
        export.export_raw_orders(orders.where(F.pmod(F.xxhash64("invoice"), F.lit(3)) == i), landing, "append")
        table, n = customer_state.update_customers(spark, landing, state, ckpt)
    batch, m = customers.customer_base(csv_orders.read_orders(spark, landing))
    cols = customer_state.BASE_COLUMNS
    assert n == m
    assert sorted(table.select(*cols).collect()) == sorted(batch.select(*cols).collect())


def test_rerun_of_a_batch_gives_the_same_table(spark):
    orders = orders_view(spark, SF_SMALL)
    state = scratch_path(spark, "t-rerun")
    early = F.col("invoice_date") < F.lit("1998-01-01").cast("timestamp_ntz")
    part = orders.where(early)
    rest = orders.where(~early | F.col("invoice_date").isNull())
    customer_state.apply_batch(spark, part, 0, state)
    customer_state.apply_batch(spark, rest, 1, state)
    first = sorted(spark.read.parquet(f"{state}/customers/v=00000002").collect())
    customer_state.apply_batch(spark, rest, 1, state)  # replayed after a failure
    again = sorted(spark.read.parquet(f"{state}/customers/v=00000002").collect())
    assert first == again
    batch, _ = customers.customer_base(orders)
    assert first == sorted(batch.select(*customer_state.BASE_COLUMNS).collect())


def test_a_batch_is_parsed_once(spark, make_orders, tmp_path):
    rows = [line(f"i{k % 5}", "s", 1, "2020-01-01 10:00", 2, k % 3) for k in range(20)]
    parsed = spark.sparkContext.accumulator(0)

    def customer(c):
        parsed.add(1)
        return c

    parse = F.udf(customer, "long").asNondeterministic()
    batch = make_orders(rows + [line(None, "s", 1, "2020-01-01 10:00", 2, 0)]).withColumn("customer_id", parse("customer_id"))
    customer_state.apply_batch(spark, batch, 0, str(tmp_path))
    assert parsed.value == 21
    got = {r.customer_id: r for r in spark.read.parquet(f"{tmp_path}/customers/v=00000001").collect()}
    assert {c: (r.invoices, r.lines, int(r.net_amount)) for c, r in got.items()} == {0: (5, 8, 16), 1: (5, 7, 14), 2: (5, 6, 12)}
