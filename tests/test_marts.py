import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tillroll.plans.marts import DeliveredMarts, Marts, folder_fingerprint
from tillroll.session import scratch_path
from tillroll.sources import csv_orders, export
from tillroll.sources.testdata import orders_view

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")


def rows(df):
    return sorted(map(str, df.collect()))


def test_delivered_marts_equal_a_full_rebuild(spark):
    orders = orders_view(spark, SF_SMALL, cancel_prefix=True)
    landing, state, ckpt = (scratch_path(spark, n) for n in ("m-landing", "m-state", "m-ckpt"))
    part = F.pmod(F.xxhash64("invoice", "stock_code"), F.lit(3))
    held = DeliveredMarts(spark, landing, state, ckpt, ttl_seconds=0)
    for i in range(3):
        export.export_raw_orders(orders.where(part == i), landing, "append")
        mart = held.get("rfm")
        assert held.get("rfm") is mart  # nothing delivered, nothing rebuilt
        whole = Marts(lambda: csv_orders.read_orders(spark, landing))
        for name in ("rfm", "churn", "clv"):
            assert rows(held.get(name)) == rows(whole.get(name)), (i, name)
        whole.close()
    # a new process goes on from the folders
    again = DeliveredMarts(spark, landing, state, ckpt, ttl_seconds=0)
    assert rows(again.get("clv")) == rows(held.get("clv"))
    again.close()
    held.close()


def test_a_delivery_that_changes_raises(spark):
    orders = orders_view(spark, SF_SMALL)
    landing, state, ckpt = (scratch_path(spark, n) for n in ("c-landing", "c-state", "c-ckpt"))
    export.export_raw_orders(orders, landing)
    held = DeliveredMarts(spark, landing, state, ckpt, ttl_seconds=0)
    held.get("churn")
    before = folder_fingerprint(spark, landing)
    export.export_raw_orders(orders.where("quantity > 3"), landing)  # overwritten
    assert folder_fingerprint(spark, landing) != before
    with pytest.raises(ValueError, match="changed or went away"):
        held.get("churn")
    held.close()


def test_marts_are_kept_while_their_source_stays(spark):
    seen = ["a"]
    marts = Marts(lambda: orders_view(spark, SF_SMALL), ttl_seconds=0, source=lambda: seen[0])
    first = marts.get("geo")
    assert marts.get("geo") is first
    seen[0] = "b"
    assert marts.get("geo") is not first and not first.is_cached
    marts.close()


def test_fingerprint_of_an_empty_folder(spark):
    folder = scratch_path(spark, "f-empty")
    spark.range(0).write.parquet(folder)
    files, _ = folder_fingerprint(spark, folder)
    assert files <= 1  # at most the file that holds the schema
