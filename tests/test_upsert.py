import datetime as dt

from pyspark.sql import functions as F

from tillroll.sources.upsert import upsert

T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 2, 1)


def test_upsert_changed_new_and_vanished(spark):
    existing = spark.createDataFrame(
        [(1, "a", T0, T0), (2, "b", T0, T0)], "customer_id long, segment string, created_at timestamp, updated_at timestamp"
    )
    updates = spark.createDataFrame([(2, "B"), (3, "c")], "customer_id long, segment string")
    out = {r.customer_id: r for r in upsert(existing, updates, "customer_id", F.lit(T1).cast("timestamp")).collect()}
    assert out[1].segment == "a" and out[1].updated_at == T0  # vanished key stays
    assert out[2].segment == "B" and out[2].created_at == T0 and out[2].updated_at == T1
    assert out[3].segment == "c" and out[3].created_at == T1


def test_upsert_is_idempotent(spark):
    updates = spark.createDataFrame([(2, "B"), (3, "c")], "customer_id long, segment string")
    once = upsert(None, updates, "customer_id", F.lit(T0).cast("timestamp"))
    twice = upsert(once, updates, "customer_id", F.lit(T1).cast("timestamp"))
    key = lambda df: sorted((r.customer_id, r.segment, r.created_at) for r in df.collect())
    assert key(once) == key(twice)
