"""Versioned tables, publishing, refresh of the bronze table, display order, rounding."""

import os
import shutil
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tillroll import registry
from tillroll.functions import money
from tillroll.plans import publish, rfm
from tillroll.session import materialize, release
from tillroll.sources import tables

have_data = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")


def test_a_failed_write_does_not_block_the_next(spark, tmp_path):
    base = f"{tmp_path}/t"
    tables.write_version(spark.range(3), base)
    os.makedirs(f"{base}/v=00000002")  # a write that ended without _SUCCESS
    assert tables.read_current(spark, base).count() == 3
    path = tables.write_version(spark.range(5), base)
    assert path.endswith("v=00000003") and tables.read_current(spark, base).count() == 5
    tables.write_version(spark.range(6), base)
    tables.expire(spark, base, keep=2)
    assert tables.versions(spark, base, finished=False) == [3, 4]


def test_released_tables_are_gone(spark):
    held = materialize(spark.range(10), "t")
    assert held.count() == 10
    path = held._scratch_path.removeprefix("file:")
    assert os.path.isdir(path)
    release(held)
    assert not os.path.exists(path)


@have_data
def test_publish_counts_both_inputs(spark, tmp_path):
    scores = registry.QUERIES["customer_rfm"](spark, SF_SMALL)
    n = scores.count()
    base = f"{tmp_path}/r"
    publish.publish_results(spark, scores.where("customer_id % 2 = 0"), base)
    publish.publish_results(spark, scores.where("customer_id % 3 = 0"), base)
    want = scores.where("customer_id % 2 = 0 OR customer_id % 3 = 0").count()
    assert publish.read_results(spark, base).count() == want < n
    with pytest.raises(ValueError, match="more than one"):
        publish.publish_results(spark, scores.union(scores), base)
    with pytest.raises(ValueError, match="no rows to merge"):
        publish.publish_results(spark, scores.limit(0), base)


@have_data
def test_bronze_follows_its_sources(spark, tmp_path):
    for name in ("lineitem", "orders", "customer", "nation", "part"):
        shutil.copy(f"{SF_SMALL}/{name}.parquet", tmp_path)
    first = registry.orders_view(spark, str(tmp_path))
    assert registry.orders_view(spark, str(tmp_path)) is first
    n = first.count()
    half = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").where("l_linenumber <= 2")
    want = half.count()
    half.coalesce(1).write.parquet(f"{tmp_path}/new")
    (part,) = [f for f in os.listdir(f"{tmp_path}/new") if f.endswith(".parquet")]
    os.replace(f"{tmp_path}/new/{part}", f"{tmp_path}/lineitem.parquet")
    assert registry.orders_view(spark, str(tmp_path)).count() == want < n


@have_data
@pytest.mark.parametrize(
    "name,column,key",
    [
        ("rfm_detail", "Montant (€)", "ID"),
        ("product_listing", "monetary", "stock_code"),
        ("churn_mart", "churn_score", "customer_id"),
        ("clv_mart", "clv_24months", "customer_id"),
    ],
)
def test_listings_are_ordered(spark, name, column, key):
    rows = [(r[column], r[key]) for r in registry.QUERIES[name](spark, SF_SMALL).collect()]
    assert rows == sorted(rows, key=lambda r: (-r[0], r[1])) and len(rows) > 50


def test_roundings(spark):
    df = spark.createDataFrame([(Decimal("2.675"), 2.5), (Decimal("-0.125"), 3.5)], "d decimal(10,3), x double")
    out = df.select(money.round_to(F.col("d"), 2), money.round_even(F.col("x"), 0)).collect()
    assert [tuple(r) for r in out] == [(2.68, 2.0), (-0.13, 4.0)]


def test_rfm_columns_are_complete():
    assert rfm.RFM_COLUMNS[0] == "customer_id" and rfm.RFM_COLUMNS[-1] == "segment"
