"""Publishing the customer RFM table: guard against an empty input, round
monetary to DECIMAL(10,2) (half up; overflow fails under ANSI), merge on
customer id into the persisted results (customers absent from this run keep
their previous row). The results are a keyed table (``sources.keyed``): only the
buckets that the run touches are rewritten, row counts are observed as they are
written and checked against what both inputs hold, old versions are deleted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.plans.rfm import RFM_COLUMNS
from tillroll.sources import keyed
from tillroll.sources.upsert import upsert

RESULT_MONEY = "decimal(10,2)"


def results_rows(rfm: DataFrame) -> DataFrame:
    return rfm.select(*[F.col(c).cast(RESULT_MONEY).alias(c) if c == "monetary" else F.col(c) for c in RFM_COLUMNS])


def merge_results(rfm: DataFrame, existing: DataFrame | None) -> DataFrame:
    """The merged results (lazy): business columns + created_at / updated_at."""
    return upsert(existing, results_rows(rfm), "customer_id")


def publish_results(spark: SparkSession, rfm: DataFrame, base: str, buckets: int = keyed.BUCKETS) -> str:
    """Merge into the keyed table at ``base`` (made where there is none): the buckets
    of the customers in ``rfm`` are rewritten, the others stay as they are. Returns
    ``base``; :func:`read_results` reads it."""
    try:
        keyed.merge(spark, base, results_rows(rfm), "customer_id", buckets=buckets)
    except ValueError as e:
        raise ValueError(f"cannot publish RFM results: {e}") from None
    return base


def read_results(spark: SparkSession, base: str) -> DataFrame | None:
    return keyed.read(spark, base)
