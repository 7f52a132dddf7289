"""The five marts built together and kept in Spark's cache for a serving
process (the dashboard datasets read them repeatedly).

Built from one customer table (shared by RFM, churn and CLV), persisted
(memory, spilling to disk), rebuilt when older than ``ttl_seconds`` or on
``refresh()``; the previous build is unpersisted only after the new one is
complete, so readers never see a half-built set. Where the fingerprint of the
source is known (``source``), marts past their time are rebuilt only if it changed.

``DeliveredMarts`` keeps the customer marts of a folder of deliveries: a refresh
reads the new files only, folds them into the stored customer table
(streaming/customer_state.py) and scores that; lines delivered before are not read
again. The scores rank all customers, so they are computed for all of them, at
customer grain.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.plans import churn, clv, customers, geo, product, rfm
from tillroll.streaming import customer_state

MART_NAMES = ("rfm", "products", "churn", "geo", "clv")
DEFAULT_TTL_SECONDS = 300


def folder_fingerprint(spark: SparkSession, folder: str) -> tuple[int, int]:
    """(files, sum of digests of their paths, sizes and times of change) of a folder;
    the files are listed, not opened."""
    listed = spark.read.format("binaryFile").load(folder)
    digest = F.xxhash64("path", "length", "modificationTime").cast("decimal(20,0)")
    files, digests = listed.agg(F.count(F.lit(1)), F.coalesce(F.sum(digest), F.lit(0).cast("decimal(30,0)"))).first()
    return files, int(digests)


class Marts:
    def __init__(
        self,
        orders: Callable[[], DataFrame],
        ttl_seconds: float = DEFAULT_TTL_SECONDS,
        source: Callable[[], object] | None = None,
    ):
        """``orders``: returns the order-line frame to build from (re-read on rebuild).
        ``source``: returns the fingerprint of what ``orders`` reads."""
        self._orders = orders
        self._source = source
        self._built_from: object = None
        self.ttl_seconds = ttl_seconds
        self._marts: dict[str, DataFrame] = {}
        self._built_at = 0.0

    def _build(self) -> dict[str, DataFrame]:
        orders = self._orders()
        base = customers.customer_base(orders)
        scores = rfm.customer_rfm(orders, base=base).persist(StorageLevel.MEMORY_AND_DISK)
        marts = {
            "rfm": scores,
            "products": product.product_rfm(orders).persist(StorageLevel.MEMORY_AND_DISK),
            "churn": churn.churn_risk(orders, base=base).persist(StorageLevel.MEMORY_AND_DISK),
            "geo": geo.geographic_analysis(orders).persist(StorageLevel.MEMORY_AND_DISK),
            "clv": clv.clv_from_base(scores, base).persist(StorageLevel.MEMORY_AND_DISK),
        }
        for df in marts.values():
            df.count()  # materialize the cache now, not on the first reader
        return marts

    def _replace(self, seen: object) -> None:
        """``seen``: the source's fingerprint from before the build, so what arrives
        while it runs is found by the next look."""
        new = self._build()
        old, self._marts, self._built_at, self._built_from = self._marts, new, time.monotonic(), seen
        for df in old.values():
            df.unpersist()

    def refresh(self) -> None:
        self._replace(self._source() if self._source else None)

    def get(self, name: str) -> DataFrame:
        if not self._marts:
            self.refresh()
        elif time.monotonic() - self._built_at > self.ttl_seconds:
            seen = self._source() if self._source else None
            if seen is None or seen != self._built_from:
                self._replace(seen)
            else:
                self._built_at = time.monotonic()
        return self._marts[name]

    def close(self) -> None:
        for df in self._marts.values():
            df.unpersist()
        self._marts = {}


class DeliveredMarts(Marts):
    """The customer marts (rfm, churn, clv) of the order-line files under ``landing``.

    ``state`` and ``checkpoint`` hold the customer table and the files that it has; a
    new process with the same folders goes on from there. Files are delivered once: a
    folder that has changed without more files than it had raises, as a changed or
    removed file cannot be taken back out of the customer table.
    """

    def __init__(self, spark: SparkSession, landing: str, state: str, checkpoint: str, ttl_seconds: float = DEFAULT_TTL_SECONDS):
        self._spark, self._folders = spark, (landing, state, checkpoint)
        super().__init__(lambda: None, ttl_seconds, self._delivered)

    def _delivered(self) -> tuple[int, int]:
        seen = folder_fingerprint(self._spark, self._folders[0])
        if self._built_from and seen != self._built_from and seen[0] <= self._built_from[0]:
            raise ValueError(f"delivered files under {self._folders[0]} changed or went away")
        return seen

    def _build(self) -> dict[str, DataFrame]:
        base = customer_state.update_customers(self._spark, *self._folders)
        table = base[0]
        scores = rfm.customer_rfm(table, base=base).persist(StorageLevel.MEMORY_AND_DISK)
        marts = {
            "rfm": scores,
            "churn": churn.churn_risk(table, base=base).persist(StorageLevel.MEMORY_AND_DISK),
            "clv": clv.clv_from_base(scores, base).persist(StorageLevel.MEMORY_AND_DISK),
        }
        for df in marts.values():
            df.count()
        return marts
