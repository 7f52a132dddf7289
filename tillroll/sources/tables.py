"""Table writes and reads on a shared file system.

Without a table format on the classpath, a table is a folder of versions:
each publish writes a complete new version folder, and readers take the
highest version. Writing never touches the live version, so a failed job
leaves the previous one readable (the 'swap' is the new folder becoming the
highest number).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION_PREFIX = "v="


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def versions(spark: SparkSession, base: str, finished: bool = True) -> list[int]:
    """Version numbers under ``base``: those written to the end, or all."""
    fs, hpath = _fs(spark, base)
    if not fs.exists(hpath):
        return []
    out = []
    for st in fs.listStatus(hpath):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(VERSION_PREFIX):
            fs2, done = _fs(spark, st.getPath().toString() + "/_SUCCESS")
            if not finished or fs2.exists(done):
                out.append(int(name[len(VERSION_PREFIX):]))
    return sorted(out)


def read_current(spark: SparkSession, base: str) -> DataFrame | None:
    vs = versions(spark, base)
    if not vs:
        return None
    return spark.read.parquet(f"{base.rstrip('/')}/{VERSION_PREFIX}{vs[-1]:08d}")


def write_version(df: DataFrame, base: str) -> str:
    """Write ``df`` as the next version of the table at ``base``; returns its path.
    Numbers go past every folder there, finished or not, so a write that failed
    never blocks the next one."""
    taken = versions(df.sparkSession, base, finished=False)
    path = f"{base.rstrip('/')}/{VERSION_PREFIX}{(taken[-1] if taken else 0) + 1:08d}"
    df.write.mode("error").parquet(path)
    return path


def expire(spark: SparkSession, base: str, keep: int = 2) -> None:
    """Delete all but the ``keep`` latest finished versions, and older unfinished ones."""
    done = versions(spark, base)
    if len(done) <= keep:
        return
    for v in versions(spark, base, finished=False):
        if v < done[-keep]:
            fs, path = _fs(spark, f"{base.rstrip('/')}/{VERSION_PREFIX}{v:08d}")
            fs.delete(path, True)


# Default display order of each mart when loaded whole (largest first).
MART_ORDER = {
    "rfm_analysis": [("monetary", False)],
    "product_rfm": [("monetary", False)],
    "churn_risk": [("churn_score", False)],
    "geographic_analysis": [("priority_rank", True)],
    "clv_forecast": [("clv_24months", False)],
}
MART_KEY = {
    "rfm_analysis": "customer_id",
    "product_rfm": "stock_code",
    "churn_risk": "customer_id",
    "geographic_analysis": "country",
    "clv_forecast": "customer_id",
}


def in_mart_order(df: DataFrame, mart: str) -> DataFrame:
    """A whole mart in its display order (the key breaks ties): a distributed sort."""
    order = [F.col(c).asc() if asc else F.col(c).desc() for c, asc in MART_ORDER[mart]]
    return df.orderBy(*order, F.col(MART_KEY[mart]).asc())


def read_mart(spark: SparkSession, path: str, mart: str) -> DataFrame:
    return in_mart_order(spark.read.parquet(path), mart)


def check_count(df: DataFrame, expected: int, what: str) -> int:
    """Post-load row-count check (one count job on the written table)."""
    n = df.count()
    if n != expected:
        raise RuntimeError(f"{what}: expected {expected} rows, found {n}")
    return n


def bronze(orders: DataFrame) -> DataFrame:
    """Order lines as the bronze table: a surrogate ``transaction_id`` (unique,
    increasing within a partition, not dense — no global numbering pass) and
    audit stamps."""
    return with_audit(orders.select(F.monotonically_increasing_id().alias("transaction_id"), *orders.columns))


def with_audit(df: DataFrame) -> DataFrame:
    now = F.current_timestamp()
    return df.withColumn("created_at", now).withColumn("updated_at", now)
