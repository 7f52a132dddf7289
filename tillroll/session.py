"""Session construction and lineage cutting.

The analyses are lazy DataFrame -> DataFrame functions over tables they write
once: :func:`materialize` runs a job and writes a grain table (the bronze lines,
customers, products, countries, value counts, sorted cut-point keys) into the
folder the cluster names in ``spark.checkpoint.dir``; :func:`release` deletes a
table whose last reader is done. Building a query therefore runs those jobs.
"""

from __future__ import annotations

import os
import tempfile
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Settings every session should carry: wall-clock arithmetic in UTC, ANSI
# semantics, adaptive execution (partition coalescing, skew-join splitting).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.exchange.reuse": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # no call site for every column expression: it costs more than the planning
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "tillroll",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with :data:`BASE_CONF` applied.

    ``master`` is left to ``spark-submit`` when None. On a cluster,
    ``shuffle_partitions`` should be sized so that a shuffle partition is
    ~128-256 MB at the target scale; AQE coalesces it down on small inputs.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra_conf:
        conf.update(extra_conf)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it only where it is unset.

    Order: the folder already on the SparkContext, then the session setting
    ``spark.checkpoint.dir``; only a local-mode session (tests, laptops) gets a
    fresh temporary folder. A cluster session without the setting is an error:
    a machine-local folder would not survive the loss of an executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext, use the session setting
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        path = tempfile.mkdtemp(prefix="tillroll-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/ABFS) "
        "so materialized plans survive executor loss"
    )


def materialize(df: DataFrame, name: str = "table", observe: dict[str, Column] | None = None) -> DataFrame:
    """Write ``df`` once as a parquet table under the shared checkpoint folder
    and return a frame reading it back.

    This cuts lineage like a reliable checkpoint and pins the values every later
    read sees, but runs a single job (``Dataset.checkpoint`` on an unpersisted
    plan computes it twice: once to count, once to write) and stores columnar,
    compressed files. Never a local checkpoint or machine-local folder: a lost
    executor must not force a recomputation that could produce different rows
    or partitions.

    ``observe``: aggregates taken of the rows as they are written, without a job of
    their own; :func:`observed` gives their values (with ``rows``, the row count).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    seen = None
    if observe is not None:
        seen = Observation()
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"), *(c.alias(k) for k, c in observe.items()))
    df.write.mode("error").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    if seen is not None:
        # a plan without rows may be cut off above the observation
        out._observed = {"rows": 0, **dict.fromkeys(observe), **seen.get}
    return out


def observed(df: DataFrame) -> dict[str, Any] | None:
    """The aggregates taken when the table was written, if any were."""
    return getattr(df, "_observed", None)


def release(*frames: DataFrame) -> None:
    """Delete the tables behind materialized frames whose last reader is done."""
    for df in frames:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._scratch_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique folder under the shared checkpoint folder for derived tables."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
