"""Tables that cut lineage, in the folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.session import scratch_path

#: Bytes of text that one Arrow batch may carry to a Python worker, so that
#: very long documents do not add up to a batch that fills its memory.
BATCH_BYTES = 16 << 20


def bounded_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


class Scratch:
    """Written tables of one operator call.

    ``keep`` writes a frame once and reads it back, so a lost executor never
    recomputes it with other rows; ``drop`` removes a table whose last reader
    has itself been written. Tables behind a returned (lazy) frame stay; expire
    the folder with the storage's lifecycle rules.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = scratch_path(spark, name)
        self.count = 0
        bounded_batches(spark)

    def keep(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.mode("error").parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept._scratch = path
        return kept

    def drop(self, *kept: DataFrame) -> None:
        jvm = self.spark._jvm
        for df in kept:
            path = jvm.org.apache.hadoop.fs.Path(df._scratch)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes to be none of ``columns``."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
