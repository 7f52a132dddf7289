"""Incremental ingest of a landing folder of order-line CSV files.

The batch ingest re-reads the whole folder on every run. As a stream, the
file source remembers which files it has already taken (in the checkpoint),
so each run converts only new files into the bronze parquet table;
``availableNow`` processes everything present and stops, which suits a
scheduled job. The conversion is the same stateless projection as the batch
reader, so batch and stream produce identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.schemas import CSV_COLUMNS
from tillroll.sources.csv_orders import reader, to_orders


def orders_stream(spark: SparkSession, landing: str, max_files: int | None = None) -> DataFrame:
    """A stream has one schema: a file whose header is not the raw layout fails."""
    source = reader(spark.readStream, CSV_COLUMNS, True)
    if max_files:
        source = source.option("maxFilesPerTrigger", max_files)
    return to_orders(source.csv(landing))


def ingest_available(
    spark: SparkSession, landing: str, bronze: str, checkpoint: str
) -> DataFrame:
    """Append every not-yet-ingested file under ``landing`` to ``bronze``
    (parquet), then return the bronze table."""
    query = (
        orders_stream(spark, landing)
        .writeStream.format("parquet")
        .option("path", bronze)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return spark.read.parquet(bronze)
