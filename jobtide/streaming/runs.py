"""Files of postings that land in a folder, each posting taken over once.

``ingest`` takes what has arrived since the last call and stops (``availableNow``), so it may be called by
a schedule.  Which files were read is in the checkpoint, so a call that failed is taken up where it
stopped, and a repeated posting is dropped as long as it arrives within ``delay`` of the first one, by the
time in the rows.  The state holds the keys of that span only, however long the stream runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def arriving(spark: SparkSession, landing: str, schema: str | StructType, files_per_batch: int | None = None) -> DataFrame:
    """A stream of the rows of Parquet files in a landing folder."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(landing)


def first_of_each(rows: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """Rows whose key did not come within ``delay`` before; rows without a time or key are left out."""
    known = rows.dropna(subset=[*keys, time])
    return known.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def ingest(
    spark: SparkSession, landing: str, schema: str | StructType, target: str, checkpoint: str, keys: Sequence[str],
    time: str, delay: str = "30 days", files_per_batch: int | None = None,
) -> int:
    """Takes over all files that have arrived; returns the number of batches of this call.

    ``target`` is partitioned by the day of ``time``.  The folders must be shared by all executors.
    """
    rows = first_of_each(arriving(spark, landing, schema, files_per_batch), keys, time, delay)
    writer = rows.withColumn("day", F.to_date(time)).writeStream.format("parquet").partitionBy("day")
    query = writer.option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(query.recentProgress)
