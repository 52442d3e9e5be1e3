"""Running totals over a whole table without ordering it in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobtide.session import scratch_dir


def running_total(df: DataFrame, order: Sequence[str], value: str, out: str = "total") -> DataFrame:
    """The rows with the sum of ``value`` over all rows up to and including them, in order.

    ``order`` must tell every two rows apart.  A null value counts as 0.  The rows are dealt into
    blocks by ranges of the order and written, so that a lost executor cannot deal them anew; each block
    is summed by itself, and gets the total of the blocks before it.  The driver holds one number for
    each block, of which there are as many as shuffle partitions.
    """
    spark = df.sparkSession
    folder = scratch_dir(spark)
    placed = df.repartitionByRange(*order).withColumn("_block", F.spark_partition_id())
    placed.write.parquet(folder)
    rows = spark.read.schema(placed.schema).parquet(folder)
    amount = F.coalesce(F.col(value), F.lit(0).cast(df.schema[value].dataType))
    sums = rows.groupBy("_block").agg(F.sum(amount).alias("_sum"))
    kind = sums.schema["_sum"].dataType
    before, total = [], None
    for row in sorted(sums.collect(), key=lambda r: r["_block"]):
        before.append((row["_block"], total))
        total = row["_sum"] if total is None else total + row["_sum"]
    offsets = spark.createDataFrame(before, f"_block int, _before {kind.simpleString()}")
    within = W.partitionBy("_block").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    local = rows.withColumn(out, F.sum(amount).over(within))
    zero = F.lit(0).cast(kind)
    return local.join(offsets, "_block").withColumn(out, F.col(out) + F.coalesce("_before", zero)).drop("_block", "_before")
