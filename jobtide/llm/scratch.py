"""Written intermediate tables in the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where that is unset, in local mode only, a local one."""
    found = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        found = getattr(spark.sparkContext, "_jobtide_llm_folder", None) or tempfile.mkdtemp(prefix="jobtide-llm-")
        spark.sparkContext._jobtide_llm_folder = found
    return found.rstrip("/")


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Writes a table once and reads it back: it cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
