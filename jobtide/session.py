"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "jobtide", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are written for.

    Adaptive execution picks join strategies and shuffle sizes from measured data; on a cluster
    the number of shuffle partitions is an upper bound that it coalesces.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Folder for written intermediate tables.

    On a cluster this is the shared folder named by ``spark.checkpoint.dir``.  Only where that is
    unset, and Spark runs on this one machine, a fresh local folder is made.
    """
    shared = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(
        CHECKPOINT_CONF
    )
    if shared:
        return f"{shared.rstrip('/')}/jobtide-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    return tempfile.mkdtemp(prefix="jobtide-")


def stored(df: DataFrame) -> DataFrame:
    """The rows, written to the scratch folder: worked out once, and of a size that Spark knows."""
    path = scratch_dir(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
