"""A stored history of postings to which runs are added, each key once.

Two tables grow together: the rows, partitioned by run, and the keys met so far, partitioned by run and
bucketed by key.  A run reads its own rows and the keys of earlier runs; as these lie in buckets, only the
run's rows are shuffled, never the history.  Writing replaces the run's own partitions, so a run that is
repeated after a failure, or by mistake, leaves the same tables as one that went through at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.functions.text import safe_timestamp
from jobtide.operators.rows import keep_first
from jobtide.sources.files import stamp_run, write_run

BUCKETS = 200
RUN = "run_ts"


@dataclass(frozen=True)
class History:
    """Where a history is kept: a folder for rows, and a catalog table with a folder for keys.

    ``keys`` identify a posting, ``order`` (which must not tie within a key) tells which row of a run is
    its first.  Both folders must be shared by all executors.
    """

    rows_path: str
    key_table: str
    key_path: str
    keys: tuple[str, ...]
    order: tuple[str, ...]
    buckets: int = BUCKETS

    def known_keys(self, spark: SparkSession, before: str) -> DataFrame:
        """Keys of the runs before the given one."""
        return spark.table(self.key_table).where(F.col(RUN) < safe_timestamp(F.lit(before))).select(*self.keys)

    def new_rows(self, batch: DataFrame, run_ts: str) -> DataFrame:
        """The first row of each key of the batch that no earlier run has met.

        Rows without a key are left out (``conform.fallback_id`` gives them one beforehand).
        """
        first = keep_first(batch.dropna(subset=list(self.keys)), self.keys, self.order)
        spark = batch.sparkSession
        if not spark.catalog.tableExists(self.key_table):
            return first
        return first.join(self.known_keys(spark, run_ts), list(self.keys), "left_anti").select(*batch.columns)

    def add(self, batch: DataFrame, run_ts: str) -> None:
        """Adds what is new in a run.  Runs are added in the order of their timestamps.

        If an earlier run is repeated with other rows than before, the later ones must be repeated, too.
        A run without any new row leaves what was stored for its timestamp.
        """
        spark = batch.sparkSession
        write_run(self.new_rows(batch, run_ts), self.rows_path, run_ts)
        # The keys are taken from what was written, so both tables agree even if the batch cannot be read twice alike.
        stored = spark.read.schema(stamp_run(batch, run_ts).schema).parquet(self.rows_path)
        own = stored.where(F.col(RUN) == safe_timestamp(F.lit(run_ts))).select(*self.keys, RUN)
        own = own.repartition(self.buckets, *self.keys)
        if spark.catalog.tableExists(self.key_table):
            own.write.insertInto(self.key_table, overwrite=True)
        else:
            # The option stays with the table: what is inserted replaces the partition of its run only.
            writer = own.write.format("parquet").options(path=self.key_path, partitionOverwriteMode="dynamic")
            writer.partitionBy(RUN).bucketBy(self.buckets, *self.keys).saveAsTable(self.key_table)

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.rows_path)


def add_runs(history: History, runs: Sequence[tuple[str, DataFrame]]) -> None:
    """Adds several runs, the earliest first."""
    for run_ts, batch in sorted(runs, key=lambda run: run[0]):
        history.add(batch, run_ts)
