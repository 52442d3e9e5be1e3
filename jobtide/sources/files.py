"""CSV and Parquet.  Parquet is the format between stages, CSV the one for exchange."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from jobtide.functions.rules import MAX_RULE_ROWS, RULE_SCHEMA, RuleSet
from jobtide.functions.text import safe_timestamp

MACRO_REGION_SCHEMA = "region string, quarter string, vacancies double, year int"
MACRO_INDUSTRY_SCHEMA = "industry string, quarter string, vacancies double, year int"
MAX_ROWS_PER_FILE = 2_000_000


def read_csv(
    spark: SparkSession, path: str, schema: str | StructType | None, multi_line: bool = True
) -> DataFrame:
    """Header, RFC 4180 quoting, line breaks inside quotes.

    A file with quoted line breaks cannot be split, so the writer below keeps files small and a
    folder is read in parallel by file.  Where no cell holds a line break, ``multi_line=False``
    lets one file be read by many tasks.  Without a schema every column is text (no extra pass to
    guess types).
    """
    reader = (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("mode", "PERMISSIVE")
    )
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def write_csv(
    df: DataFrame, path: str, mode: str = "overwrite", rows_per_file: int = MAX_ROWS_PER_FILE
) -> None:
    """CSV folder with headers; arrays are written as JSON list text, as CSV has no arrays."""
    flat = df.select(
        *[
            F.to_json(f.name).alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name)
            for f in df.schema.fields
        ]
    )
    (
        flat.write.mode(mode)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", rows_per_file)
        .csv(path)
    )


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by=()) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def run_timestamp() -> str:
    """One ISO timestamp per run, seconds precision."""
    return datetime.now().isoformat(timespec="seconds")


def stamp_run(df: DataFrame, run_ts: str) -> DataFrame:
    """The run timestamp on every row, and the file-name form as partition column."""
    return df.withColumn("scraped_at", F.lit(run_ts)).withColumn(
        "run_ts", safe_timestamp(F.lit(run_ts))
    )


def write_run(df: DataFrame, path: str, run_ts: str) -> None:
    """Writes one run to a table partitioned by run.

    Earlier runs stay as they are, and a run that is written again replaces itself.
    """
    writer = stamp_run(df, run_ts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("run_ts").parquet(path)


def union_tagged(batches: dict[str, DataFrame], tag_column: str = "search_term") -> DataFrame:
    """All batches in one table, each row tagged with its batch; absent columns become null."""
    parts = [df.withColumn(tag_column, F.lit(tag)) for tag, df in batches.items()]
    if not parts:
        raise ValueError("no batches")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def read_rules(spark: SparkSession, path: str, max_rows: int = MAX_RULE_ROWS) -> RuleSet:
    """Rule table from CSV, or from JSON lines where the path ends in ``.json``.

    The driver holds the rules; a table of more than ``max_rows`` keywords is refused.
    """
    if path.endswith(".json"):
        return RuleSet.from_table(spark.read.schema(RULE_SCHEMA).json(path), max_rows)
    return RuleSet.from_table(read_csv(spark, path, RULE_SCHEMA), max_rows)
