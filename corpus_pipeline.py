"""A training corpus from raw documents: quality rules, line dedup, near-dedup, decontamination, mixing.

Each stage takes the documents that the one before it has kept, as written to Parquet, and all but the
last return the columns of documents; the last returns the mixed blocks with their texts.

Nulls, empty and long texts, ties and repeated rows are treated as the operators say; in short: texts
of fewer than ten words (null and empty ones, too) go in the first stage, and rows without a doc_id
take no part in the two comparisons between documents.  Documents of which line dedup leaves no word
go.  Further columns of documents come through unchanged, whatever their names.  Empty tables give
empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm import decontamination, line_dedup, mixing, near_duplicates, quality_rules
from jobtide.llm.scratch import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _with_extras(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Runs a stage on the known columns, the others packed into one, and unpacks them."""
    extra = [c for c in docs.columns if c not in COLUMNS]
    if not extra:
        return stage(docs).select(*docs.columns)
    packed = F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(extra)]).alias("_packed")
    found = stage(docs.select(*[docs[c] for c in docs.columns if c in COLUMNS], packed))
    back = {c: F.col(f"_packed.c{i}").alias(c) for i, c in enumerate(extra)}
    return found.select(*[back.get(c, F.col(c)) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return _with_extras(docs, lambda d: quality_rules.judge(d).where("kept"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier one; n_chars is that of the new text."""

    def stage(d: DataFrame) -> DataFrame:
        found = line_dedup.without_repeats(d)
        has_word = F.col("text").rlike(mixing.WORD) | (F.size("removed") == 0)
        found = found.where(F.coalesce(has_word, F.lit(True)))
        if "n_chars" in found.columns:
            size = F.char_length("text").cast(d.schema["n_chars"].dataType)
            found = found.withColumn("n_chars", F.when(F.size("removed") > 0, size).otherwise(F.col("n_chars")))
        return found

    return _with_extras(docs, stage)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity of 0.8 or more."""
    return near_duplicates.without_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _with_extras(docs, lambda d: decontamination.decontaminated(d, benchmark))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus: blocks of words by shard and place, with the parts of documents in them."""
    return mixing.mix(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing sources", mix),
]

#: Perplexity bands, edit joins, component search and random draws are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
