"""Shared pieces of the registered queries."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.functions.lexicon import Lexicon
from jobtide.functions.tags import dictionary_tags

BASE_URL = "https://jobs.example.com"


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, key: str, *columns: str) -> DataFrame:
    """The columns of a stored table, on all cores where its scan has fewer splits than that.

    A file with one row group is read by one task, and everything up to the next shuffle stays in
    it.  The split count of a bare scan is known without starting a job.
    """
    scan = table(spark, sf_dir, name).select(key, *columns)
    cores = spark.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores, key)


# Words of the test texts, in place of skills.  Some share their start, some overlap, one ends in
# a mark (it counts only before a word character, as a word edge asks for).
TERMS = (
    "the", "of the", "of", "in", "to the", "license", "apache", "mit", "la", "la la", "des",
    "der", "und", "die", "que", "el", "los", "para", "tion", "r", "with", "and the", "un", "en.",
)
WORDS = Lexicon.of(TERMS)

SQL_EDGE = r"[^\p{L}\p{N}_]"
SQL_SPACE = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def sql_has_word(text: str, term: str) -> str:
    """Whole-word test in SQL; a term that ends in a mark needs a word character behind it."""
    word_end = term[-1].isalnum() or term[-1] == "_"
    after = f"($|{SQL_EDGE})" if word_end else r"[\p{L}\p{N}_]"
    pattern = f"(^|{SQL_EDGE})" + re.escape(term).replace("\\ ", " ") + after
    return f"regexp_matches({text}, '{pattern}')"


def sql_hits(table_sql: str, key: str, text: str, terms) -> str:
    """(key, term) for every term found: one literal pattern per term, compiled once."""
    return " UNION ALL ".join(
        f"SELECT {key}, '{t}' AS term FROM {table_sql} "
        f"WHERE strpos({text}, '{t}') > 0 AND {sql_has_word(text, t)}"
        for t in terms
    )


SQL_HITS = f"""
lowered AS MATERIALIZED (SELECT doc_id, lower(text) AS body FROM documents),
hits AS MATERIALIZED ({sql_hits('lowered', 'doc_id', 'body', TERMS)})"""


def tagged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the list of dictionary words found in the whole text."""
    docs = spread_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source", "n_chars")
    return docs.withColumn("tags", dictionary_tags("text", lexicon=WORDS)).drop("text")


def document_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and their labels in the shape of a posting table."""
    labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "_label_id")
    docs = tagged_documents(spark, sf_dir)
    df = docs.join(labels, F.col("doc_id") == F.col("_label_id"), "left")
    n = F.col("n_chars")
    return df.select(
        F.col("doc_id").cast("string").alias("job_id"),
        F.concat_ws(" ", "source", "lang").alias("title"),
        F.col("source").alias("company"),
        F.col("lang").alias("role"),
        F.concat(F.lit("Region "), F.pmod(n, F.lit(5)).cast("string")).alias("region"),
        F.when(n % 7 > 0, F.concat(F.lit("C"), (n % 7).cast("string"))).alias("canton"),
        F.lit(None).cast("string").alias("city"),
        F.when(n % 3 > 0, F.concat((n % 3).cast("string"), F.lit(" Branch & trade"))).alias(
            "industry"
        ),
        F.when(F.col("quality") == 1, "senior").when(F.col("quality") == 0, "junior").alias(
            "seniority"
        ),
        F.when(n % 11 > 0, (n % 100).cast("int")).alias("workload_min"),
        F.when(n % 13 > 0, F.least(n % 100 + 20, F.lit(100)).cast("int")).alias("workload_max"),
        F.coalesce("toxic", F.lit(0)).alias("salary_available"),
        F.col("tags").alias("skills_list"),
        F.size("tags").alias("skill_count"),
        F.when(n % 5 < 4, (n % 5 * 1000).cast("double")).alias("macro_vacancies_region"),
    )


SQL_POSTINGS = f"""
{SQL_HITS},
counted AS (
  SELECT d.doc_id, count(h.term) AS skill_count
  FROM documents d LEFT JOIN hits h ON h.doc_id = d.doc_id GROUP BY d.doc_id
),
postings AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS job_id, d.doc_id,
    d.source || ' ' || d.lang AS title, d.source AS company, d.lang AS role,
    'Region ' || (n_chars % 5) AS region,
    CASE WHEN n_chars % 7 > 0 THEN 'C' || (n_chars % 7) END AS canton,
    CAST(NULL AS VARCHAR) AS city,
    CASE WHEN n_chars % 3 > 0 THEN (n_chars % 3) || ' Branch & trade' END AS industry,
    CASE quality WHEN 1 THEN 'senior' WHEN 0 THEN 'junior' END AS seniority,
    CASE WHEN n_chars % 11 > 0 THEN n_chars % 100 END AS workload_min,
    CASE WHEN n_chars % 13 > 0 THEN least(n_chars % 100 + 20, 100) END AS workload_max,
    coalesce(toxic, 0) AS salary_available, c.skill_count,
    CASE WHEN n_chars % 5 < 4 THEN CAST(n_chars % 5 * 1000 AS DOUBLE) END AS macro_vacancies_region
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
  JOIN counted c ON c.doc_id = d.doc_id
)"""
