"""Texts joined to tables of names and keywords."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.operators import textjoin
from jobtide.queries.common import Query, spread_table, table


def _names(spark, sf) -> DataFrame:
    """Customer names and the words of benchmark texts of five characters or more, ranked by text."""
    people = table(spark, sf, "customer").select(F.lower("c_name").alias("name"))
    words = table(spark, sf, "benchmark").select(F.explode(F.split(F.lower("text"), r"[ \n.,]+")).alias("name"))
    names = people.unionByName(words.where(F.char_length("name") >= 5)).distinct()
    return names.withColumn("rank", F.md5("name"))


def substring_join(spark, sf):
    """Per document the first name by rank that its text holds, and how many names it holds."""
    docs = spread_table(spark, sf, "documents", "doc_id", "text").select("doc_id", F.lower("text").alias("body"))
    found = textjoin.substring_join(docs, "doc_id", "body", _names(spark, sf), "name")
    return found.groupBy("doc_id").agg(
        F.min_by("name", "rank").alias("name"), F.min("rank").alias("rank"), F.count("*").alias("names")
    )


#: Numbers that each part name is combined with to a keyword: 200,000 of them at 0.01.
VARIANTS = 100


def _rules(spark, sf) -> DataFrame:
    """Keywords of two words and a number, by size and brand of the parts."""
    parts = table(spark, sf, "part").select(
        F.col("p_size").cast("int").alias("rule_order"), F.col("p_brand").alias("category"), F.lower("p_name").alias("_name")
    )
    # Equal parts give equal keywords, so they are put together before each is written out with its numbers.
    numbers = F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))).alias("k")
    return parts.distinct().select("*", numbers).select(
        "rule_order",
        "category",
        (F.col("k") + 1).alias("keyword_order"),
        F.concat_ws(" ", "_name", F.col("k").cast("string")).alias("keyword"),
    )


def _labels(spark, sf) -> DataFrame:
    """Texts of order lines: type, name and quantity of the part."""
    lines, part = table(spark, sf, "lineitem"), table(spark, sf, "part")
    met = lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
    body = F.concat_ws(" ", "p_type", "p_name", F.col("l_quantity").cast("int").cast("string"))
    # Equal labels meet the same keywords, so each is one text.
    return met.select(body.alias("label")).groupBy("label").agg(F.count("*").alias("lines"))


def rule_table_trace(spark, sf):
    labels = _labels(spark, sf)
    found = textjoin.keyword_hits(labels, "label", "label", _rules(spark, sf))
    return found.select("label", "rule_order", "category", "keyword_order", "keyword")


def rule_table_first(spark, sf):
    """The first rule that fires for each label, with the number of its order lines."""
    labels = _labels(spark, sf)
    found = textjoin.keyword_hits(labels, "label", "label", _rules(spark, sf))
    first = textjoin.first_rule(found, "label")
    return labels.join(first, "label", "left").select("label", "lines", "rule_order", "category", "keyword")


_LABELS = """
labels AS (
  SELECT p_type || ' ' || p_name || ' ' || CAST(l_quantity AS INTEGER) AS label, lower(p_name) AS name,
         CAST(l_quantity AS INTEGER) AS number, count(*) AS lines
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
rules AS (
  SELECT DISTINCT CAST(p_size AS INTEGER) AS rule_order, p_brand AS category, lower(p_name) AS name FROM part),
hits AS (
  SELECT label, rule_order, category, number + 1 AS keyword_order, name || ' ' || number AS keyword
  FROM labels JOIN rules USING (name) WHERE number BETWEEN 0 AND 99)"""

QUERIES: dict[str, Query] = {
    "substring_join": Query(
        substring_join,
        """
WITH names AS (
  SELECT DISTINCT name FROM (
    SELECT lower(c_name) AS name FROM customer
    UNION ALL SELECT unnest(regexp_split_to_array(lower(text), '[ \\n.,]+')) FROM benchmark)
  WHERE length(name) >= 5),
ranked AS (SELECT name, md5(name) AS rank FROM names),
hits AS (
  SELECT doc_id, name, rank FROM (SELECT doc_id, lower(text) AS body FROM documents), ranked
  WHERE contains(body, name))
SELECT doc_id, arg_min(name, rank) AS name, min(rank) AS rank, count(*) AS names FROM hits GROUP BY doc_id""",
    ),
    "rule_table_trace": Query(
        rule_table_trace,
        f"WITH {_LABELS} SELECT label, rule_order, category, keyword_order, keyword FROM hits",
    ),
    "rule_table_first": Query(
        rule_table_first,
        f"""WITH {_LABELS}, first AS (
              SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY label ORDER BY rule_order, keyword_order, category) = 1)
            SELECT labels.label, lines, rule_order, category, keyword
            FROM labels LEFT JOIN first ON first.label = labels.label""",
    ),
}
