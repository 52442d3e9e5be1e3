"""Joins of postings to quarterly statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobtide.functions import periods
from jobtide.operators import joins
from jobtide.plans.macro import attach_macro, label_figures
from jobtide.queries.common import Query, table


def _postings(spark, sf):
    """Orders as postings with a region, a segment and a quarter; some regions missing."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.when(F.col("n_nationkey") % 5 > 0, F.col("r_name")).alias("region")
    )
    people = customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "region", F.col("c_mktsegment").alias("industry")
    )
    return orders.join(people, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        "region",
        "industry",
        "o_totalprice",
        periods.period_proxy(
            periods.quarter_label("o_orderdate"), {"2001Q1": "2000Q4"}
        ).alias("merge_quarter"),
    )


def _macro(spark, sf, label: str, last: str):
    """Statistics per label and quarter, up to a last published quarter."""
    rows = _postings(spark, sf).where(F.col(label).isNotNull() & (F.col("merge_quarter") <= last))
    return rows.groupBy(label, F.col("merge_quarter").alias("quarter")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("vacancies")
    )


def macro_join_region(spark, sf):
    macro = _macro(spark, sf, "region", "2000Q2")
    out = attach_macro(_postings(spark, sf), macro, "region", "merge_quarter", "vacancies_region")
    return out.select("o_orderkey", "region", "merge_quarter", "vacancies_region")


def macro_join_industry(spark, sf):
    macro = _macro(spark, sf, "industry", "1999Q4")
    out = attach_macro(
        _postings(spark, sf), macro, "industry", "merge_quarter", "vacancies_industry"
    )
    return out.select("o_orderkey", "industry", "merge_quarter", "vacancies_industry")


def macro_join_spread(spark, sf):
    """As macro_join_region, with labels that hold many orders dealt over many tasks."""
    macro = _macro(spark, sf, "region", "2000Q2")
    out = attach_macro(
        _postings(spark, sf), macro, "region", "merge_quarter", "vacancies_region", spread_hot=True
    )
    return out.select("o_orderkey", "region", "merge_quarter", "vacancies_region")


def macro_join_null_safe(spark, sf):
    """Null regions meet the statistics row without a region."""
    rows = _postings(spark, sf)
    macro = rows.groupBy("region").agg(F.count("*").alias("n"))
    return joins.left_enrich(rows, macro, {"region": "region"}, {"n": "peers"}, null_safe=True).select(
        "o_orderkey", "region", "peers"
    )


def join_match_report(spark, sf):
    macro = _macro(spark, sf, "region", "2000Q2")
    before = _postings(spark, sf)
    after = attach_macro(before, macro, "region", "merge_quarter", "vacancies_region")
    return joins.match_report(after, "vacancies_region", before)


def region_vs_macro(spark, sf):
    macro = _macro(spark, sf, "region", "2000Q2")
    found = label_figures(_postings(spark, sf), macro, "region", "merge_quarter", "o_orderkey", min_rows=3)
    return found.withColumn("macro_mean", F.round("macro_mean", 2))


_SQL = """
p AS (
  SELECT o_orderkey, CASE WHEN n_nationkey % 5 > 0 THEN r_name END AS region,
    c_mktsegment AS industry, o_totalprice,
    replace(year(o_orderdate) || 'Q' || quarter(o_orderdate), '2001Q1', '2000Q4')
      AS merge_quarter
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey),
r AS (SELECT region, merge_quarter, round(sum(o_totalprice), 2) AS vacancies FROM p
      WHERE merge_quarter <= '2000Q2' AND region IS NOT NULL GROUP BY ALL),
i AS (SELECT industry, merge_quarter, round(sum(o_totalprice), 2) AS vacancies FROM p
      WHERE merge_quarter <= '1999Q4' GROUP BY ALL),
j AS (SELECT p.*, r.vacancies AS vacancies_region FROM p
      LEFT JOIN r ON r.region = p.region AND r.merge_quarter = p.merge_quarter)"""

QUERIES: dict[str, Query] = {
    "macro_join_region": Query(
        macro_join_region,
        f"WITH {_SQL} SELECT o_orderkey, region, merge_quarter, vacancies_region FROM j",
    ),
    "macro_join_spread": Query(
        macro_join_spread,
        f"WITH {_SQL} SELECT o_orderkey, region, merge_quarter, vacancies_region FROM j",
    ),
    "macro_join_industry": Query(
        macro_join_industry,
        f"""WITH {_SQL} SELECT o_orderkey, p.industry, p.merge_quarter,
              vacancies AS vacancies_industry
            FROM p LEFT JOIN i ON i.industry = p.industry AND i.merge_quarter = p.merge_quarter""",
    ),
    "macro_join_null_safe": Query(
        macro_join_null_safe,
        f"""WITH {_SQL} SELECT o_orderkey, region,
              count(*) OVER (PARTITION BY region) AS peers FROM p""",
    ),
    "join_match_report": Query(
        join_match_report,
        f"""WITH {_SQL} SELECT (SELECT count(*) FROM p) AS rows_before, count(*) AS rows_after,
              count(vacancies_region) AS matched,
              count(*) FILTER (vacancies_region IS NULL) AS unmatched FROM j""",
    ),
    "region_vs_macro": Query(
        region_vs_macro,
        f"""WITH {_SQL} SELECT region, count(o_orderkey) AS postings,
              round(avg(vacancies_region), 2) AS macro_mean
            FROM j WHERE region IS NOT NULL GROUP BY region HAVING count(*) >= 3""",
    ),
}
