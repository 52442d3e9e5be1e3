"""The composed plans, from pages made of customer columns to cleaned postings."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobtide import fixed_values as fixed
from jobtide.functions import rules
from jobtide.plans import collect, enrich, macro
from jobtide.queries.common import BASE_URL, Query, spread_table, table
from jobtide.queries.extraction import pick, sql_pick
from jobtide.queries.texts import segment_page

SCRAPED_AT = "2026-03-01T17:21:57"
# location text, canton, city
TOWNS = (
    ("Zürich", "ZH", "Zürich"), ("Olten", "SO", "Olten"), ("Lausanne, VD", "VD", "Lausanne"),
    ("Chur", "GR", "Chur"), ("Raum Olten", None, None),
)
MONTHS = ("January", "March", "June", "August", "December")
OFFER = "We offer a modern place of work, a good team and long walks in the middle of town. " * 2


def _people(spark, sf):
    people = spread_table(spark, sf, "customer", "c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    return people.join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))


def _detail_page():
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    return F.concat(
        F.lit("<html><!-- <h1 data-cy='vacancy-title'>no</h1> --><h1 data-cy='vacancy-title'>Senior <i>"),
        F.col("c_name"),
        F.lit("</i></h1><ul><li data-cy=info-publication><span class='a white-space_nowrap'>"),
        (nation + 1).cast("string"), F.lit(" "), pick("c_custkey", MONTHS), F.lit(" "),
        (2024 + key % 2).cast("string"),
        F.lit("</span></li><li data-cy='info-workload'><span class=white-space_nowrap>"),
        (50 + nation).cast("string"),
        F.lit("<b>%</b></span></li><li data-cy='info-contract'>Fixed &amp;<i>full</i></li></ul>"),
        F.lit("<div data-cy='vacancy-logo'><p>"), pick("c_nationkey", [t[0] for t in TOWNS]),
        F.lit("</p></div><div data-cy='vacancy-description'><section aria-label='JobFit teaser'>"),
        F.lit("Java<div>no</div></section><div>The "), F.col("c_mktsegment"),
        F.lit(" team uses Python &amp;\n SQL.</div> CHF "), (100000 + key).cast("string"),
        F.lit(" per year. "), F.lit(OFFER), F.lit("</div></html>"),
    )


def _collected(spark, sf):
    people = _people(spark, sf)
    listings = people.select(
        F.lower("c_mktsegment").alias("search_term"), F.col("c_nationkey").alias("term_no"),
        F.col("c_custkey").alias("page"), segment_page().alias("html"),
    )
    url = F.concat(F.lit(f"{BASE_URL}/en/jobs/detail/"), F.col("c_custkey").cast("string"))
    details = people.where("c_custkey % 3 <> 0").select(url.alias("url"), _detail_page().alias("html"))
    return collect.collect_postings(listings, details, "board", BASE_URL, SCRAPED_AT)


def collect_postings(spark, sf):
    """Two cards of each customer's result page, two thirds of the first ones with a detail page."""
    return _collected(spark, sf)


def enrich_postings(spark, sf):
    clean = enrich.enrich_postings(_collected(spark, sf))
    return clean.withColumns(
        {"skills": F.array_join("skills", "|"), "posted_date": F.date_format("posted_date", "yyyy-MM-dd")}
    )


# Words of the company or, failing that, of the description.
BRANCHES = rules.RuleSet.of(
    [("Vehicles", ["automobile"]), ("Homes", ["building", "household team", "furniture"]), ("Language", ["sql"])]
)
PROXIES = {"2025Q4": "2025Q3"}


def _statistics(spark, sf, label):
    """Sum of customer keys per label and quarter, without the last quarter."""
    last = F.concat((2024 + F.col("c_custkey") % 2).cast("string"), pick("c_custkey", ["Q1", "Q1", "Q2", "Q3", "Q4"]))
    rows = table(spark, sf, "customer").select(label.alias("label"), last.alias("quarter"), "c_custkey")
    rows = rows.where(F.col("label").isNotNull() & (F.col("quarter") < "2025Q4"))
    return rows.groupBy("label", "quarter").agg(F.sum("c_custkey").cast("double").alias("vacancies"))


def integrate_postings(spark, sf):
    regions = [fixed.CANTON_REGION.get(t[1]) for t in TOWNS]
    by_region = _statistics(spark, sf, pick("c_nationkey", regions)).withColumnRenamed("label", "region")
    branch = (
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", "Vehicles")
        .when(F.col("c_mktsegment").isin("BUILDING", "FURNITURE"), "Homes").otherwise("Language")
    )
    by_industry = _statistics(spark, sf, branch).withColumnRenamed("label", "industry")
    clean = enrich.enrich_postings(_collected(spark, sf))
    merged = macro.integrate(clean, by_region, by_industry, BRANCHES, ("machin",), "Other", PROXIES)
    return merged.withColumns(
        {"skills": F.array_join("skills", "|"), "posted_date": F.date_format("posted_date", "yyyy-MM-dd")}
    )


_RAW = f"""
base AS (SELECT *, c_custkey % 3 <> 0 AS known FROM customer JOIN nation ON c_nationkey = n_nationkey),
raw AS (
  SELECT 'board' AS source, '{BASE_URL}/en/jobs/detail/' || c_custkey AS url,
    lower(c_mktsegment) AS search_term, CASE WHEN known THEN 'Senior ' ELSE '' END || c_name AS title,
    c_mktsegment AS company,
    CASE WHEN known THEN {sql_pick('c_nationkey', [t[0] for t in TOWNS])} ELSE n_name END AS location_raw,
    CASE WHEN known THEN (c_nationkey + 1) || ' ' || {sql_pick('c_custkey', MONTHS)} || ' ' || (2024 + c_custkey % 2)
      ELSE 'Today' END AS posted_date,
    CASE WHEN known THEN 'Fixed & full' ELSE 'Permanent' END AS employment_type,
    CASE WHEN known THEN (50 + c_nationkey) || '%' ELSE '' END AS workload_raw,
    CASE WHEN known THEN 'The ' || c_mktsegment || ' team uses Python & SQL. CHF ' || (100000 + c_custkey)
      || ' per year. {OFFER.strip()}' ELSE '' END AS description, c_custkey, c_nationkey, known
  FROM base
  UNION ALL
  SELECT 'board', '{BASE_URL}/en/jobs/x' || c_custkey, lower(c_mktsegment), 'R&D lead', c_mktsegment, '',
    'Today', 'Permanent', '', '', c_custkey, c_nationkey, false FROM base)"""

_CANTON = f"CASE WHEN known THEN {sql_pick('c_nationkey', [t[1] for t in TOWNS])} END"
_DATE = f"""CASE WHEN known THEN (2024 + c_custkey % 2) || '-' ||
  {sql_pick('c_custkey', ['01', '03', '06', '08', '12'])} || '-' || lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') END"""
_QUARTER = f"""CASE WHEN known THEN (2024 + c_custkey % 2) || {sql_pick('c_custkey', ['Q1', 'Q1', 'Q2', 'Q3', 'Q4'])} END"""
_REGION = "CASE canton " + " ".join(f"WHEN '{c}' THEN '{r}'" for c, r in fixed.CANTON_REGION.items()) + " END"

_CLEAN = f"""{_RAW},
placed AS (SELECT *, {_CANTON} AS canton FROM raw),
clean AS (
  SELECT sha1('board|' || url) AS job_id, title, company, search_term AS role,
    nullif(location_raw, '') AS location_raw,
    CASE WHEN known THEN {sql_pick('c_nationkey', [t[2] for t in TOWNS])} ELSE nullif(location_raw, '') END AS city,
    canton, {_REGION} AS region, {_DATE} AS posted_date, {_QUARTER} AS quarter, {_QUARTER} AS macro_quarter,
    CASE WHEN known THEN 'senior' WHEN title = 'R&D lead' THEN 'lead' END AS seniority,
    CAST(CASE WHEN known THEN 50 + c_nationkey END AS INTEGER) AS workload_min,
    CAST(CASE WHEN known THEN 50 + c_nationkey END AS INTEGER) AS workload_max,
    CAST(known AS INTEGER) AS salary_available,
    CAST(CASE WHEN known THEN 100000 + c_custkey END AS INTEGER) AS salary_min,
    CAST(CASE WHEN known THEN 100000 + c_custkey END AS INTEGER) AS salary_max,
    CASE WHEN known THEN 'python|sql' WHEN title = 'R&D lead' THEN 'r' ELSE '' END AS skills,
    CAST(CASE WHEN known THEN 2 WHEN title = 'R&D lead' THEN 1 ELSE 0 END AS INTEGER) AS skill_count,
    description FROM placed)"""

_BRANCH = "CASE WHEN {0} = 'AUTOMOBILE' THEN 'Vehicles' WHEN {0} IN ('BUILDING', 'FURNITURE') THEN 'Homes' ELSE {1} END"
_STATISTICS = f"""
towns AS (SELECT c_custkey, c_mktsegment, true AS known, c_nationkey,
            {sql_pick('c_nationkey', [t[1] for t in TOWNS])} AS canton FROM customer),
dated AS (SELECT c_custkey, {_REGION} AS region, {_BRANCH.format('c_mktsegment', "'Language'")} AS industry,
            {_QUARTER} AS quarter FROM towns),
by_region AS (SELECT region, quarter, CAST(sum(c_custkey) AS DOUBLE) AS v FROM dated
              WHERE region IS NOT NULL AND quarter < '2025Q4' GROUP BY ALL),
by_industry AS (SELECT industry, quarter, CAST(sum(c_custkey) AS DOUBLE) AS v FROM dated
                WHERE quarter < '2025Q4' GROUP BY ALL)"""

QUERIES: dict[str, Query] = {
    "collect_postings": Query(
        collect_postings,
        f"""WITH {_RAW} SELECT source, url, sha1('board|' || url) AS job_id, search_term, title, company,
              location_raw, posted_date, employment_type, workload_raw, '' AS salary_raw,
              description AS description_raw, '{SCRAPED_AT}' AS scraped_at, '' AS canton, '' AS seniority,
              description AS description_clean, '' AS skills, CAST(0 AS INTEGER) AS skill_count,
              CAST(0 AS INTEGER) AS salary_available FROM raw""",
    ),
    "enrich_postings": Query(enrich_postings, f"WITH {_CLEAN} SELECT * FROM clean"),
    "integrate_postings": Query(
        integrate_postings,
        f"""WITH {_CLEAN}, {_STATISTICS},
            sorted AS (SELECT * REPLACE (CASE quarter WHEN '2025Q4' THEN '2025Q3' ELSE quarter END AS macro_quarter),
              {_BRANCH.format('company', "CASE WHEN description = '' THEN 'Other' WHEN company = 'HOUSEHOLD' THEN 'Homes' ELSE 'Language' END")} AS industry
              FROM clean)
            SELECT s.* EXCLUDE (location_raw), r.v AS macro_vacancies_region, i.v AS macro_vacancies_industry FROM sorted s
            LEFT JOIN by_region r ON r.region = s.region AND r.quarter = s.macro_quarter
            LEFT JOIN by_industry i ON i.industry = s.industry AND i.quarter = s.macro_quarter""",
    ),
}
