"""Key figures, profiles, tag figures and facets."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobtide.operators import facets, quantiles, summary, tagstats
from jobtide.queries.common import (
    SQL_HITS,
    SQL_POSTINGS,
    Query,
    document_postings,
    table,
    tagged_documents,
)

LEVELS = ("en", "de", "it", "fr")
CHOICE = facets.FacetFilter(role=("en", "fr"), region=("Region 1", "Region 2"), search="src1[0-9] ")


def _rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def kpi_row(spark, sf):
    return _rounded(
        summary.kpi_row(document_postings(spark, sf)),
        "salary_rate", "skill_coverage", "missing_canton", "missing_seniority", digits=4,
    )


def disclosure_rate(spark, sf):
    return summary.disclosure_rate(table(spark, sf, "labels"), "toxic")


def missingness(spark, sf):
    view = document_postings(spark, sf)
    return _rounded(summary.missingness(view, summary.quality_checks(view)), "pct")


def _order_labels(spark, sf):
    orders = table(spark, sf, "orders")
    labels = table(spark, sf, "labels")
    return orders.join(labels, F.col("o_orderkey") == F.col("doc_id"), "left").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "quality", "toxic"
    )


def column_profile(spark, sf):
    return summary.column_profile(_order_labels(spark, sf))


def describe_numeric(spark, sf):
    found = summary.describe_numeric(_order_labels(spark, sf), ["o_totalprice", "quality", "toxic"])
    return _rounded(found, "mean", "std", "q25", "q50", "q75", digits=4)


def describe_small(spark, sf):
    found = summary.describe_numeric(
        table(spark, sf, "lineitem"), ["l_quantity", "l_discount"], small_domain=True
    )
    return _rounded(found, "mean", "std", "q25", "q50", "q75", digits=4)


def group_median(spark, sf):
    return _rounded(
        quantiles.group_median(table(spark, sf, "orders"), "o_orderpriority", "o_totalprice"),
        "median",
        digits=4,
    )


def boxplot_stats(spark, sf):
    docs = table(spark, sf, "documents").select("lang", "n_chars")
    found = quantiles.boxplot_stats(docs, "lang", "n_chars")
    return _rounded(found, "whisker_low", "q1", "median", "q3", "whisker_high", digits=4)


def boxplot_outliers(spark, sf):
    docs = table(spark, sf, "documents").select("lang", "n_chars")
    return quantiles.outliers(docs, "lang", "n_chars")


def group_mean(spark, sf):
    return _rounded(
        summary.group_mean(table(spark, sf, "customer"), "c_mktsegment", "c_acctbal"), "mean", digits=4
    )


def rate_by_group(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    labelled = docs.join(table(spark, sf, "labels"), "doc_id")
    return _rounded(summary.rate_by_group(labelled, "source", "toxic", min_rows=5), "rate")


def minmax_scale(spark, sf):
    counts = summary.value_counts(table(spark, sf, "customer"), "c_nationkey")
    return _rounded(summary.minmax_scale(counts, "count"), "scaled")


def top_tags(spark, sf):
    return tagstats.top_tags(tagged_documents(spark, sf), "tags", 15)


def tag_coverage(spark, sf):
    return summary.tag_coverage(tagged_documents(spark, sf), "tags", "the")


def tag_share_by_group(spark, sf):
    shares = tagstats.tag_share_by_group(tagged_documents(spark, sf), "source", "tags", 10, 20)
    return _rounded(shares, "share_pct")


def tag_share_by_level(spark, sf):
    shares = tagstats.tag_share_by_group(
        tagged_documents(spark, sf), "lang", "tags", 10, levels=LEVELS
    )
    return _rounded(shares, "share_pct")


def tag_presence_matrix(spark, sf):
    view = document_postings(spark, sf)
    return _rounded(tagstats.tag_presence_matrix(view, "canton", "skills_list", 8, 5), "share_pct")


def exec_summary(spark, sf):
    return _rounded(facets.exec_summary(document_postings(spark, sf)), "salary_rate", digits=4)


def facet_filter(spark, sf):
    view = facets.apply_facets(document_postings(spark, sf), CHOICE)
    return view.select("job_id", "title", "company", "role", "region", "canton", "seniority")


def facet_options(spark, sf):
    return facets.facet_options(document_postings(spark, sf), CHOICE)


def preview(spark, sf):
    return facets.preview(document_postings(spark, sf), ["job_id"], 200)


def export_view(spark, sf):
    return facets.export_view(document_postings(spark, sf))


_PREVIEW = """title, company, role, seniority, canton, region, city, industry,
  CAST(skill_count AS INTEGER) AS skill_count, CASE WHEN salary_available = 1 THEN 'Yes' ELSE 'No' END AS salary_available"""
_CHOICE = "role IN ('en', 'fr') AND region IN ('Region 1', 'Region 2')"

SQL_TOP = """top AS (SELECT term, row_number() OVER (ORDER BY n DESC, term) AS tag_rank
  FROM (SELECT term, count(*) AS n FROM hits GROUP BY term) QUALIFY tag_rank <= {k})"""


def _sql_shares(rows: str, group: str, k: int, keep: str) -> str:
    """Share table in SQL: group grid times top tags, zeros filled."""
    return f"""{SQL_TOP.format(k=k)},
grouped AS ({rows}),
sizes AS (SELECT g, count(*) AS group_rows FROM grouped WHERE g IS NOT NULL GROUP BY g {keep}),
cells AS (SELECT g, term, count(*) AS n FROM grouped JOIN hits USING (doc_id) GROUP BY g, term)
SELECT sizes.g AS {group}, group_rows, CAST(tag_rank AS INTEGER) AS tag_rank, top.term AS tag,
  coalesce(cells.n, 0) AS mentions,
  round(100.0 * coalesce(cells.n, 0) / group_rows, 6) AS share_pct
FROM sizes CROSS JOIN top LEFT JOIN cells ON cells.g = sizes.g AND cells.term = top.term"""


def _sql_describe(rows: str, columns) -> str:
    parts = [
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean,
              round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min,
              round(CAST(quantile_cont({c}, 0.25) AS DOUBLE), 4) AS q25,
              round(CAST(quantile_cont({c}, 0.5) AS DOUBLE), 4) AS q50,
              round(CAST(quantile_cont({c}, 0.75) AS DOUBLE), 4) AS q75,
              CAST(max({c}) AS DOUBLE) AS max FROM {rows}"""
        for c in columns
    ]
    return " UNION ALL ".join(parts)


_SQL_ORDER_LABELS = """(SELECT o_orderkey, o_orderstatus, o_totalprice, quality, toxic
  FROM orders LEFT JOIN labels ON o_orderkey = doc_id)"""

_SQL_BOX = """
q AS (SELECT lang, count(*) AS n, quantile_cont(n_chars, 0.25) AS q1,
        quantile_cont(n_chars, 0.5) AS median, quantile_cont(n_chars, 0.75) AS q3
      FROM documents GROUP BY lang),
x AS (SELECT d.lang, q.n, q1, median, q3, n_chars,
        n_chars BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
      FROM documents d JOIN q ON q.lang = d.lang)"""

_CHECKS = {
    "Missing canton": "canton IS NULL",
    "Missing region": "region IS NULL",
    "Missing industry": "industry IS NULL",
    "Missing seniority": "seniority IS NULL",
    "Missing workload": "workload_min IS NULL",
    "Zero extracted skills": "skill_count = 0",
    "No salary information": "salary_available = 0",
}

QUERIES: dict[str, Query] = {
    "kpi_row": Query(
        kpi_row,
        f"""WITH {SQL_POSTINGS}
            SELECT count(*) AS postings, round(avg(salary_available) * 100, 4) AS salary_rate,
              CAST(median(skill_count) AS DOUBLE) AS median_skills,
              count(DISTINCT company) AS companies,
              round(100.0 * count(*) FILTER (skill_count > 0) / count(*), 4) AS skill_coverage,
              round(100.0 * count(*) FILTER (canton IS NULL) / count(*), 4) AS missing_canton,
              round(100.0 * count(*) FILTER (seniority IS NULL) / count(*), 4)
                AS missing_seniority,
              CAST(sum(salary_available) AS BIGINT) AS salary_rows FROM postings""",
    ),
    "disclosure_rate": Query(
        disclosure_rate,
        """SELECT count(*) AS postings, CAST(sum(toxic) AS BIGINT) AS disclosed,
             round(avg(toxic) * 100, 2) AS rate_pct FROM labels""",
    ),
    "missingness": Query(
        missingness,
        f"WITH {SQL_POSTINGS} "
        + " UNION ALL ".join(
            f"""SELECT '{name}' AS metric, count(*) FILTER ({test}) AS rows,
                  round(100.0 * count(*) FILTER ({test}) / count(*), 6) AS pct FROM postings"""
            for name, test in _CHECKS.items()
        ),
    ),
    "column_profile": Query(
        column_profile,
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", '{t}' AS dtype, count(*) - count({c}) AS missing,
                  round(100.0 * (count(*) - count({c})) / count(*), 1) AS missing_pct
                FROM {_SQL_ORDER_LABELS}"""
            for c, t in (
                ("o_orderkey", "bigint"), ("o_orderstatus", "string"),
                ("o_totalprice", "double"), ("quality", "int"), ("toxic", "int"),
            )
        ),
    ),
    "describe_numeric": Query(
        describe_numeric,
        _sql_describe(_SQL_ORDER_LABELS, ("o_totalprice", "quality", "toxic")),
    ),
    "describe_small": Query(describe_small, _sql_describe("lineitem", ("l_quantity", "l_discount"))),
    "group_median": Query(
        group_median,
        """SELECT o_orderpriority, round(median(o_totalprice), 4) AS median
           FROM orders GROUP BY o_orderpriority""",
    ),
    "boxplot_stats": Query(
        boxplot_stats,
        f"""WITH {_SQL_BOX} SELECT lang, n,
              round(CAST(least(min(n_chars) FILTER (inside), q1) AS DOUBLE), 4) AS whisker_low,
              round(CAST(q1 AS DOUBLE), 4) AS q1, round(CAST(median AS DOUBLE), 4) AS median,
              round(CAST(q3 AS DOUBLE), 4) AS q3,
              round(CAST(greatest(max(n_chars) FILTER (inside), q3) AS DOUBLE), 4) AS whisker_high,
              count(*) FILTER (NOT inside) AS outliers
            FROM x GROUP BY lang, n, q1, median, q3""",
    ),
    "boxplot_outliers": Query(
        boxplot_outliers,
        f"WITH {_SQL_BOX} SELECT lang, CAST(n_chars AS DOUBLE) AS n_chars FROM x WHERE NOT inside",
    ),
    "group_mean": Query(
        group_mean,
        """SELECT c_mktsegment, round(avg(c_acctbal), 4) AS mean FROM customer
           GROUP BY c_mktsegment""",
    ),
    "rate_by_group": Query(
        rate_by_group,
        """SELECT source, count(*) AS postings, round(avg(toxic), 6) AS rate
           FROM documents JOIN labels USING (doc_id) GROUP BY source
           HAVING count(*) >= 5 AND avg(toxic) > 0""",
    ),
    "minmax_scale": Query(
        minmax_scale,
        """WITH c AS (SELECT c_nationkey, count(*) AS count FROM customer GROUP BY c_nationkey)
           SELECT c_nationkey, count, round((count - min(count) OVER ())
             / CAST(coalesce(nullif(max(count) OVER () - min(count) OVER (), 0), 1) AS DOUBLE), 6)
             AS scaled FROM c""",
    ),
    "top_tags": Query(
        top_tags,
        f"""WITH {SQL_HITS} SELECT term AS tag, count(*) AS count FROM hits GROUP BY term
            ORDER BY count DESC, tag LIMIT 15""",
    ),
    "tag_coverage": Query(
        tag_coverage,
        f"""WITH {SQL_HITS}, c AS (SELECT doc_id, count(*) AS n,
                count(*) FILTER (term = 'the') AS w FROM hits GROUP BY doc_id)
            SELECT count(*) AS rows, count(*) FILTER (n IS NULL) AS zero_tag_rows,
              count(*) FILTER (w > 0) AS wanted_rows, CAST(sum(n) AS BIGINT) AS mentions
            FROM documents LEFT JOIN c USING (doc_id)""",
    ),
    "tag_share_by_group": Query(
        tag_share_by_group,
        f"""WITH {SQL_HITS}, {_sql_shares(
            "SELECT doc_id, source AS g FROM documents", "source", 10, "HAVING count(*) >= 20")}""",
    ),
    "tag_share_by_level": Query(
        tag_share_by_level,
        f"""WITH {SQL_HITS}, {SQL_TOP.format(k=10)},
            levels AS (SELECT unnest({list(LEVELS)}) AS lang),
            sizes AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
            cells AS (SELECT lang, term, count(*) AS n FROM documents JOIN hits USING (doc_id)
                      GROUP BY lang, term)
            SELECT levels.lang, coalesce(sizes.n, 0) AS group_rows,
              CAST(tag_rank AS INTEGER) AS tag_rank, top.term AS tag,
              coalesce(cells.n, 0) AS mentions,
              round(coalesce(100.0 * cells.n / sizes.n, 0), 6) AS share_pct
            FROM levels CROSS JOIN top LEFT JOIN sizes ON sizes.lang = levels.lang
            LEFT JOIN cells ON cells.lang = levels.lang AND cells.term = top.term""",
    ),
    "tag_presence_matrix": Query(
        tag_presence_matrix,
        f"""WITH {SQL_POSTINGS}, {_sql_shares(
            "SELECT doc_id, canton AS g FROM postings", "canton", 8, "HAVING count(*) >= 5")}""",
    ),
    "exec_summary": Query(
        exec_summary,
        f"""WITH {SQL_POSTINGS}
            SELECT (SELECT role FROM postings GROUP BY role ORDER BY count(*) DESC, role LIMIT 1)
                AS top_role,
              (SELECT canton FROM postings WHERE canton IS NOT NULL GROUP BY canton
               ORDER BY count(*) DESC, canton LIMIT 1) AS top_canton,
              (SELECT term FROM hits GROUP BY term ORDER BY count(*) DESC, term LIMIT 1)
                AS top_skill,
              round(avg(salary_available) * 100, 4) AS salary_rate FROM postings""",
    ),
    "facet_filter": Query(
        facet_filter,
        f"""WITH {SQL_POSTINGS}
            SELECT job_id, title, company, role, region, canton, seniority FROM postings
            WHERE {_CHOICE} AND (regexp_matches(title, '(?i)src1[0-9]')
              OR regexp_matches(company, '(?i)src1[0-9]'))""",
    ),
    "facet_options": Query(
        facet_options,
        f"""WITH {SQL_POSTINGS}
            SELECT DISTINCT CAST(1 AS INTEGER) AS facet_no, 'role' AS facet, role AS value
              FROM postings
            UNION ALL SELECT DISTINCT 2, 'region', region FROM postings
              WHERE role IN ('en', 'fr') AND region IS NOT NULL
            UNION ALL SELECT DISTINCT 3, 'canton', canton FROM postings
              WHERE {_CHOICE} AND canton IS NOT NULL
            UNION ALL SELECT DISTINCT 4, 'industry', industry FROM postings
              WHERE {_CHOICE} AND industry IS NOT NULL
            UNION ALL SELECT DISTINCT 5, 'seniority', seniority FROM postings
              WHERE {_CHOICE} AND seniority IS NOT NULL""",
    ),
    "preview": Query(
        preview,
        f"""WITH {SQL_POSTINGS} SELECT * EXCLUDE (job_id) FROM (
              SELECT job_id, {_PREVIEW} FROM postings ORDER BY job_id LIMIT 200)""",
    ),
    "export_view": Query(export_view, f"WITH {SQL_POSTINGS} SELECT {_PREVIEW} FROM postings"),
}
