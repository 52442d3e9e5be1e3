"""All panels of the dashboard and the analysis for one filtered view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide import fixed_values as fixed
from jobtide.functions.text import short_label
from jobtide.operators import facets, quantiles, summary, tagstats
from jobtide.operators.rows import duplicate_rows, in_top_groups


def dashboard_panels(view: DataFrame, min_group: int = 5) -> dict[str, DataFrame]:
    """Lazy DataFrames by panel name.

    ``view`` is a table in the dashboard contract, filtered by :func:`facets.apply_facets`; cache
    or write it once, as every panel reads it.
    """
    salary_min = max(10, min_group)
    counts = summary.value_counts
    return {
        "kpi": summary.kpi_row(view),
        "summary": facets.exec_summary(view),
        "roles": counts(view, "role"),
        "cantons": summary.minmax_scale(counts(view, "canton"), "count"),
        "companies": summary.top_values(view, "company", 10),
        "region_vs_macro": summary.count_and_mean(
            view, "region", "job_id", "macro_vacancies_region"
        ),
        "quality": summary.missingness(view, summary.quality_checks(view)),
        "skill_count_by_role": quantiles.boxplot_stats(
            view, "role", "skill_count", small_domain=True
        ),
        "top_skills": tagstats.top_tags(view, "skills_list", 15),
        "skills_by_role": tagstats.tag_presence_matrix(
            view, "role", "skills_list", 10, min_group
        ),
        "skills_by_industry": tagstats.tag_presence_matrix(
            view, "industry", "skills_list", 10, min_group
        ),
        "skills_by_seniority": tagstats.tag_presence_matrix(
            view, "seniority", "skills_list", 10, min_group
        ),
        "workload_by_role": summary.workload_share(view, min_rows=min_group),
        "salary_by_canton": summary.rate_by_group(view, "canton", "salary_available", salary_min),
        "salary_by_role": summary.rate_by_group(view, "role", "salary_available", salary_min),
        "preview": facets.preview(view, ["job_id"]),
        "export": facets.export_view(view),
    }


def analysis_results(df: DataFrame, roles: tuple[str, ...] = fixed.DEFAULT_ROLES):
    """Results of the research questions on the merged table (``skills`` as an array)."""
    numeric = (
        "skill_count", "workload_min", "workload_max", "salary_available", "salary_min",
        "salary_max", "macro_vacancies_region", "macro_vacancies_industry",
    )
    by_industry = tagstats.tag_share_by_group(df, "industry", "skills", 10, min_rows=20)
    return {
        "describe": summary.describe_numeric(df, numeric),
        "profile": summary.column_profile(df),
        "disclosure": summary.disclosure_rate(df),
        "top_skills": tagstats.top_tags(df, "skills", 15),
        "skills_by_role": tagstats.tag_share_by_group(df, "role", "skills", 10),
        "skills_by_canton": summary.group_mean(df, "canton", "skill_count"),
        "skills_by_industry": by_industry.withColumn("label", short_label("industry")),
        "skills_by_seniority": tagstats.tag_share_by_group(
            df, "seniority", "skills", 10, levels=fixed.SENIORITY_LEVELS
        ),
        "roles_by_region": summary.pivot_counts(
            in_top_groups(df, "region", 6), "region", "role", roles
        ),
        "workload_by_role": summary.workload_share(df, variant="analysis"),
        "region_vs_macro": summary.count_and_mean(
            df, "region", "job_id", "macro_vacancies_region"
        ),
        "salary_by_canton": summary.rate_by_group(df, "canton", "salary_available"),
        "salary_by_role": summary.rate_by_group(df, "role", "salary_available"),
        "skill_median": quantiles.group_median(df, "role", "skill_count", small_domain=True),
        "tags": summary.tag_coverage(df, "skills", "r"),
        "repeats": duplicate_rows(df.withColumn("skills", F.to_json("skills"))),
    }
