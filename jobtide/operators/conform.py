"""Column contracts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide import fixed_values as fixed
from jobtide.functions.extract import raw_disclosed
from jobtide.functions.tags import parse_list
from jobtide.functions.text import clean_text, surrogate_key, to_number


def conform(
    df: DataFrame,
    columns: Iterable[str],
    defaults: Mapping[str, object] | None = None,
    default: object = "",
    rename: Mapping[str, str] | None = None,
) -> DataFrame:
    """Exactly the listed columns in the listed order; absent ones filled with their default."""
    if rename:
        df = df.withColumnsRenamed(dict(rename))
    defaults = defaults or {}
    have = set(df.columns)

    def pick(name: str) -> Column:
        if name in have:
            return F.col(name)
        value = defaults.get(name, default)
        return (value if isinstance(value, Column) else F.lit(value)).alias(name)

    return df.select(*[pick(c) for c in columns])


def select_existing(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    have = set(df.columns)
    return df.select(*[c for c in columns if c in have])


def to_raw_contract(df: DataFrame, scraped_at: str) -> DataFrame:
    """Collected rows in the raw posting contract."""
    base = [c for c in fixed.RAW_COLUMNS[:12]]
    out = conform(df, base)
    out = out.withColumns(
        {
            "scraped_at": F.lit(scraped_at),
            "canton": F.lit(""),
            "seniority": F.lit(""),
            "description_clean": clean_text("description_raw"),
            "skills": F.lit(""),
            "skill_count": F.lit(0),
            "salary_raw": F.coalesce(F.col("salary_raw").cast("string"), F.lit("")),
            "salary_available": raw_disclosed("salary_raw"),
        }
    )
    return out.select(*fixed.RAW_COLUMNS)


def with_fallback_id(
    df: DataFrame, target: str, others: Sequence[str], natural_key: Sequence[str]
) -> DataFrame:
    """Id column kept where present, else the first other id column, else a digest of the key.

    A digest stays the same on every run and needs no numbering across the whole table.
    """
    if target in df.columns:
        return df
    for name in others:
        if name in df.columns:
            return df.withColumn(target, F.col(name))
    return df.withColumn(target, surrogate_key(*natural_key))


def to_dashboard_contract(df: DataFrame, natural_key: Sequence[str]) -> DataFrame:
    """Table ready for the panels: parsed skill list, ids, numeric columns, absent ones null."""
    have = dict(df.dtypes)
    if "skills" not in have:
        tags = F.array().cast("array<string>")
    elif have["skills"].startswith("array"):
        tags = F.coalesce("skills", F.array().cast("array<string>"))
    else:
        tags = F.coalesce(parse_list("skills"), F.array().cast("array<string>"))
    df = df.withColumn("skills_list", tags)
    if "skill_count" not in have:
        df = df.withColumn("skill_count", F.size("skills_list"))
    df = with_fallback_id(df, "job_id", ["b_id"], natural_key)
    text = ("title", "company", "role", "region", "canton", "industry", "seniority", "city")
    later = ("posted_date", "scraped_at")
    number = ("workload_min", "workload_max", "macro_vacancies_region")
    missing = {
        **{c: F.lit(None).cast("string") for c in (*text, *later)},
        **{c: F.lit(None).cast("double") for c in number},
        "salary_available": F.lit(0),
    }
    df = df.withColumns({c: v for c, v in missing.items() if c not in df.columns})
    return df.withColumns(
        {
            "salary_available": to_number("salary_available", default=0.0),
            "skill_count": to_number("skill_count"),
            "workload_min": to_number("workload_min"),
            "workload_max": to_number("workload_max"),
        }
    )
