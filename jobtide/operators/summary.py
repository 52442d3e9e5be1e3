"""Counts, rates, profiles and key figures.

Plain aggregates throughout: each task pre-aggregates before the shuffle, so a group that holds a
large share of the rows costs no more than any other.  Ties are ordered by count descending, then
by value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from jobtide import fixed_values as fixed
from jobtide.functions.extract import workload_category
from jobtide.functions.rules import RuleSet
from jobtide.functions.text import nonempty, percent, strip
from jobtide.operators.quantiles import group_quantiles


def value_counts(
    df: DataFrame, column: str, include_null: bool = False, name: str = "count"
) -> DataFrame:
    if not include_null:
        df = df.where(F.col(column).isNotNull())
    return df.groupBy(column).agg(F.count("*").alias(name)).orderBy(F.desc(name), column)


def top_values(df: DataFrame, column: str, k: int = 10, name: str = "count") -> DataFrame:
    """The ``k`` most frequent values that are not blank."""
    return value_counts(df.where(nonempty(column).isNotNull()), column, name=name).limit(k)


def unresolved_values(df: DataFrame, raw: str, resolved: str, k: int = 20) -> DataFrame:
    """Most frequent raw values for which nothing was resolved."""
    return value_counts(df.where(F.col(resolved).isNull()), raw).limit(k)


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def distinct_combos(df: DataFrame, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct().orderBy(*order)


def period_range(df: DataFrame, period: str) -> DataFrame:
    return df.agg(
        F.min(period).alias("first_period"),
        F.max(period).alias("last_period"),
        F.count_distinct(period).alias("periods"),
    )


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)))


# --- key figures -----------------------------------------------------------------------------


def kpi_row(
    df: DataFrame,
    salary: str = "salary_available",
    tags: str = "skill_count",
    company: str = "company",
    canton: str = "canton",
    seniority: str = "seniority",
    small_domain: bool = True,
) -> DataFrame:
    """One row of key figures.

    The tag count has at most as many values as the dictionary has terms, so its median may be
    counted in one place; ``small_domain=False`` spreads it.  Companies are counted in a branch of
    their own: in one aggregate, every other figure would be carried once per company.
    """
    companies = df.where(F.col(company).isNotNull()).select(company).distinct()
    base = df.agg(
        F.count("*").alias("postings"),
        F.avg(F.col(salary) * 100.0).alias("salary_rate"),
        F.avg(F.when(F.coalesce(F.col(tags), F.lit(0)) > 0, 100.0).otherwise(0.0)).alias(
            "skill_coverage"
        ),
        F.avg(F.when(F.col(canton).isNull(), 100.0).otherwise(0.0)).alias("missing_canton"),
        F.avg(F.when(F.col(seniority).isNull(), 100.0).otherwise(0.0)).alias("missing_seniority"),
        F.sum(F.col(salary)).cast("long").alias("salary_rows"),
        *([F.median(tags).alias("median_skills")] if small_domain else []),
    )
    if not small_domain:
        whole = group_quantiles(
            df.select(F.lit("all").alias("g"), tags), ["g"], tags, [0.5]
        ).select("q0")
        base = base.withColumn("median_skills", whole.scalar())
    number = companies.agg(F.count("*").alias("n")).scalar()
    zero = F.lit(0.0)
    return base.select(
        "postings",
        F.coalesce("salary_rate", zero).alias("salary_rate"),
        F.coalesce("median_skills", zero).alias("median_skills"),
        number.alias("companies"),
        F.coalesce("skill_coverage", zero).alias("skill_coverage"),
        F.coalesce("missing_canton", zero).alias("missing_canton"),
        F.coalesce("missing_seniority", zero).alias("missing_seniority"),
        F.coalesce("salary_rows", F.lit(0)).alias("salary_rows"),
    )


def disclosure_rate(df: DataFrame, flag: str = "salary_available") -> DataFrame:
    return df.agg(
        F.count("*").alias("postings"),
        F.sum(flag).cast("long").alias("disclosed"),
        F.round(F.avg(F.col(flag)) * 100, 2).alias("rate_pct"),
    )


def tag_coverage(df: DataFrame, tags: str, wanted: str) -> DataFrame:
    """Rows without any tag, rows with one given tag, and all mentions."""
    n = F.coalesce(F.size(F.col(tags)), F.lit(0))
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(n == 0).alias("zero_tag_rows"),
        F.count_if(F.array_contains(F.col(tags), wanted)).alias("wanted_rows"),
        F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("mentions"),
    )


# --- data quality ----------------------------------------------------------------------------


def _melt(row: DataFrame, label: str, value_names: Sequence[str], table: Mapping) -> DataFrame:
    """One wide row to one row per label."""
    items = [
        F.struct(F.lit(name).alias(label), *[v.alias(n) for n, v in zip(value_names, values)])
        for name, values in table.items()
    ]
    return row.select(F.explode(F.array(*items)).alias("_x")).select("_x.*")


def column_profile(df: DataFrame) -> DataFrame:
    """Name, type, null count and null share of every column, from one pass."""
    fields = df.schema.fields
    row = df.agg(
        F.count("*").alias("_n"),
        *[F.count_if(F.col(f.name).isNull()).alias(f"_{i}") for i, f in enumerate(fields)],
    )
    table = {
        f.name: (
            F.lit(f.dataType.simpleString()),
            F.col(f"_{i}"),
            percent(F.col(f"_{i}"), F.col("_n"), 1),
        )
        for i, f in enumerate(fields)
    }
    return _melt(row, "column", ("dtype", "missing", "missing_pct"), table)


def missingness(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Share of rows for which each check holds, ascending; one pass for all of them."""
    row = df.agg(
        F.count("*").alias("_n"),
        *[
            F.count_if(F.coalesce(check, F.lit(False))).alias(f"_{i}")
            for i, check in enumerate(checks.values())
        ],
    )
    table = {
        name: (F.col(f"_{i}"), percent(F.col(f"_{i}"), F.col("_n")))
        for i, name in enumerate(checks)
    }
    return _melt(row, "metric", ("rows", "pct"), table).orderBy("pct", "metric")


def quality_checks(df: DataFrame) -> dict[str, Column]:
    """The standard quality lines of a posting table."""

    def blank(name: str) -> Column:
        return F.col(name).isNull() if name in df.columns else F.lit(True)

    return {
        "Missing canton": blank("canton"),
        "Missing region": blank("region"),
        "Missing industry": blank("industry"),
        "Missing seniority": blank("seniority"),
        "Missing workload": blank("workload_min"),
        "Zero extracted skills": F.coalesce(F.col("skill_count"), F.lit(0)) == 0,
        "No salary information": F.coalesce(F.col("salary_available"), F.lit(0)) == 0,
    }


_MOMENTS = {
    "count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max,
}


def describe_numeric(
    df: DataFrame, columns: Sequence[str], small_domain: bool = False
) -> DataFrame:
    """Count, mean, standard deviation (n−1), minimum, quartiles, maximum per column."""
    number = {c: F.col(c).cast("double") for c in columns}
    row = df.agg(
        *[
            f(v).alias(f"_{name}{i}")
            for i, v in enumerate(number.values())
            for name, f in _MOMENTS.items()
        ]
    )
    table = {
        c: tuple(F.col(f"_{name}{i}") for name in _MOMENTS) for i, c in enumerate(columns)
    }
    base = _melt(row, "column", tuple(_MOMENTS), table)
    items = [F.struct(F.lit(c).alias("column"), v.alias("value")) for c, v in number.items()]
    cells = df.select(F.explode(F.array(*items)).alias("_x")).select("_x.*")
    quart = group_quantiles(cells, ["column"], "value", [0.25, 0.5, 0.75], small_domain)
    return base.join(quart, "column", "left").select(
        "column",
        "count",
        "mean",
        "std",
        "min",
        F.col("q0").alias("q25"),
        F.col("q1").alias("q50"),
        F.col("q2").alias("q75"),
        "max",
    )


# --- grouped figures -------------------------------------------------------------------------


def group_mean(df: DataFrame, group: str, value: str) -> DataFrame:
    out = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.avg(value).alias("mean"))
    return out.orderBy(F.desc_nulls_last("mean"), group)


def count_and_mean(
    df: DataFrame, group: str, counted: str, averaged: str, min_rows: int = 1
) -> DataFrame:
    """Counted ids and mean of a figure per group, smallest group first.

    Empty where the figure is null for every group: there is nothing to compare then.
    """
    out = (
        df.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.count(counted).alias("postings"), F.avg(averaged).alias("macro_mean"))
        .where(F.col("postings") >= min_rows)
    )
    known = F.max(F.col("macro_mean").isNotNull()).over(Window.partitionBy(F.lit(0)))
    out = out.withColumn("_known", known).where("_known").drop("_known")
    return out.orderBy("postings", group)


def rate_by_group(df: DataFrame, group: str, flag: str, min_rows: int = 1) -> DataFrame:
    """Mean of a 0/1 flag per group, groups of enough rows with a rate above zero."""
    out = (
        df.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.count("*").alias("postings"), F.avg(flag).alias("rate"))
    )
    out = out.where((F.col("postings") >= min_rows) & (F.col("rate") > 0))
    return out.orderBy(F.desc("rate"), group)


def pivot_counts(
    df: DataFrame, rows: str, columns: str, values: Mapping[str, str] | Sequence[str]
) -> DataFrame:
    """Count table with one column per given value, zero-filled, in one aggregate."""
    names = dict(values) if isinstance(values, Mapping) else {v: v for v in values}
    return (
        df.where(F.col(rows).isNotNull())
        .groupBy(rows)
        .agg(*[F.count_if(F.col(columns) == v).alias(name) for v, name in names.items()])
        .orderBy(rows)
    )


def share_by_group(
    df: DataFrame, group: str, category: Column, categories: Sequence[str], min_rows: int = 1
) -> DataFrame:
    """Percent of each group's rows in each category, long form, every category present."""
    rows = df.where(F.col(group).isNotNull()).select(group, category.alias("_c"))
    wide = rows.groupBy(group).agg(
        F.count("*").alias("group_rows"),
        *[F.count_if(F.col("_c") == c).alias(f"_{i}") for i, c in enumerate(categories)],
    )
    wide = wide.where(F.col("group_rows") >= min_rows)
    items = [
        F.struct(F.lit(c).alias("category"), F.col(f"_{i}").alias("category_rows"))
        for i, c in enumerate(categories)
    ]
    long = wide.select(group, "group_rows", F.explode(F.array(*items)).alias("_x"))
    return long.select(
        group,
        "group_rows",
        "_x.category",
        "_x.category_rows",
        percent(F.col("_x.category_rows"), F.col("group_rows")).alias("share_pct"),
    )


def workload_share(
    df: DataFrame,
    group: str = "role",
    low: str = "workload_min",
    high: str = "workload_max",
    variant: str = "dashboard",
    min_rows: int = 1,
    labels: Sequence[str] | None = None,
) -> DataFrame:
    labels = labels or fixed.WORKLOAD_LABELS[variant]
    return share_by_group(df, group, workload_category(low, high, variant), labels, min_rows)


def minmax_scale(df: DataFrame, value: str, out: str = "scaled", zero_range: object = 1) -> DataFrame:
    """``(n-min)/(max-min)``; a zero range divides by ``zero_range`` (None gives null).

    Minimum and maximum are scalar subqueries, so no window pulls the table into one task.
    """
    low = df.agg(F.min(value).alias("v")).scalar()
    high = df.agg(F.max(value).alias("v")).scalar()
    span = F.nullif((high - low).cast("double"), F.lit(0.0))
    if zero_range is not None:
        span = F.coalesce(span, F.lit(float(zero_range)))
    return df.withColumn(out, (F.col(value) - low) / span)


# --- classification audit --------------------------------------------------------------------


def classification_audit(df: DataFrame, company: str, category: str) -> DataFrame:
    out = df.where(F.col(company).isNotNull() & F.col(category).isNotNull())
    out = out.groupBy(company, category).agg(F.count("*").alias("count"))
    return out.orderBy(category, F.desc("count"), company)


def fallback_share(df: DataFrame, category: str, default: str) -> DataFrame:
    hit = F.coalesce(F.col(category) == default, F.lit(False))
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(hit).alias("fallback_rows"),
        F.round(F.avg(F.when(hit, 100.0).otherwise(0.0)), 2).alias("fallback_pct"),
    )


def fallback_companies(
    df: DataFrame, company: str, category: str, default: str, agency: Column, k: int | None = None
) -> DataFrame:
    """Companies in the default class that are no agencies, most frequent first."""
    out = value_counts(df.where((F.col(category) == default) & ~agency), company)
    return out if k is None else out.limit(k)


def match_trace(
    df: DataFrame, text: str, rules: RuleSet, keep: Sequence[str], first_per_rule: bool = False
) -> DataFrame:
    """One row per keyword hit in the text (or per rule, its first keyword)."""
    hits = rules.trace(F.lower(text), first_per_rule)
    found = df.select(*keep, F.explode_outer(hits).alias("_h")).where(F.col("_h").isNotNull())
    return found.select(*keep, "_h.*")


def trimmed(df: DataFrame, column: str) -> DataFrame:
    """Group labels trimmed, blank ones null."""
    return df.withColumn(column, nonempty(strip(F.col(column).cast("string"))))
