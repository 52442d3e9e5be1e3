"""Faceted filtering and the panels built on a filtered view."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide import fixed_values as fixed
from jobtide.functions.text import as_col, yes_no
from jobtide.operators.conform import select_existing

FACETS = ("role", "region", "canton", "industry", "seniority")


@dataclass(frozen=True)
class FacetFilter:
    """Chosen values per facet; an empty choice does not restrict."""

    role: tuple = ()
    region: tuple = ()
    canton: tuple = ()
    industry: tuple = ()
    seniority: tuple = ()
    search: str = ""

    def chosen(self, facet: str) -> tuple:
        return tuple(getattr(self, facet))

    def condition(self, facets: Sequence[str] = FACETS) -> Column | None:
        """All choices together; null values fit no choice."""
        tests = [F.col(f).isin(*self.chosen(f)) for f in facets if self.chosen(f)]
        out = None
        for t in tests:
            out = t if out is None else out & t
        return out


def text_search(
    query: str, *columns: Column | str, regex: bool = True
) -> Column:
    """True where any column matches, ignoring case; null text matches nothing."""
    out = F.lit(False)
    for c in columns:
        text = F.coalesce(as_col(c), F.lit(""))
        if regex:
            out = out | text.rlike(f"(?iu){query}")
        else:
            out = out | F.contains(F.lower(text), F.lit(query.lower()))
    return out


def apply_facets(
    df: DataFrame,
    chosen: FacetFilter,
    search_columns: Sequence[str] = ("title", "company"),
    regex: bool = True,
) -> DataFrame:
    condition = chosen.condition()
    if condition is not None:
        df = df.where(condition)
    query = chosen.search.strip()
    if query:
        df = df.where(text_search(query, *search_columns, regex=regex))
    return df


def facet_options(
    df: DataFrame, chosen: FacetFilter, facets: Sequence[str] = FACETS
) -> DataFrame:
    """Options of every facet given the choices made in the facets before it, in one pass."""
    entries = []
    for i, facet in enumerate(facets):
        before = chosen.condition(facets[:i])
        entry = F.struct(
            F.lit(i + 1).alias("facet_no"),
            F.lit(facet).alias("facet"),
            F.col(facet).cast("string").alias("value"),
        )
        fits = F.col(facet).isNotNull()
        if before is not None:
            fits = fits & F.coalesce(before, F.lit(False))
        entries.append(F.when(fits, entry))
    options = df.select(F.explode(F.array_compact(F.array(*entries))).alias("_x"))
    return options.select("_x.*").distinct().orderBy("facet_no", "value")


def exec_summary(
    df: DataFrame,
    tags: str = "skills_list",
    role: str = "role",
    canton: str = "canton",
    salary: str = "salary_available",
) -> DataFrame:
    """Most frequent role, canton and tag, and the disclosure rate; ``N/A`` where there is none.

    All three are counted in one pass, as (kind, value) pairs.
    """
    kinds = {"role": F.col(role).cast("string"), "canton": F.col(canton).cast("string")}
    pairs = [F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in kinds.items()]
    none = F.array().cast("array<string>")
    tag_pairs = F.transform(
        F.coalesce(F.col(tags), none),
        lambda t: F.struct(F.lit("tag").alias("kind"), t.alias("value")),
    )
    entries = df.select(F.explode_outer(F.concat(F.array(*pairs), tag_pairs)).alias("_x"))
    counts = entries.groupBy("_x.kind", "_x.value").agg(F.count("*").alias("n"))

    def leader(kind: str) -> Column:
        named = (F.col("kind") == kind) & F.col("value").isNotNull()
        first = F.min(F.when(named, F.struct((-F.col("n")).alias("n"), "value")))
        return F.coalesce(first["value"], F.lit("N/A"))

    rate = df.agg(F.coalesce(F.avg(F.col(salary) * 100.0), F.lit(0.0)).alias("r")).scalar()
    return counts.agg(
        leader("role").alias("top_role"),
        leader("canton").alias("top_canton"),
        leader("tag").alias("top_skill"),
    ).withColumn("salary_rate", rate)


def export_view(df: DataFrame, columns: Sequence[str] = fixed.PREVIEW_COLUMNS) -> DataFrame:
    """The preview columns with the flag as Yes/No, all rows (for the CSV export)."""
    out = select_existing(df, columns)
    if "salary_available" in out.columns:
        out = out.withColumn("salary_available", yes_no("salary_available"))
    return out


def preview(
    df: DataFrame, order: Sequence[str], n: int = 200, columns: Sequence[str] = fixed.PREVIEW_COLUMNS
) -> DataFrame:
    """First ``n`` rows of the export view, in a fixed order."""
    return export_view(df.orderBy(*order).limit(n), columns)


def is_empty(df: DataFrame) -> bool:
    """Guard for a view without rows (reads no more than one row)."""
    return df.isEmpty()
