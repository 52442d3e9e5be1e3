"""Official statistics: cubes to tables, and tables onto postings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from jobtide import fixed_values as fixed
from jobtide.functions.periods import period_proxy, quarter_start
from jobtide.functions.rules import RuleSet, classify
from jobtide.functions.text import map_value
from jobtide.operators.joins import left_enrich, spread_join
from jobtide.operators.rows import latest_periods
from jobtide.sources.jsonstat import decode_cubes


def macro_table(
    cubes: DataFrame,
    text: str,
    dimensions: Mapping[str, str],
    label: str,
    labels: Mapping[str, str] | None,
    keep_quarters: int = 8,
) -> DataFrame:
    """Statistics of the newest quarters from JSON-stat cubes.

    ``dimensions`` maps the cube's dimension names to ``label`` and ``quarter``; the others are
    dropped.  Labels are translated by ``labels`` (unmapped ones become null).
    """
    table = decode_cubes(cubes, text, list(dimensions), "vacancies")
    table = table.withColumnsRenamed(dict(dimensions))
    if labels is not None:
        table = table.withColumn(label, map_value(label, dict(labels)))
    table = latest_periods(table, "quarter", keep_quarters)
    table = table.withColumn("year", F.year(quarter_start("quarter")))
    return table.select(label, "quarter", "vacancies", "year").orderBy("quarter", label)


def region_vacancies(cubes: DataFrame, text: str) -> DataFrame:
    dims = {"Grossregion": "region", "Quartal": "quarter"}
    return macro_table(cubes, text, dims, "region", fixed.MACRO_REGION_LABELS)


def industry_vacancies(cubes: DataFrame, text: str) -> DataFrame:
    dims = {"Wirtschaftsabteilung": "industry", "Quartal": "quarter"}
    return macro_table(cubes, text, dims, "industry", fixed.MACRO_INDUSTRY_LABELS)


#: Places that rows with a null key are dealt over in a shuffled join.
NULL_PARTS = 1000


def attach_macro(
    postings: DataFrame, macro: DataFrame, label: str, quarter: str, out: str, spread_hot: bool = False
) -> DataFrame:
    """Postings with the statistics of their label and quarter.

    Postings without a label or quarter find none.  Where the join shuffles, a third key deals them
    over ``NULL_PARTS`` places, so that no task gathers them all; where the statistics are
    broadcast, it costs nothing, and in neither case is the input read twice.  Statistics too large
    to be broadcast may meet labels with a large part of the postings: ``spread_hot`` counts the
    labels first and deals hot ones over many tasks, too (``joins.spread_join``).
    """
    plain = [f.name for f in postings.schema if f.dataType.typeName() not in ("map", "variant")]
    if spread_hot:
        right = macro.select(F.col(label).alias("_label"), F.col("quarter").alias("_quarter"), F.col("vacancies").alias(out))
        left = postings.withColumns({"_label": F.col(label), "_quarter": F.col(quarter)})
        return spread_join(left, right, ["_label", "_quarter"], plain, "left").drop("_label", "_quarter")
    missing = F.col(label).isNull() | F.col(quarter).isNull()
    place = F.when(missing, F.pmod(F.xxhash64(*plain), F.lit(NULL_PARTS)) + 1).otherwise(F.lit(0))
    # Always 0.  As a literal it would turn into a condition on the left, and the join would no longer
    # be dealt by place.
    nowhere = F.pmod(F.xxhash64(label, "quarter"), F.lit(1))
    right = macro.select(label, "quarter", "vacancies", nowhere.alias("_place"))
    on = {label: label, quarter: "quarter", "_place": "_place"}
    found = left_enrich(postings.withColumn("_place", place), right, on, {"vacancies": out})
    return found.drop("_place")


def label_figures(
    postings: DataFrame, macro: DataFrame, label: str, quarter: str, counted: str, min_rows: int = 1
) -> DataFrame:
    """Counted postings and mean vacancies per label, smallest label first.

    As ``count_and_mean`` over postings with their statistics attached, but postings are counted by
    label and quarter first, so the join meets one row for each of these.  Empty where no label has
    statistics.
    """
    rows = postings.where(F.col(label).isNotNull()).groupBy(label, quarter)
    counts = rows.agg(F.count(counted).alias("postings"), F.count("*").alias("_rows"))
    met = attach_macro(counts, macro, label, quarter, "_vacancies")
    weight = F.when(F.col("_vacancies").isNotNull(), F.col("_rows"))
    mean = F.try_divide(F.sum(F.col("_vacancies") * weight), F.sum(weight))
    out = met.groupBy(label).agg(F.sum("postings").alias("postings"), mean.alias("macro_mean"))
    out = out.where(F.col("postings") >= min_rows)
    known = F.max(F.col("macro_mean").isNotNull()).over(Window.partitionBy(F.lit(0)))
    return out.withColumn("_known", known).where("_known").drop("_known").orderBy("postings", label)


def integrate(
    clean: DataFrame,
    by_region: DataFrame,
    by_industry: DataFrame,
    rules: RuleSet,
    agencies: Sequence[str] = fixed.AGENCY_NAMES,
    default: str = fixed.DEFAULT_INDUSTRY,
    proxies: Mapping[str, str] | None = None,
) -> DataFrame:
    """Cleaned postings with industry and both vacancy figures.

    ``proxies`` names quarters that have no statistics yet and the quarter to use for them.
    """
    proxies = {"2026Q1": "2025Q4"} if proxies is None else dict(proxies)
    df = clean.withColumns(
        {
            "merge_quarter": period_proxy("macro_quarter", proxies),
            "industry": classify("company", "description", rules, agencies, default),
        }
    )
    df = attach_macro(df, by_region, "region", "merge_quarter", "macro_vacancies_region")
    df = attach_macro(df, by_industry, "industry", "merge_quarter", "macro_vacancies_industry")
    df = df.drop("macro_quarter").withColumnRenamed("merge_quarter", "macro_quarter")
    return df.select(*fixed.MERGED_COLUMNS)
