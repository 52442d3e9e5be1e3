"""Exact quantiles per group that never gather a group in one task.

Spark's ``percentile`` keeps one counter per distinct value of a group in one task's memory.  That
is right for values from a small domain (tag counts, percentages) and is offered as
``small_domain=True``.  For open-ended values a mergeable sketch gives, for each wanted rank, two
values that surely lie below and above it.  A second pass counts what lies outside these brackets
and the distinct values inside, and only those are ordered.

The second pass is exact whatever the brackets are, as long as they hold the wanted ranks: every row
below a wanted value is counted once, as lying below a bracket or as a value inside one.  So it does
not matter if a sketch comes out differently when it is computed again after a lost executor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Accuracy of the sketch: a bracket holds some eight rows in so many.
SLICES = 4096


def _values(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """Groups and values as doubles; rows without either are left out."""
    for name in (*groups, value):
        df = df.where(F.col(name).isNotNull())
    return df.select(*groups, F.col(value).cast("double").alias("_v"))


def group_quantiles(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    probs: Sequence[float],
    small_domain: bool = False,
    slices: int = SLICES,
) -> DataFrame:
    """Groups, ``n`` (non-null values) and ``q0, q1, …``, linearly interpolated.

    Groups without a name (null in any group column) are left out.  ``slices`` is the accuracy of the
    sketch.
    """
    if not groups:
        raise ValueError("at least one group column is needed")
    values = _values(df, groups, value)
    if small_domain:
        counts = values.groupBy(*groups, "_v").agg(F.count("*").alias("_c"))
        found = counts.groupBy(*groups).agg(
            F.sum("_c").alias("n"),
            F.percentile("_v", F.array(*[F.lit(float(p)) for p in probs]), F.col("_c")).alias(
                "_q"
            ),
        )
        return found.select(
            *groups, "n", *[F.get("_q", F.lit(i)).alias(f"q{i}") for i in range(len(probs))]
        )

    rows = values.join(_brackets(values, groups, probs, slices), list(groups))
    low, high = [F.col(f"_low{i}") for i in range(len(probs))], [F.col(f"_high{i}") for i in range(len(probs))]
    held = F.lit(False)
    for lo, hi in zip(low, high):
        held = held | F.col("_v").between(lo, hi)
    counts = rows.groupBy(*groups, F.when(held, F.col("_v")).alias("_at")).agg(
        F.min("n").alias("n"),
        F.count("*").alias("_c"),
        *[F.count_if(~held & (F.col("_v") < lo)).alias(f"_below{i}") for i, lo in enumerate(low)],
    )
    # The row of what lies outside all brackets comes first, where there is one.
    in_order = W.partitionBy(*groups).orderBy(F.asc_nulls_first("_at")).rowsBetween(W.unboundedPreceding, 0)
    inside = F.when(F.col("_at").isNotNull(), F.col("_c")).otherwise(F.lit(0))
    ordered = counts.withColumns({
        "_until": F.sum(inside).over(in_order),
        **{f"_below{i}": F.first(f"_below{i}").over(in_order) for i in range(len(probs))},
    }).where(F.col("_at").isNotNull())
    ranks = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    picks = []
    for i, r in enumerate(ranks):
        end = F.col(f"_below{i}") + F.col("_until")
        for name, edge in (("l", F.floor(r)), ("u", F.ceil(r))):
            hit = F.when((edge >= end - F.col("_c")) & (edge < end), F.col("_at"))
            picks.append(F.max(hit).alias(f"_{name}{i}"))
    found = ordered.groupBy(*groups, "n").agg(*picks)
    out = []
    for i, r in enumerate(ranks):
        lower, upper = F.col(f"_l{i}"), F.col(f"_u{i}")
        out.append((lower + (upper - lower) * (r - F.floor(r))).alias(f"q{i}"))
    return found.select(*groups, "n", *out)


def _brackets(values: DataFrame, groups: Sequence[str], probs: Sequence[float], accuracy: int) -> DataFrame:
    """Per group ``n`` and, for each wanted rank, values surely not above and not below it.

    The sketch's ranks are off by at most one in ``accuracy`` rows; a bracket reaches four times as
    far.  Groups too small for that to be a whole row are taken from end to end.
    """
    reach = 4.0 / accuracy
    edges = [x for p in probs for x in (max(0.0, p - reach), min(1.0, p + reach))]
    sketch = F.percentile_approx("_v", edges, accuracy)
    found = values.groupBy(*groups).agg(
        F.count("*").alias("n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"), sketch.alias("_edges")
    )
    out = []
    for i, (p_low, p_high) in enumerate(zip(edges[::2], edges[1::2])):
        small = F.col("n") <= accuracy
        low = F.when(small | F.lit(p_low <= 0.0), F.col("_min")).otherwise(F.get("_edges", F.lit(2 * i)))
        high = F.when(small | F.lit(p_high >= 1.0), F.col("_max")).otherwise(F.get("_edges", F.lit(2 * i + 1)))
        out += [low.alias(f"_low{i}"), high.alias(f"_high{i}")]
    return found.select(*groups, "n", *out)


def group_median(
    df: DataFrame, group: str, value: str, small_domain: bool = False
) -> DataFrame:
    """Groups by descending median; groups without a name are left out."""
    named = df.where(F.col(group).isNotNull())
    found = group_quantiles(named, [group], value, [0.5], small_domain)
    return found.select(group, F.col("q0").alias("median")).orderBy(F.desc("median"), group)


def boxplot_stats(
    df: DataFrame, group: str, value: str, reach: float = 1.5, small_domain: bool = False
) -> DataFrame:
    """Quartiles, whiskers (furthest values within ``reach`` box lengths) and outlier counts."""
    joined = _with_fences(df, group, value, reach, small_domain)
    v, inside = F.col("_v"), F.col("_v").between(F.col("fence_low"), F.col("fence_high"))
    out = joined.groupBy(group, "n", "q1", "median", "q3").agg(
        F.min(F.when(inside, v)).alias("_low"),
        F.max(F.when(inside, v)).alias("_high"),
        F.count_if(~inside).alias("outliers"),
    )
    return out.select(
        group,
        "n",
        F.coalesce(F.least("_low", "q1"), F.col("q1")).alias("whisker_low"),
        "q1",
        "median",
        "q3",
        F.coalesce(F.greatest("_high", "q3"), F.col("q3")).alias("whisker_high"),
        "outliers",
    ).orderBy(F.desc("median"), group)


def _with_fences(
    df: DataFrame, group: str, value: str, reach: float, small_domain: bool
) -> DataFrame:
    """The values with the box of their group."""
    found = group_quantiles(df, [group], value, [0.25, 0.5, 0.75], small_domain)
    step: Column = (F.col("q2") - F.col("q0")) * reach
    box = found.select(
        group,
        "n",
        F.col("q0").alias("q1"),
        F.col("q1").alias("median"),
        F.col("q2").alias("q3"),
        (F.col("q0") - step).alias("fence_low"),
        (F.col("q2") + step).alias("fence_high"),
    )
    return _values(df, [group], value).join(box, group)


def outliers(
    df: DataFrame, group: str, value: str, reach: float = 1.5, small_domain: bool = False
) -> DataFrame:
    """The values beyond the whiskers, each as often as it occurs."""
    joined = _with_fences(df, group, value, reach, small_domain)
    beyond = joined.where(~F.col("_v").between(F.col("fence_low"), F.col("fence_high")))
    return beyond.select(group, F.col("_v").alias(value))
