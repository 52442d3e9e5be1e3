"""Figures over tag lists.

One pass over the postings counts every (group, tag) pair, with one extra entry per posting that
counts the posting itself.  That small table then serves three times (top tags, group sizes, cells)
from the same exchange.  Conditions on its keys are written as aggregates, not as filters: a filter
would be pushed below the exchange and make each use a plan, and a pass, of its own.  The top tags
come in as a scalar subquery of a handful of strings, so there is no group-by-tag product, and tags
that a group never mentions show zero.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.functions.text import percent
from jobtide.operators.summary import trimmed


def top_tags(df: DataFrame, tags: str, k: int | None = 15) -> DataFrame:
    # outer, then filtered: a plain explode also filters on the array itself, and would compute a
    # derived tag column twice
    mentions = df.select(F.explode_outer(tags).alias("tag")).where(F.col("tag").isNotNull())
    counts = mentions.groupBy("tag").agg(F.count("*").alias("count"))
    counts = counts.orderBy(F.desc("count"), "tag")
    return counts if k is None else counts.limit(k)


def _cells(df: DataFrame, group: str, tags: str) -> DataFrame:
    """Group, tag (null for the postings themselves), mentions, and postings with the tag."""
    own = F.struct(F.lit(None).cast("string").alias("tag"), F.lit(True).alias("first"))
    items = F.transform(
        F.coalesce(F.col(tags), F.array().cast("array<string>")),
        lambda t, i: F.struct(
            t.alias("tag"), (F.array_position(F.col(tags), t) == i + 1).alias("first")
        ),
    )
    rows = df.select(group, F.explode_outer(F.concat(F.array(own), items)).alias("_x"))
    return rows.groupBy(group, F.col("_x.tag").alias("_tag")).agg(
        F.count("*").alias("_mentions"), F.count_if(F.col("_x.first")).alias("_rows")
    )


def _top_list(cells: DataFrame, k: int) -> Column:
    """The most mentioned tags of the whole table in order, as one array."""
    totals = cells.groupBy("_tag").agg(F.sum("_mentions").alias("_n"), F.sum("_rows").alias("_r"))
    no_tag = F.col("_tag").isNull()
    # the last key never decides; it keeps both counters in use here, as they are for the groups
    best = totals.orderBy(no_tag, F.desc("_n"), "_tag", "_r").limit(k)
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("_n")).alias("n"), "_tag")))
    names = F.transform(ranked, lambda x: x["_tag"])
    return best.agg(F.filter(names, lambda t: t.isNotNull()).alias("tags")).scalar()


def _shares(
    df: DataFrame,
    group: str,
    tags: str,
    k: int,
    min_rows: int,
    figure: str,
    levels: Sequence[str] | None = None,
) -> DataFrame:
    cells = _cells(df, group, tags)
    top = _top_list(cells, k)
    tag = F.col("_tag")
    counters = F.struct("_mentions", "_rows")
    entry = F.when(F.array_contains(F.col("_top"), tag), F.struct(tag, counters))
    sizes = (
        cells.withColumn("_top", top)
        .groupBy(group)
        .agg(
            F.max(F.col(group).isNotNull()).alias("_named"),
            F.sum(F.when(tag.isNull(), F.col("_mentions")).otherwise(0)).alias("group_rows"),
            F.map_from_entries(F.collect_list(entry)).alias("_hits"),
        )
        .where(F.col("_named"))
    )
    if levels is None:
        sizes = sizes.where(F.col("group_rows") >= min_rows)
    else:
        level = F.explode(F.array(*[F.lit(x) for x in levels])).alias("_level")
        wanted = df.sparkSession.range(1).select(level)
        sizes = wanted.join(sizes, F.col("_level") == F.col(group), "left").select(
            F.col("_level").alias(group),
            F.coalesce("group_rows", F.lit(0)).alias("group_rows"),
            "_hits",
        )
    out = sizes.withColumn("_top", top).select(
        group, "group_rows", "_hits", F.posexplode_outer("_top").alias("_i", "tag")
    )
    n = F.coalesce(F.try_element_at("_hits", F.col("tag"))[figure], F.lit(0))
    return out.where(F.col("tag").isNotNull()).select(
        group,
        "group_rows",
        (F.col("_i") + 1).alias("tag_rank"),
        "tag",
        n.alias("mentions"),
        percent(n, F.col("group_rows")).alias("share_pct"),
    )


def tag_share_by_group(
    df: DataFrame,
    group: str,
    tags: str,
    k: int = 10,
    min_rows: int = 1,
    levels: Sequence[str] | None = None,
) -> DataFrame:
    """Mentions per hundred postings of the top ``k`` tags in each group, zeros included.

    The top tags are those of the whole table.  ``levels`` fixes the groups; a level without
    postings shows zeros.
    """
    return _shares(df, group, tags, k, min_rows, "_mentions", levels)


def tag_presence_matrix(
    df: DataFrame, group: str, tags: str, k: int = 10, min_rows: int = 5
) -> DataFrame:
    """Percent of each group's postings that hold each of the top ``k`` tags.

    Group labels are trimmed; largest groups first.
    """
    shares = _shares(trimmed(df, group), group, tags, k, min_rows, "_rows")
    return shares.orderBy(F.desc("group_rows"), group, "tag_rank")


def widen(shares: DataFrame, group: str, tags: Sequence[str], value: str = "share_pct") -> DataFrame:
    """Long shares to one column per given tag."""
    return shares.groupBy(group, "group_rows").agg(
        *[F.max(F.when(F.col("tag") == t, F.col(value))).alias(t) for t in tags]
    )
