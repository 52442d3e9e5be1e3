"""Log of a collection: what each listing page added."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from jobtide.operators.running import running_total


def coverage_log(
    df: DataFrame, term: str, page: str, key: str, order: str, term_order: str | None = None
) -> DataFrame:
    """Per (term, page): cards, new keys, running total of new keys, length of the no-new streak.

    A key counts as new on the page where it is first met.  First meetings are found by an
    aggregate (a hot key sends one row per task), and windows run only over the page table: the
    running total is summed inside each term and then shifted by the totals of earlier terms, which
    come from a prefix sum over blocks of terms.
    """
    rank = F.col(term_order) if term_order else F.col(term)
    rows = df.select(
        rank.alias("_rank"),
        F.col(term).alias("_term"),
        F.col(page).alias("_page"),
        F.col(key).alias("_key"),
        F.col(order).alias("_order"),
    )
    pages = rows.groupBy("_rank", "_term", "_page").agg(F.count("*").alias("cards"))
    first = rows.groupBy("_key").agg(
        F.min(F.struct("_rank", "_page", "_order", "_term")).alias("_first")
    )
    new = first.groupBy(F.col("_first._term").alias("_t"), F.col("_first._page").alias("_p")).agg(
        F.count("*").alias("new")
    )
    log = pages.join(
        new, (pages["_term"] == new["_t"]) & (pages["_page"] == new["_p"]), "left"
    ).select("_rank", "_term", "_page", "cards", F.coalesce("new", F.lit(0)).alias("new"))

    by_page = W.partitionBy("_rank", "_term").orderBy("_page").rowsBetween(
        W.unboundedPreceding, W.currentRow
    )
    terms = log.groupBy("_rank", "_term").agg(F.sum("new").alias("_sum"))
    totals = running_total(terms, ["_rank", "_term"], "_sum", "_until")
    shift = totals.select(F.col("_term").alias("_t"), (F.col("_until") - F.col("_sum")).alias("_shift"))
    log = log.withColumn("_within", F.sum("new").over(by_page)).withColumn(
        "_island", F.sum(F.when(F.col("new") > 0, 1).otherwise(0)).over(by_page)
    )
    streak = W.partitionBy("_rank", "_term", "_island").orderBy("_page").rowsBetween(
        W.unboundedPreceding, W.currentRow
    )
    log = log.withColumn(
        "no_new_streak", F.sum(F.when(F.col("new") == 0, 1).otherwise(0)).over(streak)
    )
    return log.join(shift, log["_term"] == shift["_t"]).select(
        F.col("_term").alias(term),
        F.col("_page").alias(page),
        "cards",
        "new",
        (F.col("_within") + F.col("_shift")).alias("total"),
        "no_new_streak",
    )
