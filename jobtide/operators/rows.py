"""Row selection: first of each key, latest periods, top groups, samples, repeats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One whole row per key, the first by ``order`` (which must not tie within a key).

    An aggregate, not a window: every task reduces its own rows first, so a key that holds a third
    of the table sends one row per task instead of all of them.
    """
    row = F.struct(*[F.col(c) for c in df.columns])
    first = F.min_by(row, F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*keys).agg(first.alias("_row")).select("_row.*")


def limit_in_order(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows by ``order`` (a top-n, no full sort)."""
    return df.orderBy(*order).limit(n)


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows, the same on every run whatever the partitioning."""
    digest = F.sha1(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))
    return df.orderBy(digest, key).limit(n)


def latest_periods(df: DataFrame, period: str, k: int = 8) -> DataFrame:
    """Rows of the ``k`` newest distinct periods."""
    newest = df.select(period).where(F.col(period).isNotNull()).distinct()
    return df.join(newest.orderBy(F.desc(period)).limit(k), period, "left_semi")


def in_top_groups(df: DataFrame, group: str, k: int | None = None, min_rows: int = 1) -> DataFrame:
    """Rows whose group is among the ``k`` largest, or has at least ``min_rows`` rows."""
    sizes = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("_n"))
    sizes = sizes.where(F.col("_n") >= min_rows)
    if k is not None:
        sizes = sizes.orderBy(F.desc("_n"), group).limit(k)
    return df.join(sizes.select(group), group, "left_semi")


def row_digest(columns: Sequence[str]) -> Column:
    """SHA-256 of the whole row; lengths and null marks keep different rows apart."""

    def part(name: str) -> Column:
        text = F.col(name).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat_ws("|", *[part(c) for c in columns]).cast("binary"), 256)


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: rows, distinct rows, and rows that repeat an earlier one in every column.

    Rows travel as digests, so wide text is never shuffled.
    """
    counts = df.groupBy(row_digest(columns or df.columns).alias("_d")).agg(F.count("*").alias("_n"))
    return counts.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        F.count("*").alias("distinct_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def class_of_key(
    df: DataFrame, key: str, value: str, order: Sequence[str], wanted: Sequence | None = None
) -> DataFrame:
    """The value on the first row of each (wanted) key."""
    if wanted is not None:
        df = df.where(F.col(key).isin(*wanted))
    first = F.min_by(F.col(value), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(key).agg(first.alias(value))
