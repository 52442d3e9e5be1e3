"""Joins to lookup and statistics tables.

No side is broadcast by hint unless its size is fixed by the code: Spark broadcasts by the
measured size and falls back to a shuffled join, with skewed partitions split, beyond it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_enrich(
    df: DataFrame,
    other: DataFrame,
    on: Mapping[str, str],
    values: Mapping[str, str],
    null_safe: bool = False,
) -> DataFrame:
    """Left equi-join.  ``on`` maps left to right key names, ``values`` right to output names.

    A repeated key on the right repeats the left row.  ``null_safe`` lets null keys meet.
    """
    right = other.select(
        *[F.col(r).alias(f"_k{i}") for i, r in enumerate(on.values())],
        *[F.col(r).alias(out) for r, out in values.items()],
    )
    tests: list[Column] = []
    for i, left_name in enumerate(on):
        left, key = df[left_name], right[f"_k{i}"]
        tests.append(left.eqNullSafe(key) if null_safe else left == key)
    cond = tests[0]
    for t in tests[1:]:
        cond = cond & t
    return df.join(right, cond, "left").drop(*[f"_k{i}" for i in range(len(on))])


def match_report(df: DataFrame, value: str, before: DataFrame | None = None) -> DataFrame:
    """One row: rows before and after a left join, and how many found a partner."""
    after = df.agg(
        F.count("*").alias("rows_after"),
        F.count(value).alias("matched"),
        F.count_if(F.col(value).isNull()).alias("unmatched"),
    )
    if before is None:
        return after
    rows = before.agg(F.count("*").alias("n")).scalar()
    return after.select(rows.alias("rows_before"), "rows_after", "matched", "unmatched")


#: A key with more than one in so many left rows is hot, so at most so many keys are.
HOT_SHARE = 1000


def hot_keys(df: DataFrame, keys: Sequence[str], share: int = HOT_SHARE) -> DataFrame:
    """Keys with more than one in ``share`` rows, and ``_parts``, the places each is dealt over.

    At most ``share`` rows, whatever the table; keys with a null are not counted.
    """
    counts = df.select(*keys).dropna().groupBy(*keys).agg(F.count("*").alias("_n"))
    return hot_of_counts(counts, keys, share)


def hot_of_counts(counts: DataFrame, keys: Sequence[str], share: int = HOT_SHARE) -> DataFrame:
    """As ``hot_keys``, of the rows ``_n`` of each key; the keys must not repeat, those with a null are not counted."""
    counts = counts.dropna(subset=list(keys))
    least = counts.agg(F.sum("_n") / share).scalar()
    return counts.where(F.col("_n") > least).select(*keys, F.ceil(F.col("_n") / least).cast("int").alias("_parts"))


def spread_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], spread: Sequence[str], how: str = "inner", share: int = HOT_SHARE,
    counts: DataFrame | None = None, shuffled: bool = False,
) -> DataFrame:
    """Equi-join (``inner`` or ``left``) in which no task gathers a hot key or the rows without a key.

    Left rows of a hot key are dealt over places by a hash of their ``spread`` columns, and the right
    rows of that key are copied to each of its places; left rows with a null key are dealt over
    ``share`` places.  The hot keys are counted first, by an aggregate over the keys only; there are at
    most ``share`` of them, so they may be broadcast.  Left rows that agree in all ``spread`` columns
    stay together.  ``counts`` (the keys and their left rows ``_n``), where they are known, save that
    aggregate.  ``shuffled`` keeps Spark from broadcasting the right rows: what it takes for the size of
    rows made by an explode can be far too low.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    hot = F.broadcast(hot_keys(left, on, share) if counts is None else hot_of_counts(counts, on, share))
    if how == "inner":
        left = left.dropna(subset=list(on))
    missing = F.lit(False)
    for key in on:
        missing = missing | F.col(key).isNull()
    hashed = F.xxhash64(*[F.col(c) for c in spread])
    parts = F.when(missing, F.lit(share)).otherwise(F.coalesce("_parts", F.lit(1)))
    dealt = left.join(hot, list(on), "left").withColumn("_place", F.pmod(hashed, parts).cast("int")).drop("_parts")
    places = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    copied = right.join(hot, list(on), "left").withColumn("_place", places).drop("_parts")
    copied = copied.hint("merge") if shuffled else copied
    return dealt.join(copied, [*on, "_place"], how).drop("_place")
