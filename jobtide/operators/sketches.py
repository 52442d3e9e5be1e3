"""Distinct counts that can be stored per run and united for any choice of facets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The sketch has 2**LOG2_SIZE registers, some 4 kB.
LOG2_SIZE = 12


def relative_error(log2_size: int = LOG2_SIZE) -> float:
    """Standard error of an estimate, as a share of the count."""
    return 1.04 / 2 ** (log2_size / 2)


def distinct_sketches(df: DataFrame, by: Sequence[str], value: str, log2_size: int = LOG2_SIZE) -> DataFrame:
    """Per group a sketch of its different values: (by, sketch).  Null values do not count."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(F.col(value), log2_size).alias("sketch"))


def distinct_estimates(sketches: DataFrame, by: Sequence[str], name: str = "distinct") -> DataFrame:
    """Estimated different values of united groups; an empty ``by`` unites them all."""
    united = sketches.groupBy(*by).agg(F.hll_union_agg("sketch", True).alias("_s"))
    return united.select(*by, F.hll_sketch_estimate("_s").alias(name))
