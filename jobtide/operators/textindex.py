"""Text search that reads only rows which can match, by an index of three-character pieces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.functions.text import as_col
from jobtide.operators.facets import text_search
from jobtide.operators.textjoin import grams
from jobtide.session import stored

GRAM = 3
_SPECIAL = set("\\^$.|?*+()[]{}")
#: Letters with a further small form, that form as it counts when case is ignored; a mark that goes.
_FORMS, _PLAIN = "ςſµıϐϑϕϖϰϱϵẛ\u1fbe\u0307", "σsμiβθφπκρεṡι"


def folded(c: Column | str) -> Column:
    """Text in which letters that count as equal when case is ignored are equal."""
    return F.translate(F.lower(as_col(c)), _FORMS, _PLAIN)


def build_index(df: DataFrame, key: str, columns: Sequence[str], path: str) -> None:
    """Writes (gram, key) rows, dealt by ranges of the gram and sorted, so that a search reads few row groups.

    ``key`` must identify a row.  A piece that very many rows hold is spread over ranges of keys.
    """
    pieces = F.array_distinct(F.concat(*[grams(folded(F.coalesce(F.col(c), F.lit(""))), GRAM) for c in columns]))
    # Written first: the ranges are found by readings of their own, which would cut all texts again.
    rows = stored(df.select(F.explode(pieces).alias("gram"), F.col(key).alias("key")))
    rows.repartitionByRange("gram", "key").sortWithinPartitions("gram", "key").write.mode("overwrite").parquet(path)


def literal_runs(pattern: str) -> list[str]:
    """Texts that every match of a regular expression holds.  Where that is not plain to see, fewer or none."""
    if "|" in pattern or "(?" in pattern or "\\" in pattern:
        return []
    runs, run, depth, inside = [], "", 0, False
    for at, ch in enumerate(pattern):
        after = pattern[at + 1 : at + 2]
        plain = ch not in _SPECIAL and not depth and not inside and not (after and after in "?*{")
        if plain:
            run += ch
            if after == "+":
                runs.append(run)
                run = ""
            continue
        runs.append(run)
        run = ""
        if inside:
            inside = ch != "]"
        elif ch == "[":
            inside = True
        elif ch in "({":
            depth += 1
        elif ch in ")}":
            depth -= 1
    # A class may hold brackets of its own; such a pattern is not taken apart.
    if "[]" in pattern or "[^]" in pattern or pattern.count("[") != pattern.count("]") or depth or inside:
        return []
    return [r for r in [*runs, run] if r]


def needed_grams(spark: SparkSession, query: str, regex: bool) -> list[str]:
    """Pieces that a row must hold to match, all in one of its columns; none if every row may match."""
    runs = literal_runs(query) if regex else [query]
    if not runs:
        return []
    found = spark.createDataFrame([(r,) for r in runs], "run string").select(F.explode(grams(folded("run"), GRAM)).alias("g"))
    return sorted(r["g"] for r in found.distinct().collect())


def candidates(spark: SparkSession, path: str, needed: Sequence[str]) -> DataFrame:
    """Keys of the rows that hold all needed pieces."""
    hits = spark.read.parquet(path).where(F.col("gram").isin(list(needed)))
    return hits.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") == len(needed)).select("key")


def indexed_search(df: DataFrame, key: str, columns: Sequence[str], path: str, query: str, regex: bool = True) -> DataFrame:
    """The rows that ``facets.text_search`` finds, looked for only among those with all pieces of the query."""
    needed = needed_grams(df.sparkSession, query, regex)
    if needed:
        found = candidates(df.sparkSession, path, needed)
        df = df.join(found, df[key] == found["key"], "left_semi")
    return df.where(text_search(query, *columns, regex=regex))
