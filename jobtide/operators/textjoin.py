"""Joins of texts to tables of names and keywords of any size.

Nothing of either table is collected or folded into the plan: both sides become rows with a piece of
text in common, meet in an equi-join, and are then tested exactly.  A piece that a large part of the
texts holds is dealt over many tasks (``joins.spread_join``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.functions.text import WORD
from jobtide.operators.joins import spread_join
from jobtide.operators.rows import keep_first
from jobtide.session import stored

GRAM = 4


def grams(text: Column, size: int) -> Column:
    """Distinct pieces of ``size`` neighbouring characters, found in one pass over the text."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1)))


def _exploded_grams(rows: DataFrame, keys: Sequence[str], text: Column, sizes: Sequence[int]) -> DataFrame:
    every = F.concat(*[grams(text, n) for n in sizes]) if len(sizes) > 1 else grams(text, sizes[0])
    return rows.select(*keys, F.explode(every).alias("_gram"))


def substring_join(
    texts: DataFrame, key: str, text: str, names: DataFrame, name: str, gram: int = GRAM
) -> DataFrame:
    """The key of each text with every row of ``names`` whose name the text contains, as it is written.

    ``key`` must identify a text.  Each name is entered under that one of its pieces of ``gram``
    characters which the fewest texts hold (a shorter name under itself); a name with a piece that no
    text holds is out at once.  Texts meet names by these pieces, and the whole name is then looked
    for.  Null and empty names and null texts meet nothing.  A repeated name gives a row each time.
    """
    names = names.where(F.length(name) > 0)
    listed = names.select(F.col(name).alias("_name")).distinct()
    # How long the pieces are: at most ``gram`` different numbers.
    sizes = sorted(r[0] for r in listed.select(F.least(F.char_length("_name"), F.lit(gram))).distinct().collect())
    if not sizes:
        return _none(texts.select(key), names)
    own = F.when(F.char_length("_name") < gram, F.array("_name")).otherwise(grams(F.col("_name"), gram))
    of_name = listed.select("_name", F.explode(own).alias("_gram"))
    of_text = _exploded_grams(texts.where(F.col(text).isNotNull()), [key], F.col(text), sizes)
    # The texts are cut twice: to count the pieces that names have, and to meet the names by the pieces chosen.  Both
    # times what no name asks for falls out at once, before anything is shuffled, if the pieces asked for are few.
    asked = stored(of_name.select("_gram").distinct())
    counts = stored(of_text.join(asked, "_gram", "left_semi").groupBy("_gram").agg(F.count("*").alias("_n")))
    rated = of_name.join(counts, "_gram", "left")
    entry = rated.groupBy("_name").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("_n"), "_gram")).alias("_entry"))
    entry = stored(entry.where(F.col("_entry._n") > 0).select("_name", F.col("_entry._gram").alias("_gram")))
    chosen = stored(counts.join(entry.select("_gram").distinct(), "_gram", "left_semi"))
    # Names that texts do not meet are out before their rows are joined; a repeated name has an entry for each row.
    named = names.withColumn("_name", F.col(name)).join(entry, "_name")
    met = of_text.join(chosen.select("_gram"), "_gram", "left_semi")
    pairs = spread_join(met, named, ["_gram"], [key], counts=chosen, shuffled=True).drop("_gram")
    found = pairs.join(texts.select(F.col(key).alias("_key"), F.col(text).alias("_text")), F.col(key) == F.col("_key"))
    return found.where(F.contains("_text", "_name")).select(key, *names.columns)


def _none(left: DataFrame, right: DataFrame) -> DataFrame:
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema]
    return left.where(F.lit(False)).select("*", *columns)


def first_name(found: DataFrame, key: str, priority: Sequence[str]) -> DataFrame:
    """Of the names found in each text the first by the priority columns (which must not tie)."""
    return keep_first(found, [key], priority)


# --- keyword rules ---------------------------------------------------------------------------


def _pieces(text: Column) -> tuple[Column, Column]:
    """The words of a text, and what stands before, between and after them (one more)."""
    return F.regexp_extract_all(text, F.lit(f"([{WORD}]+)"), F.lit(1)), F.split(text, f"[{WORD}]+", -1)


def _at(array: Column, i: Column | int) -> Column:
    return F.get(array, i if isinstance(i, Column) else F.lit(i))


def _core(words: Column, gaps: Column, i: Column, size: int) -> Column:
    parts = [_at(words, i)]
    for n in range(1, size):
        parts += [_at(gaps, i + n), _at(words, i + n)]
    return F.concat(*parts)


def _phrases(words: Column, gaps: Column, size: int) -> Column:
    """Every run of ``size`` words as written, with the marks before and after it; 0 asks for marks alone."""
    last = F.size(words) - size
    if size == 0:
        low, high = F.lit(1), last - 1

        def piece(i: Column) -> Column:
            return F.struct(F.lit(0).alias("n"), _at(gaps, i).alias("core"), F.lit("").alias("before"), F.lit("").alias("after"))
    else:
        low, high = F.lit(0), last

        def piece(i: Column) -> Column:
            before = F.when(i > 0, _at(gaps, i))
            after = F.when(i < last, _at(gaps, i + size))
            return F.struct(
                F.lit(size).alias("n"), _core(words, gaps, i, size).alias("core"), before.alias("before"), after.alias("after")
            )

    places = F.when(high >= low, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, piece))


def keyword_hits(texts: DataFrame, key: str, text: str, rules: DataFrame, keyword: str = "keyword") -> DataFrame:
    """The key of each text with every row of ``rules`` whose keyword is in its lower-cased text as whole words.

    The same hits as ``RuleSet.trace`` (which folds a short list into one pattern and reads each text
    once), for tables of any size.  A keyword is its words as written, with what stands between them;
    marks before its first or behind its last word must be all that parts them from a further word.
    Runs of as many words as keywords have are joined to the keywords; ``key`` must identify a text.
    Null and empty keywords and null texts meet nothing.
    """
    words, gaps = _pieces(F.col(keyword))
    parsed = rules.where(F.length(keyword) > 0).withColumns({"_w": words, "_g": gaps})
    parsed = parsed.withColumn("n", F.size("_w"))
    # How many words keywords have: as many numbers as there are different lengths.
    sizes = sorted(r[0] for r in parsed.select("n").distinct().collect())
    if not sizes:
        return _none(texts.select(key), rules)
    head, tail = F.char_length(_at(F.col("_g"), 0)), F.char_length(_at(F.col("_g"), F.col("n")))
    inner = F.substring(F.col(keyword), head + 1, F.char_length(keyword) - head - tail)
    lead = F.when(F.col("n") > 0, _at(F.col("_g"), 0)).otherwise(F.lit(""))
    trail = F.when(F.col("n") > 0, _at(F.col("_g"), F.col("n"))).otherwise(F.lit(""))
    core = F.when(F.col("n") > 0, inner).otherwise(F.col(keyword))
    entries = parsed.withColumns({"core": core, "_lead": lead, "_trail": trail}).drop("_w", "_g")
    entries = entries.select("n", "core", "_lead", "_trail", F.struct(*rules.columns).alias("_rule"))
    words, gaps = _pieces(F.lower(F.col(text)))
    cut = texts.where(F.col(text).isNotNull()).select(key, words.alias("_w"), gaps.alias("_g"))
    every = [_phrases(F.col("_w"), F.col("_g"), n) for n in sizes]
    runs = cut.select(key, F.explode(F.concat(*every) if len(every) > 1 else every[0]).alias("_p")).select(key, "_p.*")
    met = spread_join(runs, entries, ["core", "n"], [key], shuffled=True)
    fits = ((F.col("_lead") == "") | (F.col("_lead") == F.col("before"))) & (
        (F.col("_trail") == "") | (F.col("_trail") == F.col("after"))
    )
    # A keyword may be met at several places with different marks around it.
    return met.where(fits).select(key, "_rule").distinct().select(key, "_rule.*")


def first_rule(hits: DataFrame, key: str) -> DataFrame:
    """Per text the first rule that fires, by rule and keyword order."""
    return keep_first(hits, [key], ["rule_order", "keyword_order", "category", "keyword"])
