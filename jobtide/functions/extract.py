"""Typed facts out of free text: salary, seniority, experience, workload."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobtide import fixed_values as fixed
from jobtide.functions.text import SPACE, WORD_EDGE, as_col

_WS = f"[{SPACE}]*"


def plain_apostrophes(c: Column | str) -> Column:
    marks = fixed.TYPOGRAPHIC_APOSTROPHES
    return F.translate(as_col(c), marks, "'" * len(marks))


def _amount(text: Column, marks: str, factor: int = 1) -> Column:
    digits = F.regexp_replace(text, f"[{marks}]", "") if marks else text
    return F.try_multiply(digits.try_cast("long"), F.lit(factor).cast("long"))


def salary_range(c: Column | str) -> Column:
    """``struct<min int, max int>`` of the first plausible amount, null where there is none.

    Tried in order: a range, one amount grouped by apostrophes, a monthly amount (times twelve),
    one amount grouped by commas.  Within a form the first hit inside the bounds wins.  Texts
    without the currency skip every pattern.
    """
    low, high = fixed.SALARY_BOUNDS
    cur = fixed.SALARY_CURRENCY
    month = f"{_WS}".join(fixed.SALARY_MONTH_WORDS)
    text = plain_apostrophes(c)

    def plausible(x: Column) -> Column:
        return F.coalesce(x.between(low, high), F.lit(False))

    def pair(lo: Column, hi: Column) -> Column:
        return F.struct(lo.alias("min"), hi.alias("max"))

    def single(pattern: str, marks: str, factor: int = 1) -> Column:
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
        amounts = F.filter(F.transform(found, lambda s: _amount(s, marks, factor)), plausible)
        return F.get(F.transform(amounts, lambda a: pair(a, a)), F.lit(0))

    span = rf"(?i){cur}{_WS}([0-9']+){_WS}(?:{fixed.SALARY_RANGE_WORDS}){_WS}([0-9']+)"
    # the text is searched once; the two figures are taken from each short hit
    spans = F.transform(
        F.regexp_extract_all(text, F.lit(span), F.lit(0)),
        lambda hit: pair(
            _amount(F.regexp_extract(hit, span, 1), "',"),
            _amount(F.regexp_extract(hit, span, 2), "',"),
        ),
    )
    spans = F.filter(spans, lambda s: plausible(s["min"]) & plausible(s["max"]))

    found = F.coalesce(
        F.get(spans, F.lit(0)),
        single(rf"(?i){cur}{_WS}([0-9']['0-9]+)", "',"),
        single(rf"(?i)([0-9]+){_WS}{cur}{_WS}{month}", "", 12),
        single(rf"(?i){cur}{_WS}([0-9,]+)", ","),
    )
    kind = "struct<min:int,max:int>"
    return F.when(F.contains(F.lower(as_col(c)), F.lit(cur)), found.cast(kind))


def disclosed(c: Column | str) -> Column:
    """1 where the value is present, else 0."""
    return as_col(c).isNotNull().cast("int")


def raw_disclosed(c: Column | str) -> Column:
    """1 where the raw text is not empty, else 0."""
    return (F.length(F.coalesce(as_col(c), F.lit(""))) > 0).cast("int")


def _any_word(text: Column, words: str) -> Column:
    return text.rlike(f"{WORD_EDGE}(?:{words}){WORD_EDGE}")


def seniority_from_words(title: Column | str, description: Column | str) -> Column:
    """Level named in the title, else one named unmistakably in the description, else null."""
    title = F.lower(F.coalesce(as_col(title), F.lit("")))
    text = F.lower(F.coalesce(as_col(description), F.lit("")))

    def cascade(where: Column, patterns) -> Column:
        return F.coalesce(*[F.when(_any_word(where, w), F.lit(level)) for level, w in patterns])

    # most descriptions name no level at all: one test for all words spares them the cascade
    some = "|".join(words for _, words in fixed.SENIORITY_TEXT_PATTERNS)
    in_text = F.when(_any_word(text, some), cascade(text, fixed.SENIORITY_TEXT_PATTERNS))
    return F.coalesce(cascade(title, fixed.SENIORITY_TITLE_PATTERNS), in_text)


def seniority_of_years(years: Column) -> Column:
    return (
        F.when(years <= fixed.JUNIOR_MAX_YEARS, "junior")
        .when(years <= fixed.MID_MAX_YEARS, "mid")
        .when(years.isNotNull(), "senior")
    )


def experience_years(c: Column | str) -> Column:
    """Years asked for: lower bound of the first range, else the first single figure, else null."""
    tail = (
        rf"{_WS}(?:{fixed.EXPERIENCE_YEAR_WORDS})(?:[{SPACE}]+of)?{_WS}"
        rf"(?:{fixed.EXPERIENCE_WORDS})"
    )
    span = rf"(?iu)([0-9]+)\+?{_WS}(?:{fixed.EXPERIENCE_RANGE_WORDS}){_WS}[0-9]+\+?{tail}"
    one = rf"(?iu)([0-9]+)\+?{tail}"

    def years(pattern: str) -> Column:
        digits = F.regexp_extract(as_col(c), pattern, 1)
        # a figure too long for a number is still a (large) number of years
        return F.when(digits != "", F.coalesce(digits.try_cast("int"), F.lit(2**31 - 1)))

    return F.coalesce(years(span), years(one))


def seniority(title: Column | str, description: Column | str) -> Column:
    """Words first; where they say nothing, the years of experience asked for."""
    return F.coalesce(
        seniority_from_words(title, description),
        seniority_of_years(experience_years(description)),
    )


def workload_bounds(c: Column | str) -> Column:
    """``struct<min int, max int>``: one figure gives both bounds, more give the first two.

    A figure beyond an int is an unknown bound; no later figure takes its place.
    """
    runs = F.regexp_extract_all(as_col(c), F.lit("([0-9]+)"), F.lit(1))
    # folded over the first two, so the text is searched once
    none = F.lit(None).cast("int")
    return F.aggregate(
        F.slice(F.coalesce(runs, F.array().cast("array<string>")), 1, 2),
        F.struct(F.lit(0).alias("n"), none.alias("min"), none.alias("max")),
        lambda seen, run: F.struct(
            (seen["n"] + 1).alias("n"),
            F.when(seen["n"] == 0, run.try_cast("int")).otherwise(seen["min"]).alias("min"),
            run.try_cast("int").alias("max"),
        ),
        lambda seen: F.struct(seen["min"].alias("min"), seen["max"].alias("max")),
    )


def workload_category(low: Column | str, high: Column | str, variant: str = "analysis") -> Column:
    """Part-time up to 60, full-time from 90, else flexible.

    ``analysis`` calls a missing lower bound unknown; ``dashboard`` only both bounds missing.
    """
    low, high = as_col(low), as_col(high)
    full, flexible, part, unknown = fixed.WORKLOAD_LABELS[variant]
    missing = low.isNull() if variant == "analysis" else low.isNull() & high.isNull()
    return F.when(missing, unknown).when(high <= 60, part).when(low >= 90, full).otherwise(flexible)
