"""Dates and quarters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobtide.functions.text import as_col, nonempty, strip

DATE_FORMATS = ("yyyy-MM-dd", "d MMMM yyyy", "d MMM yyyy", "dd.MM.yyyy", "yyyy-MM-dd'T'HH:mm:ss")


def parse_date(c: Column | str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Timestamp by the first format that fits, else null."""
    text = nonempty(strip(c))
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def quarter_label(c: Column | str) -> Column:
    """``2026Q1``; null dates give null."""
    c = as_col(c)
    return F.concat(F.year(c).cast("string"), F.lit("Q"), F.quarter(c).cast("string"))


def quarter_start(label: Column | str) -> Column:
    """First day of a ``2026Q1`` label, null where the text is no such label."""
    label = as_col(label)
    year = F.regexp_extract(label, r"^(\d{4})Q([1-4])$", 1).try_cast("int")
    quarter = F.regexp_extract(label, r"^(\d{4})Q([1-4])$", 2).try_cast("int")
    ok = year.isNotNull() & quarter.isNotNull()
    return F.when(ok, F.make_date(year, (quarter - 1) * 3 + 1, F.lit(1)))


def period_proxy(
    label: Column | str, replacements: dict | None = None, latest: Column | str | None = None
) -> Column:
    """Quarter used as join key: listed labels replaced; none later than ``latest``.

    Labels of this form sort by time as text.
    """
    label = as_col(label)
    out = label
    for old, new in (replacements or {}).items():
        out = F.when(label == old, F.lit(new)).otherwise(out)
    if latest is not None:
        bound = F.lit(latest) if isinstance(latest, str) else latest
        out = F.when(out > bound, bound).otherwise(out)
    return out
