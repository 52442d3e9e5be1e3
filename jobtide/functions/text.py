"""Text clean-up, keys and small scalar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes spelled out, so the result depends neither on the JDK's idea of ``\b`` and
# ``\s`` nor on the (slower) UNICODE_CHARACTER_CLASS flag.
SPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD = r"\p{L}\p{N}_"
WORD_START = rf"(?<![{WORD}])(?=[{WORD}])"
WORD_EDGE = rf"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim all Unicode white space, not only blanks."""
    return F.regexp_replace(as_col(c), f"^[{SPACE}]+|[{SPACE}]+$", "")


def clean_text(c: Column | str) -> Column:
    """Null to ``''``, white space runs to one blank, trimmed."""
    return F.trim(F.regexp_replace(F.coalesce(as_col(c), F.lit("")), f"[{SPACE}]+", " "))


def nonempty(c: Column | str) -> Column:
    """Null for null, empty and white-space-only text, else the text unchanged."""
    c = as_col(c)
    return F.when(F.length(strip(c)) > 0, c)


def coalesce_nonempty(*cols: Column | str) -> Column:
    """First text that is not empty, else null."""
    return F.coalesce(*[nonempty(c) for c in cols])


def surrogate_key(*cols: Column | str, sep: str = "|") -> Column:
    """SHA-1 hex digest of the joined columns; nulls count as ``''``."""
    parts = [F.coalesce(as_col(c).cast("string"), F.lit("")) for c in cols]
    return F.sha1(F.concat_ws(sep, *parts).cast("binary"))


def concat_fields(*cols: Column | str) -> Column:
    """Fields joined by one blank, nulls as ``''``."""
    return F.concat_ws(" ", *[F.coalesce(as_col(c), F.lit("")) for c in cols])


def safe_timestamp(c: Column | str) -> Column:
    """A run timestamp made usable in a file name."""
    return F.translate(as_col(c), ":", "-")


def to_number(c: Column | str, kind: str = "double", default: object = None) -> Column:
    """Number in a text; unreadable text gives null, or ``default`` where one is given."""
    out = strip(as_col(c).cast("string")).try_cast(kind)
    return out if default is None else F.coalesce(out, F.lit(default).cast(kind))


def percent(part: Column, whole: Column, digits: int | None = None) -> Column:
    out = F.when(whole > 0, F.lit(100.0) * part / whole).otherwise(F.lit(0.0))
    return out if digits is None else F.round(out, digits)


def short_label(c: Column | str, width: int = 30) -> Column:
    """Text after the first blank (the whole text where there is none), cut to ``width``."""
    parts = F.split(as_col(c), " ", 2)
    return F.substring(F.element_at(parts, -1), 1, width)


def preview_text(c: Column | str, width: int = 500) -> Column:
    return F.substring(as_col(c), 1, width)


def yes_no(c: Column | str) -> Column:
    return F.when(as_col(c) == 1, F.lit("Yes")).otherwise(F.lit("No"))


def replace_value(c: Column | str, mapping: dict) -> Column:
    """Listed values replaced, all others kept."""
    c = as_col(c)
    out = c
    for old, new in mapping.items():
        out = F.when(c == F.lit(old), F.lit(new)).otherwise(out)
    return out


def map_value(c: Column | str, mapping: dict) -> Column:
    """Dictionary map for short dictionaries; unmapped and null give null."""
    if not mapping:
        return F.lit(None).cast("string")
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    c = as_col(c)
    return F.when(c.isNotNull(), F.try_element_at(F.create_map(*pairs), c))


def contains_any(c: Column | str, parts) -> Column:
    """True where any of the parts is a substring; a null text contains nothing."""
    c = F.coalesce(as_col(c), F.lit(""))
    out = F.lit(False)
    for part in parts:
        out = out | F.contains(c, F.lit(part))
    return out


def contained_parts(c: Column | str, parts) -> Column:
    """The parts that are substrings, in list order."""
    c = F.coalesce(as_col(c), F.lit(""))
    return F.filter(F.array(*[F.lit(p) for p in parts]), lambda p: F.contains(c, p))


def ordinal(c: Column | str, levels) -> Column:
    """Position of the value in a fixed order; unlisted and null values come last."""
    pos = F.array_position(F.array(*[F.lit(x) for x in levels]), as_col(c))
    return F.when(pos > 0, pos.cast("int")).otherwise(F.lit(len(tuple(levels)) + 1))
