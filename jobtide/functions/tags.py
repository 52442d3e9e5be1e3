"""Tag lists: extraction, parsing, normalising, membership."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobtide import fixed_values as fixed
from jobtide.functions.lexicon import Lexicon
from jobtide.functions.text import as_col, concat_fields, strip

SKILLS = Lexicon.of(fixed.SKILL_TERMS)

_LIST_OPTIONS = {
    "allowSingleQuotes": "true",
    "allowBackslashEscapingAnyCharacter": "true",
}


def dictionary_tags(*fields: Column | str, lexicon: Lexicon = SKILLS) -> Column:
    """Sorted distinct dictionary terms that occur as whole words in the joined fields."""
    return lexicon.found(F.lower(concat_fields(*fields)))


def _literal_list(raw: Column) -> Column:
    listish = F.when(F.startswith(raw, F.lit("[")), raw)
    return F.from_json(listish, "array<string>", _LIST_OPTIONS)


def parse_list(c: Column | str, variant: str = "dashboard", aliases: dict | None = None) -> Column:
    """List written as text back to an array.

    ``analysis``: list literal to stripped lower-case items, anything else to ``[]``.
    ``dashboard``: list literal, else comma-separated text, then :func:`normalize_tags`.
    """
    raw = strip(as_col(c))
    parsed = _literal_list(raw)
    if variant == "analysis":
        items = F.transform(parsed, lambda s: F.lower(strip(s)))
        return F.coalesce(items, F.array().cast("array<string>"))
    if variant != "dashboard":
        raise ValueError(f"unknown variant: {variant}")
    return normalize_tags(F.coalesce(parsed, F.split(raw, ",")), aliases)


def normalize_tags(tags: Column | str, aliases: dict | None = None) -> Column:
    """Strip, lower, drop empties, replace aliases, keep the first of repeats."""
    aliases = fixed.SKILL_ALIASES if aliases is None else aliases
    none = F.array().cast("array<string>")
    items = F.transform(F.coalesce(as_col(tags), none), lambda s: F.lower(strip(s)))
    items = F.filter(items, lambda s: F.length(s) > 0)
    if aliases:
        table = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
        items = F.transform(items, lambda s: F.coalesce(F.try_element_at(table, s), s))
    return F.array_distinct(items)


def tag_count(tags: Column | str) -> Column:
    return F.coalesce(F.size(as_col(tags)), F.lit(0))


def has_tag(tags: Column | str, tag: str) -> Column:
    return F.coalesce(F.array_contains(as_col(tags), tag), F.lit(False))
