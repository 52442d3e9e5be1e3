"""Location text to canton, city and region."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobtide import fixed_values as fixed
from jobtide.functions.lexicon import Lexicon
from jobtide.functions.text import WORD_EDGE, as_col, contains_any, map_value, nonempty, strip


@dataclass(frozen=True)
class Gazetteer:
    """The lookup tables of one country."""

    codes: tuple[str, ...] = fixed.CANTON_CODES
    code_prefix: str = "CH"
    names: dict = field(default_factory=lambda: fixed.CANTON_NAMES)
    cities: dict = field(default_factory=lambda: fixed.CITY_CANTON)
    company_canton: dict = field(default_factory=lambda: fixed.COMPANY_CANTON)
    company_city: dict = field(default_factory=lambda: fixed.COMPANY_CITY)
    company_markers: tuple[str, ...] = fixed.COMPANY_MARKERS
    region_markers: tuple[str, ...] = fixed.REGION_MARKERS
    regions: dict = field(default_factory=lambda: fixed.CANTON_REGION)


def _not_a_place(loc: Column, gaz: Gazetteer) -> Column:
    return contains_any(loc, gaz.company_markers) | contains_any(loc, gaz.region_markers)


def _first_part(loc: Column) -> Column:
    return F.get(F.split(loc, ","), F.lit(0))


def _named(loc: Column, names: dict, word_bounded: bool) -> Column:
    """Code of the first listed name that occurs in the text."""
    text = F.lower(loc)
    if not names:
        return F.lit(None).cast("string")
    if not word_bounded:
        return F.coalesce(
            *[F.when(F.contains(text, F.lit(n)), F.lit(code)) for n, code in names.items()]
        )
    place = {name: i for i, name in enumerate(names)}
    order = F.create_map(*[F.lit(x) for kv in place.items() for x in kv])
    hits = F.transform(
        Lexicon.of(names).found(text), lambda n: F.try_element_at(order, n)
    )
    codes = F.array(*[F.lit(code) for code in names.values()])
    return F.get(codes, F.array_min(hits))


def canton(c: Column | str, gaz: Gazetteer | None = None, word_bounded: bool = False) -> Column:
    """Canton code of a location text, null where it cannot be told.

    Tried in order: an explicit code (``CH-ZG``), a known company, a canton name inside the text;
    then, unless the text looks like a company or a region label, the first comma part and the
    whole text as a city.  ``word_bounded`` accepts canton names only as whole words (``Fleurier``
    then no longer holds ``uri``).
    """
    gaz = gaz or Gazetteer()
    loc = strip(as_col(c))
    code = rf"{WORD_EDGE}{gaz.code_prefix}-({'|'.join(gaz.codes)}){WORD_EDGE}"
    by_city = F.coalesce(
        map_value(strip(_first_part(loc)), gaz.cities), map_value(loc, gaz.cities)
    )
    return F.coalesce(
        nonempty(F.regexp_extract(loc, code, 1)),
        map_value(loc, gaz.company_canton),
        _named(loc, gaz.names, word_bounded),
        F.when(~_not_a_place(loc, gaz), by_city),
    )


def city(c: Column | str, gaz: Gazetteer | None = None) -> Column:
    """City of a location text: a known company's, else the first comma part without brackets."""
    gaz = gaz or Gazetteer()
    loc = strip(as_col(c))
    bare = strip(F.regexp_replace(_first_part(loc), r"\([^\n]*?\)", ""))
    return F.coalesce(
        map_value(loc, gaz.company_city), F.when(~_not_a_place(loc, gaz), nonempty(bare))
    )


def region(canton_code: Column | str, gaz: Gazetteer | None = None) -> Column:
    return map_value(canton_code, (gaz or Gazetteer()).regions)
