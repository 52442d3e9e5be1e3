"""URL building and classification."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobtide.functions.text import as_col


def search_url(base: str, term: Column | str, page: Column | str) -> Column:
    """``base?term=…&page=…`` with the term form-encoded (blank to ``+``)."""
    coded = F.url_encode(as_col(term))
    coded = F.replace(F.replace(coded, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
    return F.concat(F.lit(f"{base}?term="), coded, F.lit("&page="), as_col(page).cast("string"))


def canonical_url(c: Column | str) -> Column:
    """Without query, fragment and trailing slashes; null gives ``''``."""
    bare = F.regexp_replace(F.coalesce(as_col(c), F.lit("")), r"[?#].*$", "")
    return F.regexp_replace(bare, "/+$", "")


def url_path(c: Column | str) -> Column:
    """Path part, ``''`` where there is none."""
    return F.regexp_extract(as_col(c), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def path_parts(c: Column | str) -> Column:
    return F.filter(F.split(url_path(c), "/"), lambda p: p != "")


def absolute_url(base: Column | str, href: Column | str) -> Column:
    """``href`` seen from the page ``base``: absolute, host-relative or path-relative."""
    base, href = as_col(base), as_col(href)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    host = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(url_path(base), r"^(.*/)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    page = F.concat(host, url_path(base))
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, href))
        .when(F.startswith(href, F.lit("/")), F.concat(host, href))
        .when(F.startswith(href, F.lit("#")) | F.startswith(href, F.lit("?")), F.concat(page, href))
        .when(href == "", page)
        .otherwise(F.concat(host, folder, href))
    )


def detail_pattern(
    base: str,
    section: Sequence[str] = ("en", "jobs"),
    reserved: Sequence[str] = ("search", "results"),
) -> str:
    """Pattern of a canonical URL below the section root that is not a listing."""
    path = "/+".join(["", *map(re.escape, section), ""])
    listing = "|".join(map(re.escape, reserved))
    other = rf"(?!(?:{listing})(?:/|$))" if listing else ""
    return rf"^(?={re.escape(base)})[^/?#]*//[^/]*{path}{other}[^/]"


def is_detail_url(
    url: Column | str,
    base: str,
    section: Sequence[str] = ("en", "jobs"),
    reserved: Sequence[str] = ("search", "results"),
) -> Column:
    """True for pages of one posting."""
    return canonical_url(url).rlike(detail_pattern(base, section, reserved))


def ranked_urls(urls: Column | str, marker: str = "/detail/") -> Column:
    """Distinct URLs, best first: with the marker, then the longest path, then by name."""
    keyed = F.transform(
        F.array_distinct(as_col(urls)),
        lambda u: F.struct(
            (~F.contains(u, F.lit(marker))).alias("unmarked"),
            (-F.length(url_path(u))).alias("shortness"),
            u.alias("url"),
        ),
    )
    return F.transform(F.array_sort(keyed), lambda k: k["url"])


def best_url(urls: Column | str, marker: str = "/detail/") -> Column:
    return F.get(ranked_urls(urls, marker), F.lit(0))
