"""Facts out of HTML pages.

Cards, detail facts, main text, labelled values and links are column expressions (``functions.markup``), so
no page goes through Python; URL choice, joining and de-duplication of cards are DataFrame work.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.functions import markup
from jobtide.functions.markup import AnyOf, Path, Tag
from jobtide.functions.urls import absolute_url, canonical_url, detail_pattern, ranked_urls

CARD_FIELDS = ("url", "title", "company", "location_raw", "posted_date", "employment_type")
FACT_FIELDS = (
    "title", "company", "location_raw", "posted_date", "workload_raw", "employment_type",
)
CARD_TYPE = "array<struct<" + ",".join(f"{f}:string" for f in CARD_FIELDS) + ">>"
RAW_CARD_TYPE = CARD_TYPE.replace("url:string", "links:array<string>")
FACT_TYPE = "struct<" + ",".join(f"{f}:string" for f in FACT_FIELDS) + ">"


def _info(name: str) -> Tag:
    return Tag("li", "data-cy", f"info-{name}")


_NOWRAP = Tag("span", "class", "white-space_nowrap", "word")


@dataclass(frozen=True)
class PageLayout:
    """Where one site keeps its facts, as paths of tags.

    Lists are tried in order, the first non-empty result wins.  The defaults are fixed values.
    """

    cards: tuple[Tag, ...] = (
        Tag("div", "data-cy", "vacancy-serp-item"),
        Tag("", "data-cy", "vacancy-serp", "holds", True),
        Tag("", "data-cy", "serp-item", "holds", True),
    )
    card_title: Path = (AnyOf((Tag("span", "class", "fw_bold", "holds"), Tag("h2"), Tag("h3"))),)
    card_company: Path = (Tag("strong"),)
    card_date: Path = (Tag("p"),)
    card_location_label: str = "Place of work"
    card_contract_label: str = "Contract type"
    label: str = "span"
    labelled: str = "p"
    title: tuple[Path, ...] = ((Tag("h1", "data-cy", "vacancy-title"),),)
    company: tuple[Path, ...] = ((Tag("a", "data-cy", "company-link"), Tag("span")),)
    posted_date: tuple[Path, ...] = ((_info("publication"), _NOWRAP), (_info("publication"),))
    workload: tuple[Path, ...] = ((_info("workload"), _NOWRAP), (_info("workload"),))
    contract: tuple[Path, ...] = ((_info("contract"), Tag("span")), (_info("contract"),))
    location: tuple[Path, ...] = (
        (
            Tag("div", "class", "grid-area_vacancy-info", "word"), Tag("ul"),
            Tag("li", "data-cy", how="lacks"), Tag("span"),
        ),
        (Tag("div", "data-cy", "vacancy-logo"), Tag("p")),
    )
    teaser: Tag = Tag("section", "aria-label", "JobFit teaser")
    body: tuple[Path, ...] = (
        (Tag("div", "data-cy", "vacancy-description"),),
        (Tag("", "data-cy", "vacancy-description", "holds", True),),
        (Tag("", "data-cy", "description", "holds", True),),
        (Tag("", "class", "description", "holds", True),),
        (Tag("", "class", "job-description", "holds", True),),
        (Tag("article"),),
        (Tag("main"),),
    )
    body_min_chars: int = 120
    body_meta: Tag = Tag("meta", "property", "og:description")
    section: tuple[str, ...] = ("en", "jobs")
    reserved: tuple[str, ...] = ("search", "results")


def raw_cards(html: str, layout: PageLayout | None = None) -> Column:
    """Cards of a listing page in page order, each with the link around it and all links in it.

    The first kind of card that the page holds counts.  ``html`` here and below names the column with the
    page.
    """
    layout = layout or PageLayout()
    label, value = Tag(layout.label), Tag(layout.labelled)

    def facts(inner: str, before: str) -> str:
        def text(path: Path) -> str:
            return markup.plain_text(markup.first_inner(inner, path))

        inside = f"transform({markup.anchors(inner)}, l -> l.href)"
        beside = markup.beside_labels(inner, [layout.card_location_label, layout.card_contract_label], label, value)

        def card(labels: str) -> str:
            found = {
                "links": f"concat({markup.open_link(before)}, {inside})",
                "title": text(layout.card_title),
                "company": text(layout.card_company),
                "location_raw": f"get({labels}, 0)",
                "posted_date": text(layout.card_date),
                "employment_type": f"get({labels}, 1)",
            }
            return "named_struct(" + ", ".join(f"'{name}', {fact}" for name, fact in found.items()) + ")"

        return markup.bound(beside, card)

    def choose(page: str) -> str:
        patterns = [f"rlike({page}, {markup.literal(tag.pattern())})" for tag in layout.cards]
        kinds = [markup.elements(page, tag, facts) for tag in layout.cards]
        cases = " ".join(f"WHEN {test} THEN {found}" for test, found in zip(patterns, kinds))
        return f"CASE {cases} ELSE CAST(array() AS {RAW_CARD_TYPE}) END"

    return F.expr(markup.bound(markup.visible(html), choose)).cast(RAW_CARD_TYPE)


def card_list(html: str, base: str, layout: PageLayout | None = None) -> Column:
    """Cards with their detail URL; cards without one, and repeats of a URL, are left out.

    The URL of a card is the best of its links that no earlier card of the page has taken.
    """
    layout = layout or PageLayout()

    names = [f for f in CARD_FIELDS if f != "url"]
    pattern = detail_pattern(base, layout.section, layout.reserved)

    def with_choices(card: Column) -> Column:
        full = F.transform(
            card["links"], lambda href: canonical_url(absolute_url(F.lit(base), href))
        )
        good = F.filter(full, lambda u: u.rlike(pattern))
        return F.struct(ranked_urls(good).alias("urls"), *[card[f].alias(f) for f in names])

    def add(kept: Column, card: Column) -> Column:
        taken = F.transform(kept, lambda k: k["url"])
        url = F.get(F.filter(card["urls"], lambda u: ~F.array_contains(taken, u)), F.lit(0))
        row = F.struct(url.alias("url"), *[card[f].alias(f) for f in names])
        return F.when(url.isNull(), kept).otherwise(F.concat(kept, F.array(row)))

    none = F.array().cast(CARD_TYPE)
    return F.aggregate(F.transform(raw_cards(html, layout), with_choices), none, add)


def labelled_value(html: str, prefix: str, layout: PageLayout | None = None) -> Column:
    """Value beside the label that starts with ``prefix`` (any case), ``''`` where none does."""
    layout = layout or PageLayout()
    label, value = Tag(layout.label), Tag(layout.labelled)
    return F.expr(
        markup.bound(
            markup.visible(html), lambda page: markup.beside_label(page, prefix, label, value)
        )
    )


def detail_facts(html: str, layout: PageLayout | None = None) -> Column:
    """Struct of the facts on a detail page; ``''`` where a fact is not there.

    Pieces of text are joined by a blank, but follow each other directly in the first choice of date,
    workload, contract and location.
    """
    layout = layout or PageLayout()
    paths = {
        "title": layout.title,
        "company": layout.company,
        "location_raw": layout.location,
        "posted_date": layout.posted_date,
        "workload_raw": layout.workload,
        "employment_type": layout.contract,
    }
    facts = {f: paths[f] for f in FACT_FIELDS}
    joined = ("location_raw", "posted_date", "workload_raw", "employment_type")
    return F.expr(
        markup.bound(markup.visible(html), lambda page: markup.first_texts(page, facts, joined))
    )


def main_text(html: str, layout: PageLayout | None = None) -> Column:
    """Main text: first candidate element that is long enough, else the meta description.

    The teaser is left out where the first candidate holds it.
    """
    layout = layout or PageLayout()

    def long_enough(page: str, path: Path) -> str:
        text = markup.plain_text(markup.first_inner(page, path))
        return markup.bound(text, lambda t: f"if(length({t}) >= {layout.body_min_chars}, {t}, NULL)")

    def text_of(page: str) -> str:
        meta = f"regexp_extract({page}, {markup.literal(layout.body_meta.pattern())}, 0)"
        last = markup.plain_text(markup.attribute(meta, "content"))
        return f"coalesce({', '.join([*(long_enough(page, path) for path in layout.body), last])})"

    def choose(page: str) -> str:
        if not layout.body:
            return text_of(page)
        first = markup.first_inner(page, layout.body[0])
        teaser = markup.literal(layout.teaser.pattern())
        bare = f"if(coalesce(rlike({first}, {teaser}), false), {markup.without_first(page, layout.teaser)}, {page})"
        return markup.bound(bare, text_of)

    return F.expr(markup.bound(markup.visible(html), choose))


def links(html: str, within: Tag | None = None) -> Column:
    """``array<struct<href, text>>`` of the links, all or those inside some element, in page order."""
    cut = markup.anchors if within is None else lambda page: markup.anchors_within(page, within)
    return F.expr(markup.bound(markup.visible(html), cut))


def listing_cards(
    pages: DataFrame, html: str, base: str, keep: Sequence[str] = (), layout=None
) -> DataFrame:
    """One row per card of each listing page, with its place on the page."""
    cards = pages.select(
        *keep, F.posexplode_outer(card_list(html, base, layout)).alias("card_no", "c")
    ).where(F.col("card_no").isNotNull())
    return cards.select(*keep, "card_no", *[F.col(f"c.{f}").alias(f) for f in CARD_FIELDS])


def link_rows(
    pages: DataFrame, html: str, within: Tag | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per link, as :func:`links`: its place on the page, ``href`` and ``text``."""
    found = pages.select(*keep, F.posexplode_outer(links(html, within)).alias("pos", "l"))
    found = found.where(F.col("pos").isNotNull())
    return found.select(*keep, "pos", F.col("l.href").alias("href"), F.col("l.text").alias("text"))
