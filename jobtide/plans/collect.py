"""Fetched pages to raw postings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.functions.text import coalesce_nonempty, surrogate_key
from jobtide.operators.conform import to_raw_contract
from jobtide.operators.rows import keep_first, limit_in_order
from jobtide.sources.html import FACT_FIELDS, PageLayout, detail_facts, listing_cards, main_text


def collect_postings(
    listings: DataFrame,
    details: DataFrame | None,
    source: str,
    base_url: str,
    scraped_at: str,
    layout: PageLayout | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Raw postings from fetched pages.

    ``listings``: ``search_term, term_no, page, html`` of result pages.
    ``details``: ``url, html`` of posting pages, one row per URL (None: cards only).
    A URL met again, on any page of any term, is left out; facts of the detail page come first,
    those of the card fill the gaps.
    """
    place = ["term_no", "page", "card_no"]
    cards = listing_cards(listings, "html", base_url, ["search_term", "term_no", "page"], layout)
    cards = keep_first(cards, ["url"], place)
    if limit is not None:
        cards = limit_in_order(cards, place, limit)
    if details is not None:
        facts = details.select(
            F.col("url").alias("_url"),
            detail_facts("html", layout).alias("_facts"),
            main_text("html", layout).alias("_text"),
        )
        cards = cards.join(facts, F.col("url") == F.col("_url"), "left")
    else:
        none = F.lit(None)
        struct = "struct<" + ",".join(f"{f}:string" for f in FACT_FIELDS) + ">"
        cards = cards.withColumns({"_facts": none.cast(struct), "_text": none.cast("string")})

    def best(name: str):
        return F.coalesce(coalesce_nonempty(f"_facts.{name}", name), F.lit(""))

    rows = cards.select(
        F.lit(source).alias("source"),
        "url",
        surrogate_key(F.lit(source), "url").alias("job_id"),
        best("title").alias("title"),
        best("company").alias("company"),
        best("location_raw").alias("location_raw"),
        best("posted_date").alias("posted_date"),
        best("employment_type").alias("employment_type"),
        F.lit("").alias("salary_raw"),
        F.coalesce("_text", F.lit("")).alias("description_raw"),
        F.coalesce("_facts.workload_raw", F.lit("")).alias("workload_raw"),
        "search_term",
    )
    return to_raw_contract(rows, scraped_at)
