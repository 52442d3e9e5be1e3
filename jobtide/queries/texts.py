"""Text, URL and HTML queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobtide.functions import text as tx
from jobtide.functions import urls
from jobtide.functions.markup import Tag
from jobtide.queries.common import BASE_URL, SQL_SPACE, Query, spread_table, table
from jobtide.sources import html

PAGE = html.PageLayout(
    title=((Tag("h1"),), (Tag("title"),)),
    company=((Tag("footer"),),),
    location=((Tag("div", "class", "ad", "word"),),),
    posted_date=((Tag("time"),), (Tag("head"), Tag("title"))),
    workload=((Tag("nav"), Tag("ul"), Tag("li"), Tag("a")),),
    contract=((Tag("li", "data-cy", how="lacks"), Tag("a", "href", how="has")),),
    body=((Tag("div", "data-cy", "vacancy-description"),), (Tag("article"),), (Tag("main"),)),
)


def _sql_plain(expr: str) -> str:
    """Markup to plain text: comments and tags to blanks, entities to characters."""
    bare = f"regexp_replace(regexp_replace({expr}, '(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g')"
    for entity, char in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·")):
        bare = f"replace({bare}, '{entity}', '{char}')"
    bare = f"regexp_replace({bare}, '&amp;?', '&', 'g')"
    return f"trim(regexp_replace({bare}, '{SQL_SPACE}+', ' ', 'g'))"


def _sql_element(tag: str) -> str:
    return _sql_plain(f"regexp_extract(html, '(?s)<{tag}>(.*?)</{tag}>', 1)")


def clean_text(spark, sf):
    docs = spread_table(spark, sf, "documents", "doc_id", "text")
    return docs.select("doc_id", tx.clean_text("text").alias("cleaned"))


def short_label(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        tx.short_label("text").alias("label"),
        tx.preview_text("text", 500).alias("preview"),
    )


def surrogate_key(spark, sf):
    key = tx.surrogate_key(F.lit("web"), "url").alias("job_id")
    return table(spark, sf, "pages").select("page_id", key)


def canonical_url(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.canonical_url("url").alias("url"))


def url_build(spark, sf):
    term = F.concat_ws(" ", "p_name", F.lit("é*~"), "p_brand")
    return table(spark, sf, "part").select(
        "p_partkey", urls.search_url(f"{BASE_URL}/en/jobs/", term, "p_size").alias("url")
    )


def detail_url_filter(spark, sf):
    pages = table(spark, sf, "pages")
    n, base = F.col("page_id").cast("string"), F.lit(BASE_URL)
    kind = F.col("page_id") % 6
    link = (
        F.when(kind == 0, F.concat(base, F.lit("/en/jobs/detail/"), n, F.lit("/?term=a#b")))
        .when(kind == 1, F.concat(base, F.lit("/en/jobs/")))
        .when(kind == 2, F.concat(base, F.lit("/en/jobs/search?page="), n))
        .when(kind == 3, F.concat(base, F.lit("/fr/jobs/"), n))
        .when(kind == 4, F.col("url"))
        .otherwise(F.concat(base, F.lit("/en/jobs//p"), n, F.lit("//#top")))
    )
    return pages.select("page_id", link.alias("link")).select(
        "page_id",
        urls.is_detail_url("link", BASE_URL).cast("int").alias("is_detail"),
        F.size(urls.path_parts("link")).alias("parts"),
    )


def html_facts(spark, sf):
    facts = html.detail_facts("html", PAGE).alias("f")
    out = spread_table(spark, sf, "pages", "page_id", "html").select("page_id", facts)
    return out.select("page_id", *[F.col(f"f.{c}").alias(c) for c in html.FACT_FIELDS])


def html_text(spark, sf):
    pages = spread_table(spark, sf, "pages", "page_id", "html")
    return pages.select("page_id", html.main_text("html", PAGE).alias("text"))


def html_links(spark, sf):
    pages = spread_table(spark, sf, "pages", "page_id", "url", "html")
    found = html.link_rows(pages, "html", Tag("nav"), ["page_id", "url"])
    return found.select("page_id", "pos", urls.absolute_url("url", "href").alias("link"), "text")


def segment_page():
    """Result page with two cards for the same posting, one for another, one without a link."""

    def card(url, title, company, place):
        return F.concat(
            F.lit('<div data-cy="vacancy-serp-item"><a href="'), url,
            F.lit('?ref=list"><span class="fs_1 fw_bold">'), title,
            F.lit('</span></a><div data-cy="serp-item-1"><p>Today</p></div><p><strong>'), company,
            F.lit("</strong></p><div><span>Place of work:</span><p>"), place,
            F.lit("<br></p></div><div><span>Contract type</span><p>Permanent</p></div></div>"),
        )

    key = F.col("c_custkey").cast("string")
    one = F.concat(F.lit("/en/jobs/detail/"), key)
    two = F.concat(F.lit("/en/jobs/x"), key, F.lit("/"))
    return F.concat(
        F.lit("<html><body><nav><a href='/en/jobs'>all</a></nav>"),
        card(one, F.col("c_name"), F.col("c_mktsegment"), F.col("n_name")),
        card(one, F.lit("again"), F.lit("again"), F.lit("again")),
        card(two, F.lit("R&amp;D <b>lead"), F.col("c_mktsegment"), F.lit("")),
        card(F.lit("/en/jobs/search"), F.lit("none"), F.lit("none"), F.lit("none")),
    )


def html_cards(spark, sf):
    people = spread_table(
        spark, sf, "customer", "c_custkey", "c_name", "c_mktsegment", "c_nationkey"
    ).join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    pages = people.select("c_custkey", segment_page().alias("page"))
    return html.listing_cards(pages, "page", BASE_URL, ["c_custkey"])


def html_labeled_value(spark, sf):
    people = spread_table(
        spark, sf, "customer", "c_custkey", "c_name", "c_mktsegment", "c_nationkey"
    ).join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    page = F.concat(
        F.lit('<div class="card"><div><span> Place of work:</span><p>'), "n_name",
        F.lit("</p></div><div><span>contract <i>TYPE</i></span><p>"), "c_mktsegment",
        F.lit(" &amp;\n<b>"), "c_name", F.lit("</p></div></div>"),
    )
    pages = people.select("c_custkey", page.alias("page"))
    return pages.select(
        "c_custkey",
        html.labelled_value("page", "place of work").alias("place"),
        html.labelled_value("page", "Contract type").alias("contract"),
        html.labelled_value("page", "Salary").alias("salary"),
    )


def best_link(spark, sf):
    pages = spread_table(spark, sf, "pages", "page_id", "url", "html")
    pages = pages.select("page_id", "url", html.links("html").alias("l"))
    hrefs = F.transform("l", lambda x: urls.canonical_url(urls.absolute_url(F.col("url"), x["href"])))
    marked = F.when(
        F.col("page_id") % 3 == 0,
        F.concat(F.lit("https://a.example.com/detail/"), F.col("page_id").cast("string")),
    )
    candidates = F.concat(hrefs, F.array_compact(F.array(urls.canonical_url("url"), marked)))
    return pages.select("page_id", urls.best_url(candidates).alias("link"))


def coalesce_nonempty(spark, sf):
    kind = F.col("event_id") % 4
    first = F.when(kind == 0, "").when(kind == 1, "  ").when(kind == 2, F.col("event_type"))
    second = F.when(kind != 1, F.get_json_object("props", "$.k"))
    return table(spark, sf, "events").select(
        "event_id", tx.coalesce_nonempty(first, second, F.lit("none")).alias("value")
    )


_URL_HOST = "regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)"
_URL_PATH = "regexp_extract({0}, '^[a-z]+://[^/?#]*([^?#]*)', 1)"
_CANON = "regexp_replace(regexp_replace({0}, '[?#].*$', ''), '/+$', '')"
_NAV = "regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1)"

QUERIES: dict[str, Query] = {
    "clean_text": Query(
        clean_text,
        f"""SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '{SQL_SPACE}+', ' ', 'g'))
            AS cleaned FROM documents""",
    ),
    "short_label": Query(
        short_label,
        """SELECT doc_id,
             CASE WHEN strpos(text, ' ') > 0
                  THEN substr(substr(text, strpos(text, ' ') + 1), 1, 30)
                  ELSE substr(text, 1, 30) END AS label,
             substr(text, 1, 500) AS preview
           FROM documents""",
    ),
    "surrogate_key": Query(
        surrogate_key, "SELECT page_id, sha1('web|' || url) AS job_id FROM pages"
    ),
    "canonical_url": Query(
        canonical_url, f"SELECT page_id, {_CANON.format('url')} AS url FROM pages"
    ),
    "url_build": Query(
        url_build,
        f"""SELECT p_partkey, '{BASE_URL}/en/jobs/?term='
              || replace(url_encode(p_name || ' é*~ ' || p_brand), '%20', '+')
              || '&page=' || p_size AS url
            FROM part""",
    ),
    "detail_url_filter": Query(
        detail_url_filter,
        f"""SELECT page_id, CAST(page_id % 6 IN (0, 5) AS INTEGER) AS is_detail,
              CAST(CASE page_id % 6 WHEN 0 THEN 4 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 3
                WHEN 5 THEN 3
                ELSE len(list_filter(string_split({_URL_PATH.format('url')}, '/'),
                                     lambda p: p <> '')) END AS INTEGER) AS parts
            FROM pages""",
    ),
    "html_facts": Query(
        html_facts,
        f"""SELECT page_id, {_sql_element('h1')} AS title,
              {_sql_plain("regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1)")} AS company,
              {_sql_plain("regexp_extract(html, '(?s)<div class=.ad.>(.*?)</div>', 1)")}
                AS location_raw,
              {_sql_element('title')} AS posted_date,
              {_sql_plain(f"regexp_extract({_NAV}, '(?s)<li>(.*?)</li>', 1)")} AS workload_raw,
              {_sql_plain(f"regexp_extract({_NAV}, '(?s)<li>(.*?)</li>', 1)")} AS employment_type
            FROM pages""",
    ),
    "html_text": Query(
        html_text,
        f"""SELECT page_id, CASE WHEN length(t) >= 120 THEN t ELSE '' END AS text
            FROM (SELECT page_id, {_sql_element('article')} AS t FROM pages)""",
    ),
    "html_links": Query(
        html_links,
        f"""WITH a AS (
              SELECT page_id, {_URL_HOST} AS host,
                regexp_extract_all({_NAV}, '<a href="([^"]*)">', 1) AS hrefs,
                regexp_extract_all({_NAV}, '(?s)<a href="[^"]*">(.*?)</a>', 1) AS texts
              FROM pages),
            b AS (SELECT page_id, host, unnest(hrefs) AS href, unnest(texts) AS t,
                         generate_subscripts(hrefs, 1) AS i FROM a)
            SELECT page_id, CAST(i - 1 AS INTEGER) AS pos,
              host || replace(replace(href, '&quot;', '"'), '&amp;', '&') AS link,
              {_sql_plain('t')} AS text FROM b""",
    ),
    "html_cards": Query(
        html_cards,
        f"""SELECT c_custkey, CAST(0 AS INTEGER) AS card_no,
              '{BASE_URL}/en/jobs/detail/' || c_custkey AS url, c_name AS title,
              c_mktsegment AS company, n_name AS location_raw, 'Today' AS posted_date,
              'Permanent' AS employment_type
            FROM customer JOIN nation ON c_nationkey = n_nationkey
            UNION ALL
            SELECT c_custkey, 1, '{BASE_URL}/en/jobs/x' || c_custkey, 'R&D lead',
              c_mktsegment, '', 'Today', 'Permanent'
            FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "html_labeled_value": Query(
        html_labeled_value,
        """SELECT c_custkey, n_name AS place, c_mktsegment || ' & ' || c_name AS contract,
             '' AS salary
           FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "best_link": Query(
        best_link,
        f"""WITH c AS (
              SELECT page_id, {_CANON.format('url')} AS u FROM pages
              UNION ALL
              SELECT page_id, 'https://a.example.com/detail/' || page_id FROM pages
              WHERE page_id % 3 = 0
              UNION ALL
              SELECT page_id, {_CANON.format("host || replace(replace(href, '&quot;', chr(34)), '&amp;', '&')")}
              FROM (SELECT page_id, {_URL_HOST} AS host,
                      unnest(regexp_extract_all(html, '<a href="([^"]*)">', 1)) AS href FROM pages))
            SELECT page_id, first(u ORDER BY strpos(u, '/detail/') = 0,
                length({_URL_PATH.format('u')}) DESC, u) AS link
            FROM c GROUP BY page_id""",
    ),
    "coalesce_nonempty": Query(
        coalesce_nonempty,
        """SELECT event_id,
             coalesce(CASE WHEN event_id % 4 = 2 THEN event_type END,
                      CASE WHEN event_id % 4 <> 1 THEN json_extract_string(props, '$.k') END,
                      'none') AS value
           FROM events""",
    ),
}
