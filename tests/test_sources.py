from pyspark.sql import functions as F

from jobtide.functions import markup, text
from jobtide.functions.markup import Tag
from jobtide.sources import files, html, jsonstat

BASE = "https://jobs.example.com"


def test_facts_fallbacks(spark):
    page = """<h1 data-cy="vacancy-title"> Data  <i>Lead</i></h1>
      <ul><li data-cy="info-publication">12 May 2026</li>
      <li data-cy="info-workload"><span class="white-space_nowrap">80%</span> extra</li>
      <li data-cy="info-contract">Fixed</li></ul>
      <div data-cy="vacancy-logo"><p>Bern</p></div>"""
    df = spark.createDataFrame([(page,), (None,), ("",)], "html string")
    got = [tuple(r.f) for r in df.select(html.detail_facts("html").alias("f")).collect()]
    assert got[0] == ("Data Lead", "", "Bern", "12 May 2026", "80%", "Fixed")
    assert got[1] == got[2] == ("",) * 6


def test_main_text(spark):
    long = "word " * 30
    pages = [
        f"<div data-cy='vacancy-description'><section aria-label='JobFit teaser'>no</section>{long}</div>",
        f"<div data-cy='vacancy-description'>short</div><div class='Job-Description'>{long}x</div>",
        f"<main>short</main><article>{long}y</article>",
        "<article>short</article><meta property='og:description' content=' from   meta '>",
        "<article>short</article>",
    ]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string")
    got = {r.i: r.t for r in df.select("i", html.main_text("html").alias("t")).collect()}
    want = long.strip()
    assert got == {0: want, 1: want + " x", 2: want + " y", 3: "from meta", 4: ""}


def test_cards_prefer_unseen_links(spark):
    page = """<a href="/en/jobs/detail/outer?x"><div data-cy="vacancy-serp-item"><h2>A</h2></div></a>
      <div data-cy="vacancy-serp-item"><a href="/en/jobs/detail/outer/">o</a>
         <a href="/en/jobs/longer-than-others-by-far">l</a><h3>B</h3></div>
      <div data-cy="vacancy-serp-item"><a href="/en/jobs/detail/outer">again</a></div>
      <div data-cy="vacancy-serp-item"><a href="/en/jobs/results/x">no</a></div>"""
    other = "<div data-cy='my-serp-item-2'><a href='/en/jobs/z'><h3>Z</h3></a></div>"
    df = spark.createDataFrame([(1, page), (2, other), (3, None)], "p int, html string")
    got = html.listing_cards(df, "html", BASE, ["p"]).collect()
    assert sorted((r.p, r.card_no, r.url, r.title) for r in got) == [
        (1, 0, f"{BASE}/en/jobs/detail/outer", "A"),
        (1, 1, f"{BASE}/en/jobs/longer-than-others-by-far", "B"),
        (2, 0, f"{BASE}/en/jobs/z", "Z"),
    ]


CUBE = """{"id":["m","region","q"],"size":[1,2,3],"value":[1,2,3,4,null,6],"dimension":{
 "m":{"category":{"label":{"0":"Total"}}},
 "region":{"category":{"index":{"b":0,"a":1},"label":{"b":"Zürich","a":"Ticino"}}},
 "q":{"label":"Quarter","category":{"label":{"1":"2025Q3","2":"2025Q4","3":"2026Q1"}}}}}"""


def test_jsonstat(spark):
    df = spark.createDataFrame([(CUBE,)], "cube string")
    got = jsonstat.decode_cubes(df, "cube", ["region", "q"], "v").collect()
    assert [tuple(r) for r in got] == [
        ("Zürich", "2025Q3", 1.0), ("Zürich", "2025Q4", 2.0), ("Zürich", "2026Q1", 3.0),
        ("Ticino", "2025Q3", 4.0), ("Ticino", "2025Q4", None), ("Ticino", "2026Q1", 6.0),
    ]


def test_label_grid(spark):
    df = spark.createDataFrame([(1, ["a", "b"], ["x", "y", "z"]), (2, ["a"], [])], "i int, l array<string>, m array<string>")
    got = [tuple(r) for r in jsonstat.label_grid(df, ["l", "m"], ["i"]).collect()]
    assert got == [(1, a, b) for a in "ab" for b in "xyz"]


def test_csv_keeps_everything(spark, tmp_path):
    rows = [("a,\"b\"\nc", " pad ", 1, ["x", "it's"]), ("", None, None, []), ("Zürich\\", "–", 2, None)]
    df = spark.createDataFrame(rows, "t string, p string, n int, tags array<string>")
    path = str(tmp_path / "out")
    files.write_csv(df, path)
    got = files.read_csv(spark, path, "t string, p string, n int, tags string").collect()
    assert sorted((r.t or "", r.p or "", r.n or 0) for r in got) == sorted(
        (t or "", p or "", n or 0) for t, p, n, _ in rows
    )
    from jobtide.functions.tags import parse_list

    back = files.read_csv(spark, path, "t string, p string, n int, tags string")
    lists = back.where("n = 1").select(parse_list("tags").alias("x")).first().x
    assert lists == ["x", "it's"]


def test_runs_are_kept_apart(spark, tmp_path):
    path = str(tmp_path / "runs")
    df = spark.range(3)
    for ts in ("2026-03-01T17:21:57", "2026-03-02T00:00:00"):
        files.write_run(df, path, ts)
    got = spark.read.parquet(path).groupBy("run_ts").count().collect()
    assert sorted((str(r.run_ts), r["count"]) for r in got) == [
        ("2026-03-01T17-21-57", 3), ("2026-03-02T00-00-00", 3),
    ]


def test_csv_without_line_breaks_is_split(spark, tmp_path):
    path = str(tmp_path / "one.csv")
    with open(path, "w") as f:
        f.write("a,b\n" + "".join(f"{i},text of row {i}\n" for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        whole = files.read_csv(spark, path, "a int, b string")
        split = files.read_csv(spark, path, "a int, b string", multi_line=False)
        assert whole.rdd.getNumPartitions() == 1 < split.rdd.getNumPartitions()
        assert whole.exceptAll(split).count() == split.exceptAll(whole).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_card_link_far_out_and_unquoted_slash(spark):
    inner = "<div data-cy='vacancy-serp-item'><span>t</span></div>"
    page = "<a href='/en/jobs/detail/x/'>" + "<div>" * 12 + inner + "</div>" * 12 + "</a>"
    layout = html.PageLayout(cards=(Tag("div", "data-cy", "vacancy-serp-item"),))
    df = spark.createDataFrame([(page,)], "page string").select(html.raw_cards("page", layout).alias("c"))
    assert df.first().c[0]["links"] == ["/en/jobs/detail/x/"]
    page = "<div data-cy='vacancy-serp-item'><a href=/en/jobs/>first</a><br/><a href='b'>x</a></div>"
    df = spark.createDataFrame([(page,)], "page string").select(html.raw_cards("page", layout).alias("c"))
    assert df.first().c[0]["links"] == ["/en/jobs/", "b"]


def test_cards_of_the_first_kind_with_all_their_facts(spark):
    card = """<div data-cy="vacancy-serp-item"><a class=x href="/en/jobs/{0}?a=1&amp;b=2"><p class="caption">  {0} May </p>
      <span class="text fw_bold big">Title <b>{0}</b></span><h2>no</h2><p><strong>Firm &amp; {0}</strong></p>
      <div><span>Place of work:</span><p>Bern</p></div><div><span>contract type</span><p>Full<br>time</p></div></a></div>"""
    nested = '<a href="/out"><div data-cy="vacancy-serp-item">A<div data-cy="vacancy-serp-item"><h3>In</h3></div></div></a>'
    pages = [
        "<!-- <div data-cy='vacancy-serp-item'><h2>x</h2></div> --><a href='/closed'>y</a>" + card.format(1) + card.format(2) + "<div data-cy='serp-item-9'><h2>z</h2></div>",
        nested, "<li data-cy='My-SERP-item-3'><h3>T</h3></li>", "<p>no card</p>", None,
    ]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, page string").select("i", html.raw_cards("page").alias("c"))
    found = {r.i: [tuple(x) for x in r.c] for r in df.collect()}
    one = lambda n: ([f"/en/jobs/{n}?a=1&b=2"], f"Title {n}", f"Firm & {n}", "Bern", f"{n} May", "Full time")
    assert found[0] == [one(1), one(2)]
    assert [(c[0], c[1]) for c in found[1]] == [(["/out"], "In"), (["/out"], "In")]
    assert found[2] == [([], "T", "", "", "", "")] and found[3] == found[4] == []


def test_key_is_sha1(values):
    import hashlib

    want = hashlib.sha1("board|https://x/é".encode()).hexdigest()
    from pyspark.sql import functions as F

    assert values(text.surrogate_key(F.lit("board"), "x"), ["https://x/é"]) == [want]


def test_markup_without_python(spark):
    page = """<!-- <h1>no</h1> --><script>"<h1>no</h1>"</script>
      <div class='x a'><div>in <b>n</b>er</div> out&nbsp;&amp;&#233;&#xE9;&copy2 &unknown; 1<2</div>tail
      <ul><li data-cy=info-workload><span class=white-space_nowrap>80<b>%</b></span></li>
      <li data-cy="info-contract">a<i>b</i></li></ul>
      <ul><li>none</li></ul><ul><li><a title="q" href=/en/jobs/>fi<b>rst</b></a></li></ul>
      <nav><a href='/x?a=1&amp;b=2'>x</a><nav><a href="/y">y</nav></nav><a name="n">z</a>"""
    df = spark.createDataFrame([(1, page), (2, None), (3, "")], "i int, html string")
    tag = markup.Tag
    paths = {"div": [(tag("div", "class", "a", "word"),)], "path": [(tag("ul"), tag("li"), tag("a", "href", how="has"))]}
    both = F.expr(markup.bound(markup.visible("html"), lambda p: markup.first_texts(p, paths)))
    facts = html.detail_facts("html")
    found = df.select("i", both.alias("b"), facts.alias("f"), html.links("html").alias("all"), html.links("html", tag("nav")).alias("nav"))
    got = {r.i: r for r in found.collect()}
    assert got[1].b.div == "in n er out &éé©2 &unknown; 1<2"
    assert got[1].b.path == "fi rst"
    assert (got[1].f.workload_raw, got[1].f.employment_type) == ("80%", "a b")
    assert [tuple(x) for x in got[1].all] == [("/en/jobs/", "fi rst"), ("/x?a=1&b=2", "x"), ("/y", "y z")]
    assert [tuple(x) for x in got[1].nav] == [("/x?a=1&b=2", "x"), ("/y", "y")]
    for i in (2, 3):
        assert got[i].b.div == "" and got[i].b.path == "" and set(got[i].f) == {""} and got[i].all == got[i].nav == []


def test_labelled_value_stays_in_its_element(spark):
    page = """<div><span>Place of work:</span></div><div><p>not this</p></div>
      <div><span>Con<b>tract</b> type</span><br><p>Per<i>manent</i></p></div>
      <div><span>contract</span><p>later</p></div>"""
    df = spark.createDataFrame([(page,), (None,)], "html string")
    got = df.select(*[html.labelled_value("html", x) for x in ("place", "con tract", "contract", "salary")]).collect()
    assert [tuple(r) for r in got] == [("", "Per manent", "later", ""), ("",) * 4]


def test_markup_of_long_pages(spark):
    page = "<article>" + ("<div class='" + "c" * 500 + "'><p>w</p><br>") * 2000 + "</article>"
    row = spark.createDataFrame([(page,)], "html string").select(html.main_text("html", html.PageLayout(body_min_chars=3)).alias("t")).first()
    assert row.t == " ".join(["w"] * 2000)


def test_parts_are_those_of_split(spark):
    texts = ["", "a", "<p>", "x<p>y<p z>\n<b>", "<p><p", "é𝄞<p>é", "</p><P >", "<" * 5000 + "<p>", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = F.expr(markup.parts_at("t", markup.literal(r"<(?i:p)[\s>]")))
    for r in df.select("t", found.alias("a"), F.split("t", r"(?=<(?i:p)[\s>])").alias("b")).collect():
        assert r.a == r.b


def test_labels_are_read_once_for_all_prefixes(spark):
    label, value = markup.Tag("span"), markup.Tag("p")
    page = "<div><span>Place</span><p>Bern</p></div><div><SPAN>Contract <b>type</b></SPAN><p>Fixed</p></div><span>Pay</span>"
    df = spark.createDataFrame([(page,), ("",)], "t string")
    found = F.expr(markup.beside_labels("t", ["contract type", "place", "pay", "other"], label, value))
    assert [r.a for r in df.select(found.alias("a")).collect()] == [["Fixed", "Bern", "", ""], [""] * 4]
    cards = markup.elements("t", label, lambda inner, before: markup.plain_text(inner))
    assert "split(" not in cards + markup.beside_label("t", "place", label, value)
