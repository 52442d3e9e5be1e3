"""Pages to raw postings to the merged table to the panels, on a handful of postings."""

import pytest
from pyspark.sql import functions as F

from jobtide import fixed_values as fixed
from jobtide.functions.rules import RuleSet
from jobtide.operators import conform, facets
from jobtide.plans import collect, enrich, macro, panels
from jobtide.sources import files

BASE = "https://jobs.example.com"
RULES = RuleSet.of([("10-33 Manufacturing", ["stadler"]), ("64-66 Finance and Insurance", ["bank"])])


def card(path, title, company="Foo AG", place="Bern"):
    return (
        f"<div data-cy='vacancy-serp-item'><a href='{path}?x=1'><h2>{title}</h2></a>"
        f"<p><strong>{company}</strong></p><div><span>Place of work:</span><p>{place}</p></div></div>"
    )


def detail(title, text, place, workload, date="3 February 2026"):
    return (
        f"<h1 data-cy='vacancy-title'>{title}</h1><ul>"
        f"<li data-cy='info-publication'><span class='white-space_nowrap'>{date}</span></li>"
        f"<li data-cy='info-workload'><span class='white-space_nowrap'>{workload}</span></li></ul>"
        f"<div data-cy='vacancy-logo'><p>{place}</p></div>"
        f"<div data-cy='vacancy-description'>{text}<br>{'more words here ' * 10}</div>"
    )


@pytest.fixture(scope="module")
def raw(spark):
    listings = [
        ("data engineer", 1, 1, card("/en/jobs/detail/1", "One", "Stadler Rail") + card("/en/jobs/detail/2", "Two")),
        ("data engineer", 1, 2, card("/en/jobs/detail/1", "One again") + "<p>nothing</p>"),
        ("Data Analyst ", 2, 1, card("/en/jobs/detail/2", "Two again") + card("/en/jobs/detail/3", "Three", "Adecco")),
    ]
    details = [
        (f"{BASE}/en/jobs/detail/1", detail("Senior Engineer", "Python, SQL. CHF 110'000 to 130'000", "Zürich", "80 – 100%")),
        (f"{BASE}/en/jobs/detail/3", detail("", "A bank with R&D. 2 years of experience", "Olten", "50%", "2 June 2025")),
    ]
    return collect.collect_postings(
        spark.createDataFrame(listings, "search_term string, term_no int, page int, html string"),
        spark.createDataFrame(details, "url string, html string"),
        "board", BASE, "2026-03-01T17:21:57",
    )


def test_collect(raw):
    assert tuple(raw.columns) == fixed.RAW_COLUMNS
    got = {r.url[-1]: r for r in raw.collect()}
    assert sorted(got) == ["1", "2", "3"]
    assert (got["1"].title, got["1"].company) == ("Senior Engineer", "Stadler Rail")
    assert (got["2"].title, got["2"].search_term) == ("Two", "data engineer")
    assert (got["3"].title, got["3"].location_raw) == ("Three", "Olten")
    assert got["2"].description_raw == "" and got["2"].salary_available == 0
    assert got["1"].description_clean.startswith("Python, SQL. CHF 110'000 to 130'000 more words")


def test_collect_cards_only(spark, raw):
    listings = spark.createDataFrame(
        [("x", 1, 1, card("/en/jobs/a", "A") + card("/en/jobs/b", "B"))],
        "search_term string, term_no int, page int, html string",
    )
    got = collect.collect_postings(listings, None, "board", BASE, "t", limit=1).collect()
    assert [(r.title, r.workload_raw) for r in got] == [("A", "")]


@pytest.fixture(scope="module")
def clean(raw):
    return enrich.enrich_postings(raw)


def test_enrich(clean):
    assert tuple(clean.columns) == fixed.CLEAN_COLUMNS
    got = {r.title: r for r in clean.collect()}
    one = got["Senior Engineer"]
    assert (one.role, one.canton, one.city, one.region) == ("data engineer", "ZH", "Zürich", "Zurich")
    assert (one.quarter, one.macro_quarter, one.seniority) == ("2026Q1", "2026Q1", "senior")
    assert (one.workload_min, one.workload_max) == (80, 100)
    assert (one.salary_min, one.salary_max, one.salary_available) == (110000, 130000, 1)
    assert one.skills == ["python", "sql"] and one.skill_count == 2
    three = got["Three"]
    assert (three.role, three.skills, three.seniority) == ("data analyst", ["r"], "junior")
    assert (three.salary_available, three.quarter, three.region) == (0, "2025Q2", "Espace Mittelland")
    two = got["Two"]
    assert (two.posted_date, two.quarter, two.workload_min) == (None, None, None)


def cube(dimension, labels, quarters, values):
    def dim(items):
        return '{"category":{"label":{' + ",".join(f'"{i}":"{x}"' for i, x in enumerate(items)) + "}}}"

    return (
        f'{{"id":["Offene Stellen","{dimension}","Quartal"],"size":[1,{len(labels)},{len(quarters)}],'
        f'"value":{values},"dimension":{{"Offene Stellen":{dim(["total"])},'
        f'"{dimension}":{dim(labels)},"Quartal":{dim(quarters)}}}}}'
    )


QUARTERS = [f"{y}Q{q}" for y in (2023, 2024, 2025) for q in (1, 2, 3, 4)]


@pytest.fixture(scope="module")
def statistics(spark):
    regions = cube("Grossregion", ["Zürich", "Espace Mittelland", "Other"], QUARTERS, list(range(36)))
    branches = cube(
        "Wirtschaftsabteilung", ["10-33 Manufactury", "62-63 IT and other information services"],
        QUARTERS, list(range(100, 124)),
    )
    one = macro.region_vacancies(spark.createDataFrame([(regions,)], "c string"), "c")
    two = macro.industry_vacancies(spark.createDataFrame([(branches,)], "c string"), "c")
    return one, two


def test_macro_tables(statistics):
    one, two = (t.collect() for t in statistics)
    assert len(one) == 24 and len(two) == 16
    assert tuple(one[0]) == (None, "2024Q1", 28.0, 2024)
    assert {r.region for r in one} == {None, "Zurich", "Espace Mittelland"}
    assert tuple(two[-1]) == ("62-63 IT services", "2025Q4", 123.0, 2025)


@pytest.fixture(scope="module")
def merged(spark, clean, statistics, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("merged") / "table")
    files.write_table(macro.integrate(clean, *statistics, RULES), path)
    return spark.read.parquet(path)


def test_integrate(merged):
    assert tuple(merged.columns) == fixed.MERGED_COLUMNS
    got = {r.title: r for r in merged.collect()}
    one, two, three = got["Senior Engineer"], got["Two"], got["Three"]
    assert (one.industry, one.macro_quarter) == ("10-33 Manufacturing", "2025Q4")
    assert (one.macro_vacancies_region, one.macro_vacancies_industry) == (11.0, 111.0)
    assert (three.industry, three.macro_quarter) == ("64-66 Finance and Insurance", "2025Q2")
    assert (three.macro_vacancies_region, three.macro_vacancies_industry) == (21.0, None)
    assert (two.industry, two.macro_vacancies_region) == (fixed.DEFAULT_INDUSTRY, None)


def test_macro_side_is_broadcast_from_its_size(spark, clean, statistics, tmp_path):
    """A stored statistics table is small by its file size: no shuffle of the postings for it."""
    stored = []
    for i, t in enumerate(statistics):
        files.write_table(t, str(tmp_path / f"m{i}"))
        stored.append(spark.read.parquet(str(tmp_path / f"m{i}")))
    files.write_table(clean, str(tmp_path / "clean"))
    out = macro.integrate(spark.read.parquet(str(tmp_path / "clean")), *stored, RULES)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "Exchange hashpartitioning" not in plan


def test_panels(merged):
    view = conform.to_dashboard_contract(merged, ["job_id"])
    view = facets.apply_facets(view, facets.FacetFilter(role=("data engineer", "data analyst")))
    for name, panel in panels.dashboard_panels(view, min_group=1).items():
        assert panel.count() >= 0, name
    kpi = panels.dashboard_panels(view, 1)["kpi"].first()
    assert (kpi.postings, kpi.companies, kpi.salary_rows) == (3, 3, 1)
    results = panels.analysis_results(merged)
    counts = {name: df.count() for name, df in results.items()}
    assert counts["describe"] == 8 and counts["profile"] == 22 and counts["skills_by_seniority"] == 15
    assert results["repeats"].first().duplicate_rows == 0
    top = results["top_skills"].collect()
    assert [(r.tag, r["count"]) for r in top] == [("python", 1), ("r", 1), ("sql", 1)]
    assert results["roles_by_region"].where(F.col("region") == "Zurich").first()["data engineer"] == 1


def test_enrich_does_not_depend_on_partitioning(spark):
    rows = [(f"id{i % 40}", "2026-01-01", f"term {i}", f"title {i}", f"CHF {i}0'000") for i in range(400)]
    raw = spark.createDataFrame(rows, "job_id string, scraped_at string, search_term string, title string, description_clean string")
    for c in ("url", "location_raw", "posted_date", "workload_raw", "company"):
        raw = raw.withColumn(c, F.lit("2026-01-01"))
    found = [sorted(map(str, enrich.enrich_postings(raw.repartition(n, "title")).collect())) for n in (1, 3, 7, 16)]
    assert found[0] == found[1] == found[2] == found[3] and len(found[0]) == 40


def test_label_figures_match_figures_over_joined_postings(spark):
    from jobtide.operators import summary

    rows = [(i if i % 7 else None, ["a", "b", None][i % 3], ["2024Q1", "2024Q2", "2024Q3", None][i % 4]) for i in range(100)]
    postings = spark.createDataFrame(rows, "id int, region string, quarter string")
    stats = spark.createDataFrame([("a", "2024Q1", 10.0), ("a", "2024Q2", 20.0), ("b", "2024Q1", None), ("b", "2024Q3", 7.0)], "region string, quarter string, vacancies double")
    joined = macro.attach_macro(postings, stats, "region", "quarter", "v")
    assert joined.count() == 100 and joined.where("region is null and v is not null").count() == 0
    plain = summary.count_and_mean(joined, "region", "id", "v").collect()
    found = macro.label_figures(postings, stats, "region", "quarter", "id").collect()
    assert [(r.region, r.postings, round(r.macro_mean, 9)) for r in found] == [
        (r.region, r.postings, round(r.macro_mean, 9)) for r in plain
    ]
    assert macro.label_figures(postings, stats.where("false"), "region", "quarter", "id").collect() == []


@pytest.mark.parametrize("spread_hot", [False, True])
def test_macro_join_deals_postings_without_region(spark, spread_hot):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "40"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        region = F.when(F.col("id") % 10 == 0, F.concat(F.lit("r"), F.col("id") % 3)) if not spread_hot else F.when(F.col("id") % 10 < 6, "hot")
        postings = spark.range(20_000).select("id", region.alias("region"), F.lit("2024Q1").alias("quarter"))
        stats = spark.createDataFrame([("r0", "2024Q1", 1.0), ("r1", "2024Q1", 2.0), ("hot", "2024Q1", 3.0)], "region string, quarter string, vacancies double")
        found = macro.attach_macro(postings, stats, "region", "quarter", "v", spread_hot)
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 20_000 and max(sizes) < 2_000
        assert found.where("v is not null").count() == (12_000 if spread_hot else 1_334)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
