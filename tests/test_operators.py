"""Operators against brute force, with one key holding a third of the rows."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobtide.operators import conform, coverage, facets, joins, quantiles, rows, summary, tagstats


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    data = []
    for i in range(6000):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(40)}"
        value = rng.choice([5.0, rng.gauss(0, 1), rng.expovariate(1e-6), -rng.expovariate(0.01)])
        data.append((i, key, None if rng.random() < 0.05 else value))
    rng.shuffle(data)
    return data, spark.createDataFrame(data, "i int, g string, v double").repartition(8)


def test_keep_first(skewed):
    data, df = skewed
    want = {}
    for i, g, v in sorted(data):
        want.setdefault(g, (i, v))
    got = rows.keep_first(df, ["g"], ["i"]).collect()
    assert {r.g: (r.i, r.v) for r in got} == want
    assert rows.keep_first(df, ["g"], ["i"]).columns == df.columns


@pytest.mark.parametrize("small", [True, False])
def test_quantiles(skewed, small):
    data, df = skewed
    groups = defaultdict(list)
    for _, g, v in data:
        if v is not None:
            groups[g].append(v)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = quantiles.group_quantiles(df, ["g"], "v", probs, small).collect()
    assert len(got) == len(groups)
    for r in got:
        want = np.quantile(groups[r.g], probs)
        assert r.n == len(groups[r.g])
        assert np.allclose([r[f"q{i}"] for i in range(len(probs))], want, rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("slices", [1, 3, 4096])
def test_quantiles_few_values(spark, slices):
    data = [("a", 1.0)] * 7 + [("a", 2.0)] * 2 + [("b", 4.0), ("c", 1.0), ("c", 2.0)]
    data += [("d", None), (None, 3.0), ("e", 0.0), ("e", -1e300), ("e", 1e300)]
    df = spark.createDataFrame(data, "g string, v double")
    found = quantiles.group_quantiles(df, ["g"], "v", [0.5, 0.9], slices=slices)
    got = {r.g: (r.q0, round(r.q1, 9)) for r in found.collect()}
    assert got.pop("e")[0] == 0.0
    assert got == {"a": (1.0, 2.0), "b": (4.0, 4.0), "c": (1.5, 1.9)}


@pytest.mark.parametrize("slices", [50, 400])
def test_quantiles_order_only_values_near_the_ranks(spark, slices):
    """Groups larger than the sketch, with heavy repeats, against numpy."""
    rng = np.random.default_rng(slices)
    values = {
        "hot": np.concatenate([rng.lognormal(0, 3, 30_000), np.full(9_000, 1.5), -rng.random(4_000)]),
        "steps": rng.integers(0, 7, 5_000).astype(float), "same": np.full(3_000, 2.0), "few": np.array([3.0, 1.0]),
    }
    data = [(g, float(v)) for g, vs in values.items() for v in vs]
    rng.shuffle(data)
    df = spark.createDataFrame([(g, float(v)) for g, v in data], "g string, v double").repartition(8)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    for r in quantiles.group_quantiles(df, ["g"], "v", probs, slices=slices).collect():
        assert r.n == len(values[r.g])
        assert np.allclose([r[f"q{i}"] for i in range(7)], np.quantile(values[r.g], probs), rtol=1e-12)


def test_quantiles_exchange_values_at_most_three_times(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("v"))
    found = quantiles.group_quantiles(df, ["g"], "v", [0.25, 0.5, 0.75])
    plan = found._jdf.queryExecution().executedPlan().toString()
    # The sketches of groups, the join, the values inside brackets, and the values in order.
    assert plan.count("Exchange hashpartitioning") <= 5 and "Range" in plan


def test_boxplot(spark):
    values = [1, 2, 3, 4, 100, -50, 2, 3]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 7)], "g string, v int")
    got = {r.g: r for r in quantiles.boxplot_stats(df, "g", "v").collect()}
    q1, med, q3 = np.quantile(values, [0.25, 0.5, 0.75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    kept = [v for v in values if low <= v <= high]
    a = got["a"]
    assert (a.q1, a.median, a.q3) == (q1, med, q3)
    assert (a.whisker_low, a.whisker_high, a.outliers) == (min(kept), max(kept), 2)
    assert (got["b"].whisker_low, got["b"].whisker_high, got["b"].outliers) == (7, 7, 0)
    assert sorted(r.v for r in quantiles.outliers(df, "g", "v").collect()) == [-50, 100]


def test_coverage_log(spark):
    rng = random.Random(3)
    data, order = [], 0
    for term in ("ai", "data"):
        for page in range(1, 13):
            for _ in range(rng.randrange(1, 5)):
                key = "hot" if rng.random() < 0.34 else f"u{rng.randrange(12)}"
                data.append((term, page, key, order))
                order += 1
    df = spark.createDataFrame(data, "term string, page int, url string, n int").repartition(6)
    seen, total, streak, want = set(), 0, 0, []
    pages = defaultdict(list)
    for term, page, key, _ in data:
        pages[term, page].append(key)
    last = None
    for (term, page), keys in pages.items():
        new = len(set(keys) - seen)
        seen |= set(keys)
        total += new
        streak = 0 if new or term != last else streak
        streak += new == 0
        last = term
        want.append((term, page, len(keys), new, total, streak))
    log = coverage.coverage_log(df, "term", "page", "url", "n")
    got = [tuple(r) for r in log.orderBy("term", "page").collect()]
    assert got == want


def test_duplicate_rows_tells_null_from_empty(spark):
    data = [("a", None), (None, "a"), ("a", ""), ("a", None), ("", "a"), ("a|", "b"), ("a", "|b")]
    df = spark.createDataFrame(data, "x string, y string")
    got = rows.duplicate_rows(df).first()
    assert (got.row_count, got.distinct_rows, got.duplicate_rows) == (7, 6, 1)
    none = rows.duplicate_rows(df.limit(0)).first()
    assert (none.row_count, none.duplicate_rows) == (0, 0)


def test_sample_ignores_partitioning(skewed):
    _, df = skewed
    one = [r.i for r in rows.hash_sample(df, "i", 10).collect()]
    two = [r.i for r in rows.hash_sample(df.repartition(3), "i", 10).collect()]
    assert one == two and len(set(one)) == 10
    assert one != [r.i for r in rows.hash_sample(df, "i", 10, seed=1).collect()]


def test_left_enrich(spark):
    left = spark.createDataFrame([(1, "a", "q"), (2, None, "q"), (3, "b", "q")], "i int, g string, k string")
    right = spark.createDataFrame([("a", "q", 5), ("a", "q", 6), (None, "q", 7)], "g string, quarter string, v int")
    on, values = {"g": "g", "k": "quarter"}, {"v": "out"}
    plain = joins.left_enrich(left, right, on, values)
    assert plain.columns == ["i", "g", "k", "out"]
    assert sorted((r.i, r.out or 0) for r in plain.collect()) == [(1, 5), (1, 6), (2, 0), (3, 0)]
    safe = joins.left_enrich(left, right, on, values, null_safe=True)
    assert sorted((r.i, r.out or 0) for r in safe.collect()) == [(1, 5), (1, 6), (2, 7), (3, 0)]
    report = joins.match_report(plain, "out", left).first()
    assert tuple(report) == (3, 4, 2, 2)


@pytest.fixture(scope="module")
def tagged(spark):
    rng = random.Random(5)
    names = [f"t{i}" for i in range(14)]
    data = []
    for i in range(900):
        group = "hot" if i % 3 == 0 else rng.choice(["a", "b ", " b", "c", "  ", None, "rare"[: rng.randrange(3, 5)]])
        tags = [rng.choice(names[: 3 + i % 12]) for _ in range(rng.randrange(0, 6))]
        data.append((i, group, None if i % 50 == 0 else tags))
    return data, spark.createDataFrame(data, "i int, g string, tags array<string>").repartition(8)


def top_of(data, k):
    counts = Counter(t for _, _, tags in data for t in tags or [])
    return [t for t, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k]]


def test_tag_share(tagged):
    data, df = tagged
    top = top_of(data, 10)
    sizes = Counter(g for _, g, _ in data if g is not None)
    want = {
        (g, t): (n, sum((tags or []).count(t) for _, h, tags in data if h == g))
        for g, n in sizes.items()
        if n >= 20
        for t in top
    }
    got = tagstats.tag_share_by_group(df, "g", "tags", 10, 20).collect()
    assert {(r.g, r.tag): (r.group_rows, r.mentions) for r in got} == want
    assert all(abs(r.share_pct - 100 * r.mentions / r.group_rows) < 1e-9 for r in got)
    assert all(r.tag == top[r.tag_rank - 1] for r in got)


def test_tag_levels(tagged):
    data, df = tagged
    got = tagstats.tag_share_by_group(df, "g", "tags", 3, levels=("hot", "nobody")).collect()
    assert len(got) == 6
    assert all(r.share_pct == 0 and r.group_rows == 0 for r in got if r.g == "nobody")


def test_tag_presence(tagged):
    data, df = tagged
    top = top_of(data, 4)
    groups = defaultdict(list)
    for _, g, tags in data:
        if g is not None and g.strip():
            groups[g.strip()].append(set(tags or []))
    want = {
        (g, t): sum(t in s for s in sets) * 100 / len(sets)
        for g, sets in groups.items()
        if len(sets) >= 5
        for t in top
    }
    got = {(r.g, r.tag): r.share_pct for r in tagstats.tag_presence_matrix(df, "g", "tags", 4, 5).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_tags_of_nothing(spark):
    df = spark.createDataFrame([("a", [])], "g string, tags array<string>")
    assert tagstats.top_tags(df, "tags").collect() == []
    assert tagstats.tag_share_by_group(df, "g", "tags").collect() == []
    assert tagstats.tag_presence_matrix(df.limit(0), "g", "tags").collect() == []


def view_of(spark, data):
    schema = (
        "job_id string, title string, company string, role string, region string, canton string, "
        "industry string, seniority string, city string, workload_min int, workload_max int, "
        "salary_available double, skills_list array<string>, skill_count double, "
        "macro_vacancies_region double"
    )
    return spark.createDataFrame(data, schema)


@pytest.fixture(scope="module")
def view(spark):
    return view_of(
        spark,
        [
            ("1", "Data nan", "Foo (CH)", "de", "Z", "ZH", "IT", "mid", None, 80, 100, 1.0, ["sql", "r"], 2.0, 5.0),
            ("2", None, "Bar", "de", "Z", "ZH", None, None, None, None, 50, 0.0, [], 0.0, 7.0),
            ("3", "Lead", " ", "ds", "E", None, "IT", "lead", None, None, None, None, ["sql"], None, None),
            ("4", "ÉCOLE", None, None, None, "BE", "Bank", "mid", None, 100, 100, 0.0, ["r", "sql", "x"], 3.0, None),
        ],
    )


def test_kpis(view):
    for small in (True, False):
        got = summary.kpi_row(view, small_domain=small).first()
        assert (got.postings, got.companies, got.salary_rows, got.median_skills) == (4, 3, 1, 2.0)
        assert (got.skill_coverage, got.missing_canton, got.missing_seniority) == (50.0, 25.0, 25.0)
        assert abs(got.salary_rate - 100 / 3) < 1e-9
    empty = summary.kpi_row(view.limit(0)).first()
    assert (empty.postings, empty.salary_rate, empty.median_skills, empty.salary_rows) == (0, 0, 0, 0)


def test_summary_and_quality(view):
    got = facets.exec_summary(view).first()
    assert (got.top_role, got.top_canton, got.top_skill) == ("de", "ZH", "sql")
    none = facets.exec_summary(view.limit(0)).first()
    assert tuple(none) == ("N/A", "N/A", "N/A", 0.0)
    quality = {r.metric: r.rows for r in summary.missingness(view, summary.quality_checks(view)).collect()}
    assert quality == {
        "Missing canton": 1, "Missing region": 1, "Missing industry": 1, "Missing seniority": 1,
        "Missing workload": 2, "Zero extracted skills": 2, "No salary information": 3,
    }
    assert facets.is_empty(view.where("role = 'x'")) and not facets.is_empty(view)


def test_facets(view):
    choose = facets.FacetFilter

    def ids(chosen, **kw):
        return sorted(r.job_id for r in facets.apply_facets(view, chosen, **kw).collect())

    assert ids(choose()) == ["1", "2", "3", "4"]
    assert ids(choose(role=("de",), canton=("ZH", "BE"))) == ["1", "2"]
    assert ids(choose(search="nan")) == ["1"]
    assert ids(choose(search="école|^bar$")) == ["2", "4"]
    assert ids(choose(search="(ch)"), regex=False) == ["1"]
    options = facets.facet_options(view, choose(role=("de",), canton=("BE",))).collect()
    assert [(r.facet, r.value) for r in options] == [
        ("role", "de"), ("role", "ds"), ("region", "Z"), ("canton", "ZH"),
    ]
    shown = facets.preview(view, ["job_id"], 2)
    assert shown.count() == 2 and "city" in shown.columns
    assert [r.salary_available for r in facets.export_view(view.orderBy("job_id")).collect()] == ["Yes", "No", "No", "No"]


def test_grouped_figures(view):
    got = summary.count_and_mean(view, "region", "job_id", "macro_vacancies_region").collect()
    assert [tuple(r) for r in got] == [("E", 1, None), ("Z", 2, 6.0)]
    lost = view.withColumn("macro_vacancies_region", F.lit(None).cast("double"))
    assert summary.count_and_mean(lost, "region", "job_id", "macro_vacancies_region").collect() == []
    rates = summary.rate_by_group(view, "role", "salary_available").collect()
    assert [tuple(r) for r in rates] == [("de", 2, 0.5)]
    assert summary.rate_by_group(view, "role", "salary_available", min_rows=3).collect() == []
    share = summary.workload_share(view).collect()
    assert {(r.role, r.category): r.share_pct for r in share if r.share_pct} == {
        ("de", "Flexible (61-89%)"): 50.0, ("de", "Part-time (<=60%)"): 50.0, ("ds", "Unknown"): 100.0,
    }
    pivot = summary.pivot_counts(view, "canton", "seniority", ["mid", "lead"]).collect()
    assert [tuple(r) for r in pivot] == [("BE", 1, 0), ("ZH", 1, 0)]
    counts = summary.value_counts(view, "canton", include_null=True).collect()
    assert [tuple(r) for r in counts] == [("ZH", 2), (None, 1), ("BE", 1)]
    scaled = summary.minmax_scale(summary.value_counts(view, "canton"), "count").collect()
    assert [(r.canton, r.scaled) for r in scaled] == [("ZH", 1.0), ("BE", 0.0)]
    flat = summary.minmax_scale(view.limit(1).select("workload_min"), "workload_min", zero_range=None)
    assert flat.first().scaled is None
    assert [r.company for r in summary.top_values(view, "company").collect()] == ["Bar", "Foo (CH)"]


def test_profile_and_shape(view):
    got = {r["column"]: (r.dtype, r.missing, r.missing_pct) for r in summary.column_profile(view).collect()}
    assert got["title"] == ("string", 1, 25.0) and got["workload_min"] == ("int", 2, 50.0)
    assert tuple(summary.shape(view).first()) == (4, 15)


def test_conform(spark):
    df = spark.createDataFrame([(1, "x")], "b int, old string")
    out = conform.conform(df, ["new", "b", "c", "d"], {"d": 0}, rename={"old": "new"})
    assert tuple(out.first()) == ("x", 1, "", 0)
    assert conform.select_existing(df, ["z", "old", "b"]).columns == ["old", "b"]
    ids = conform.with_fallback_id(df.withColumnRenamed("b", "b_id"), "job_id", ["b_id"], ["old"])
    assert ids.first().job_id == 1
    raw = spark.createDataFrame([("['a','Py']", "7", "x")], "skills string, workload_min string, title string")
    ready = conform.to_dashboard_contract(raw, ["title"]).first()
    assert ready.skills_list == ["a", "python"] and ready.skill_count == 2.0
    assert ready.workload_min == 7.0 and ready.salary_available == 0.0 and ready.canton is None
