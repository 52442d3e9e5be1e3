from pyspark.sql import functions as F

from jobtide.functions import extract, periods, text, urls


def pairs(rows):
    return [None if r is None else (r["min"], r["max"]) for r in rows]


def test_salary(values):
    cases = {
        "CHF 110'000 to 130'000": (110000, 130000),
        "CHF 110’000 bis 130‘000": (110000, 130000),
        "chf 110′000 – 130'000 p.a.": (110000, 130000),
        "CHF 88,000": (88000, 88000),
        "CHF 95'000 per year": (95000, 95000),
        "3000 CHF per month": (36000, 36000),
        "CHF 110'000 - CHF 130'000": (110000, 110000),
        "CHF, plus bonus": None,
        "CHF 5'000 to 9'000": None,
        "CHF 500'001": None,
        "from CHF 9'000 to 20'000, later CHF 80'000 to 90'000": (80000, 90000),
        "CHF 99999999999999999999999": None,
        "CHF ''": None,
        "EUR 80'000": None,
        "CHF 80'000": (80000, 80000),
    }
    assert pairs(values(extract.salary_range("x"), list(cases))) == list(cases.values())
    assert values(extract.salary_range("x"), [None]) == [None]
    assert values(extract.disclosed(extract.salary_range("x")), ["CHF 88,000", "x"]) == [1, 0]


def test_workload(values):
    got = values(extract.workload_bounds("x"), ["80 – 100%", "100%", "on request", None, "20-40-60"])
    assert pairs(got) == [(80, 100), (100, 100), (None, None), (None, None), (20, 40)]


def test_experience(values):
    cases = {
        "3-5 years of experience": "mid",
        "3–5 years of experience": "mid",
        "10+ Jahre Erfahrung": "senior",
        "5 ans d'expérience": None,
        "2 ANS EXPÉRIENCE": "junior",
        "1 à 2 ans expérience": "junior",
        "6 anni esperienza": "senior",
        "99999999999999999999 years experience": "senior",
        "years of experience": None,
    }
    got = values(extract.seniority_of_years(extract.experience_years("x")), list(cases))
    assert got == list(cases.values())


def test_seniority_order(spark):
    rows = [
        ("Senior Trainee", "", "intern"),
        ("Internal auditor", "", None),
        ("Jr. dev", "", "junior"),
        ("Product Manager", "junior", "lead"),
        ("Sr.Engineer", "", "senior"),
        ("Dev", "manage a team as senior", "lead"),
        ("Dev", "First job welcome", "junior"),
        ("Dev", "first\njob", None),
        ("Dev", "8 years experience", "senior"),
        (None, None, None),
    ]
    df = spark.createDataFrame(rows, "t string, d string, want string")
    got = df.select("want", extract.seniority("t", "d").alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_workload_categories_differ(spark):
    df = spark.createDataFrame([(None, 50), (None, None), (95, None), (70, 80)], "a int, b int")
    one = extract.workload_category("a", "b", "analysis").alias("x")
    two = extract.workload_category("a", "b", "dashboard").alias("y")
    got = [(r.x, r.y) for r in df.select(one, two).collect()]
    assert got[0] == ("Unknown", "Part-time (<=60%)")
    assert got[1] == ("Unknown", "Unknown")
    assert got[2] == ("Full-time (≥90%)", "Full-time (>=90%)")
    assert got[3] == ("Flexible (61-89%)", "Flexible (61-89%)")


def test_clean_text_like_python(values):
    odd = " a  b\x1c\x85c　\n\t d​ "
    assert values(text.clean_text("x"), [odd, None, "  "]) == [" ".join(odd.split()), "", ""]


def test_small_text_functions(values):
    assert values(text.short_label("x"), ["62-63 IT services", "Sport", None]) == [
        "IT services", "Sport", None,
    ]
    assert values(text.to_number("x"), ["1.5", " 2 ", "n/a", "", None]) == [1.5, 2.0, None, None, None]
    assert values(text.coalesce_nonempty("x", F.lit("b")), ["a", "", "  ", None]) == ["a", "b", "b", "b"]
    assert values(text.safe_timestamp("x"), ["2026-03-01T17:21:57"]) == ["2026-03-01T17-21-57"]
    assert values(text.yes_no("x"), [1, 0, None], "int") == ["Yes", "No", "No"]
    levels = ("intern", "junior", "mid")
    assert values(text.ordinal("x", levels), ["mid", "intern", "boss", None]) == [3, 1, 4, 4]


def test_periods(values):
    texts = ["28 February 2026", "2026-02-28", "28.02.2026", "yesterday", "", None, "31 June 2026"]
    got = values(periods.parse_date("x").cast("date").cast("string"), texts)
    assert got == ["2026-02-28"] * 3 + [None] * 4
    assert values(periods.quarter_label(F.to_date("x")), ["2026-02-28", None]) == ["2026Q1", None]
    starts = values(periods.quarter_start("x").cast("string"), ["2026Q1", "2025Q4", "2025Q5", "NaT"])
    assert starts == ["2026-01-01", "2025-10-01", None, None]
    proxy = periods.period_proxy("x", {"2026Q1": "2025Q4"}, latest="2026Q2")
    assert values(proxy, ["2026Q1", "2026Q3", "2025Q1", None]) == ["2025Q4", "2026Q2", "2025Q1", None]


def test_urls(values):
    base = "https://jobs.example.com"
    cases = {
        f"{base}/en/jobs/detail/1/?term=x#y": True,
        f"{base}/en/jobs/abc": True,
        f"{base}//en/jobs//abc/more": True,
        f"{base}/en/jobs/": False,
        f"{base}/en/jobs": False,
        f"{base}/en/jobs/search?page=2": False,
        f"{base}/en/jobs/searching": True,
        f"{base}/en/jobs/results/": False,
        f"{base}/fr/jobs/abc": False,
        "https://other.example.com/en/jobs/abc": False,
        f"http://x/{base}/en/jobs/abc": False,
        "": False,
        None: False,
    }
    assert values(urls.is_detail_url("x", base), list(cases)) == list(cases.values())
    assert values(urls.canonical_url("x"), ["http://a/b//?q#f", "http://a/", None]) == [
        "http://a/b", "http://a", "",
    ]
    page = F.lit("https://a.b/c/d?x")
    links = ["/e", "e", "//h/e", "http://z/e", "?q", "#f", "", "mailto:a@b.c"]
    assert values(urls.absolute_url(page, "x"), links) == [
        "https://a.b/e", "https://a.b/c/e", "https://h/e", "http://z/e", "https://a.b/c/d?q",
        "https://a.b/c/d#f", "https://a.b/c/d", "mailto:a@b.c",
    ]
    got = values(urls.search_url("https://s/", "x", F.lit(2)), ["data & ai~*é", "c++"])
    assert got == ["https://s/?term=data+%26+ai~%2A%C3%A9&page=2", "https://s/?term=c%2B%2B&page=2"]
    ranked = urls.best_url(F.split("x", " "))
    assert values(ranked, ["http://a/bb http://a/detail/c http://a/b", "http://a/b http://a/c"]) == [
        "http://a/detail/c", "http://a/b",
    ]


def test_long_figures_do_not_end_the_job(values):
    texts = ["999999999999999999 CHF per month", "CHF 9999999999999999999999 - 120'000", "CHF 80'000 - 100'000"]
    assert [x and tuple(x) for x in values(extract.salary_range("x"), texts)][::2] == [None, (80000, 100000)]
    assert [tuple(x) for x in values(extract.workload_bounds("x"), ["99999999999 - 80%", "80 - 100%", "60%", "", None])] == [
        (None, 80), (80, 100), (60, 60), (None, None), (None, None),
    ]
