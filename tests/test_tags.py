import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jobtide import fixed_values as fixed
from jobtide.functions import rules, tags
from jobtide.functions.lexicon import Lexicon


def brute(text, terms):
    """Each term on its own, as whole word."""
    return sorted(t for t in set(terms) if re.search(r"\b" + re.escape(t) + r"\b", text))


TRICKY = (
    "r", "r&d", "c++", "c", "data", "data lake", "data lakehouse", "lake", "text classification",
    "classification", ".net", "green ", "é", "a/b", "b", "x_1", "x", "fis (x)", "fis",
)


def test_lexicon_tricky(values):
    texts = [
        "text classification; data lakehouse, data lake house",
        "r&d c++ c++x asp.net x.net green day green, résultats é a/b x_1 fis (x)y fis (x) ",
        "", None, "data  lake data\nlake data_lake", "x_1x x-1 (r) R",
    ]
    got = values(Lexicon.of(TRICKY).found("x"), texts)
    assert got == [brute(t or "", TRICKY) for t in texts]


def test_lexicon_random(values):
    """Random texts over the dictionary's own pieces, against one search for each term."""
    texts = []

    @settings(max_examples=300, database=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.sampled_from([*TRICKY, " ", "-", "ä", "_", "+", "1", ";"]), max_size=12))
    def make(parts):
        texts.append("".join(parts))

    make()
    got = values(Lexicon.of(TRICKY).found("x"), texts)
    assert got == [brute(t, TRICKY) for t in texts]


def test_skill_dictionary(values):
    texts = [
        "Python, SQL & R; excellent résultats, scalable digital trust",
        "machine learning / deep learning, CI/CD, d3.js, weights & biases, a/b testing",
        "data pipeline and data pipelines on Google Cloud (vertex ai), c++ c++17 ki",
        " ".join(fixed.SKILL_TERMS),
    ]
    got = values(tags.dictionary_tags("x"), texts)
    assert got == [brute(t.lower(), fixed.SKILL_TERMS) for t in texts]


def test_parse_list(values):
    texts = ["['a', 'b']", '["A", "it\'s"]', "python, SQL , py,", "[]", None, "", r"['it\'s']", "[broken"]
    assert values(tags.parse_list("x"), texts) == [
        ["a", "b"], ["a", "it's"], ["python", "sql"], [], [], [], ["it's"], ["[broken"],
    ]
    assert values(tags.parse_list("x", "analysis"), texts) == [
        ["a", "b"], ["a", "it's"], [], [], [], [], ["it's"], [],
    ]


def test_normalize(values):
    got = values(tags.normalize_tags("x"), [[" Py", "python", "", None, "K8s"], None], "array<string>")
    assert got == [["python", "kubernetes"], []]


RULES = rules.RuleSet.of(
    [
        ("Construction", ["holcim", "halter ag"]),
        ("Finance", ["bank cler", "bank", "fis (switzerland)"]),
        ("Public", ["green ", "kanton"]),
        ("Other bank", ["bank", "on ag"]),
    ]
)


def brute_class(company, text, agencies=("adecco", "hays")):
    def first(where):
        for name, words in RULES.rules:
            if any(re.search(r"\b" + re.escape(w) + r"\b", where) for w in words):
                return name
        return None

    company, text = (company or "").lower(), (text or "").lower()
    by_company = None if any(a in company for a in agencies) else first(company)
    return by_company or first(text) or "IT"


def test_classifier_against_brute_force(spark):
    names = ["Bank Cler AG", "Adecco Bank", "Chaysers Bank", "On AG", "Kantonalbank", "FIS (Switzerland)x", None, "Halter AG", "bank_x"]
    texts = ["green day", "green", "Kanton Bern, holcim", "a bank on ag", "", None]
    rows = [(n, t) for n in names for t in texts]
    df = spark.createDataFrame(rows, "c string, d string")
    got = df.select("c", "d", rules.classify("c", "d", RULES, ("adecco", "hays"), "IT").alias("k"))
    for r in got.collect():
        assert r.k == brute_class(r.c, r.d), (r.c, r.d)


def test_trace(values):
    text = "on ag bank cler kanton"
    got = values(RULES.trace("x"), [text])[0]
    assert [(h.rule_order, h.keyword) for h in got] == [
        (2, "bank cler"), (2, "bank"), (3, "kanton"), (4, "bank"), (4, "on ag"),
    ]
    first = values(RULES.trace("x", first_per_rule=True), [text])[0]
    assert [(h.rule_order, h.keyword) for h in first] == [(2, "bank cler"), (3, "kanton"), (4, "bank")]


def test_rules_from_table(spark, tmp_path):
    from jobtide.sources.files import read_rules

    path = tmp_path / "rules.csv"
    path.write_text(
        "rule_order,category,keyword_order,keyword\n2,B,1,bank\n1,\"A, a\",2,green \n1,\"A, a\",1,x\n"
    )
    loaded = read_rules(spark, str(path))
    assert loaded.rules == (("A, a", ("x", "green ")), ("B", ("bank",)))
    table = spark.range(30).selectExpr(
        "int(id) rule_order", "'c' category", "1 keyword_order", "string(id) keyword"
    )
    try:
        rules.RuleSet.from_table(table, max_rows=20)
        raise AssertionError("a large table must be refused")
    except ValueError:
        pass


def test_agency_names(values):
    got = values(rules.agency_flag("x"), ["Chaysers", "MANPOWER SA", "Hamilton", None])
    assert got == [True, True, False, False]
    found = values(tags.has_tag(F.split("x", ","), "r"), ["r,s", "rs", None])
    assert found == [True, False, False]
