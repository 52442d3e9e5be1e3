"""Running totals, inferred dates, sketches, the text index and streams against plain loops."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from jobtide.operators import dates, facets, running, sketches, textindex
from jobtide.streaming import runs as stream


def test_running_total_over_blocks(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(50), i, rng.choice([None, 1, 5, -3])) for i in range(900)]
    df = spark.createDataFrame(rows, "a int, i int, v long").repartition(6)
    found = {(r.a, r.i): r.total for r in running.running_total(df, ["a", "i"], "v").collect()}
    total = 0
    for a, i, v in sorted(rows, key=lambda r: r[:2]):
        total += v or 0
        assert found.pop((a, i)) == total
    assert not found
    assert running.running_total(df.where("false"), ["a", "i"], "v").collect() == []
    plan = running.running_total(df, ["a", "i"], "v")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_dates_by_the_format_of_their_source(spark):
    rows = [("day", "31/01/2026"), ("day", "03/04/2026"), ("day", "04/31/2026"), ("day", None), ("day", " 1 "),
            ("month", "01/31/2026"), ("month", "03/04/2026"), ("both", "03/04/2026"), ("both", "05/04/2026"),
            ("same", "04/04/2026"), ("none", "soon"), (None, "2 March 2025"), (None, "2025-03-04"), (None, "3 March 2025")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, s string, t string")
    found = [r.parsed for r in sorted(dates.infer_dates(df, "t", "s").collect(), key=lambda r: r.i)]
    day = datetime.date
    assert found == [
        day(2026, 1, 31), day(2026, 4, 3), None, None, None, day(2026, 1, 31), day(2026, 3, 4), None, None,
        day(2026, 4, 4), None, day(2025, 3, 2), None, day(2025, 3, 3),
    ]


def test_sketches_unite_over_any_choice(spark):
    df = spark.range(60_000).select((F.col("id") % 7).alias("run"), (F.col("id") % 3).alias("lang"), (F.col("id") % 20_011).alias("v"))
    stored = sketches.distinct_sketches(df, ["run", "lang"], "v")
    whole = sketches.distinct_estimates(stored, []).first()["distinct"]
    assert abs(whole - 20_011) <= 4 * sketches.relative_error() * 20_011
    for r in sketches.distinct_estimates(stored, ["lang"]).collect():
        exact = df.where(F.col("lang") == r.lang).select("v").distinct().count()
        assert abs(r["distinct"] - exact) <= 4 * sketches.relative_error() * exact
    assert sketches.distinct_estimates(stored.where("run = 1"), []).first()["distinct"] == pytest.approx(8572, rel=0.07)


@pytest.mark.parametrize(
    ("pattern", "want"),
    [("abcd", ["abcd"]), ("ab+cd", ["ab", "cd"]), ("colou?r", ["colo", "r"]), ("a(bc)d", ["a", "d"]), ("x[abc]y", ["x", "y"]),
     ("abc|d", []), (r"a\d", []), ("(?:ab)", []), ("^start.*end$", ["start", "end"]), ("ab{2,3}c", ["a", "c"]), ("[]a]b", [])],
)
def test_literal_runs(pattern, want):
    assert textindex.literal_runs(pattern) == want


def test_indexed_search_equals_the_full_scan(spark, tmp_path):
    rng = random.Random(3)
    words = ["Bank", "STRASSE", "straße", "data", "engineer", "Ingénieur", "ſpace", "İstanbul", "ΣΟΦΟΣ", "σοφος", "x"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 4))), rng.choice([None, "bank ag", "data sa"])) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, title string, company string").repartition(4)
    path = str(tmp_path / "index")
    textindex.build_index(df, "id", ["title", "company"], path)
    for query, regex in [("bank", True), ("data.*x", True), ("STRAß", True), ("space", True), ("istanbul", True), ("σοφος", True),
                         ("eng", False), ("bank ag", False), ("ingÉnieur", True), ("x", True), ("ban[kg]", True), ("nowhere", True)]:
        want = {r.id for r in df.where(facets.text_search(query, "title", "company", regex=regex)).collect()}
        assert {r.id for r in textindex.indexed_search(df, "id", ["title", "company"], path, query, regex).collect()} == want, query
    # Only rows with all pieces are read for the pattern.
    needed = textindex.needed_grams(spark, "ingénieur", True)
    read = textindex.candidates(spark, path, needed)
    assert len(needed) == 7 and read.count() == sum("Ingénieur" in r[1] for r in rows) < 300


def test_stream_equals_batch_and_restarts(spark, tmp_path):
    schema = "id long, ts timestamp, v string"
    rows = [(i, datetime.datetime(2026, 1, 1 + i % 9, i % 24), f"v{i}") for i in range(90)]
    parts = [rows[:40], rows[30:70], rows[:10] + rows[60:]]
    args = (str(tmp_path / "in"), schema, str(tmp_path / "out"), str(tmp_path / "state"), ["id"], "ts", "30 days", 1)
    for n, part in enumerate(parts):
        spark.createDataFrame([*part, (None, datetime.datetime(2026, 1, 1), "no key")], schema).coalesce(1).write.mode("append").parquet(args[0])
        if n != 1:
            stream.ingest(spark, *args)
    stream.ingest(spark, *args)
    found = spark.read.parquet(args[2]).collect()
    assert sorted((r.id, r.v) for r in found) == [(i, f"v{i}") for i in range(90)]
    assert {r.day for r in found} == {datetime.date(2026, 1, d) for d in range(1, 10)}


def test_an_index_cuts_each_text_once(spark, tmp_path):
    cut = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        cut.add(1)
        return text

    df = spark.range(200).select("id", seen.asNondeterministic()(F.concat(F.lit("a text "), F.col("id"))).alias("text"))
    textindex.build_index(df, "id", ["text"], str(tmp_path / "index"))
    assert cut.value == 200
    assert textindex.candidates(spark, str(tmp_path / "index"), ["t 1"]).count() == 111
