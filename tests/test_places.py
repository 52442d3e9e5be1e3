"""Places from tables against the folded expressions."""

import random

from pyspark.sql import functions as F

from jobtide import fixed_values as fixed
from jobtide.functions import geo
from jobtide.operators import places


def test_tables_tell_what_the_lists_tell(spark):
    rng = random.Random(8)
    gaz = geo.Gazetteer()
    words = [
        *fixed.CITY_CANTON, *fixed.CANTON_NAMES, *fixed.COMPANY_CANTON, *fixed.COMPANY_CITY, *fixed.REGION_MARKERS, *fixed.COMPANY_MARKERS[:6],
    ]
    texts = [*fixed.CITY_CANTON, *fixed.COMPANY_CANTON, *fixed.COMPANY_CITY]
    texts += [f"CH-{c}" for c in fixed.CANTON_CODES] + ["xCH-ZH", "CH-ZHx", "CH-XX, Bern", "to CH-GE now"]
    texts += [rng.choice(["", "  ", "Office "]) + rng.choice(words) + rng.choice(["", ", ", " (", " "]) + rng.choice([*words, "x", ")"]) for _ in range(600)]
    texts += [None, "", "  ", ",", "(Bern)", "Nowhere, Bern", " Bern\t", "ZÜRICH", "Bern, Holding"] + ["Bern"] * 50
    df = spark.createDataFrame(list(enumerate(texts)), "i int, place string").repartition(4)
    found = places.resolve_places(df, "place", places.place_table(spark, gaz), ["i"])
    want = df.select("i", "place", geo.canton("place").alias("canton"), geo.city("place").alias("city"))
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))
    assert found.where("canton is not null").count() > 500 and found.count() == len(texts)


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "Bern")], "i int, place string")
    none = spark.createDataFrame([], places.SCHEMA)
    assert [tuple(r) for r in places.resolve_places(df, "place", none, ["i"]).collect()] == [(1, "Bern", None, "Bern")]
    full = places.place_table(spark, geo.Gazetteer())
    assert places.resolve_places(df.where(F.lit(False)), "place", full, ["i"]).collect() == []


def test_rows_are_read_twice_only(spark):
    rows = spark.range(40).select("id", F.concat(F.lit("North "), F.col("id") % 4).alias("at"))
    table = spark.createDataFrame([("name", "north 1", 0, "N1", None), ("marker", "North 2", 1, None, None)], places.SCHEMA)
    out = places.resolve_places(rows, "at", table, ["id"])
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Range (0, 40") == 1
    assert sorted((r.at, r.canton, r.city) for r in out.distinct().select("at", "canton", "city").distinct().collect()) == [
        ("North 0", None, "North 0"), ("North 1", "N1", "North 1"), ("North 2", None, None), ("North 3", None, "North 3")
    ]
