"""Joins of texts to name and keyword tables against plain loops and the folded forms."""

import random

import pytest
from pyspark.sql import functions as F

from jobtide.functions.rules import RuleSet
from jobtide.operators import joins, textjoin

PIECES = ["c", "c++", "C#", ".net", "asp", "go", "go-lang", "data", "machine learning", "é", "x_1", "r", "++", "--", " - ", "𝒳𝒴"]


def texts_of(spark, rng, n, extra=(), pieces=PIECES):
    rows = [(i, "".join(rng.choice(pieces) + rng.choice([" ", "", "  ", ", ", "\n", "++"]) for _ in range(rng.randint(0, 12)))) for i in range(n)]
    rows += [(n + i, t) for i, t in enumerate([None, "", " ", *extra])]
    return rows, spark.createDataFrame(rows, "id long, text string").repartition(4)


def test_substring_join_matches_a_loop(spark):
    rng = random.Random(5)
    rows, texts = texts_of(spark, rng, 120, ["abc" * 2000 + "needle in it"])
    words = ["c", "c+", "machine", "learning", "e learn", "needle in", "é", "𝒴", "asp.net", "nowhere", "", None, "go", "go"]
    names = spark.createDataFrame([(w, k) for k, w in enumerate(words)], "name string, rank int")
    want = sorted((i, w, k) for i, t in rows for k, w in enumerate(words) if t and w and w in t)
    found = textjoin.substring_join(texts, "id", "text", names, "name")
    assert sorted(map(tuple, found.collect())) == want and len(want) > 100
    first = {r.id: r.rank for r in textjoin.first_name(found, "id", ["rank"]).collect()}
    assert first == {i: min(k for j, _, k in want if j == i) for i in {w[0] for w in want}}


def test_substring_join_of_empty_tables(spark):
    names = spark.createDataFrame([(None, 1), ("", 2)], "name string, rank int")
    texts = spark.createDataFrame([(1, "a text")], "id long, text string")
    found = textjoin.substring_join(texts, "id", "text", names, "name")
    assert found.collect() == [] and found.columns == ["id", "name", "rank"]
    names = spark.createDataFrame([("a", 1)], "name string, rank int")
    assert textjoin.substring_join(texts.where("false"), "id", "text", names, "name").collect() == []


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_keyword_hits_equal_the_folded_rules(spark, seed):
    rng = random.Random(seed)
    words = ["c", "c++", "c#", ".net", "net", "machine learning", "go-lang", "lang", "go ", "++", "--", "é", "x_1", "r", "data", "learning data", " - ", ", "]
    rng.shuffle(words)
    rules = [(f"rule {k}", words[k::5]) for k in range(5)]
    rows, texts = texts_of(spark, rng, 150, ["c++x", "asp.net", "go lang", "c", "x.net", "a++b", "a--", "machine learning"], PIECES[:-1])
    table = spark.createDataFrame(
        [(i, name, j, w) for i, (name, ws) in enumerate(rules, 1) for j, w in enumerate(ws, 1)],
        "rule_order int, category string, keyword_order int, keyword string",
    )
    found = textjoin.keyword_hits(texts, "id", "text", table)
    plain = texts.select("id", F.explode(RuleSet.of(rules).trace(F.lower("text"))).alias("h")).select("id", "h.*")
    ours = sorted(map(tuple, found.collect()))
    assert ours == sorted(map(tuple, plain.collect())) and len(ours) > 200
    first = {r.id: r.category for r in textjoin.first_rule(found, "id").collect()}
    folded = texts.select("id", RuleSet.of(rules).first_category(F.lower("text")).alias("c")).where("c is not null")
    assert first == {r.id: r.c for r in folded.collect()}


def largest_share(df):
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


@pytest.fixture
def shuffled_joins(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "50",
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_deals_hot_and_null_keys(spark, shuffled_joins, how):
    left = spark.range(20_000).select(
        "id", F.when(F.col("id") % 10 < 4, "hot").when(F.col("id") % 10 < 7, F.concat(F.lit("k"), F.col("id") % 50)).alias("k")
    )
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k0", 3), ("k3", 4), (None, 5)], "k string, v int")
    found = joins.spread_join(left, right, ["k"], ["id"], how)
    plain = left.join(right, "k", how)
    assert sorted(found.groupBy("k", "v").count().collect(), key=str) == sorted(plain.groupBy("k", "v").count().collect(), key=str)
    assert largest_share(found) < 0.1 < 0.4 < largest_share(plain)
    assert joins.hot_keys(left, ["k"], 20).count() <= 20


def test_substring_join_splits_a_hot_gram(spark, shuffled_joins):
    texts = spark.range(4_000).select("id", F.concat(F.lit("same words "), F.col("id").cast("string")).alias("text"))
    names = spark.createDataFrame([("same words", 1), ("words 39", 2)], "name string, rank int")
    found = textjoin.substring_join(texts, "id", "text", names, "name")
    assert found.where("rank = 1").count() == 4_000 and found.where("rank = 2").count() == 111
    assert largest_share(found) < 0.1


def test_keyword_rows_made_by_an_explode_are_not_broadcast(spark):
    rules = spark.range(3).select(
        F.col("id").cast("int").alias("rule_order"), F.lit("c").alias("category"), F.explode(F.sequence(F.lit(0), F.lit(999))).alias("keyword_order")
    )
    rules = rules.withColumn("keyword", F.concat_ws(" ", F.lit("bolt"), F.col("keyword_order").cast("string")))
    texts = spark.range(50).select("id", F.concat(F.lit("a bolt "), F.col("id").cast("string")).alias("text"))
    found = textjoin.keyword_hits(texts, "id", "text", rules)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin [core" in plan
    assert found.count() == 150


def test_substring_join_cuts_the_texts_once_after_counting(spark):
    texts = spark.range(200).select("id", F.concat(F.lit("some words "), F.col("id").cast("string")).alias("text"))
    names = spark.createDataFrame([("words 1", 1), ("none", 2), (None, 3), ("words 1", 4)], "name string, rank int")
    found = textjoin.substring_join(texts, "id", "text", names, "name")
    assert found._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
    assert sorted(r["rank"] for r in found.collect()) == [1] * 111 + [4] * 111
