"""Runs added to a stored history against a plain set of keys."""

import uuid

import pytest

from jobtide.sources.history import History, add_runs

ROWS = "k string, n int, v string"
RUNS = [
    ("2024-01-01T00:00:00", [("a", 1, "x"), ("a", 0, "w"), ("b", 2, "y"), (None, 3, "n")]),
    ("2024-01-02T00:00:00", [("b", 0, "late"), ("c", 1, "z"), ("c", 1, "z")]),
    ("2024-01-03T00:00:00", [("a", 9, "again"), ("d", 1, "q")]),
]


@pytest.fixture
def history(tmp_path):
    return History(str(tmp_path / "rows"), f"keys_{uuid.uuid4().hex}", str(tmp_path / "keys"), ("k",), ("n", "v"), buckets=4)


def stored(history, spark):
    return sorted((r.scraped_at[:10], r.k, r.n, r.v) for r in history.rows(spark).collect())


WANT = [("2024-01-01", "a", 0, "w"), ("2024-01-01", "b", 2, "y"), ("2024-01-02", "c", 1, "z"), ("2024-01-03", "d", 1, "q")]


def test_repeated_runs_leave_the_same_tables(spark, history):
    frames = [(ts, spark.createDataFrame(rows, ROWS)) for ts, rows in RUNS]
    add_runs(history, frames)
    assert stored(history, spark) == WANT
    for ts, df in (frames[1], frames[0], frames[2], frames[2]):
        history.add(df, ts)
        assert stored(history, spark) == WANT
    keys = [tuple(r) for r in spark.table(history.key_table).collect()]
    assert sorted(k[0] for k in keys) == ["a", "b", "c", "d"]


def test_history_is_not_shuffled(spark, history):
    frames = [(ts, spark.createDataFrame(rows, ROWS)) for ts, rows in RUNS]
    add_runs(history, frames[:2])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = history.new_rows(frames[2][1], frames[2][0])
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan or "SelectedBucketsCount" in plan
        side = plan[plan.index("FileScan"):]
        head = plan[: plan.index("FileScan")]
        # Only the batch, which is read from memory, stands below an exchange.
        assert "Exchange" not in side.split("LocalTableScan")[0] and head.count("Exchange") <= 3
        assert sorted(r.k for r in new.collect()) == ["d"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_runs_without_rows_and_without_keys(spark, history):
    history.add(spark.createDataFrame([], ROWS), "2024-01-01T00:00:00")
    history.add(spark.createDataFrame([("a", 1, "x")], ROWS), "2024-01-02T00:00:00")
    history.add(spark.createDataFrame([(None, 1, "x")], ROWS), "2024-01-03T00:00:00")
    assert stored(history, spark) == [("2024-01-02", "a", 1, "x")]
