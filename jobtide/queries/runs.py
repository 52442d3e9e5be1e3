"""Runs added to a stored history, streams, indexes and sketches that are kept."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from jobtide.operators import dates, sketches, textindex
from jobtide.queries.common import Query, spread_table, table
from jobtide.session import scratch_dir
from jobtide.sources.history import History
from jobtide.streaming import runs as stream

#: Three runs of events; the second is written twice.
RUNS = ("2024-02-01T00:00:00", "2024-02-02T00:00:00", "2024-02-03T00:00:00")


def incremental_runs(spark, sf):
    """The first event of each user and type, with the run that brought it."""
    folder = scratch_dir(spark)
    keys = ("user_id", "event_type")
    history = History(
        f"{folder}/rows", f"jobtide_keys_{uuid.uuid4().hex}", f"{folder}/keys", keys, ("ts", "event_id"), buckets=16
    )
    third = F.floor(F.minute("ts") / 20).cast("int")
    events = table(spark, sf, "events").withColumn("run", third)
    for number, repeats in ((0, 1), (1, 2), (2, 1)):
        for _ in range(repeats):
            history.add(events.where(F.col("run") == number).drop("run"), RUNS[number])
    return history.rows(spark).select("scraped_at", *keys, "event_id", "value")


def stream_runs(spark, sf):
    """Events that land in three files, the second of them twice, taken over in two calls."""
    folder = scratch_dir(spark)
    third = F.floor(F.minute("ts") / 20).cast("int")
    # A watermark needs a point in time.
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    keys = ("event_id",)
    for numbers in ((0, 1), (1, 2)):
        for number in numbers:
            events.where(third == number).write.mode("append").parquet(f"{folder}/landing")
        stream.ingest(
            spark, f"{folder}/landing", events.schema, f"{folder}/events", f"{folder}/checkpoint", keys, "ts", "3650 days"
        )
    return spark.read.parquet(f"{folder}/events").select("event_id", "user_id", "event_type", "value", "day")


def indexed_search(spark, sf):
    """Documents with a pattern in their text, by an index of its pieces."""
    docs, path = spread_table(spark, sf, "documents", "doc_id", "text", "source"), scratch_dir(spark)
    textindex.build_index(docs, "doc_id", ["text", "source"], path)
    found = textindex.indexed_search(docs, "doc_id", ["text", "source"], path, "licensed under [a-z]+ apache")
    literal = textindex.indexed_search(docs, "doc_id", ["text", "source"], path, "PATHETIC", regex=False)
    return found.select("doc_id", F.lit("pattern").alias("by")).unionByName(literal.select("doc_id", F.lit("literal").alias("by")))


def distinct_sketch(spark, sf):
    """Users of each event type, exact, and whether the sketches per day, united, come near."""
    events = table(spark, sf, "events")
    daily = sketches.distinct_sketches(events.withColumn("day", F.to_date("ts")), ["day", "event_type"], "user_id")
    estimates = sketches.distinct_estimates(daily, ["event_type"], "estimate")
    exact = events.groupBy("event_type").agg(F.countDistinct("user_id").alias("users"))
    # Four standard errors, and at least one user.
    reach = F.greatest(F.lit(1.0), 4 * sketches.relative_error() * F.col("users"))
    near = F.abs(F.col("estimate") - F.col("users")) <= reach
    return exact.join(estimates, "event_type").select("event_type", "users", near.alias("near"))


def date_infer(spark, sf):
    """Order dates written in the format of their priority; one priority cannot be told."""
    orders = table(spark, sf, "orders")
    date, turned = F.col("o_orderdate"), F.dayofmonth("o_orderdate") % 12 + 1
    written = (
        F.when(F.col("o_orderkey") % 50 == 0, F.lit("on request"))
        .when(F.col("o_orderpriority") == "1-URGENT", F.date_format(date, "dd/MM/yyyy"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.date_format(date, "MM/dd/yyyy"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format(date, "d MMMM yyyy"))
        .when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lpad(turned.cast("string"), 2, "0"), F.date_format(date, "/MM/yyyy")))
        .otherwise(F.date_format(date, "yyyy-MM-dd"))
    )
    rows = orders.select("o_orderkey", "o_orderpriority", written.alias("written"))
    return dates.infer_dates(rows, "written", "o_orderpriority")


QUERIES: dict[str, Query] = {
    "incremental_runs": Query(
        incremental_runs,
        f"""
WITH runs AS (
  SELECT *, CASE minute(ts) // 20 WHEN 0 THEN '{RUNS[0]}' WHEN 1 THEN '{RUNS[1]}' ELSE '{RUNS[2]}' END AS scraped_at
  FROM events WHERE user_id IS NOT NULL AND event_type IS NOT NULL)
SELECT scraped_at, user_id, event_type, event_id, value FROM runs
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY scraped_at, ts, event_id) = 1""",
    ),
    "stream_runs": Query(
        stream_runs, "SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS day FROM events WHERE ts IS NOT NULL"
    ),
    "indexed_search": Query(
        indexed_search,
        """SELECT doc_id, 'pattern' AS by FROM documents
             WHERE regexp_matches(text, '(?i)licensed under [a-z]+ apache') OR regexp_matches(source, '(?i)licensed under [a-z]+ apache')
           UNION ALL SELECT doc_id, 'literal' FROM documents
             WHERE contains(lower(text), 'pathetic') OR contains(lower(source), 'pathetic')""",
    ),
    "distinct_sketch": Query(
        distinct_sketch,
        "SELECT event_type, count(DISTINCT user_id) AS users, TRUE AS near FROM events GROUP BY event_type",
    ),
    "date_infer": Query(
        date_infer,
        """SELECT o_orderkey, o_orderpriority,
             CASE WHEN o_orderkey % 50 = 0 THEN 'on request'
               WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%d/%m/%Y')
               WHEN o_orderpriority = '2-HIGH' THEN strftime(o_orderdate, '%m/%d/%Y')
               WHEN o_orderpriority = '3-MEDIUM' THEN strftime(o_orderdate, '%-d %B %Y')
               WHEN o_orderpriority = '5-LOW' THEN lpad(CAST(day(o_orderdate) % 12 + 1 AS VARCHAR), 2, '0') || strftime(o_orderdate, '/%m/%Y')
               ELSE strftime(o_orderdate, '%Y-%m-%d') END AS written,
             CASE WHEN o_orderkey % 50 > 0 AND o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS parsed
           FROM orders""",
    ),
}
