"""Contracts, row selection, periods, cubes and plain counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobtide.functions import periods
from jobtide.functions import text as tx
from jobtide.operators import conform, coverage, facets, rows, running, summary
from jobtide.queries.common import BASE_URL, Query, table
from jobtide.session import scratch_dir
from jobtide.sources import files, jsonstat

RUN = "2026-03-01T17:21:57"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
STATUSES = ("F", "O", "P")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def conform_schema(spark, sf):
    docs = table(spark, sf, "documents").select(
        "source",
        F.concat(F.lit(f"{BASE_URL}/"), F.col("doc_id").cast("string")).alias("url"),
        tx.surrogate_key("source", "doc_id").alias("job_id"),
        F.col("lang").alias("term"),
        F.col("text").alias("description_raw"),
        F.when(F.col("doc_id") % 2 == 0, F.col("n_chars").cast("string")).alias("salary_raw"),
    )
    raw = conform.to_raw_contract(docs.withColumnsRenamed({"term": "search_term"}), RUN)
    return raw.withColumn("run_ts", tx.safe_timestamp("scraped_at"))


def fallback_id(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang")
    return conform.with_fallback_id(docs, "job_id", ["b_id"], ["source", "lang", "doc_id"])


def numeric_coerce(spark, sf):
    number = F.get_json_object("props", "$.k")
    kind = F.col("event_id") % 4
    raw = F.when(kind == 0, number).when(kind == 1, "n/a").when(kind == 2, F.lit(" 12.5 "))
    return table(spark, sf, "events").select(
        "event_id",
        tx.to_number(raw).alias("value"),
        tx.to_number(raw, "int", 0).alias("whole"),
    )


def csv_roundtrip(spark, sf):
    folder = f"{scratch_dir(spark)}/documents_csv"
    files.write_csv(table(spark, sf, "documents"), folder)
    return files.read_csv(spark, folder, DOC_SCHEMA)


def dedup_first(spark, sf):
    docs = table(spark, sf, "documents")
    keyed = docs.select(
        F.sha1(F.col("text").cast("binary")).alias("key"), "doc_id", "lang", "source", "n_chars"
    )
    return rows.keep_first(keyed, ["key"], ["doc_id"])


def duplicate_rows(spark, sf):
    return rows.duplicate_rows(table(spark, sf, "documents"), ["text", "lang"])


def union_tagged(spark, sf):
    customer = table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("amount"), "c_mktsegment"
    )
    supplier = table(spark, sf, "supplier").select(
        F.col("s_acctbal").alias("amount"), F.col("s_name").alias("name")
    )
    part = table(spark, sf, "part").select(
        F.col("p_name").alias("name"), F.col("p_retailprice").alias("amount")
    )
    return files.union_tagged({"customer": customer, "supplier": supplier, "part": part})


def limit_in_order(spark, sf):
    return rows.limit_in_order(
        table(spark, sf, "events").select("event_id", "user_id", "event_type"), ["event_id"], 1000
    )


def coverage_log(spark, sf):
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    return coverage.coverage_log(events, "event_type", "day", "user_id", "event_id")


def coverage_log_users(spark, sf):
    """Each user as a search term: values first met on each of the user's days."""
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    return coverage.coverage_log(events, "user_id", "day", "value", "event_id")


def running_revenue(spark, sf):
    """Quantity of all order lines up to each, by date and line."""
    lines = table(spark, sf, "lineitem").groupBy("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").agg(
        F.sum(F.col("l_quantity").cast("long")).alias("quantity")
    )
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return running.running_total(lines, order, "quantity")


def hash_sample(spark, sf):
    return rows.hash_sample(table(spark, sf, "customer").select("c_custkey", "c_name"), "c_custkey", 10)


def ordinal_order(spark, sf):
    counts = summary.value_counts(table(spark, sf, "orders"), "o_orderpriority", name="orders")
    wanted = ("5-LOW", "3-MEDIUM", "1-URGENT")
    place = tx.ordinal("o_orderpriority", wanted)
    return counts.withColumn("place", place).orderBy("place", "o_orderpriority")


_LABELS = ",".join(f'"{s.lower()}":"{s}"' for s in STATUSES)
_PRIOS = ",".join(f'"p{i}":"{p}"' for i, p in enumerate(PRIORITIES))
_DIMENSIONS = (
    '{"metric":{"category":{"label":{"1":"Orders"}}},'
    f'"status":{{"category":{{"label":{{{_LABELS}}}}}}},'
    f'"priority":{{"category":{{"label":{{{_PRIOS}}}}}}}}}'
)


def _cubes(spark, sf):
    """One JSON-stat cube per customer: orders by status and priority, dense."""
    orders = table(spark, sf, "orders")
    cells = [
        F.count_if((F.col("o_orderstatus") == s) & (F.col("o_orderpriority") == p)).cast("string")
        for s in STATUSES
        for p in PRIORITIES
    ]
    counts = orders.groupBy("o_custkey").agg(F.array(*cells).alias("v"))
    cube = F.concat(
        F.lit('{"version":"2.0","id":["metric","status","priority"],"size":[1,3,5],"dimension":'),
        F.lit(_DIMENSIONS),
        F.lit(',"value":['),
        F.array_join("v", ","),
        F.lit("]}"),
    )
    return counts.select("o_custkey", cube.alias("cube"))


def jsonstat_decode(spark, sf):
    return jsonstat.decode_cubes(
        _cubes(spark, sf), "cube", ["status", "priority"], "orders", ["o_custkey"]
    )


def label_grid(spark, sf):
    seen = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.array_sort(F.collect_set("o_orderstatus")).alias("status"),
        F.array_sort(F.collect_set("o_orderpriority")).alias("priority"),
    )
    return jsonstat.label_grid(seen, ["status", "priority"], ["o_custkey"])


def date_parse(spark, sf):
    day, kind = F.col("o_orderdate"), F.col("o_orderkey") % 4
    raw = (
        F.when(kind == 0, F.date_format(day, "d MMMM yyyy"))
        .when(kind == 1, F.date_format(day, "yyyy-MM-dd"))
        .when(kind == 2, F.concat(F.lit(" "), F.date_format(day, "dd.MM.yyyy"), F.lit(" ")))
        .otherwise("last week")
    )
    parsed = periods.parse_date(raw).cast("date")
    return table(spark, sf, "orders").select("o_orderkey", parsed.alias("posted"))


def _quartered(spark, sf):
    return table(spark, sf, "orders").withColumn("quarter", periods.quarter_label("o_orderdate"))


def quarter_label(spark, sf):
    return _quartered(spark, sf).select(
        "o_orderkey", "quarter", periods.quarter_start("quarter").alias("quarter_start")
    )


def period_range(spark, sf):
    found = summary.period_range(_quartered(spark, sf), "quarter")
    return found.withColumn("first_day", periods.quarter_start("first_period"))


def latest_k_periods(spark, sf):
    latest = rows.latest_periods(_quartered(spark, sf), "quarter", 8)
    counts = latest.groupBy("quarter", "o_orderstatus").agg(
        F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )
    return counts.orderBy("quarter", F.desc("o_orderstatus"))


def period_proxy(spark, sf):
    proxy = periods.period_proxy("quarter", {"1995Q1": "1995Q2"}, latest="2000Q4")
    out = _quartered(spark, sf).select(proxy.alias("merge_quarter"))
    return summary.value_counts(out, "merge_quarter")


def value_counts(spark, sf):
    orders = table(spark, sf, "orders").withColumn(
        "status", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    )
    return summary.value_counts(orders, "status", include_null=True)


def distinct_sorted(spark, sf):
    return summary.distinct_sorted(table(spark, sf, "part"), "p_brand")


def distinct_combos(spark, sf):
    cols = ["p_brand", "p_type", "p_size"]
    return summary.distinct_combos(table(spark, sf, "part"), cols, ["p_size", "p_brand", "p_type"])


def pivot_counts(spark, sf):
    orders = table(spark, sf, "orders")
    names = {p: p[2:].lower().replace(" ", "_") for p in PRIORITIES}
    return summary.pivot_counts(orders, "o_orderstatus", "o_orderpriority", names)


def semi_topk(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return rows.in_top_groups(orders, "o_custkey", 25, min_rows=2)


def top_companies(spark, sf):
    orders = table(spark, sf, "orders")
    people = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    joined = orders.join(people, F.col("o_custkey") == F.col("c_custkey")).withColumn(
        "company", F.when(F.col("c_nationkey") > 2, F.col("c_name")).otherwise("  ")
    )
    return summary.top_values(joined, "company", 10)


def code_to_region(spark, sf):
    codes = {f"NATION_{i}": f"Area {i % 4}" for i in range(20)}
    people = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return people.select("c_custkey", tx.map_value("n_name", codes).alias("area"))


def text_search(spark, sf):
    part = table(spark, sf, "part").withColumn(
        "brand", F.when(F.col("p_size") % 5 > 0, F.col("p_brand"))
    )
    return part.where(facets.text_search("RING$|brand#1[0-3]", "p_name", "brand")).select(
        "p_partkey", "p_name", "brand"
    )


_QUARTER = "(year(o_orderdate) || 'Q' || quarter(o_orderdate))"

QUERIES: dict[str, Query] = {
    "conform_schema": Query(
        conform_schema,
        f"""SELECT source, '{BASE_URL}/' || doc_id AS url,
              sha1(source || '|' || doc_id) AS job_id, lang AS search_term, '' AS title,
              '' AS company, '' AS location_raw, '' AS posted_date, '' AS employment_type,
              '' AS workload_raw,
              CASE WHEN doc_id % 2 = 0 THEN CAST(n_chars AS VARCHAR) ELSE '' END AS salary_raw,
              text AS description_raw, '{RUN}' AS scraped_at, '' AS canton, '' AS seniority,
              trim(regexp_replace(text, '[\\t-\\r\\x1c-\\x20\\x{{85}}\\x{{a0}}\\x{{2028}}]+', ' ', 'g'))
                AS description_clean,
              '' AS skills, CAST(0 AS INTEGER) AS skill_count,
              CAST(doc_id % 2 = 0 AS INTEGER) AS salary_available,
              replace('{RUN}', ':', '-') AS run_ts
            FROM documents""",
    ),
    "fallback_id": Query(
        fallback_id,
        """SELECT doc_id, source, lang, sha1(source || '|' || lang || '|' || doc_id) AS job_id
           FROM documents""",
    ),
    "numeric_coerce": Query(
        numeric_coerce,
        """SELECT event_id,
             CASE event_id % 4 WHEN 0 THEN CAST(json_extract_string(props, '$.k') AS DOUBLE)
                               WHEN 2 THEN 12.5 END AS value,
             CAST(CASE event_id % 4 WHEN 0 THEN json_extract_string(props, '$.k') ELSE '0' END
                  AS INTEGER) AS whole
           FROM events""",
    ),
    "csv_roundtrip": Query(
        csv_roundtrip, "SELECT doc_id, text, lang, source, n_chars FROM documents"
    ),
    "dedup_first": Query(
        dedup_first,
        """SELECT key, doc_id, lang, source, n_chars FROM (
             SELECT sha1(text) AS key, doc_id, lang, source, n_chars,
               row_number() OVER (PARTITION BY sha1(text) ORDER BY doc_id) AS rn
             FROM documents) WHERE rn = 1""",
    ),
    "duplicate_rows": Query(
        duplicate_rows,
        """SELECT CAST(sum(n) AS BIGINT) AS row_count, count(*) AS distinct_rows,
             CAST(sum(n - 1) AS BIGINT) AS duplicate_rows
           FROM (SELECT text, lang, count(*) AS n FROM documents GROUP BY text, lang)""",
    ),
    "union_tagged": Query(
        union_tagged,
        """SELECT c_name AS name, c_acctbal AS amount, c_mktsegment, 'customer' AS search_term
           FROM customer
           UNION ALL SELECT s_name, s_acctbal, NULL, 'supplier' FROM supplier
           UNION ALL SELECT p_name, p_retailprice, NULL, 'part' FROM part""",
    ),
    "limit_in_order": Query(
        limit_in_order,
        "SELECT event_id, user_id, event_type FROM events ORDER BY event_id LIMIT 1000",
    ),
    "coverage_log": Query(
        coverage_log,
        """WITH e AS (
             SELECT event_type, CAST(ts AS DATE) AS day, row_number() OVER (
               PARTITION BY user_id ORDER BY event_type, CAST(ts AS DATE), event_id) AS rn
             FROM events),
           p AS (SELECT event_type, day, count(*) AS cards, count(*) FILTER (rn = 1) AS new
                 FROM e GROUP BY event_type, day),
           g AS (SELECT *, sum(new) OVER (ORDER BY event_type, day) AS total,
                   count(*) FILTER (new > 0) OVER (PARTITION BY event_type ORDER BY day) AS island
                 FROM p)
           SELECT event_type, day, cards, new, CAST(total AS BIGINT) AS total,
             count(*) FILTER (new = 0) OVER (PARTITION BY event_type, island ORDER BY day)
               AS no_new_streak
           FROM g""",
    ),
    "coverage_log_users": Query(
        coverage_log_users,
        """WITH e AS (
             SELECT user_id, CAST(ts AS DATE) AS day, row_number() OVER (
               PARTITION BY value ORDER BY user_id, CAST(ts AS DATE), event_id) AS rn
             FROM events),
           p AS (SELECT user_id, day, count(*) AS cards, count(*) FILTER (rn = 1) AS new
                 FROM e GROUP BY user_id, day),
           g AS (SELECT *, sum(new) OVER (ORDER BY user_id, day) AS total,
                   count(*) FILTER (new > 0) OVER (PARTITION BY user_id ORDER BY day) AS island
                 FROM p)
           SELECT user_id, day, cards, new, CAST(total AS BIGINT) AS total,
             count(*) FILTER (new = 0) OVER (PARTITION BY user_id, island ORDER BY day)
               AS no_new_streak
           FROM g""",
    ),
    "running_revenue": Query(
        running_revenue,
        """WITH l AS (SELECT l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey,
                       CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem GROUP BY ALL)
           SELECT *, CAST(sum(quantity) OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey
                                              ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM l""",
    ),
    "hash_sample": Query(
        hash_sample,
        """SELECT c_custkey, c_name FROM customer
           ORDER BY sha1('42|' || c_custkey), c_custkey LIMIT 10""",
    ),
    "ordinal_order": Query(
        ordinal_order,
        """SELECT o_orderpriority, count(*) AS orders,
             CAST(CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '3-MEDIUM' THEN 2
                  WHEN '1-URGENT' THEN 3 ELSE 4 END AS INTEGER) AS place
           FROM orders GROUP BY o_orderpriority""",
    ),
    "jsonstat_decode": Query(
        jsonstat_decode,
        f"""WITH s AS (SELECT unnest({list(STATUSES)}) AS status),
              p AS (SELECT unnest({list(PRIORITIES)}) AS priority),
              c AS (SELECT DISTINCT o_custkey FROM orders)
            SELECT c.o_custkey, s.status, p.priority, CAST(count(o.o_orderkey) AS DOUBLE) AS orders
            FROM c CROSS JOIN s CROSS JOIN p
            LEFT JOIN orders o ON o.o_custkey = c.o_custkey AND o.o_orderstatus = s.status
              AND o.o_orderpriority = p.priority
            GROUP BY c.o_custkey, s.status, p.priority""",
    ),
    "label_grid": Query(
        label_grid,
        """SELECT a.o_custkey, a.status, b.priority
           FROM (SELECT DISTINCT o_custkey, o_orderstatus AS status FROM orders) a
           JOIN (SELECT DISTINCT o_custkey, o_orderpriority AS priority FROM orders) b
             ON a.o_custkey = b.o_custkey""",
    ),
    "date_parse": Query(
        date_parse,
        """SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN CAST(o_orderdate AS DATE) END
             AS posted FROM orders""",
    ),
    "quarter_label": Query(
        quarter_label,
        f"""SELECT o_orderkey, {_QUARTER} AS quarter,
              CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter_start FROM orders""",
    ),
    "period_range": Query(
        period_range,
        f"""SELECT min({_QUARTER}) AS first_period, max({_QUARTER}) AS last_period,
              count(DISTINCT {_QUARTER}) AS periods,
              CAST(date_trunc('quarter', min(o_orderdate)) AS DATE) AS first_day FROM orders""",
    ),
    "latest_k_periods": Query(
        latest_k_periods,
        f"""WITH q AS (SELECT *, {_QUARTER} AS quarter FROM orders),
              k AS (SELECT quarter FROM q GROUP BY quarter ORDER BY quarter DESC LIMIT 8)
            SELECT quarter, o_orderstatus, count(*) AS orders,
              round(sum(o_totalprice), 2) AS total
            FROM q WHERE quarter IN (SELECT quarter FROM k) GROUP BY quarter, o_orderstatus""",
    ),
    "period_proxy": Query(
        period_proxy,
        f"""SELECT merge_quarter, count(*) AS count FROM (
              SELECT CASE WHEN q > '2000Q4' THEN '2000Q4' WHEN q = '1995Q1' THEN '1995Q2'
                     ELSE q END AS merge_quarter
              FROM (SELECT {_QUARTER} AS q FROM orders)) GROUP BY merge_quarter""",
    ),
    "value_counts": Query(
        value_counts,
        """SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status,
             count(*) AS count FROM orders GROUP BY 1""",
    ),
    "distinct_sorted": Query(
        distinct_sorted, "SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL"
    ),
    "distinct_combos": Query(
        distinct_combos, "SELECT DISTINCT p_brand, p_type, p_size FROM part"
    ),
    "pivot_counts": Query(
        pivot_counts,
        """SELECT o_orderstatus, count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent,
             count(*) FILTER (o_orderpriority = '2-HIGH') AS high,
             count(*) FILTER (o_orderpriority = '3-MEDIUM') AS medium,
             count(*) FILTER (o_orderpriority = '4-NOT SPECIFIED') AS not_specified,
             count(*) FILTER (o_orderpriority = '5-LOW') AS low
           FROM orders GROUP BY o_orderstatus""",
    ),
    "semi_topk": Query(
        semi_topk,
        """SELECT o_custkey, o_orderkey FROM orders WHERE o_custkey IN (
             SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) >= 2
             ORDER BY count(*) DESC, o_custkey LIMIT 25)""",
    ),
    "top_companies": Query(
        top_companies,
        """SELECT c_name AS company, count(*) AS count
           FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey > 2
           GROUP BY c_name ORDER BY count DESC, company LIMIT 10""",
    ),
    "code_to_region": Query(
        code_to_region,
        """SELECT c_custkey, CASE WHEN n_nationkey < 20 THEN 'Area ' || (n_nationkey % 4) END
             AS area
           FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "text_search": Query(
        text_search,
        """SELECT p_partkey, p_name, CASE WHEN p_size % 5 > 0 THEN p_brand END AS brand FROM part
           WHERE regexp_matches(p_name, '(?i)ring$')
              OR (p_size % 5 > 0 AND regexp_matches(p_brand, '(?i)brand#1[0-3]'))""",
    ),
}
