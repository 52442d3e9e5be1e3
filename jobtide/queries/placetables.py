"""Locations resolved against place tables made from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.operators import places, summary
from jobtide.queries.common import Query, table


def _places(spark, sf) -> DataFrame:
    """Codes, names and cities from nations and regions, companies from customers, markers from segments."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    customer, supplier = table(spark, sf, "customer"), table(spark, sf, "supplier")
    code = F.concat(F.lit("C"), F.col("n_nationkey"))
    none = F.lit(None).cast("string")

    def rows(df: DataFrame, kind: str, key, rank, canton, city=none) -> DataFrame:
        return df.select(
            F.lit(kind).alias("kind"), key.alias("key"), rank.cast("int").alias("rank"), canton.alias("canton"), city.alias("city")
        )

    home = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    parts = [
        rows(nation, "code", code, F.col("n_nationkey"), F.concat(F.lit("K"), F.col("n_nationkey"))),
        rows(nation, "city", F.col("n_name"), F.col("n_nationkey"), F.concat(F.lit("K"), F.col("n_nationkey"))),
        rows(region, "name", F.lower("r_name"), F.col("r_regionkey"), F.concat(F.lit("R"), F.col("r_regionkey"))),
        rows(home, "company", F.col("c_name"), F.col("c_custkey"), F.concat(F.lit("K"), F.col("c_nationkey")), F.col("n_name")),
        rows(supplier, "marker", F.col("s_name"), F.col("s_suppkey"), none),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _located(spark, sf) -> DataFrame:
    """Order lines with a location text in one of nine forms, of columns of the tables they belong to."""
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    customer, supplier = table(spark, sf, "customer"), table(spark, sf, "supplier")
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    whole = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    forms = [
        F.concat(F.lit("Tower "), F.col("l_linenumber"), F.lit(" CH-C"), F.col("n_nationkey")),
        F.col("c_name"),
        F.concat(F.lit("North of "), F.col("r_name"), F.lit(", "), F.col("n_name")),
        F.concat(F.lit(" "), F.col("n_name"), F.lit(", floor "), F.col("l_linenumber")),
        F.col("n_name"),
        F.concat(F.col("n_name"), F.lit(", "), F.col("s_name")),
        F.concat(F.lit("Lane "), F.col("l_linenumber"), F.lit(" (off), "), F.col("n_name")),
        F.concat(F.col("c_name"), F.lit(" & Co")),
        F.lit(None).cast("string"),
    ]
    form = F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(len(forms)))
    text = F.coalesce(*[F.when(form == i, f) for i, f in enumerate(forms)])
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return whole.select(*keys, text.alias("location_raw"))


def place_tables(spark, sf):
    spread = ["l_orderkey", "l_linenumber", "l_partkey"]
    return places.resolve_places(_located(spark, sf), "location_raw", _places(spark, sf), spread)


def unresolved_locations(spark, sf):
    """The most frequent locations without a canton."""
    return summary.unresolved_values(place_tables(spark, sf), "location_raw", "canton", 20)


_RESOLVED = """
located AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_orderkey + l_linenumber) % 9 AS form,
         c_name, c_nationkey, s_name, n_name, n_nationkey, r_name, r_regionkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey),
resolved AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE form WHEN 0 THEN 'Tower ' || l_linenumber || ' CH-C' || n_nationkey WHEN 1 THEN c_name
      WHEN 2 THEN 'North of ' || r_name || ', ' || n_name
      WHEN 3 THEN ' ' || n_name || ', floor ' || l_linenumber WHEN 4 THEN n_name
      WHEN 5 THEN n_name || ', ' || s_name WHEN 6 THEN 'Lane ' || l_linenumber || ' (off), ' || n_name
      WHEN 7 THEN c_name || ' & Co' END AS location_raw,
    CASE form WHEN 0 THEN 'K' || n_nationkey WHEN 1 THEN 'K' || c_nationkey WHEN 2 THEN 'R' || r_regionkey
      WHEN 3 THEN 'K' || n_nationkey WHEN 4 THEN 'K' || n_nationkey END AS canton,
    CASE form WHEN 0 THEN 'Tower ' || l_linenumber || ' CH-C' || n_nationkey
      WHEN 1 THEN (SELECT n.n_name FROM nation n WHERE n.n_nationkey = c_nationkey)
      WHEN 2 THEN 'North of ' || r_name WHEN 3 THEN n_name WHEN 4 THEN n_name
      WHEN 6 THEN 'Lane ' || l_linenumber WHEN 7 THEN c_name || ' & Co' END AS city
  FROM located)"""

QUERIES: dict[str, Query] = {
    "place_tables": Query(
        place_tables,
        f"""WITH {_RESOLVED}
            SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, location_raw, canton, city FROM resolved""",
    ),
    "unresolved_locations": Query(
        unresolved_locations,
        f"""WITH {_RESOLVED} SELECT location_raw, count(*) AS count FROM resolved
            WHERE canton IS NULL AND location_raw IS NOT NULL
            GROUP BY location_raw ORDER BY count DESC, location_raw LIMIT 20""",
    ),
}
