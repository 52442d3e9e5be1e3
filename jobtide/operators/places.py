"""Location texts resolved against tables of places of any size.

``functions.geo`` folds short lists into an expression; here the lists are rows, and no part of them is
collected or broadcast by hint.  Every distinct location is looked up once: what it may be called goes out
as (priority, kind, key) rows, one equi-join finds the places, names and markers inside the text are found
by ``textjoin.substring_join``, and of all that is found the first by priority counts.  A marker (of a
company or a vague region) is a find without a place, so it ends the search before cities are tried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.functions.text import WORD, WORD_EDGE, nonempty, strip
from jobtide.operators.joins import spread_join
from jobtide.operators.textjoin import substring_join
from jobtide.session import stored

#: A place table: what a key is (code, company, name, marker or city), its place in its list, and what it says.
SCHEMA = "kind string, key string, rank int, canton string, city string"

_PRIORITY = {"code": 1, "company": 2, "name": 3, "marker": 4, "first": 5, "whole": 6}


def resolve_places(df: DataFrame, location: str, places: DataFrame, spread: list[str], code_prefix: str = "CH") -> DataFrame:
    """The rows with columns ``canton`` and ``city``, as ``geo.canton`` and ``geo.city`` tell them.

    Tried in order: an explicit code (``CH-ZG``), a known company, a name inside the text (the first by
    rank); then, unless a marker is inside, the first comma part and the whole text as a city.  Names are
    given in lower case.  Null and empty texts have no place.  Rows of a frequent location are dealt by
    a hash of their ``spread`` columns.
    """
    trimmed = strip(location)
    found = df.withColumn("_loc", nonempty(trimmed))
    # The rows are read twice: here, to count the locations, and to be joined to what was found for them.
    counts = stored(found.groupBy("_loc").agg(F.count("*").alias("_n")).where(F.col("_loc").isNotNull()))
    texts = counts.select("_loc")
    first = strip(F.get(F.split("_loc", ","), F.lit(0)))
    code = F.regexp_extract("_loc", rf"{WORD_EDGE}{code_prefix}-([{WORD}]+)", 1)

    def item(priority: str, kind: str, key: Column) -> Column:
        return F.struct(F.lit(_PRIORITY[priority]).alias("priority"), F.lit(kind).alias("kind"), key.alias("key"))

    asked = F.array(
        item("code", "code", code), item("company", "company", F.col("_loc")), item("first", "city", first),
        item("whole", "city", F.col("_loc")),
    )
    asked = texts.select("_loc", F.explode(asked).alias("_q")).select("_loc", "_q.*").where(F.length("key") > 0)
    exact = places.where(F.col("kind").isin("code", "company", "city"))
    hits = spread_join(asked, exact, ["kind", "key"], ["_loc"]).select("_loc", "priority", "rank", "canton", "city")
    inner = texts.withColumn("_lower", F.lower("_loc"))
    named = substring_join(inner, "_loc", "_lower", places.where(F.col("kind") == "name"), "key")
    marked = substring_join(texts.withColumn("_text", F.col("_loc")), "_loc", "_text", places.where(F.col("kind") == "marker"), "key")
    inside = [
        part.select("_loc", F.lit(_PRIORITY[kind]).alias("priority"), "rank", canton.alias("canton"), F.lit(None).cast("string").alias("city"))
        for kind, part, canton in (("name", named, F.col("canton")), ("marker", marked, F.lit(None).cast("string")))
    ]
    hits = hits.unionByName(inside[0]).unionByName(inside[1])
    order = F.struct("priority", "rank")
    # A find without a canton says nothing, unless it is a marker.
    telling = F.col("canton").isNotNull() | (F.col("priority") == _PRIORITY["marker"])
    by_company = (F.col("priority") == _PRIORITY["company"]) & F.col("city").isNotNull()
    said = hits.groupBy("_loc").agg(
        F.min_by(F.when(telling, F.col("canton")), F.when(telling, order)).alias("canton"),
        F.min_by("city", F.when(by_company, order)).alias("_city"),
        F.max(F.when(F.col("priority") == _PRIORITY["marker"], 1)).alias("_stop"),
    )
    bare = nonempty(strip(F.regexp_replace(F.get(F.split("_loc", ","), F.lit(0)), r"\([^\n]*?\)", "")))
    told = texts.join(said, "_loc", "left").select(
        "_loc", "canton", F.coalesce("_city", F.when(F.col("_stop").isNull(), bare)).alias("city")
    )
    return spread_join(found, told, ["_loc"], spread, "left", counts=counts).drop("_loc")


def place_table(spark, gazetteer) -> DataFrame:
    """The lists of a ``geo.Gazetteer`` as a place table."""
    rows = [("code", c, i, c, None) for i, c in enumerate(gazetteer.codes)]
    rows += [("name", n, i, c, None) for i, (n, c) in enumerate(gazetteer.names.items())]
    rows += [("city", n, i, c, None) for i, (n, c) in enumerate(gazetteer.cities.items())]
    companies = dict.fromkeys([*gazetteer.company_canton, *gazetteer.company_city])
    rows += [
        ("company", n, i, gazetteer.company_canton.get(n), gazetteer.company_city.get(n)) for i, n in enumerate(companies)
    ]
    rows += [("marker", m, i, None, None) for i, m in enumerate([*gazetteer.company_markers, *gazetteer.region_markers])]
    return spark.createDataFrame(rows, SCHEMA)
