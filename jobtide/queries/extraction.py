"""Extractor, place and classifier queries over texts derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobtide.functions import extract, geo, rules, tags
from jobtide.functions import text as tx
from jobtide.operators import rows, summary
from jobtide.queries.common import (
    SQL_EDGE,
    SQL_HITS,
    WORDS,
    Query,
    spread_table,
    sql_hits,
    table,
)
from jobtide import fixed_values as fixed


def pick(column: str, options) -> F.Column:
    """One of the options by row number, in a cycle."""
    place = F.pmod(F.col(column), F.lit(len(options))).cast("int")
    return F.get(F.array(*[F.lit(o).cast("string") for o in options]), place)


def sql_pick(column: str, options) -> str:
    whens = " ".join(
        f"WHEN {i} THEN " + ("NULL" if o is None else "'" + str(o).replace("'", "''") + "'")
        for i, o in enumerate(options)
    )
    return f"CASE {column} % {len(options)} {whens} END"


# --- salary ----------------------------------------------------------------------------------


def salary_extract(spark, sf):
    low = F.floor("l_extendedprice").cast("long")
    high = low + F.col("l_quantity").cast("long") * 1000

    def grouped(n, mark):
        return F.translate(F.format_number(n, 0), ",", mark)

    form = F.col("l_linenumber")
    text = (
        F.when(form == 1, F.concat(F.lit("Pay CHF "), grouped(low, "'"), F.lit(" to "), grouped(high, "'")))
        .when(form == 2, F.concat(F.lit("Lohn: chf "), grouped(low, "’"), F.lit(" – "), grouped(high, "′"), F.lit(" p.a.")))
        .when(form == 3, F.concat(F.lit("bonus, CHF "), grouped(low, "'"), F.lit(" per year")))
        .when(form == 4, F.concat((low / 12).cast("long").cast("string"), F.lit(" CHF per  month")))
        .when(form == 5, F.concat(F.lit("Salary CHF "), grouped(low, ",")))
        .when(form == 6, F.concat(F.lit("CHF, plus bonus "), low.cast("string")))
        .otherwise(F.concat(low.cast("string"), F.lit(" EUR")))
    )
    line = spread_table(
        spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_quantity"
    ).select("l_orderkey", "l_partkey", "l_linenumber", text.alias("text"))
    out = line.withColumn("s", extract.salary_range("text"))
    return out.select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.col("s.min").alias("salary_min"),
        F.col("s.max").alias("salary_max"),
        extract.disclosed("s").alias("salary_available"),
    )


# --- seniority -------------------------------------------------------------------------------

# title, description, level
SENIORITY_CASES = (
    ("Praktikant Data", "", "intern"),
    ("Postdoctoral Junior Fellow", "", "mid"),
    ("Jr. Analyst", "", "junior"),
    ("Senior Lead Engineer", "", "lead"),
    ("Sr. Engineer", "lead", "senior"),
    ("Mid-level developer", "", "mid"),
    ("Medior developer", "", "mid"),
    ("International sales", "", None),
    ("Head of data", "internship", "lead"),
    ("Developer", "An internship", "intern"),
    ("Developer", "postdoc position", "mid"),
    ("Developer", "your first-job", "junior"),
    ("Developer", "Verantwortlich für das Team", "lead"),
    ("Developer", "you will leading", None),
    (None, "entry level", "junior"),
    ("Misleading jrx", "3-5 years of experience", "mid"),
    ("Developer", "2 Jahre Erfahrung", "junior"),
    ("Developer", "at least 8+ years experience", "senior"),
    ("Developer", None, None),
)


def seniority_cascade(spark, sf):
    part = spread_table(spark, sf, "part", "p_partkey", "p_name").select(
        "p_partkey",
        pick("p_partkey", [c[0] for c in SENIORITY_CASES]).alias("title"),
        pick("p_partkey", [c[1] for c in SENIORITY_CASES]).alias("text"),
        "p_name",
    )
    title = F.concat_ws(" ", "title", "p_name")
    return part.select("p_partkey", extract.seniority(title, "text").alias("seniority"))


def experience_level(spark, sf):
    n = F.col("p_size").cast("string")
    more = (F.col("p_size") + 2).cast("string")
    form = F.col("p_partkey") % 7
    text = (
        F.when(form == 0, F.concat(n, F.lit("-"), more, F.lit(" years of experience")))
        .when(form == 1, F.concat(n, F.lit(" – "), more, F.lit(" years of experience")))
        .when(form == 2, F.concat(F.lit("mind. "), n, F.lit("+ Jahre Erfahrung")))
        .when(form == 3, F.concat(n, F.lit(" ans d'expérience")))
        .when(form == 4, F.concat(n, F.lit(" À "), more, F.lit(" ANS EXPÉRIENCE")))
        .when(form == 5, F.concat(more, F.lit(" anni  esperienza, "), n, F.lit(" to "), more, F.lit("years experience")))
    )
    years = extract.experience_years("text")
    part = table(spark, sf, "part").select("p_partkey", text.alias("text"))
    return part.select(
        "p_partkey", years.alias("years"), extract.seniority_of_years(years).alias("level")
    )


# --- workload --------------------------------------------------------------------------------


def _workload_text():
    q = F.col("l_quantity").cast("int")
    form = F.col("l_linenumber")
    return (
        F.when(form == 1, F.concat(q.cast("string"), F.lit(" – "), (q + 50).cast("string"), F.lit("%")))
        .when(form == 2, F.concat(q.cast("string"), F.lit("%")))
        .when(form == 3, F.concat(F.lit("from "), q.cast("string"), F.lit(" to "), (q + 20).cast("string"), F.lit(", 5 days")))
        .when(form == 4, F.lit("on request"))
        .when(form == 5, F.concat((q * 2).cast("string"), F.lit("-100 %")))
    )


def workload_parse(spark, sf):
    line = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", extract.workload_bounds(_workload_text()).alias("w")
    )
    return line.select(
        "l_orderkey", "l_partkey", "l_linenumber",
        F.col("w.min").alias("workload_min"), F.col("w.max").alias("workload_max"),
    )


def _bounds(spark, sf):
    q = F.col("l_quantity").cast("int")
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_returnflag",
        F.when(F.col("l_linenumber") != 1, q * 2).alias("low"),
        F.when(F.col("l_linenumber") > 2, q * 2 + 20).alias("high"),
    )


def workload_category(spark, sf):
    return _bounds(spark, sf).select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        extract.workload_category("low", "high", "analysis").alias("analysis"),
        extract.workload_category("low", "high", "dashboard").alias("dashboard"),
    )


def workload_share(spark, sf):
    shares = summary.workload_share(
        _bounds(spark, sf), "l_returnflag", "low", "high", "dashboard", min_rows=5
    )
    return shares.withColumn("share_pct", F.round("share_pct", 6))


# --- place -----------------------------------------------------------------------------------

# location text, canton, city
PLACES = (
    ("Zug, CH-ZG", "ZG", "Zug"),
    (" Scandit AG ", "ZH", "Zürich"),
    ("Kanton Zürich", "ZH", "Kanton Zürich"),
    ("Fleurier", "UR", "Fleurier"),
    ("Raum Zürich", "ZH", None),
    ("Raum Olten", None, None),
    ("Olten", "SO", "Olten"),
    ("Baar (Zentrum), Schweiz", None, "Baar"),
    ("Baar, Schweiz", "ZG", "Baar"),
    ("Foo Consulting", None, None),
    ("Deutschschweiz", None, None),
    ("Bern (Wabern), CH-BE2", "BE", "Bern"),
    ("Agie Charmilles SA, Losone", "TI", "Losone"),
    ("Lausanne, VD", "VD", "Lausanne"),
    ("La Chaux-de-Fonds", "NE", "La Chaux-de-Fonds"),
    ("EAWAG Dübendorf, Eidg. Anstalt für Wasser-, Abwasserreinigung & Gewässerschutz", "ZH", "Dübendorf"),
    ("Büro, CH-GE", "GE", "Büro"),
    ("XCH-GE", None, "XCH-GE"),
    ("Chur ", "GR", "Chur"),
    ("", None, None),
    (None, None, None),
    ("(Remote)", None, None),
    ("Vaduz, Liechtenstein", None, None),
    ("Delémont, Jura", "JU", "Delémont"),
    ("Jabil Switzerland Manufacturing GmbH", "UR", "Zürich"),
    ("Wil", "SG", "Wil"),
    ("St. Gallen", "SG", "St. Gallen"),
)


def _located(spark, sf):
    people = spread_table(spark, sf, "customer", "c_custkey")
    place = pick("c_custkey", [p[0] for p in PLACES])
    return people.select("c_custkey", place.alias("location_raw"))


def geo_resolve(spark, sf):
    found = _located(spark, sf).withColumn("canton", geo.canton("location_raw"))
    return found.select("c_custkey", "canton", geo.region("canton").alias("region"))


def city_extract(spark, sf):
    return _located(spark, sf).select("c_custkey", geo.city("location_raw").alias("city"))


def unresolved_values(spark, sf):
    found = _located(spark, sf).withColumn("canton", geo.canton("location_raw"))
    return summary.unresolved_values(found, "location_raw", "canton", 20)


# --- tags ------------------------------------------------------------------------------------


def dictionary_tags(spark, sf):
    docs = spread_table(spark, sf, "documents", "doc_id", "text", "source")
    found = docs.select(
        "doc_id", tags.dictionary_tags("text", "source", lexicon=WORDS).alias("found")
    )
    return found.select("doc_id", F.array_join("found", "|").alias("tags"), F.size("found").alias("n"))


SKILL_TEXTS = (
    "Python & SQL, résultats; CI/CD on AWS.",
    "text classification with scikit-learn (sklearn), c++ and c++17",
    "data pipelines, data pipeline, R&D, d3.js and weights & biases",
    "Digital trust, scalable, excellent; GitHub, gitlab_ci, git.",
    "Maschinelles Lernen, KI-Projekte; a/b testing; Power BI",
    "",
)


def skill_tags(spark, sf):
    """The default skill dictionary on each text with some skill words behind it."""
    docs = spread_table(spark, sf, "documents", "doc_id", "text", "lang")
    extra = pick("doc_id", SKILL_TEXTS)
    found = tags.dictionary_tags("text", extra, "lang")
    return docs.select("doc_id", F.array_join(found, "|").alias("tags"))


LISTS = (
    "['Python', ' SQL ', 'py']",
    '["it\'s", "Ml", "ml"]',
    "K8s, ms excel, , CICD",
    "[]",
    "",
    None,
    "['ci cd', 'ci/cd', '']",
)
LISTS_DASHBOARD = (
    "python|sql", "it's|machine learning", "kubernetes|excel|ci/cd", "", "", "", "ci/cd",
)
LISTS_ANALYSIS = ("python|sql|py", "it's|ml|ml", "", "", "", "", "ci cd|ci/cd|")


def parse_list(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", pick("p_partkey", LISTS).alias("raw"))
    return part.select(
        "p_partkey",
        F.array_join(tags.parse_list("raw"), "|").alias("dashboard"),
        F.array_join(tags.parse_list("raw", "analysis"), "|").alias("analysis"),
    )


def parse_list_columns(spark, sf):
    """Lists written from the columns of parts: as literals with either quote, and with commas."""
    part, form = table(spark, sf, "part"), F.col("p_partkey") % 3
    raw = (
        F.when(form == 0, F.concat(F.lit("['"), "p_brand", F.lit("', ' "), "p_type", F.lit(" ', '"), "p_name", F.lit("']")))
        .when(form == 1, F.concat(F.lit('["'), "p_type", F.lit('", "'), F.lower("p_type"), F.lit('", "x,y"]')))
        .otherwise(F.concat("p_name", F.lit(", "), "p_type", F.lit(",,"), F.upper("p_name")))
    )
    return part.withColumn("raw", raw).select(
        "p_partkey",
        F.array_join(tags.parse_list("raw"), "|").alias("dashboard"),
        F.array_join(tags.parse_list("raw", "analysis"), "|").alias("analysis"),
    )


def alias_normalize(spark, sf):
    part = table(spark, sf, "part")
    raw = F.array("p_type", F.concat(F.lit(" "), F.lower("p_type")), F.col("p_brand"), F.lit(" "), "p_name")
    aliases = {"economy": "basic", "brand#12": "brand#21", "red ring": "basic"}
    return part.select("p_partkey", F.array_join(tags.normalize_tags(raw, aliases), "|").alias("tags"))


# --- rules -----------------------------------------------------------------------------------

RULES = rules.RuleSet.of(
    [
        ("Legal", ["license", "apache", "src3"]),
        ("German", ["der", "die", "und", "mit der", "mit", "src5"]),
        ("French", ["les", "des", "la la", "la", "src1"]),
        ("Spanish", ["los", "el", "para", "la"]),
    ]
)
AGENCIES = ("src1", "rc7")
DEFAULT = "Other"


def _firms(spark, sf):
    """Documents as postings: the source is the company, the text the description."""
    return spread_table(spark, sf, "documents", "doc_id", "text", "source").withColumn(
        "company", F.concat(F.lit("Firma "), F.upper("source"), F.lit(" AG"))
    )


def _classified(spark, sf):
    category = rules.classify("company", "text", RULES, AGENCIES, DEFAULT)
    return _firms(spark, sf).select("doc_id", "company", category.alias("industry"))


def rule_classifier(spark, sf):
    return _classified(spark, sf).select("doc_id", "industry")


def rule_trace(spark, sf):
    return summary.match_trace(_firms(spark, sf), "text", RULES, ["doc_id"])


def rule_trace_first(spark, sf):
    return summary.match_trace(_firms(spark, sf), "text", RULES, ["doc_id"], first_per_rule=True)


def agency_flag(spark, sf):
    return _firms(spark, sf).select(
        "doc_id",
        rules.agency_flag("company", AGENCIES).cast("int").alias("is_agency"),
        F.array_join(tx.contained_parts(F.lower("company"), AGENCIES), "|").alias("names"),
    )


def classification_audit(spark, sf):
    return summary.classification_audit(_classified(spark, sf), "company", "industry")


def fallback_share(spark, sf):
    return summary.fallback_share(_classified(spark, sf), "industry", DEFAULT)


def fallback_non_agency(spark, sf):
    return summary.fallback_companies(
        _classified(spark, sf), "company", "industry", DEFAULT, rules.agency_flag("company", AGENCIES)
    )


def class_of_key(spark, sf):
    return rows.class_of_key(_classified(spark, sf), "company", "industry", ["doc_id"])


# --- oracles ---------------------------------------------------------------------------------


def _any(text: str, words) -> str:
    return (
        f"regexp_matches({text}, '(^|{SQL_EDGE})(" + "|".join(words) + f")($|{SQL_EDGE})')"
    )


def _sql_first_rule(text: str) -> str:
    whens = " ".join(f"WHEN {_any(text, words)} THEN '{name}'" for name, words in RULES.rules)
    return f"CASE {whens} END"


_IS_AGENCY = "(strpos(company_l, 'src1') > 0 OR strpos(company_l, 'rc7') > 0)"
SQL_CLASSIFIED = f"""
firms AS (SELECT doc_id, text, 'Firma ' || upper(source) || ' AG' AS company,
            'firma ' || source || ' ag' AS company_l FROM documents),
classified AS (
  SELECT doc_id, company, company_l,
    coalesce(CASE WHEN NOT {_IS_AGENCY} THEN {_sql_first_rule('company_l')} END,
             {_sql_first_rule('lower(text)')}, '{DEFAULT}') AS industry
  FROM firms)"""

_WORD_LIST = dict.fromkeys(w for _, words in RULES.rules for w in words)
SQL_TRACE = f"""keywords AS (SELECT * FROM (VALUES {", ".join(
    f"({i}, '{name}', {j}, '{word}')"
    for i, (name, words) in enumerate(RULES.rules, 1)
    for j, word in enumerate(words, 1)
)}) k(rule_order, category, keyword_order, keyword)),
lowered AS MATERIALIZED (SELECT doc_id, lower(text) AS body FROM documents),
found AS ({sql_hits('lowered', 'doc_id', 'body', _WORD_LIST)}),
trace AS (
  SELECT doc_id, rule_order, category, keyword_order, keyword
  FROM found JOIN keywords ON keyword = term)"""

_S_LOW = "CAST(floor(l_extendedprice) AS BIGINT)"
_S_MONTH = "12 * CAST(floor(floor(l_extendedprice) / 12) AS BIGINT)"
_Q = "CAST(l_quantity AS INTEGER)"
_LOW = f"CASE WHEN l_linenumber <> 1 THEN {_Q} * 2 END"
_HIGH = f"CASE WHEN l_linenumber > 2 THEN {_Q} * 2 + 20 END"
_SQL_BOUNDS = f"""
b AS (SELECT l_orderkey, l_partkey, l_linenumber, l_returnflag, {_LOW} AS low, {_HIGH} AS high
      FROM lineitem)"""


def _sql_category(variant: str) -> str:
    full, flexible, part, unknown = fixed.WORKLOAD_LABELS[variant]
    missing = "low IS NULL" if variant == "analysis" else "low IS NULL AND high IS NULL"
    return (
        f"CASE WHEN {missing} THEN '{unknown}' WHEN high <= 60 THEN '{part}' "
        f"WHEN low >= 90 THEN '{full}' ELSE '{flexible}' END"
    )


_CANTON = sql_pick("c_custkey", [p[1] for p in PLACES])
_REGION = "CASE canton " + " ".join(
    f"WHEN '{c}' THEN '{r}'" for c, r in fixed.CANTON_REGION.items()
) + " END"

QUERIES: dict[str, Query] = {
    "salary_extract": Query(
        salary_extract,
        f"""WITH l AS (SELECT l_orderkey, l_partkey, l_linenumber, {_S_LOW} AS a,
                {_S_LOW} + CAST(l_quantity AS BIGINT) * 1000 AS b, {_S_MONTH} AS m FROM lineitem),
              r AS (SELECT *, CASE
                WHEN l_linenumber IN (1, 2, 3, 5) AND a BETWEEN 10000 AND 500000 THEN a
                WHEN l_linenumber = 4 AND m BETWEEN 10000 AND 500000 THEN m END AS lo FROM l)
            SELECT l_orderkey, l_partkey, l_linenumber, CAST(lo AS INTEGER) AS salary_min,
              CAST(CASE WHEN l_linenumber IN (1, 2) AND lo IS NOT NULL THEN b ELSE lo END
                   AS INTEGER) AS salary_max,
              CAST(lo IS NOT NULL AS INTEGER) AS salary_available FROM r""",
    ),
    "seniority_cascade": Query(
        seniority_cascade,
        f"""SELECT p_partkey, {sql_pick('p_partkey', [c[2] for c in SENIORITY_CASES])}
              AS seniority FROM part""",
    ),
    "experience_level": Query(
        experience_level,
        """SELECT p_partkey, years, CASE WHEN years <= 2 THEN 'junior' WHEN years <= 5 THEN 'mid'
             WHEN years IS NOT NULL THEN 'senior' END AS level
           FROM (SELECT p_partkey, CAST(CASE p_partkey % 7 WHEN 0 THEN p_size WHEN 1 THEN p_size + 2
             WHEN 2 THEN p_size WHEN 4 THEN p_size WHEN 5 THEN p_size END AS INTEGER) AS years
             FROM part)""",
    ),
    "workload_parse": Query(
        workload_parse,
        f"""SELECT l_orderkey, l_partkey, l_linenumber,
              CAST(CASE WHEN l_linenumber <= 3 THEN {_Q} WHEN l_linenumber = 5 THEN {_Q} * 2 END
                   AS INTEGER) AS workload_min,
              CAST(CASE l_linenumber WHEN 1 THEN {_Q} + 50 WHEN 2 THEN {_Q} WHEN 3 THEN {_Q} + 20
                   WHEN 5 THEN 100 END AS INTEGER) AS workload_max FROM lineitem""",
    ),
    "workload_category": Query(
        workload_category,
        f"""WITH {_SQL_BOUNDS} SELECT l_orderkey, l_partkey, l_linenumber,
              {_sql_category('analysis')} AS analysis, {_sql_category('dashboard')} AS dashboard
            FROM b""",
    ),
    "workload_share": Query(
        workload_share,
        f"""WITH {_SQL_BOUNDS},
              k AS (SELECT l_returnflag, {_sql_category('dashboard')} AS category FROM b),
              g AS (SELECT l_returnflag, count(*) AS group_rows FROM k GROUP BY l_returnflag
                    HAVING count(*) >= 5),
              c AS (SELECT unnest({list(fixed.WORKLOAD_LABELS['dashboard'])}) AS category),
              n AS (SELECT l_returnflag, category, count(*) AS n FROM k GROUP BY ALL)
            SELECT g.l_returnflag, g.group_rows, c.category, coalesce(n.n, 0) AS category_rows,
              round(100.0 * coalesce(n.n, 0) / g.group_rows, 6) AS share_pct
            FROM g CROSS JOIN c LEFT JOIN n
              ON n.l_returnflag = g.l_returnflag AND n.category = c.category""",
    ),
    "geo_resolve": Query(
        geo_resolve,
        f"""SELECT c_custkey, canton, {_REGION} AS region
            FROM (SELECT c_custkey, {_CANTON} AS canton FROM customer)""",
    ),
    "city_extract": Query(
        city_extract,
        f"SELECT c_custkey, {sql_pick('c_custkey', [p[2] for p in PLACES])} AS city FROM customer",
    ),
    "unresolved_values": Query(
        unresolved_values,
        f"""SELECT location_raw, count(*) AS count FROM (
              SELECT {sql_pick('c_custkey', [p[0] for p in PLACES])} AS location_raw,
                {_CANTON} AS canton FROM customer)
            WHERE canton IS NULL AND location_raw IS NOT NULL
            GROUP BY location_raw ORDER BY count DESC, location_raw LIMIT 20""",
    ),
    "dictionary_tags": Query(
        dictionary_tags,
        f"""WITH {SQL_HITS}
            SELECT d.doc_id, coalesce(string_agg(h.term, '|' ORDER BY h.term), '') AS tags,
              CAST(count(h.term) AS INTEGER) AS n
            FROM documents d LEFT JOIN hits h ON h.doc_id = d.doc_id GROUP BY d.doc_id""",
    ),
    "skill_tags": Query(
        skill_tags,
        f"""WITH t AS MATERIALIZED (SELECT doc_id, lower(text || ' ' || {sql_pick('doc_id', SKILL_TEXTS)}
                || ' ' || lang) AS body FROM documents),
              h AS ({sql_hits('t', 'doc_id', 'body', fixed.SKILL_TERMS)})
            SELECT t.doc_id, coalesce(string_agg(h.term, '|' ORDER BY h.term), '') AS tags
            FROM t LEFT JOIN h ON h.doc_id = t.doc_id GROUP BY t.doc_id""",
    ),
    "parse_list": Query(
        parse_list,
        f"""SELECT p_partkey, {sql_pick('p_partkey', LISTS_DASHBOARD)} AS dashboard,
              {sql_pick('p_partkey', LISTS_ANALYSIS)} AS analysis FROM part""",
    ),
    "parse_list_columns": Query(
        parse_list_columns,
        """WITH i AS (
             SELECT p_partkey, p_partkey % 3 AS form, lower(p_brand) AS b, lower(p_type) AS t, lower(p_name) AS n FROM part)
           SELECT p_partkey,
             CASE form WHEN 0 THEN b || CASE WHEN t = b THEN '' ELSE '|' || t END
                 || CASE WHEN n = b OR n = t THEN '' ELSE '|' || n END
               WHEN 1 THEN t || '|x,y' ELSE n || CASE WHEN t = n THEN '' ELSE '|' || t END END AS dashboard,
             CASE form WHEN 0 THEN b || '|' || t || '|' || n WHEN 1 THEN t || '|' || t || '|x,y' ELSE '' END AS analysis
           FROM i""",
    ),
    "alias_normalize": Query(
        alias_normalize,
        """WITH i AS (
             SELECT p_partkey, 1 AS i, lower(p_type) AS t FROM part
             UNION ALL SELECT p_partkey, 2, lower(p_brand) FROM part
             UNION ALL SELECT p_partkey, 3, lower(p_name) FROM part),
           m AS (SELECT p_partkey, CASE t WHEN 'economy' THEN 'basic' WHEN 'red ring' THEN 'basic'
                   WHEN 'brand#12' THEN 'brand#21' ELSE t END AS t, min(i) AS i
                 FROM i GROUP BY 1, 2)
           SELECT p_partkey, string_agg(t, '|' ORDER BY i) AS tags FROM m GROUP BY p_partkey""",
    ),
    "rule_classifier": Query(
        rule_classifier, f"WITH {SQL_CLASSIFIED} SELECT doc_id, industry FROM classified"
    ),
    "rule_trace": Query(
        rule_trace,
        f"""WITH {SQL_TRACE} SELECT doc_id, rule_order, category, keyword_order, keyword
            FROM trace""",
    ),
    "rule_trace_first": Query(
        rule_trace_first,
        f"""WITH {SQL_TRACE} SELECT doc_id, rule_order, category, keyword_order, keyword
            FROM trace QUALIFY row_number() OVER (PARTITION BY doc_id, rule_order
                                                  ORDER BY keyword_order) = 1""",
    ),
    "agency_flag": Query(
        agency_flag,
        f"""WITH {SQL_CLASSIFIED} SELECT doc_id, CAST({_IS_AGENCY} AS INTEGER) AS is_agency,
              concat_ws('|', CASE WHEN strpos(company_l, 'src1') > 0 THEN 'src1' END,
                        CASE WHEN strpos(company_l, 'rc7') > 0 THEN 'rc7' END) AS names
            FROM classified""",
    ),
    "classification_audit": Query(
        classification_audit,
        f"""WITH {SQL_CLASSIFIED} SELECT company, industry, count(*) AS count FROM classified
            GROUP BY company, industry""",
    ),
    "fallback_share": Query(
        fallback_share,
        f"""WITH {SQL_CLASSIFIED} SELECT count(*) AS rows,
              count(*) FILTER (industry = '{DEFAULT}') AS fallback_rows,
              round(100.0 * count(*) FILTER (industry = '{DEFAULT}') / count(*), 2) AS fallback_pct
            FROM classified""",
    ),
    "fallback_non_agency": Query(
        fallback_non_agency,
        f"""WITH {SQL_CLASSIFIED} SELECT company, count(*) AS count FROM classified
            WHERE industry = '{DEFAULT}' AND NOT {_IS_AGENCY} GROUP BY company""",
    ),
    "class_of_key": Query(
        class_of_key,
        f"""WITH {SQL_CLASSIFIED} SELECT company, first(industry ORDER BY doc_id) AS industry
            FROM classified GROUP BY company""",
    ),
}
