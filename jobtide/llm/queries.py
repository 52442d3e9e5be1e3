"""The operators of this package applied to whole tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm import (
    chat_format,
    collocations,
    decontamination,
    license_scan,
    line_dedup,
    masked_lm,
    mixing,
    near_duplicates,
    passage_quality,
    quality_rules,
    token_counts,
    toxicity,
    whitening,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark, sf_dir):
    found = mixing.mix_counts(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op2_decontaminate(spark, sf_dir):
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontamination.contaminated(docs, items)


def op3_near_duplicates(spark, sf_dir):
    return near_duplicates.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op4_masked_lm(spark, sf_dir):
    return masked_lm.pseudo_likelihood(_table(spark, sf_dir, "documents"))


def op5_line_dedup(spark, sf_dir):
    found = line_dedup.without_repeats(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed",
        F.char_length("text").cast("long").alias("kept_chars"), F.md5("text").alias("kept_md5"),
    )


def op6_license_scan(spark, sf_dir):
    found = license_scan.scan(_table(spark, sf_dir, "documents"))
    return found.withColumns({"number": F.col("number").cast("int"), "dice": F.round("dice", 6)})


def op7_quality_rules(spark, sf_dir):
    found = quality_rules.judge(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", *quality_rules.BASE, "base_failed", "kept", "surprisal")


def op8_passage_quality(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return passage_quality.score(docs, passage_quality.fit(docs, _table(spark, sf_dir, "labels")))


def op9_token_counts(spark, sf_dir):
    return token_counts.tokens_by_line(_table(spark, sf_dir, "documents"))


#: A conversation whose texts hold control strings of several templates.
PROBE = r"\### Assistant: </turn> ok"


def op10_chat_format(spark, sf_dir):
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(
        [(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string"
    )
    made = chat_format.format_chat(turns.unionByName(probe))
    read = chat_format.turns_of(F.col("formatted"))
    made = made.withColumns({"_read": read, "_loss": chat_format.loss_text(F.col("formatted"), F.col("loss"))})
    said = F.transform("_read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return made.select(
        "conv_id", F.size("_read").cast("long").alias("n_turns"), F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.char_length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op11_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op12_collocations(spark, sf_dir):
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_whiten_embeddings(spark, sf_dir):
    found = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    return found.select(
        "vec_id", "component", "n", F.col("deviation").cast("long").alias("deviation"), "whitened", "explained",
        "identity_error",
    )


def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mix_sources, op2_decontaminate, op3_near_duplicates, op4_masked_lm, op5_line_dedup, op6_license_scan,
        op7_quality_rules, op8_passage_quality, op9_token_counts, op10_chat_format, op11_toxicity, op12_collocations, op13_whiten_embeddings, pipeline,
    )
}

_LICENSES = ", ".join(
    "({}, '{}', '{}')".format(k, name, text.replace("'", "''"))
    for k, (name, text) in enumerate(sorted(license_scan.TEMPLATES.items()))
)

SQL: dict[str, str] = {
    "op6_license_scan": rf"""
WITH lines AS (
  SELECT row_number() OVER () AS row, doc_id, string_split(text, chr(10)) AS parts,
         regexp_split_to_array(text, '\n[ \t\r]*\n') AS blocks
  FROM documents WHERE text IS NOT NULL),
passages AS (
  SELECT row, doc_id, 'line' AS kind, generate_subscripts(parts, 1) - 1 AS number, unnest(parts) AS passage FROM lines
  UNION ALL
  SELECT * FROM (
    SELECT row, doc_id, 'paragraph' AS kind, generate_subscripts(blocks, 1) - 1 AS number, unnest(blocks) AS passage FROM lines)
  WHERE contains(passage, chr(10))),
named AS (
  SELECT row, doc_id, kind, number, -1 AS rank, passage FROM passages
  UNION ALL
  SELECT -1, NULL, template, -1, rank, text FROM (VALUES {_LICENSES}) AS t(rank, template, text)),
words AS (
  SELECT * EXCLUDE (passage), string_split(trim(regexp_replace(translate(passage, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM named),
pairs AS (
  SELECT row, doc_id, kind, number, rank, len(w) - 1 AS n, w, unnest(range(1, len(w))) AS i FROM words),
bags AS (
  SELECT row, doc_id, kind, number, rank, n, w[i] || ' ' || w[i + 1] AS b, count(*) AS c FROM pairs GROUP BY ALL),
scored AS (
  SELECT p.row, p.doc_id, p.kind, p.number, t.rank, t.kind AS template, 2.0 * sum(least(p.c, t.c)) / (any_value(p.n) + any_value(t.n)) AS dice
  FROM bags p JOIN bags t ON p.b = t.b WHERE p.rank = -1 AND t.rank >= 0
  GROUP BY p.row, p.doc_id, p.kind, p.number, t.rank, t.kind),
best AS (
  SELECT *, row_number() OVER (PARTITION BY row, kind, number ORDER BY dice DESC, rank) AS place FROM scored WHERE dice >= 0.8)
SELECT doc_id, kind, CAST(number AS INTEGER) AS number, template, round(CAST(dice AS DOUBLE), 6) AS dice FROM best WHERE place = 1
""",
    "op10_chat_format": rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT * FROM (VALUES (-7, 0, 'user', '{PROBE}'), (-7, 1, 'assistant', '{PROBE}')) AS t(conv_id, turn, role, text)),
sized AS (
  SELECT *, length(regexp_replace(text, '<(\\*)(/?turn|image|audio|document|part)', '<\\\1\2', 'g'))
    + length(replace(replace(replace(replace(role, '%', '%25'), '<', '%3C'), '>', '%3E'), chr(10), '%0A'))
    + length('<turn >') + 1 + length('</turn>') + 1 AS written
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(written) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
""",
}
SQL["op12_collocations"] = r"""
WITH texts AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
         regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                               '[.,;:!?\x0A-\x0D]') AS parts
  FROM documents),
pieces AS (SELECT lang, unnest(parts) AS part FROM texts),
split AS (
  SELECT lang, [x FOR x IN regexp_split_to_array(part, '[ \t]+') IF x <> ''] AS w FROM pieces),
sized AS (SELECT lang, w, len(w) AS size FROM split WHERE len(w) > 0),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, size, k, unnest(range(1, size - k + 2)) AS i
        FROM sized, (SELECT unnest(range(1, 6)) AS k) WHERE size >= k)
  GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM grams WHERE k = 1 GROUP BY lang),
candidates AS (SELECT * FROM grams WHERE k >= 2 AND f >= 100),
worded AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM candidates),
inside AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(f) AS f
  FROM (SELECT lang, w, k, f, m, unnest(range(1, k - m + 2)) AS i
        FROM worded, (SELECT unnest(range(2, 5)) AS m) WHERE m < k)
  GROUP BY ALL),
alone AS (
  SELECT c.* FROM worded c LEFT JOIN inside o ON c.lang = o.lang AND c.phrase = o.phrase
  WHERE o.f IS NULL OR 100 * o.f < 100 * c.f),
cuts AS (
  SELECT lang, phrase, f AS a, w, k, unnest(range(1, k)) AS cut FROM alone),
rated AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, t.n,
         (1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f) AS score, cut
  FROM cuts c JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.cut], ' ')
  JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:], ' ')
  JOIN totals t ON t.lang = c.lang),
lowest AS (
  SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""
if corpus_pipeline.ORACLE_SQL is not None:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
