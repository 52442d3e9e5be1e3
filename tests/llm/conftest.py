import pytest


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a documents table from (doc_id, text) or (doc_id, text, lang, source) rows."""

    def build(rows, parts=3):
        full = [(*r, "en", "a")[:4] if len(r) == 2 else r for r in rows]
        full = [(*r, None if r[1] is None else len(r[1])) for r in full]
        return spark.createDataFrame(full, DOCS).repartition(parts)

    return build


@pytest.fixture(scope="session")
def odd(spark, documents):
    """Nulls, empty, white and long texts, repeated rows, and columns named like results."""
    words = " ".join(f"word{i % 997}" for i in range(30_000))
    rows = [
        (None, None, None, None), (None, "no id at all", "en", None), (1, None, "en", "a"), (2, "", "en", "a"),
        (3, " \n\t ", None, "b"), (4, "x", "en", None), (5, words, "en", "b"), (6, words, "en", "b"),
        (6, words, "en", "b"), (7, "same line of twenty and more\n" * 40, "en", "a"), (8, "ÀÉ 漢字 🙂 ß", "zz", "a"),
        (9, "y" * 60_000, "en", "a"), (10, "one two three", "en", "a"), (11, "one two three", "en", "a"),
    ]
    docs = documents(rows)
    extra = ("n_words", "kept", "node", "label", "taken", "removed", "size", "_model", "band", "line")
    from pyspark.sql import functions as F

    return docs.withColumns({c: F.lit("extra") for c in extra})
