"""Features against a plain count, and what the model tells apart on documents it has not learnt from."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from jobtide.llm import toxicity
from jobtide.llm.texts import Texts

NAMES = list(toxicity.FEATURES)


def rows_of(texts, terms=(), strength=4.0):
    keys = toxicity.word_hashes(list(terms)) if terms else np.zeros(0, np.uint64)
    lexicon = toxicity.Lexicon(keys, np.full((toxicity.FOLDS + 1, len(keys)), strength, np.float32))
    column = Texts(pa.array(texts, pa.string()))
    version = np.full(column.n, toxicity.FOLDS)
    x = toxicity.features(column, lexicon, version, toxicity.word_hashes(toxicity.INSULTS), toxicity.word_hashes(toxicity.SECOND_PERSON))
    return [dict(zip(NAMES, row.tolist())) for row in x]


def test_features_match_a_plain_count():
    texts = [
        "You are a Moron, a MORON!! Really?", "", None, "no such thing here", "ÉTÉ été Été", "stuuupid you 1d10t s-c-u-m",
        "far " * 20 + "clown " + "far " * 20 + "you", "id.iot\nLOSER", "a", "x1y2 2024-05-06 a@b.com",
    ]
    for text, row in zip(texts, rows_of(texts)):
        text = text or ""
        words = re.findall(r"[^\W_]+", text.lower())
        insults = sum(w in toxicity.INSULTS for w in words)
        assert row["size"] == pytest.approx(np.log1p(len(words)))
        assert row["insult_count"] == pytest.approx(np.log1p(insults))
        assert row["insult_density"] == pytest.approx(insults / max(len(words), 1))
        assert row["second_person_density"] == pytest.approx(sum(w in toxicity.SECOND_PERSON for w in words) / max(len(words), 1))
        hit = [i for i, w in enumerate(words) if w in toxicity.INSULTS]
        you = [i for i, w in enumerate(words) if w in toxicity.SECOND_PERSON]
        gaps = [min((abs(i - j) for j in you), default=np.inf) for i in hit]
        assert row["closeness"] == pytest.approx(max((1 / (1 + g) for g in gaps), default=0))
        assert row["near_second_person"] == pytest.approx(sum(g <= toxicity.NEAR for g in gaps) / max(len(hit), 1))
    found = rows_of(texts)
    assert found[0]["repeated_marks"] == pytest.approx(1 / 7) and found[0]["exclamations"] == pytest.approx(3 / 7)
    assert found[0]["capital_word_share"] == pytest.approx(1 / 7)
    assert found[5]["hidden_hits"] == pytest.approx(np.log1p(2)) and found[5]["stretched_rate"] > 0
    assert found[7]["hidden_hits"] == pytest.approx(np.log1p(1))
    assert rows_of(["x"] * 3 + ["moron"])[3]["insult_count"] > 0


def test_lexicon_knows_words_and_their_beginnings():
    column = Texts(pa.array(["réeuxtion", "réeuxment", "ré", "Réeuxtion!"]))
    words = toxicity.Vocabulary(column)
    long, keys = words.beginnings(5)
    assert long.tolist() == [0, 1, 3] and len(set(keys.tolist())) == 1
    assert words.words[0] == words.words[3]
    lexicon = toxicity.Lexicon(keys[:1], np.full((toxicity.FOLDS + 1, 1), 2.0, np.float32))
    assert lexicon.strength(words, np.full(4, 0)).tolist() == [2, 2, 0, 2]


def test_strength_without_a_fold_does_not_see_it():
    toxic, other = np.array([[5, 0, 0], [4, 4, 4]]), np.zeros((2, 3), int)
    found = toxicity.Lexicon.of(np.array([9, 4], np.uint64), toxic, other, np.full(3, 10), np.full(3, 90))
    assert found.terms.tolist() == [4, 9]
    assert found.strengths[0, 1] == 0 and found.strengths[1, 1] > 1
    assert (found.strengths[:, 0] > 2).all()


def corpus(rng, n):
    parts = ["la", "re", "mi", "to", "ne", "sol", "fa"]
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(parts) for _ in range(rng.randint(2, 4))) for _ in range(rng.randint(5, 120))]
        bad = i % 4 == 0
        for _ in range(rng.randint(2, 4) if bad else 0):
            word = "zork" + rng.choice(parts) + rng.choice(parts) if i % 8 else rng.choice(["moron", "scum", "loser"])
            words.insert(rng.randrange(len(words)), word)
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return docs, labels


def test_held_out_documents_are_told_apart(spark, documents):
    docs, labels = corpus(random.Random(4), 900)
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    table = documents(docs)
    found = toxicity.score(table, toxicity.fit(table, known)).collect()
    truth = dict(labels)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    new = [r for r in found if r.held_out]
    assert len(new) > 200 and np.mean([r.predicted == truth[r.doc_id] for r in new]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)


def test_odd_rows_are_scored(spark, odd):
    known = spark.createDataFrame([(1, 1), (5, 0), (6, None), (None, 1), (6, 0), (6, 1)], "doc_id long, toxic int")
    found = toxicity.score(odd, toxicity.fit(odd, known)).collect()
    assert len(found) == odd.count() and all(0 <= r.score <= 1 for r in found)
    assert all(r.held_out is False for r in found if r.doc_id is None)
    none = toxicity.fit(odd, known.where("false"))
    assert {r.score for r in toxicity.score(odd, none).collect()} == {0.5}
    assert toxicity.score(odd.where("false"), none).collect() == []


def test_sample_bound_holds_with_repeated_ids(spark, documents):
    known = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    table = documents([(i % 60, f"text {i} of some words that differ {i * i}") for i in range(600)])
    found = toxicity.sampled(table, known, "toxic", 10).collect()
    assert 0 < len(found) <= 10 and len({r.doc_id for r in found}) == len(found)
