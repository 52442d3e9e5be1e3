"""Collocations against a plain count, and that the local finds lose no frequent phrase."""

import random
import re
from collections import Counter

import pytest

from jobtide.llm import collocations


def plain(rows, support, top):
    grams, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", small):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            totals[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    grams[lang, words[i : i + k]] += 1
    frequent = {g: f for g, f in grams.items() if len(g[1]) > 1 and f >= support}
    held = Counter()
    for (lang, words), f in frequent.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                held[lang, words[i : i + k]] = max(held[lang, words[i : i + k]], f)
    out = []
    for (lang, words), a in frequent.items():
        if held[lang, words] >= a:
            continue
        cuts = []
        for k in range(1, len(words)):
            l, r = grams[lang, words[:k]], grams[lang, words[k:]]
            cuts.append((1000 * a * totals[lang] // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        out.append((lang, score, a, " ".join(words), l, r, totals[lang]))
    out.sort(key=lambda x: (x[0], -x[1], -x[2], x[3].encode()))
    rank, result = Counter(), set()
    for lang, score, a, phrase, l, r, n in out:
        rank[lang] += 1
        if rank[lang] <= top:
            result.add((lang, rank[lang], phrase, a, l, r, n, score))
    return result


def mined(docs, support, top):
    return {tuple(r) for r in collocations.collocations(docs, support, top).collect()}


@pytest.mark.parametrize("shard_words", [1 << 22, 300, 40])
def test_matches_a_plain_count(spark, documents, monkeypatch, shard_words):
    monkeypatch.setattr(collocations, "SHARD_WORDS", shard_words)
    rng = random.Random(shard_words)
    words = ["a", "b", "The", "the", "of", "Éa", "x-y", "q", "zz", "new", "york", "city"]
    rows = []
    for i in range(160):
        text = []
        for _ in range(rng.randint(0, 40)):
            text.append(rng.choice(words) if rng.random() < 0.7 else "new york city hall")
            text.append(rng.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "\x0b", ";"]))
        rows.append(("".join(text), rng.choice(["en", "en", "de", None])))
    rows += [(None, "en"), ("", None), ("alone", "fr"), ("the end of " * 50, "en"), ("the end of " * 50, "en")]
    docs = documents([(i, t, lang, "s") for i, (t, lang) in enumerate(rows)], parts=5)
    found = mined(docs, 12, 40)
    assert found == plain(rows, 12, 40) and len(found) > 40
    assert "new york city hall" in {f[2] for f in found}


def test_ties_and_rank_cut(spark, documents):
    rows = [(f"w{i} v{i}", "en") for i in range(30) for _ in range(3)]
    docs = documents([(i, t, lang, "s") for i, (t, lang) in enumerate(rows)])
    assert mined(docs, 3, 7) == plain(rows, 3, 7)


def test_odd_rows(spark, odd):
    rows = [(r.text, r.lang) for r in odd.collect()]
    assert mined(odd, 4, 50) == plain(rows, 4, 50)
    assert mined(odd.where("false"), 4, 50) == set()


def test_local_support_adds_up():
    part = collocations.Shard.__new__(collocations.Shard)
    for sizes in ([7, 90, 3], [1] * 100, [100], [33, 33, 34]):
        least = 0
        for n in sizes:
            part.names, part.sizes = ["en"], __import__("numpy").array([n])
            least += int(part.local_support({"en": sum(sizes)}, 100)[0]) - 1
        assert least < 100


@pytest.mark.parametrize("k", [2, 3, 4, 5])
def test_rows_from_tasks_grow_as_the_input(spark, documents, monkeypatch, k):
    """Five times the rows in five times the tasks: a task sends no more rows, though far more phrases are frequent."""
    monkeypatch.setattr(collocations, "SHARD_WORDS", 400)
    rng = random.Random(k)
    text = lambda: " ".join(rng.choice("abcdefgh") for _ in range(50))
    texts = [(i, text(), "en", "s") for i in range(400)]
    made = []
    for times in (1, 5):
        docs = documents(texts[: 80 * times], parts=4 * times)
        every = [collocations.np.full(1 << 20, (1 << 64) - 1, collocations.np.uint64)] * (k - 1)
        counts = collocations.local_counts(docs.select("text", "lang"), every, k)
        made.append(counts.count())
        plain = Counter(tuple(r.text.split()[i : i + k]) for r in docs.collect() for i in range(51 - k))
        found = collocations.counted(docs.select("text", "lang"), every, k, 3).collect()
        assert sorted(r.n for r in found) == sorted(n for n in plain.values() if n >= 3)
    assert made[0] <= 80 * (51 - k) and made[1] <= 1.5 * 5 * made[0]


def test_texts_are_read_once_a_length(spark, documents, monkeypatch):
    """No second pass asks the shards for counts of candidates: words, then each length once."""
    passes = []
    counts = collocations.local_counts
    monkeypatch.setattr(collocations, "local_counts", lambda t, f, k: passes.append((k, len(f))) or counts(t, f, k))
    docs = documents([(i, "a b c d e f", "en", "s") for i in range(9)])
    phrases, words, totals = collocations.frequent_phrases(docs, 9)
    assert passes == [(2, 1), (3, 2), (4, 3), (5, 4)] and totals == {"en": 54} and words.count() == 6
    assert sorted((len(r.words), r.a) for r in phrases.collect()) == sorted((k, 9) for k in range(2, 6) for _ in range(7 - k))
