"""The character model of the quality rules: whole characters, own counts left out, parts with the counts they need."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from jobtide.llm import quality_rules
from jobtide.llm.texts import Texts


def grams(text):
    padded = [quality_rules.START] * (quality_rules.ORDER - 1) + [ord(c) for c in text]
    return [tuple(padded[i : i + quality_rules.ORDER]) for i in range(len(text))]


def test_ngrams_hold_whole_characters():
    texts = ["aB1é", "", "Жя𝄞中!", None, "AZ09.,\t\n ", "é"]
    first, rest, offsets = quality_rules.codes_of(Texts(pa.array(texts)))
    low = (1 << quality_rules.CHARACTER) - 1
    got = [(int(f), int(r) >> 42, int(r) >> 21 & low, int(r) & low) for f, r in zip(first, rest)]
    assert got == [g for t in texts for g in grams(t or "")]
    assert np.diff(offsets).tolist() == [len(t or "") for t in texts]


def plain(counts, discounts, gram):
    """Interpolated Kneser-Ney by its definition, from the counts of the longest n-grams."""
    levels = {quality_rules.ORDER: {g: n for g, n in counts.items() if n}}
    for k in range(quality_rules.ORDER - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    after = defaultdict(list)
    for level in levels.values():
        for g, n in level.items():
            after[g[:-1]].append(n)

    def p(g):
        if not g:
            return 1 / (1 << quality_rules.CHARACTER)
        own, d = after.get(g[:-1], ()), discounts[len(g)]
        if not own:
            return p(g[1:])
        n = levels[len(g)].get(g, 0)
        return (n - d[min(n, 3)]) / sum(own) + sum(d[min(x, 3)] for x in own) / sum(own) * p(g[1:])

    return p(gram)


@pytest.mark.parametrize("block", [quality_rules.BLOCK, 7])
def test_own_counts_are_left_out(block, monkeypatch):
    monkeypatch.setattr(quality_rules, "BLOCK", block)
    rng = random.Random(4)
    texts = ["".join(rng.choice("abÄß中 ") for _ in range(rng.randint(0, 30))) for _ in range(25)] + ["xyzxyz", "ab" * 20]
    counted = np.array([True] * 20 + [False] * 5 + [True, True])
    first, rest, offsets = quality_rules.codes_of(Texts(pa.array(texts)))
    held = np.repeat(counted, np.diff(offsets))
    codes, n = np.unique(np.stack([first[held], rest[held]]), axis=1, return_counts=True)
    model = quality_rules.Model.built(codes[1], n, codes[0].astype(np.int32), quality_rules.CHARACTER)
    got = quality_rules.Model.of(model.rows(), quality_rules.CHARACTER).losses(first, rest, offsets, counted)
    whole = Counter(g for t, c in zip(texts, counted) if c for g in grams(t))
    for t, c, loss in zip(texts, counted, got):
        others = whole - Counter(grams(t)) if c else whole
        assert loss == pytest.approx(-sum(math.log(plain(others, model.discounts, g)) for g in grams(t)), abs=1e-6)


def said(rng, letters, n, shuffled=False):
    own = random.Random(1)
    syllables = [own.choice(letters) + own.choice(letters) for _ in range(8)]
    pick = (lambda: rng.choice(letters) + rng.choice(letters)) if shuffled else (lambda: rng.choice(syllables))
    words = ["".join(pick() for _ in range(rng.randint(2, 5))) for _ in range(n)]
    return " ".join(words)


@pytest.mark.parametrize("letters", ["ABCDEFGHIJKLMNOPQRST", "0123456789", "àáâãäåæçèéêëìíîïñòóô", "天地玄黄宇宙洪荒日月盈昃辰宿列張"])
def test_quality_rules_see_every_character(documents, letters):
    # Letters that used to be one class, or to share classes: texts in them differ by their characters alone.
    rng = random.Random(5)
    rows = [(i, said(rng, letters, 100)) for i in range(200)]
    rows += [(1000 + i, said(rng, letters, 100, True)) for i in range(3)]
    # A script that no other text uses: its n-grams must not vouch for themselves.
    rows.append((2000, said(rng, [chr(c) for c in range(0x0E01, 0x0E2F)], 100, True)))
    found = {r.doc_id: r for r in quality_rules.judge(documents(rows)).collect()}
    assert not any(r.base_failed for r in found.values())
    assert sum(found[i].kept for i in range(200)) >= 194
    assert [i for i in found if i >= 1000 and found[i].kept] == []


def test_parts_get_the_counts_they_need(documents, monkeypatch):
    for name in ("PART_BYTES", "PART_BYTES_LARGE"):
        monkeypatch.setattr(quality_rules, name, 4000)
    monkeypatch.setattr(quality_rules, "PART_BYTES_GRAM", 0)
    rng = random.Random(6)
    rows = [(i, said(rng, "abcdefghijklmno", rng.randint(0, 60), i % 17 == 0), ["de", None, "zh"][i % 3], "a") for i in range(150)]
    rows += [(200, None, "de", "a"), (201, "too short", "it", "a"), (202, "天地玄黄 " * 3, "zh", "a"), *rows[:3]]
    docs = documents(rows)

    def judged(**limits):
        columns = ["doc_id", "lang", *quality_rules.BASE, "base_failed", "kept"]
        rows = quality_rules.judge(docs, **limits).collect()
        return Counter((*(r[c] for c in columns), round(r.surprisal or 0, 9)) for r in rows)

    sent = judged()
    assert sum(sent.values()) == len(rows)
    assert judged(max_languages=1) == sent
    assert judged(max_grams=0) == sent
