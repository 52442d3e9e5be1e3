"""Quality rules, masked language model, passage classifier and token counts."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from jobtide.llm import masked_lm, passage_quality, quality_rules, token_counts
from jobtide.llm.texts import Texts


def prose(rng, n):
    return " ".join("".join(rng.choice(["la", "re", "mi", "to", "ne"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_kneser_ney_matches_a_plain_model():
    rng = np.random.default_rng(0)
    codes = rng.integers(0, 5, (3000, quality_rules.ORDER)) ** 2 % 7
    grams = Counter(map(tuple, codes.tolist()))
    number = lambda g: sum(x << (quality_rules.BITS * (len(g) - 1 - i)) for i, x in enumerate(g))
    pairs = sorted((number(g), n) for g, n in grams.items())
    model = quality_rules.Model.of(quality_rules.Model.built(*map(np.array, zip(*pairs))).rows())
    levels = {quality_rules.ORDER: dict(grams)}
    for k in range(quality_rules.ORDER - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    discounts = {k: quality_rules._discounts(np.array(list(v.values()))) for k, v in levels.items()}
    after = defaultdict(list)
    for k, level in levels.items():
        for g, n in level.items():
            after[k, g[:-1]].append(n)

    def p(g):
        if not g:
            return 1 / (1 << quality_rules.BITS)
        own, d = after.get((len(g), g[:-1])), discounts[len(g)]
        if not own:
            return p(g[1:])
        n = levels[len(g)].get(g, 0)
        free = sum(d[min(x, 3)] for x in own) / sum(own)
        return (n - d[min(n, 3)]) / sum(own) * (n > 0) + free * p(g[1:])

    tried = [*list(grams)[:200], (31, 31, 31, 31), (0, 0, 9, 1), (1, 4, 2, 9)]
    got = model.scores(np.array([number(g) for g in tried], np.int32))
    assert np.allclose(got, [math.log(p(g)) for g in tried], atol=1e-4)
    assert sum(math.exp(v) for v in model.scores(np.array([number((1, 4, 2, x)) for x in range(32)], np.int32))) == pytest.approx(1, abs=1e-3)


def test_quality_rules_keep_prose_and_reject_odd_texts(documents):
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randint(12, 150))) for i in range(400)]
    rows += [(1000, " ".join(a + b + c for a in "qxzj" for b in "kvw" for c in "xqz")), (1001, "too short"), (1002, "a b c d e f " * 10), (1003, None)]
    found = {r.doc_id: r for r in quality_rules.judge(documents(rows)).collect()}
    assert sum(found[i].kept for i in range(400)) >= 398
    assert not any(found[i].kept for i in range(1000, 1004))
    assert not found[1000].base_failed and found[1001].base_failed and found[1002].base_failed
    assert found[1003].surprisal is None


def test_quality_rules_reject_mildly_odd_texts(documents):
    rng = random.Random(12)
    rows = [(i, prose(rng, 120)) for i in range(400)]
    for i in range(1000, 1020):
        text = list(prose(rng, 120))
        for at in rng.sample(range(len(text)), 4):
            text[at] = rng.choice("qxzjkvw")
        rows.append((i, "".join(text)))
    found = {r.doc_id: r for r in quality_rules.judge(documents(rows)).collect()}
    assert sum(found[i].kept for i in range(400)) >= 392
    assert not any(found[i].base_failed for i in range(1000, 1020))
    assert sum(found[i].kept for i in range(1000, 1020)) <= 5


def test_quality_rules_know_every_language_and_script(documents):
    rng = random.Random(13)

    def said(k, n, shuffled=False):
        # Language 0 is written in Cyrillic letters; each other one has syllables of its own.
        letters = "абвгдежзийклмнопрст" if k == 0 else "abcdefghijklmnopqrst"
        own = random.Random(k)
        syllables = [own.choice(letters) + own.choice(letters) for _ in range(6)]
        made = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n)]
        if shuffled:
            made = ["".join(rng.choice(letters) for _ in w) for w in made]
        return " ".join(made)

    rows = [(1000 * k + i, said(k, 90), f"l{k:02}", "a") for k in range(20) for i in range(40 if k else 30)]
    rows += [(1000 * k + 900 + i, said(k, 90, True), f"l{k:02}", "a") for k in (0, 18, 19) for i in range(2)]
    docs = documents(rows)
    found = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    assert len(found) == len(rows) and not any(r.base_failed for r in found.values())
    assert [i for i, r in found.items() if r.kept and i % 1000 >= 900] == []
    assert sum(r.kept for i, r in found.items() if i % 1000 < 900) >= 0.97 * (len(rows) - 6)
    sent = {r.doc_id: r for r in quality_rules.judge(docs, max_languages=50).collect()}
    assert all(sent[i].kept == r.kept and sent[i].surprisal == pytest.approx(r.surprisal) for i, r in found.items())


def test_quality_rules_odd_rows(odd):
    found = quality_rules.judge(odd)
    assert found.count() == odd.count()
    assert {r.doc_id: r.n_words for r in found.collect()}[7] == 240
    assert quality_rules.judge(odd.limit(0)).count() == 0


def log_probability(network, around, target):
    """One token by a plain loop over the two levels."""
    x = np.concatenate([network.E[c] for c in around]).astype(float)
    h = np.tanh(x @ network.W + network.b)
    k, member = divmod(int(target), masked_lm.GROUP)
    groups = h @ network.G + network.g
    own = h @ network.O[k] + network.c[k]
    return groups[k] - np.log(np.exp(groups).sum()) + own[member] - np.log(np.exp(own).sum())


def test_masked_network_gradient_and_scores():
    rng = np.random.default_rng(0)
    classes = 100
    around = rng.integers(0, classes, (64, 2 * masked_lm.SIDE))
    target = rng.integers(0, classes, 64)
    network = masked_lm.Network(classes=classes)
    before = network.log_probabilities(around, target)
    assert np.allclose(before, [log_probability(network, a, t) for a, t in zip(around, target)], atol=1e-4)
    # A probability over all classes.
    every = network.log_probabilities(np.repeat(around[:1], classes, axis=0), np.arange(classes))
    assert np.exp(every).sum() == pytest.approx(1, abs=1e-4)
    gradient = network.gradient(around, target)
    loss = lambda flat: -np.mean([log_probability(masked_lm.Network(flat, classes), a, t) for a, t in zip(around, target)])
    for i in rng.choice(len(network.flat), 25, replace=False):
        step = np.zeros(len(network.flat), np.float32)
        step[i] = 1e-2
        assert gradient[i] == pytest.approx((loss(network.flat + step) - loss(network.flat - step)) / 2e-2, abs=2e-4)
    for _ in range(60):
        network.train(around, target, 0.2)
    assert network.log_probabilities(around, target).mean() > before.mean() + 0.5


def test_buckets_go_by_the_ending_of_a_word():
    texts = Texts(pa.array(["a ba cba dcba DCBA xcba a", "xba ba é"]))
    found = masked_lm.buckets_of(texts, texts.words(fold=True)).tolist()
    assert found[2] == found[3] == found[4] == found[5] and found[0] == found[6] and found[1] == found[8]
    assert len({found[0], found[1], found[2], found[7], found[9]}) == 5


def test_scores_of_a_table_match_a_plain_loop(documents):
    rng = random.Random(12)
    rows = [(i, prose(rng, rng.randint(0, 40))) for i in range(60)]
    docs = documents(rows)
    frequent = masked_lm.frequent_words(docs)
    network = masked_lm.Network()
    counts = Counter(w for _, t in rows for w in t.split())
    texts = Texts(pa.array([" ".join(counts)]))
    words = texts.words(fold=True)
    classes = {}
    for w, x, bucket in zip(counts, words.hashes, masked_lm.buckets_of(texts, words)):
        at = np.flatnonzero(frequent == x)
        classes[w] = int(at[0]) + 1 if len(at) else int(bucket) + masked_lm.class_count(frequent) - masked_lm.BUCKETS
    in_bucket = Counter()
    for w, n in counts.items():
        in_bucket[classes[w]] += n
    found = {r.doc_id: r for r in masked_lm.score(docs, network.flat, frequent).collect()}
    for i, t in rows:
        c = [0] * masked_lm.SIDE + [classes[w] for w in t.split()] + [0] * masked_lm.SIDE
        want = 0.0
        for k, w in enumerate(t.split()):
            around = c[k : k + masked_lm.SIDE] + c[k + masked_lm.SIDE + 1 : k + 2 * masked_lm.SIDE + 1]
            want += log_probability(network, around, classes[w]) + math.log(counts[w] / in_bucket[classes[w]])
        assert found[i].log_likelihood == pytest.approx(want, abs=1e-2) if t else found[i].n_tokens == 0


def test_masked_lm_learns_both_sides_and_scores_odd_rows(documents, odd):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        w = []
        for _ in range(60):
            a = rng.choice("abcd")
            w += [a, "mid" + a, "end" + a]
        rows.append((i, " ".join(w)))
    docs = documents(rows)
    frequent = masked_lm.frequent_words(docs)
    found = masked_lm.score(docs, masked_lm.train(docs, frequent, draw=1), frequent).collect()
    assert np.mean([r.mean_log_likelihood for r in found]) > -2.5
    frequent = masked_lm.frequent_words(odd)
    scored = {r.doc_id: r for r in masked_lm.score(odd, masked_lm.Network().flat, frequent).collect()}
    assert scored[1].n_tokens == scored[2].n_tokens == 0 and scored[1].mean_log_likelihood is None
    assert scored[5].n_tokens == 30_000 and scored[5].log_likelihood == pytest.approx(scored[6].log_likelihood)
    assert masked_lm.pseudo_likelihood(odd.limit(0)).count() == 0


def test_every_token_is_a_target_and_word_pairs_fall_to_all_rounds(documents):
    assert masked_lm.ROUNDS >= masked_lm.DRAW
    words = Texts(pa.array([" ".join(["one", "two"] * 200)] * 2 + ["", "x"])).words(fold=True)
    dealt = masked_lm.rounds_of(words, masked_lm.DRAW)
    assert len(dealt) == 801 and set(dealt.tolist()) == set(range(masked_lm.DRAW))
    assert all(0.3 < (dealt[k:800:2] == 0).mean() < 0.7 for k in (0, 1))
    rng = random.Random(5)
    rows = [(i, " ".join(x for _ in range(60) for x in rng.choice(["a mid b", "c mid d"]).split())) for i in range(150)]
    docs = documents(rows)
    found = masked_lm.pseudo_likelihood(docs).collect()
    assert np.mean([r.mean_log_likelihood for r in found]) > -2


def test_masked_lm_scores_the_word_within_its_bucket(documents):
    assert masked_lm.frequent_count(100_000) == 160 < masked_lm.frequent_count(1 << 24) < masked_lm.frequent_count(1 << 30)
    names = [f"rare{i}" for i in range(200)]
    texts = Texts(pa.array([" ".join(names)]))
    by = defaultdict(list)
    for name, bucket in zip(names, masked_lm.buckets_of(texts, texts.words(fold=True)).tolist()):
        by[bucket].append(name)
    often, once = next(v for v in by.values() if len(v) > 1)[:2]
    fillers = [f"filler{i}" for i in range(160)]
    rows = [(i, " ".join(fillers)) for i in range(20)]
    rows += [(100 + i, f"filler1 filler2 {often if i else once} filler3 filler4") for i in range(11)]
    docs = documents(rows)
    frequent = masked_lm.frequent_words(docs)
    for common in (masked_lm.COMMON, 1, 0):
        found = {r.doc_id: r for r in masked_lm.score(docs, masked_lm.Network().flat, frequent, common=common).collect()}
        assert len(found) == len(rows) and found[0].n_tokens == 160
        assert found[101].log_likelihood - found[100].log_likelihood == pytest.approx(math.log(10), abs=1e-3)


def test_surroundings_stay_within_texts():
    got = masked_lm.surroundings(np.array([1, 2, 3, 4]), np.array([0, 3, 3, 4]))
    assert got.tolist() == [[0, 0, 2, 3], [0, 1, 3, 0], [1, 2, 0, 0], [0, 0, 0, 0]]


def test_passage_quality_sample_holds_one_row_of_each_id(spark, documents):
    known = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    docs = documents([(i % 40, f"text {i} of a document") for i in range(400)])
    found = passage_quality.sampled(docs, known, "quality", 12).collect()
    assert 0 < len(found) == len({r.doc_id for r in found}) <= 12


def test_passage_quality_on_held_out_documents(spark, documents):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        parts = [prose(rng, 64) for _ in range(rng.randint(1, 4))]
        if bad:
            parts[rng.randrange(len(parts))] = " ".join(w + "$$" for w in prose(rng, 64).split())
        rows.append((i, " ".join(parts)))
        labels.append((i, int(not bad)))
    docs = documents(rows)
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    found = passage_quality.score(docs, passage_quality.fit(docs, table)).collect()
    held = [(r.predicted, dict(labels)[r.doc_id]) for r in found if r.held_out]
    assert 80 < len(held) < 200 and np.mean([a == b for a, b in held]) > 0.95


def test_passage_quality_odd_rows(spark, odd):
    labels = spark.createDataFrame([(2, 0), (5, 1), (5, 0), (None, 1), (6, None), (10, 1)], "doc_id long, quality int")
    found = passage_quality.score(odd, passage_quality.fit(odd, labels)).collect()
    assert len(found) == odd.count() and all(0 <= r.score <= 1 for r in found)
    none = passage_quality.score(odd, passage_quality.fit(odd, labels.limit(0))).collect()
    assert {r.score for r in none} == {0.5}
    assert passage_quality.score(odd.limit(0), None).count() == 0


def test_tokens_by_line_and_section(spark, documents, odd):
    encoder = token_counts.Encoder(open(token_counts.VOCABULARY, "rb").read())
    rows = [(1, "Hello wörld\n\nsecond  line\n"), (2, "漢字🙂 and ß\nx"), (3, ""), (4, None)]
    found = token_counts.tokens_by_line(documents(rows)).collect()
    counts = Counter()
    for r in found:
        counts[r.doc_id] += r.n_tokens
    assert dict(counts) == {i: len(encoder.inner.encode_ordinary(t or "")) for i, t in rows}
    assert [(r.section, r.first_char, r.end_char) for r in found if r.doc_id == 1] == [("0", 0, 12), ("1", 12, 13), ("2", 13, 26), ("3", 26, 26)]
    sections = spark.createDataFrame([(1, "head", 0, 3), (1, "tail", 3, 26), (2, None, None, 3)], "doc_id long, section string, first_char int, end_char int")
    by = {(r.doc_id, r.section): r.n_tokens for r in token_counts.tokens_by_section(documents(rows), sections).collect()}
    assert by[1, "head"] == 1 and by[1, "tail"] == counts[1] - 1 and by[2, None] == counts[2]
    assert token_counts.tokens_by_line(odd).agg(F.count_distinct("doc_id")).first()[0] == 11
    assert token_counts.tokens_by_line(odd.limit(0)).count() == 0


def test_allocation_matches_brute_force():
    rng = random.Random(8)
    for _ in range(300):
        cuts = sorted(rng.sample(range(40), 9))
        tokens = np.array([cuts[:-1], cuts[1:]])
        sections = sorted((a, a + rng.randint(0, 9)) for a in (rng.randrange(35) for _ in range(rng.randint(0, 5))))
        low, high = (np.array([s[i] for s in sections], np.int64) for i in (0, 1))
        got = token_counts.allocated(*tokens, low, high).tolist()
        for (a, b), where in zip(tokens.T.tolist(), got):
            held = [min(b, h) - max(a, x) for x, h in sections]
            best = max(held, default=0)
            assert where == (held.index(best) if best > 0 else -1)


def test_surroundings_of_some_places_are_those_of_all():
    classes, first = np.arange(1, 10), np.array([0, 3, 3, 4, 9])
    whole = masked_lm.surroundings(classes, first)
    assert whole[[0, 3, 8]].tolist() == [[0, 0, 2, 3], [0, 0, 0, 0], [7, 8, 0, 0]]
    some = np.array([1, 4, 7])
    assert (masked_lm.surroundings(classes, first, some) == whole[some]).all()
