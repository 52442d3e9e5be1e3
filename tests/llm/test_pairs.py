"""Near-duplicates, line dedup and decontamination against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from jobtide.llm import components, decontamination, line_dedup, near_duplicates
from jobtide.llm.texts import Texts


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def shingle_set(text, k):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def grouped(ids, linked):
    parent = {i: i for i in ids}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and linked(a, b) and top(a) != top(b):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {i: top(i) for i in ids}


@pytest.mark.parametrize(("shingle", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_match_brute_force(documents, shingle, percent):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    rows, base = [], [[rng.choice(vocabulary) for _ in range(rng.randint(1, 90))] for _ in range(12)]
    for i in range(160):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        rows.append((i, rng.choice([" ", "\n", "  "]).join(w).title()))
    sets = {i: shingle_set(t, shingle) for i, t in rows}

    def linked(a, b):
        both = len(sets[a] & sets[b])
        return both and 100 * both >= percent * (len(sets[a] | sets[b]))

    top = grouped(list(sets), linked)
    found = near_duplicates.near_duplicates(documents(rows), shingle, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == {
        i: (len(sets[i]), top[i], top[i] == i) for i in sets
    }
    assert len(set(top.values())) < len(sets) - 20


def test_near_duplicates_odd_rows(spark, odd):
    found = near_duplicates.near_duplicates(odd, 3, 85).collect()
    assert len(found) == odd.count()
    own = {(r.doc_id, r.component_id, r.kept) for r in found}
    assert {(None, None, True), (1, 1, True), (2, 2, True), (6, 5, False), (11, 10, False)} <= own
    assert near_duplicates.near_duplicates(odd.limit(0)).count() == 0
    kept = near_duplicates.without_copies(odd)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect())[6] == 0


def test_without_copies_tells_rows_by_doc_id_and_text(documents):
    rng = random.Random(9)
    text = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(40))
    a, b, c, d, e = (text() for _ in range(5))
    rows = [(1, a), (1, a), (1, a), (2, b), (3, b), (3, c), (4, d), (4, d.upper()), (5, e), (5, a), (6, ""), (6, "")]
    found = Counter((r.doc_id, r.text) for r in near_duplicates.without_copies(documents(rows)).collect())
    fours = [k for k in found if k[0] == 4]
    assert len(fours) == 1 and fours[0][1].lower() == d
    assert found == Counter([(1, a), (2, b), (3, c), (5, e), (6, ""), *fours])


def test_bayes_keeps_pairs_at_the_threshold():
    least = near_duplicates.least_matches(256, 80)
    rng = np.random.default_rng(1)
    seen = rng.random((4000, 256)) < 0.8 + 0.2 / 256
    total = seen.cumsum(axis=1)
    at = np.arange(16, 257, 16)
    assert (total[:, at - 1] >= least[at]).all(axis=1).mean() > 0.999
    assert least[256] > 256 * 0.6


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5000, 4000), (4000, 4500)]
    rows = components.components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    label = {r.node: r.label for r in rows}
    assert len(rows) == len(label) == 201 + 50 + 3
    assert len({label[i] for i in range(201)}) == len({label[1000 + i] for i in range(50)}) == 1
    assert len({label[5000], label[4000], label[4500]}) == 1 and len(set(label.values())) == 3
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_components_of_a_chain_in_few_rounds(spark, monkeypatch):
    made, written = [], components.written
    monkeypatch.setattr(components, "written", lambda df, name: made.append(name) or written(df, name))
    ids = np.random.default_rng(3).permutation(3000).tolist()
    links = spark.createDataFrame(list(zip(ids, ids[1:])), "a long, b long").coalesce(1)
    rows = components.components(links, "a", "b").collect()
    assert len(rows) == 3000 and len({r.label for r in rows}) == 1
    assert made.count("cc-points") <= 2


def test_further_links_join_labels(spark):
    labels = spark.createDataFrame([(1, 1), (2, 1), (5, 5), (6, 5), (8, 8), (9, 8)], "node long, label long")
    links = spark.createDataFrame([(2, 6), (6, 7), (10, 11), (1, 2)], "a long, b long")
    rows = near_duplicates._joined(labels, links).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r.label, set()).add(r.node)
    assert len(rows) == 9 and sorted(map(sorted, groups.values())) == [[1, 2, 5, 6, 7], [8, 9], [10, 11]]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def mutated(rng, text, edits, letters):
    text = list(text)
    for _ in range(edits):
        k, way = rng.randrange(len(text)), rng.random()
        if way < 0.34:
            text[k] = rng.choice(letters)
        elif way < 0.67:
            del text[k]
        else:
            text.insert(k, rng.choice(letters))
    return "".join(text)


def test_banded_distance():
    rng, pairs = random.Random(1), []
    for _ in range(600):
        a = "".join(rng.choice("ab é") for _ in range(rng.randint(6, 30)))
        pairs.append((a, mutated(rng, a, rng.randint(0, 4), "abé漢")))
    for d in (0, 1, 2, 3):
        some = [(a, b) for a, b in pairs if abs(len(a) - len(b)) <= d and min(len(a), len(b)) > d]
        points = [[np.array([ord(c) for c in x], np.uint32) for x in side] for side in zip(*some)]
        assert line_dedup.within(*points, d).tolist() == [distance(a, b) <= d for a, b in some]


@pytest.mark.parametrize("limit", [0, 1, 2, 3])
def test_line_dedup_matches_brute_force(documents, limit):
    rng = random.Random(limit)
    base = ["".join(rng.choice("abcdefgé ") for _ in range(rng.randint(20, 34))) for _ in range(25)]
    rows = []
    for i in range(70):
        rows.append((i, "\n".join(mutated(rng, rng.choice(base), rng.choice([0, 0, 1, 2, 3]), "xyz") for _ in range(rng.randint(0, 4)))))
    lines = [(i, k, x) for i, t in rows for k, x in enumerate(t.split("\n")) if len(x) >= 20]
    distinct = sorted({x for *_, x in lines})
    top = grouped(distinct, lambda a, b: abs(len(a) - len(b)) <= limit and distance(a, b) <= limit)
    first = {}
    for i, k, x in lines:
        first.setdefault(top[x], (i, k))
    expected = {(i, k): first[top[x]] for i, k, x in lines if first[top[x]] != (i, k)}
    found = line_dedup.repeated_lines(documents(rows), limit).collect()
    assert {(r.doc_id, r.number): (r.kept_doc_id, r.kept_number) for r in found} == expected
    texts = {r.doc_id: r.text for r in line_dedup.without_repeats(documents(rows), limit).collect()}
    for i, t in rows:
        assert texts[i] == "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in expected)


def test_line_dedup_odd_rows(odd):
    found = {(r.doc_id, r.source): r for r in line_dedup.without_repeats(odd).collect()}
    assert line_dedup.without_repeats(odd).count() == odd.count()
    assert found[7, "a"].text == "same line of twenty and more\n" and len(found[7, "a"].removed) == 39
    assert found[1, "a"].text is None and found[2, "a"].text == "" and found[6, "b"].text == ""
    assert found[None, None].removed == [] and found[5, "b"].n_words == "extra"
    assert line_dedup.without_repeats(odd.limit(0)).count() == 0


def test_decontamination_matches_brute_force(spark, documents):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(text(rng.choice([6, 9, 14, 25, 40, 70])))) for i in range(40)]
    rows = []
    for i in range(150):
        w = text(rng.randint(0, 120))
        if i % 3 == 0:
            own = rng.choice(items)[1].upper().split()
            for _ in range(rng.choice([0, 0, 1])):
                own[rng.randrange(len(own))] = "changed"
            at = rng.randint(0, len(w))
            w[at:at] = own
        rows.append((i, " ".join(w)))
    bag = lambda w: Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    expected = {}
    for i, t in rows:
        w = words(t)
        for j, q in items:
            v = words(q)
            best = max((near(bag(w[k : k + len(v)]), bag(v)) for k in range(len(w) - len(v) + 1)), default=0)
            if best >= 0.8:
                expected[i, j] = round(best, 9)
    table = spark.createDataFrame(items, "item_id long, text string")
    for block in (10**6, 100):
        found = decontamination.contaminated(documents(rows), table, block_words=block).collect()
        assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in found} == expected
    assert len(expected) > 25
    clean = decontamination.decontaminated(documents(rows), table, block_words=100)
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in rows} - {i for i, _ in expected}


def near(a, b):
    shared = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - shared
    return shared / total if total else 0


def test_edited_items_at_the_threshold_are_found():
    rng = random.Random(8)
    items = [[f"w{rng.randrange(5000)}" for _ in range(rng.randint(12, 260))] for _ in range(60)]
    index = decontamination.Index(list(range(60)), [" ".join(x) for x in items])
    held = 0
    for k, item in enumerate(items * 8):
        w = list(item)
        for _ in range(rng.randint(0, 1 + len(w) // 45)):
            at = rng.randrange(len(w))
            w[at : at + rng.randint(0, 1)] = ["changed"] * rng.randint(0, 1)
        before = [f"b{i}" for i in range(rng.randint(0, 30))]
        text = Texts(pa.array([" ".join([*before, *w, *(f"a{i}" for i in range(20))])], pa.large_string()))
        own, seen = index.bags[k % 60], text.words(fold=True).hashes
        n = len(item)
        best = max(decontamination.similarity(own, decontamination.bag(seen[i : i + n])) for i in range(len(seen) - n + 1))
        found = {hit[1]: hit[2] for hit in decontamination._search(text, index, 0.8)}
        assert (k % 60 in found) == (best >= 0.8)
        held += 0.8 <= best < 1
    assert held > 100


def test_items_cut_by_the_edge_of_a_document_are_found():
    rng = random.Random(10)
    text = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    item, other = text(60), text(40)
    index = decontamination.Index([1], [" ".join(item)])
    cases = [
        (item[5:] + other, 0, 60), (other + item[:-5], 35, 60), (item[:30] + item[31:], 0, 59),
        (item[:-6], 0, 54), (item[6:], 0, 54),
    ]
    for w, first, n in cases:
        hits = decontamination._search(Texts(pa.array([" ".join(text(50)), " ".join(w)], pa.large_string())), index, 0.8)
        best = near(Counter(zip(*(item[k:] for k in range(5)))), Counter(zip(*(w[first : first + n][k:] for k in range(5)))))
        assert best >= 0.8 and hits == [(1, 0, pytest.approx(best), first, n)]
    assert not decontamination._search(Texts(pa.array([" ".join(item[:-14])], pa.large_string())), index, 0.8)


def test_multi_index_finds_all_within_the_radius():
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{rng.integers(1000)}" for _ in range(30)) for _ in range(20)]
    group = decontamination.Index(list(range(20)), texts).sizes[30]
    own = group.prints
    prints = np.concatenate([own, own, own, rng.integers(0, 2**63, (500, 4)).astype(np.uint64)])
    for k in range(3 * len(own)):
        for bit in rng.choice(256, rng.integers(40, 75), replace=False):
            prints[k, bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
    for radius in (63, 50):
        got = set(zip(*(x.tolist() for x in group.candidates(prints, radius))))
        apart = np.bitwise_count(prints[:, None] ^ own[None]).sum(axis=2)
        assert got == set(zip(*(x.tolist() for x in np.nonzero(apart <= radius)))) and len(got) > 5


def test_fingerprints_of_windows_are_those_of_their_bags():
    rng = np.random.default_rng(7)
    shingles = rng.integers(0, 12, 300).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    shingles[100:180] = rng.integers(0, 2**62, 80).astype(np.uint64)
    starts = np.array([0, 1, 2, 50, 101, 102, 140, 150, 250])
    found = decontamination.fingerprints(shingles, starts, 40)
    for row, at in zip(found, starts):
        assert (row == decontamination.fingerprint(shingles[at : at + 40])[0]).all()


@pytest.mark.parametrize("form", ["halves", "thirds", "insert", "replace", "repeated", "cut"])
def test_moved_and_edited_items_are_found_whenever_similar(form):
    """Every item-sized window at 0.8 or more, by brute force over all starts."""
    rng = random.Random(form)
    items = [[f"w{rng.randrange(3000)}" for _ in range(rng.randint(30, 150))] for _ in range(50)]
    index = decontamination.Index(list(range(50)), [" ".join(x) for x in items])
    held = 0
    for k, item in enumerate(items):
        n = len(item)
        if form == "halves":
            w = item[n // 2 :] + item[: n // 2]
        elif form == "thirds":
            w = item[n // 3 : 2 * n // 3] + item[: n // 3] + item[2 * n // 3 :]
        elif form == "insert":
            at = rng.randrange(n)
            w = item[:at] + [f"x{i}" for i in range(rng.randint(1, n // 12))] + item[at:]
        elif form == "replace":
            w = list(item)
            w[rng.randrange(n)] = "changed"
        elif form == "repeated":
            size = max(1, n // 30)
            at = rng.randrange(n - size)
            w = item[:at] + ["the"] * size + item[at + size :]
        else:
            w = item[rng.randint(0, n // 10) :]
        whole = [f"b{i}" for i in range(rng.randint(0, 40))] + w + [f"a{i}" for i in range(rng.randint(n // 8, 60))]
        text = Texts(pa.array([" ".join(whole)], pa.large_string()))
        seen, own = text.words(fold=True).hashes, index.bags[k]
        best = max(decontamination.similarity(own, decontamination.bag(seen[i : i + n])) for i in range(len(seen) - n + 1))
        found = {hit[1]: hit[2] for hit in decontamination._search(text, index, 0.8)}
        assert found.get(k) == (pytest.approx(best) if best >= 0.8 else None)
        held += best >= 0.8
    assert held >= 20


def test_decontamination_odd_rows(spark, odd):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "one two three"), (None, "x")], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontamination.contaminated(odd, items).collect()}
    assert found == {(10, 3), (11, 3), (4, None)}
    assert decontamination.contaminated(odd, items.limit(0)).count() == 0
    assert decontamination.contaminated(odd.limit(0), items).count() == 0
    assert decontamination.decontaminated(odd, items).columns == odd.columns
