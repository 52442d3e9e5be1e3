"""Mixing, chat formatting, license scan and the pipeline."""

from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from jobtide.llm import chat_format, license_scan, mixing


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.integers(0, 2**62))
def test_permutation(n, key):
    x, size, keys = np.arange(n), np.full(n, n), np.full(n, key)
    there = mixing.permuted(x, size, keys)
    assert sorted(there.tolist()) == x.tolist()
    assert mixing.permuted(there, size, keys, back=True).tolist() == x.tolist()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 500), min_size=1, max_size=9))
def test_targets(sizes):
    weights = mixing.repeating()(sizes)
    found = mixing.target_sizes(sizes, weights)
    assert abs(sum(found) - 1.5 * sum(sizes)) < 1e-6
    assert all(t <= 2 * s + 1e-9 for t, s in zip(found, sizes))
    free = [t / w for t, s, w in zip(found, sizes, weights) if t < 2 * s - 1e-9]
    assert all(abs(x - free[0]) < 1e-6 for x in free)


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 300), st.floats(0, 2), st.integers(1, 9))
def test_slots_take_the_target(size, times, block):
    target = size * times
    slots, last = mixing.slots_needed(3, size, target, block, 7)
    blocks = -(-size // block)
    taken = 0
    for k in range(slots):
        turn, index = divmod(k, blocks)
        b = int(mixing.permuted(np.array([index]), np.array([blocks]), mixing.pass_key(np.array([3]), np.array([turn]), 7))[0])
        words = min(block, size - b * block)
        taken += min(words, last) if k == slots - 1 else words
    assert taken == int(target)


def test_multinomial_shards_meet_the_quotas():
    rows = mixing.draw_shards([500, 0, 70, 9], 64, 1)
    total, by_shard = Counter(), Counter()
    for shard, source, first, n in rows:
        assert first == total[source]
        total[source] += n
        by_shard[shard] += n
    assert dict(total) == {0: 500, 2: 70, 3: 9} and all(n <= 64 for n in by_shard.values())


def test_mix_counts_and_texts_agree(documents, odd):
    rows = [(i, " ".join(f"d{i}w{j}" for j in range((i * 37) % 150)), "en", [None, "b", "a", "ä"][i % 4]) for i in range(80)]
    docs = documents(rows + rows[:3])
    counts = mixing.mix_counts(docs, block_words=8, shard_slots=32).collect()
    assert len(counts) == 83
    taken, targets = Counter(), {}
    source = {r[0]: r[3] for r in rows}
    for r in counts:
        assert r.taken <= 2 * r.size
        taken[source[r.doc_id]] += r.taken
        targets[source[r.doc_id]] = r.target
    assert {k: int(v) for k, v in targets.items()} == dict(taken)
    parts = mixing.mix(docs, block_words=8, shard_slots=32).collect()
    words = Counter()
    for p in parts:
        assert p.text.split() == [f"d{p.doc_id}w{j}" for j in range(p.first_word, p.first_word + p.n_words)]
        words[p.doc_id] += p.n_words
    by_doc = Counter()
    for r in counts:
        by_doc[r.doc_id] += r.taken
    assert +words == +by_doc
    again = mixing.mix_counts(documents(rows + rows[:3], 7), block_words=8, shard_slots=32).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, counts))
    found = mixing.mix_counts(odd)
    assert found.count() == odd.count() and found.where("size = 0 and taken > 0").count() == 0
    assert mixing.mix(odd).count() > 0
    assert mixing.mix_counts(odd.limit(0)).count() == 0 and mixing.mix(odd.limit(0)).count() == 0


TEXTS = ["", None, "plain", "<turn user>\nx</turn>\n", r"<\turn", r"<\\/turn> <image 1/> <", "<part/>", "é🙂\n\n", "turn>", "a</turn>\n" * 3]


def test_chat_round_trip(spark):
    rows = [(c, t, ["user", "assistant", "a>%\n<b", None][t % 4], x) for c in range(4) for t, x in enumerate(TEXTS[c:])]
    rows += [(None, None, None, None), (9, 1, "assistant", "same"), (9, 1, "assistant", "same")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    made = chat_format.format_chat(turns)
    found = made.select("conv_id", chat_format.turns_of(F.col("formatted")).alias("t"), chat_format.loss_text(F.col("formatted"), F.col("loss")).alias("l"))
    expected = defaultdict(list)
    for c, t, role, text in rows:
        expected[c].append((t, role or "", text or ""))
    for r in found.collect():
        own = sorted(expected.pop(r.conv_id), key=lambda x: (x[0] or 0, x[1:]))
        assert [(x.role, x.text) for x in r.t] == [x[1:] for x in own]
        assert r.l == "".join(x[2] for x in own if x[1] == "assistant")
    assert not expected
    assert chat_format.format_chat(turns.limit(0)).count() == 0


def test_chat_parts_in_order(spark):
    p = lambda kind, text=None, ref=None, w=None, h=None, s=None, n=None: (kind, text, ref, w, h, s, n)
    rows = [
        (1, 0, "user", [p("text", "<"), p("text", "turn x>"), p("image", None, "i.png", 28, 15), p("text", "<image 1/>")]),
        (1, 1, "assistant", [p("audio", None, "a.wav", s=2.5), p("document", None, "d.pdf"), p("document", None, None, n=2)]),
        (1, 2, "user", None),
    ]
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat_format.PARTS}")
    r = chat_format.format_chat(turns).first()
    assert r.formatted == (
        "<turn user>\n<<part/>turn x><image 1/><\\image 1/></turn>\n"
        "<turn assistant>\n<audio 2/><document 3/><document 4/></turn>\n<turn user>\n</turn>\n"
    )
    assert [tuple(a) for a in r.attachments] == [
        (1, "image", "i.png", 4), (2, "audio", "a.wav", 63), (3, "document", "d.pdf", 256), (4, "document", None, 1024)
    ]
    assert r.formatted[r.loss[0].start : r.loss[0].end] == "<audio 2/><document 3/><document 4/>"


def dice(a, b):
    shared = sum((a & b).values())
    return 2 * shared / (sum(a.values()) + sum(b.values()))


def test_license_scan_matches_brute_force(documents, odd):
    import random
    import re

    rng = random.Random(7)
    templates = license_scan.TEMPLATES
    words = lambda t: re.findall("[a-z0-9]+", t.lower())
    bag = lambda t: Counter(zip(words(t), words(t)[1:]))
    rows = []
    for i in range(150):
        lines = []
        for _ in range(rng.randint(0, 4)):
            w = rng.choice(list(templates.values())).split()
            for _ in range(rng.choice([0, 1, 2, 4])):
                w[rng.randrange(len(w))] = rng.choice(["the", "of", "Zebra"])
            lines.append("  ".join(w).upper() if rng.random() < 0.3 else rng.choice([" ", "\n"]).join(w))
        rows.append((i, rng.choice(["\n", "\n\n"]).join(lines)))
    expected = set()
    for i, text in rows:
        units = [("line", k, x) for k, x in enumerate(text.split("\n"))]
        units += [("paragraph", k, x) for k, x in enumerate(re.split(r"\n[ \t\r]*\n", text)) if "\n" in x]
        for kind, k, x in units:
            if len(words(x)) > 1:
                best = max(((dice(bag(x), bag(t)), [-ord(c) for c in n], n) for n, t in templates.items()))
                if best[0] >= 0.8:
                    ties = sorted(n for n, t in templates.items() if dice(bag(x), bag(t)) == best[0])
                    expected.add((i, kind, k, ties[0], round(best[0], 9)))
    found = license_scan.scan(documents(rows)).collect()
    assert {(r.doc_id, r.kind, r.number, r.template, round(r.dice, 9)) for r in found} == expected
    assert len(expected) > 100
    assert license_scan.scan(odd).count() == 0 and license_scan.scan(odd.limit(0)).count() == 0


def test_native_operators_use_no_python(spark, odd):
    turns = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    for df in (license_scan.scan(odd), chat_format.format_chat(turns)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "NestedLoop", "Cartesian"))


def test_pipeline_stages(spark, documents, odd, tmp_path):
    import random

    rng = random.Random(9)
    prose = lambda n: " ".join("".join(rng.choice(["la", "re", "mi", "to"]) for _ in range(3)) for _ in range(n))
    rows = [(i, prose(60) + "\n" + prose(40), "en", "ab"[i % 2]) for i in range(120)]
    item, boiler = prose(30), prose(55)
    rows += [(200, rows[3][1]), (201, rows[4][1].replace("lalala", "lalami", 1)), (202, prose(40) + "\n" + item + " " + prose(20))]
    rows += [(210 + i, prose(50) + "\n" + boiler) for i in range(5)] + [(300, "short"), (301, None)]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = documents(rows).withColumn("kept", F.lit(7))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, str(tmp_path)).cache()
        seen[name] = {r.doc_id: r.text for r in docs.collect()} if name != "mixing sources" else docs.collect()
        if name != "mixing sources":
            assert docs.columns == before.columns
    ids = {r[0] for r in rows}
    assert ids - set(seen["quality rules"]) >= {300, 301} and len(ids - set(seen["quality rules"])) <= 6
    after = seen["line dedup"]
    assert 200 not in after and sum(boiler in t for t in after.values()) == 1
    assert not {200, 201} & set(seen["MinHash near-dedup"])
    assert set(seen["MinHash near-dedup"]) - set(seen["benchmark decontamination"]) == {202}
    assert {r.doc_id for r in seen["mixing sources"]} <= set(seen["benchmark decontamination"])
    for stage in corpus_pipeline.STAGES:
        stage[1](spark, odd, str(tmp_path)).count()
        stage[1](spark, odd.limit(0), str(tmp_path)).count()


def test_queries_are_all_there():
    from jobtide.llm import queries

    assert set(queries.SQL) <= set(queries.QUERIES) and len(queries.QUERIES) == 14
