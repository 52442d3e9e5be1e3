import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from jobtide.llm import bloom, quality_rules, texts

ANY = st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\t#é漢", max_size=40)), max_size=6)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@settings(max_examples=150, deadline=None)
@given(ANY, st.integers(0, 3))
def test_words_lines_and_shingles(rows, skip):
    column = pa.array([None, "zz z", "q"] + rows, pa.string())[skip:]
    rows = column.to_pylist()
    found = texts.Texts(column)
    got = found.words()
    assert got.counts().tolist() == [len(words(t)) for t in rows]
    flat = [w for t in rows for w in words(t)]
    assert len(set(zip(flat, got.hashes.tolist()))) == len(set(flat)) == len(set(got.hashes.tolist()))
    start, end, first = found.lines()
    lines = [found.data[a:b].tobytes().decode() for a, b in zip(start, end)]
    assert [lines[a:b] for a, b in zip(first[:-1], first[1:])] == [(t or "").split("\n") for t in rows]
    hashes, first = got.shingles(3)
    expected = []
    for t in rows:
        w = words(t)
        expected.append([tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else [])
    assert np.diff(first).tolist() == [len(x) for x in expected]
    flat = [s for x in expected for s in x]
    assert len(set(zip(flat, hashes.tolist()))) == len(set(flat)) == len(set(hashes.tolist()))


@settings(max_examples=150, deadline=None)
@given(ANY)
def test_base_figures_match_plain_counts(rows):
    column = pa.array(["a b a b a b a b a b a b"] + rows, pa.string())
    got = quality_rules.base_figures(texts.Texts(column))
    for k, text in enumerate(column.to_pylist()):
        w, lines = words(text), [x for x in (text or "").split("\n") if words(x)]
        windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        covered = {j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(i, i + 5)}
        assert [int(got[n][k]) for n in quality_rules.BASE] == [
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)
        ]


def test_pieces_cover_long_and_short_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 3_000_000, "", None, "b" * 700_000, "c" * 700_000])], ["text"])
    parts = list(texts.pieces(batch))
    assert sum(p.num_rows for p in parts) == 5 and len(parts) > 2
    assert [x for p in parts for x in p.column(0).to_pylist()] == batch.column(0).to_pylist()


def test_whole_groups_across_batches():
    rows = [1, 1, 2, 3, 3, 3, 3, 4]
    batches = [pa.RecordBatch.from_arrays([pa.array(rows[i : i + 2])], ["k"]) for i in range(0, 8, 2)]
    found = []
    for table, edges in texts.whole_groups(iter(batches), ["k"]):
        found += [table.column("k").to_pylist()[a:b] for a, b in zip(edges[:-1], edges[1:])]
    assert found == [[1, 1], [2], [3, 3, 3, 3], [4]]


def test_bitmap_never_misses(spark):
    values = np.array([0, 1, 63, 64, -1, -2**62, 2**62 + 5])
    bits = bloom.bitmap(spark.createDataFrame([(int(v),) for v in values], "x long"), "x")
    assert bloom.may_hold(bits, values).all()
    assert not bloom.may_hold(bits, np.array([7, 100])).any()
