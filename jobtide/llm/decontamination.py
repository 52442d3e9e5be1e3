"""Benchmark decontamination.

Method: an item of n words is compared with the windows of n words at every place of every document; a
document with fewer words than the item is one window.  Windows and items are condensed to SimHash
fingerprints of ``BITS`` bits of their five-word shingles, the second occurrence of a shingle in a window
counting as another feature, and so on.  At a weighted Jaccard similarity of 0.8 two fingerprints differ in
some 39 bits, with a standard deviation of 6.  All within Hamming radius ``RADIUS`` are found by
sixteen blocks of 16 bits: two fingerprints that differ in at most 63 bits have a block in which they
differ in at most three bits.  Every candidate is verified: the weighted Jaccard similarity of
the two bags of shingles, weighted by how often they occur, must reach 0.8.  An item whose parts were
moved, or that was edited or cut, so is one window like any other.

Before windows are condensed, those are put aside that cannot reach the similarity, as too few of their
shingles belong to any item of their size; that bound loses nothing.

Words are compared with A-Z lower-cased.

The benchmark is the stated query set.  It is cut into blocks of at most ``BLOCK_WORDS`` words, each
sent to the executors in turn, so what is broadcast is bounded whatever its size; documents are
never shuffled.

Nulls: null or empty texts and items match nothing; a null doc_id or item_id is reported as null.
A text or item of fewer than five words is compared by its whole word sequence, and only with equal
word counts.  Repeated rows are reported each.  Very long texts are read whole.  Ties: a document
and item are reported once, with the best similarity, at its first place.  Only doc_id and text are
read of documents, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.texts import Texts, map_texts, mix, sequence_hash

SHINGLE = 5
SIMILARITY = 0.8
BITS, BLOCKS = 256, 16
RADIUS = 63
#: Words of the benchmark in one broadcast block: some 10 MB with their shingles.
BLOCK_WORDS = 250_000
#: Windows that are condensed at a time.
STEP = 1 << 11


def features(shingles: np.ndarray) -> np.ndarray:
    """Shingles numbered by occurrence, so that a bag becomes a set."""
    order = np.argsort(shingles, kind="stable")
    ordered = shingles[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else order
    number = np.arange(len(ordered)) - np.repeat(first, np.diff(np.append(first, len(ordered))))
    out = np.empty_like(shingles)
    out[order] = np.where(number > 0, mix(ordered + number.astype(np.uint64) * _AGAIN), ordered)
    return out


_AGAIN = np.uint64(0xA24BAED4963EE407)
_SALTS = [np.uint64(0x9FB21C651E98DF25 * (2 * k + 1) % 2**64) for k in range(BITS // 64)]


def signs(values: np.ndarray) -> np.ndarray:
    """The bits of each feature, a row of ``BITS``."""
    parts = np.stack([mix(values ^ salt) for salt in _SALTS], axis=1)
    return np.unpackbits(np.ascontiguousarray(parts).view(np.uint8).reshape(len(values), -1), axis=1)


def condensed(totals: np.ndarray, counts: np.ndarray | int) -> np.ndarray:
    """Fingerprints from how many features have each bit: set if more than half have it."""
    return np.packbits(2 * totals > np.reshape(counts, (-1, 1)), axis=1).view(np.uint64)


def fingerprint(shingles: np.ndarray) -> np.ndarray:
    """The fingerprint of one bag of shingles, a row of 64-bit parts."""
    return condensed(signs(features(shingles)).sum(axis=0, dtype=np.int64)[None], len(shingles))


def fingerprints(shingles: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """Fingerprints of the ``count`` shingles from each start on; the starts ascend."""
    out = np.zeros((len(starts), BITS // 64), np.uint64)
    low = 0
    while low < len(starts):
        # Neighbouring windows share their sums.
        high = min(low + STEP, len(starts))
        apart = np.flatnonzero(np.diff(starts[low:high]) > count)
        high = low + int(apart[0]) + 1 if len(apart) else high
        base, top = int(starts[low]), int(starts[high - 1]) + count
        own = shingles[base:top]
        sums = np.zeros((len(own) + 1, BITS), np.int32)
        np.cumsum(signs(own), axis=0, out=sums[1:])
        at = starts[low:high] - base
        out[low:high] = condensed(sums[at + count] - sums[at], count)
        order = np.argsort(own, kind="stable")
        again = np.full(len(own), len(own) + count)
        same = own[order][1:] == own[order][:-1]
        again[order[:-1][same]] = order[1:][same]
        # The next place at which a shingle from here on comes again: windows that reach it are condensed alone.
        nearest = np.minimum.accumulate(again[::-1])[::-1]
        for k in np.flatnonzero(nearest[at] < at + count):
            out[low + k] = fingerprint(own[at[k] : at[k] + count])
        low = high
    return out


_MASKS = np.array([m for m in range(1 << 16) if m.bit_count() <= RADIUS // BLOCKS], np.uint16)


class Group:
    """Items of one size: their fingerprints, for each block the values near theirs, and their shingles."""

    def __init__(self, members: list[int], prints: np.ndarray, shingles: np.ndarray, count: int):
        self.members, self.prints, self.shingles, self.count = np.array(members), prints, shingles, count
        self.blocks = prints.view(np.uint16).reshape(len(prints), BLOCKS)
        near = np.zeros((BLOCKS, 1 << 16), bool)
        for b in range(BLOCKS):
            for value in np.unique(self.blocks[:, b]):
                near[b, value ^ _MASKS] = True
        self.near = np.packbits(near, axis=1)

    def candidates(self, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """All (window, member) whose fingerprints differ in at most ``radius`` bits."""
        found = set()
        values = prints.view(np.uint16).reshape(len(prints), BLOCKS)
        for b in range(BLOCKS):
            own = values[:, b]
            hit = np.flatnonzero((self.near[b, own >> 3] >> (7 - (own & 7)).astype(np.uint8)) & 1)
            for low in range(0, len(hit), STEP):
                part = hit[low : low + STEP]
                meets = np.bitwise_count(own[part, None] ^ self.blocks[None, :, b]) <= RADIUS // BLOCKS
                window, member = np.nonzero(meets)
                window = part[window]
                apart = np.bitwise_count(prints[window] ^ self.prints[member]).sum(axis=1)
                close = apart <= radius
                found.update(zip(window[close].tolist(), member[close].tolist()))
        pairs = np.array(sorted(found), np.int64).reshape(-1, 2)
        return pairs[:, 0], pairs[:, 1]


class Index:
    """Items by size, with tables of the blocks of their fingerprints."""

    def __init__(self, ids: list, texts: list[str], radius: int = RADIUS):
        if not 0 <= radius <= RADIUS:
            raise ValueError(f"the blocks guarantee a radius of at most {RADIUS}")
        words = Texts(pa.array(texts, pa.large_string())).words(fold=True)
        self.ids, self.radius = ids, radius
        self.items = [words.hashes[words.first[k] : words.first[k + 1]] for k in range(len(ids))]
        self.bags = [bag(x) for x in self.items]
        by_size: dict[int, list[int]] = {}
        for k, item in enumerate(self.items):
            if len(item):
                by_size.setdefault(len(item), []).append(k)
        self.sizes = {}
        for size, members in sorted(by_size.items()):
            own = [shingles_of(self.items[k]) for k in members]
            prints = np.concatenate([fingerprint(x) for x in own])
            self.sizes[size] = Group(members, prints, np.unique(np.concatenate(own)), len(own[0]))
        #: All shingles of the items, by the words in a shingle.
        self.shingles = {}
        for size, group in self.sizes.items():
            width = min(size, SHINGLE)
            self.shingles[width] = np.union1d(self.shingles.get(width, group.shingles[:0]), group.shingles)


def shingles_of(words: np.ndarray) -> np.ndarray:
    """The shingles of a word sequence; of fewer than five words the whole sequence."""
    size = min(len(words), SHINGLE)
    return sequence_hash([words[k : len(words) - size + 1 + k] for k in range(size)])


def least_shared(own: int, other: int, threshold: float) -> int:
    """How many shingles two bags of these sizes share at least, if they are as similar as the threshold."""
    return max(1, int(np.ceil(threshold * (own + other) / (1 + threshold) - 1e-9)))


def bag(words: np.ndarray) -> dict[int, int]:
    """How often each shingle occurs in a word sequence."""
    if not len(words):
        return {}
    keys, n = np.unique(shingles_of(words), return_counts=True)
    return dict(zip(keys.tolist(), n.tolist()))


def similarity(a: dict[int, int], b: dict[int, int]) -> float:
    """Weighted Jaccard similarity of two bags."""
    shared = sum(min(n, b[k]) for k, n in a.items() if k in b)
    total = sum(a.values()) + sum(b.values()) - shared
    return shared / total if total else 0.0


def _held(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return sorted_keys[at] == keys


def _search(texts: Texts, index: Index, threshold: float) -> list[tuple]:
    """(document, item, similarity, first word, words) of the best verified window of each pair."""
    words = texts.words(fold=True)
    total, counts = len(words.hashes), words.counts()
    last = np.repeat(words.first[1:], counts)
    best: dict[tuple[int, int], tuple] = {}

    def verify(starts, sizes, members, group):
        for at, n, member in zip(starts.tolist(), sizes.tolist(), members.tolist()):
            item = int(group.members[member])
            found = similarity(index.bags[item], bag(words.hashes[at : at + n]))
            if found >= threshold:
                document = int(np.searchsorted(words.first, at, "right")) - 1
                key, value = (document, item), (-found, at - int(words.first[document]), n)
                best[key] = min(best.get(key, value), value)

    for width, known in index.shingles.items():
        shingles, whole = words.windows(width)
        met = np.flatnonzero(whole)
        met = met[_held(known, shingles[met])]
        if not len(met):
            continue
        for size, group in index.sizes.items():
            if min(size, SHINGLE) != width:
                continue
            own = met[_held(group.shingles, shingles[met])]
            if not len(own):
                continue
            hits = np.zeros(total + 1, np.int32)
            hits[own + 1] = 1
            np.cumsum(hits, out=hits)
            need = least_shared(group.count, group.count, threshold)
            if len(own) >= need and total >= size:
                starts = np.flatnonzero(hits[group.count : total + 1] - hits[: total + 1 - group.count] >= need)
                starts = starts[starts + size <= last[starts]]
                if len(starts):
                    windows, members = group.candidates(fingerprints(shingles, starts, group.count), index.radius)
                    verify(starts[windows], np.full(len(windows), size), members, group)
            # Documents with fewer words than the item, but enough of its shingles.
            held = hits[words.first[1:]] - hits[words.first[:-1]]
            for document in np.flatnonzero((counts < size) & (held > 0)).tolist():
                low, n = int(words.first[document]), int(counts[document])
                count = n - width + 1
                if count > 0 and held[document] >= least_shared(count, group.count, threshold):
                    _, members = group.candidates(fingerprint(shingles[low : low + count]), index.radius)
                    verify(np.full(len(members), low), np.full(len(members), n), members, group)
    return [(d, i, -s, at, n) for (d, i), (s, at, n) in best.items()]


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[tuple[list, list[str]]]:
    """The items in blocks of at most so many words (one longer item is a block), read one by one."""
    sized = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    block, size = ([], []), 0
    for r in sized.orderBy("item_id", "text").toLocalIterator():
        n = r["text"].count(" ") + 1
        if block[0] and size + n > block_words:
            yield block
            block, size = ([], []), 0
        block[0].append(r["item_id"])
        block[1].append(r["text"])
        size += n
    if block[0]:
        yield block


SCHEMA = "doc_id long, item_id long, similarity double, first_word long, n_words long"


def contaminated(
    docs: DataFrame, benchmark: DataFrame, threshold: float = SIMILARITY, radius: int = RADIUS,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words) for every document that holds an item.

    One row per document row and item: the most similar place, the first one of equals.
    """
    spark = docs.sparkSession
    found = None
    for ids, texts in _blocks(benchmark, block_words):
        sent = spark.sparkContext.broadcast(Index(ids, texts, radius))

        def run(rows, texts, sent=sent):
            index = sent.value
            hits = _search(texts, index, threshold)
            doc_ids = rows.column(rows.schema.get_field_index("doc_id")).to_pylist()
            columns = list(zip(*hits)) or [()] * 5
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([doc_ids[d] for d in columns[0]], pa.int64()),
                    pa.array([index.ids[i] for i in columns[1]], pa.int64()),
                    pa.array(columns[2], pa.float64()), pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int64()),
                ],
                ["doc_id", "item_id", "similarity", "first_word", "n_words"],
            )

        part = map_texts(docs.select("doc_id", "text"), run, SCHEMA)
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], SCHEMA) if found is None else found


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, threshold: float = SIMILARITY, radius: int = RADIUS,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """All columns of the documents that hold no item; documents are judged row by row, unshuffled."""
    spark = docs.sparkSession
    kept = docs
    for ids, texts in _blocks(benchmark, block_words):
        sent = spark.sparkContext.broadcast(Index(ids, texts, radius))

        def run(rows, texts, sent=sent):
            clean = np.ones(rows.num_rows, bool)
            for hit in _search(texts, sent.value, threshold):
                clean[hit[0]] = False
            return rows.filter(pa.array(clean))

        kept = map_texts(kept, run, kept.schema)
    return kept
