"""Quality rules: base rules and language-specific perplexity bands.

Method: a modified Kneser-Ney model over characters (code points; none are put together).  Spark counts
the four-grams of every document that passes the base rules, per language.  A document is scored with
the model of its language without the document's own counts, as else n-grams that it alone has would
vouch for it; discounts stay those of all counts.  For a language of at most ``MAX_GRAMS`` four-grams one
task turns the counts into arrays of sorted n-gram hashes.  Those of the ``MAX_LANGUAGES`` commonest, up to
``MAX_GRAMS`` four-grams together, are sent to all tasks; documents of other languages are dealt into parts
that each get the one model they need.  Of a larger model, as scripts with thousands of characters have,
joins bring to each part the counts of the n-grams it holds, so no task needs the whole.  The band of a
language is the median of its documents' mean surprisal, plus and minus ``width`` times a deviation that
is wider for short documents; documents below or above their band are rejected.

Nulls: a null text counts as empty and fails the base rules; a null language is a language of its
own.  Ties and repeated rows: rows are judged one by one, equal rows alike.  Other columns pass
through, except that a column named like an output column is replaced.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from jobtide.llm.scratch import written
from jobtide.llm.texts import (
    SPACE, Texts, map_texts, mix, pieces, range_hash, release, small_batches, sums_by, with_columns,
)

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RESULT = BASE + ["base_failed", "surprisal", "kept"]
WINDOW = 5
ORDER = 4
#: Bits of a character.  The last three of an n-gram fill the 63 bits of a long, the first one is a value of its own.
CHARACTER = 21
#: Stands before the first character of a text; no code point.
START = 0x110000
#: Bits of a symbol in codes that hold a whole n-gram, for alphabets of up to 32 symbols.
BITS = 5
#: Languages, by number of documents, whose models are sent to all tasks.
MAX_LANGUAGES = 16
#: Four-grams of a model that one task holds, and of all that are sent; some 35 bytes each.
MAX_GRAMS = 1 << 22
#: Bytes of text in one part of a rarer language, the same for each four-gram of its model, and in one of a larger model.
PART_BYTES, PART_BYTES_GRAM, PART_BYTES_LARGE = 1 << 24, 16, 1 << 22
#: Rows of a batch of n-grams, and characters of a long text handled at once.
GRAM_ROWS, BLOCK = 1 << 16, 1 << 20
#: Half width of a band in deviations: 3 keeps 98.5 % of the good ones of labelled test documents (rates in the README).
WIDTH = 3.0
#: Columns of a count (see ``needed_counts``).
COUNTED = ["kind", "ngram", "first", "rest", "a", "b", "c", "d"]
#: What sums of equal texts may differ by.
ROUNDING = 1e-9

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Whether each value occurs twice or more."""
    order = np.argsort(keys, kind="stable")
    equal = np.zeros(len(keys) + 1, bool)
    equal[1:-1] = keys[order[1:]] == keys[order[:-1]]
    out = np.empty(len(keys), bool)
    out[order] = equal[1:] | equal[:-1]
    return out


def base_figures(texts: Texts) -> dict[str, np.ndarray]:
    """The base figures of each text, as int64 arrays."""
    words = texts.words()
    counts = words.counts()
    inside = ~SPACE[texts.data]
    start, end, first = texts.lines()
    held = np.searchsorted(words.start, end) > np.searchsorted(words.start, start)
    owner = np.repeat(np.arange(texts.n), np.diff(first))[held].astype(np.uint64)
    keys = mix(range_hash(texts.sums(), start[held], end[held]) + owner * np.uint64(0x9FB21C651E98DF25))
    _, at = np.unique(keys, return_index=True)
    distinct = np.bincount(owner[at].astype(np.int64), minlength=texts.n)
    with_word = np.bincount(owner.astype(np.int64), minlength=texts.n)
    found, whole = words.windows(WINDOW)
    places = np.flatnonzero(whole)
    keys = mix(found[places] + words.owners()[places].astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
    places = places[_repeats(keys)]
    n = len(words.hashes)
    change = np.bincount(places, minlength=n + 1) - np.bincount(places + WINDOW, minlength=n + 1)
    covered = np.cumsum(change[:n]) > 0
    return {
        "n_words": counts.astype(np.int64),
        "word_chars": sums_by(inside & texts.characters(), texts.offsets),
        "n_symbols": sums_by(_SYMBOL[texts.data], texts.offsets),
        "n_dup_lines": (with_word - distinct).astype(np.int64),
        "n_repeat_words": sums_by(covered, words.first),
    }


def failed(figures: dict[str, np.ndarray]) -> np.ndarray:
    n, repeated = figures["n_words"], figures["n_repeat_words"]
    return (n < 10) | (100 * repeated > 20 * n)


def characters_of(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The code points, and offsets of the texts among them."""
    at = np.flatnonzero(texts.characters())
    offsets = np.searchsorted(at, texts.offsets)
    found = texts.data[at].astype(np.int32)
    wide = np.flatnonzero(found >= 0xC0)
    if len(wide):
        at, lead = at[wide], found[wide]
        after = [(texts.data[np.minimum(at + k, len(texts.data) - 1)] & 0x3F).astype(np.int32) for k in (1, 2, 3)]
        two = (lead & 0x1F) << 6 | after[0]
        three = (lead & 0x0F) << 12 | after[0] << 6 | after[1]
        four = (lead & 0x07) << 18 | after[0] << 12 | after[1] << 6 | after[2]
        found[wide] = np.where(lead < 0xE0, two, np.where(lead < 0xF0, three, four))
    return found, offsets


def codes_of(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n-gram that ends at each character, as its first character and its others, and offsets of the texts."""
    now, offsets = characters_of(texts)
    starts = offsets[:-1][offsets[:-1] < len(now)]
    rest, last = now.astype(np.int64), now
    for k in range(1, ORDER):
        last = np.concatenate([np.full(min(1, len(last)), START, np.int32), last[:-1]])
        last[starts] = START
        if k < ORDER - 1:
            rest |= last.astype(np.int64) << (CHARACTER * k)
    return last, rest, offsets


def hash_of(order: int, first: np.ndarray | int, rest: np.ndarray) -> np.ndarray:
    return mix(rest.astype(np.uint64) ^ mix(np.atleast_1d(first).astype(np.uint64) << np.uint64(3) | np.uint64(order)))


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place at which each different hash stands, and which of them stands at each place."""
    which = pa.array(hashes).dictionary_encode().indices.to_numpy()
    place = np.empty(int(which.max()) + 1 if len(which) else 0, np.int64)
    place[which] = np.arange(len(which))
    return place, which


def ascending(first: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the different n-grams in ascending order, and which of them stands at each place."""
    place, which = distinct(hash_of(ORDER, first, rest))
    by = np.lexsort((rest[place], first[place]))
    number = np.empty(len(by), np.int64)
    number[by] = np.arange(len(by))
    return place[by], number[which]


def tally(
    first: np.ndarray, rest: np.ndarray, owner: np.ndarray, times: np.ndarray | None = None
) -> tuple[np.ndarray, ...]:
    """The different n-grams in ascending order; and for each owner and n-gram it has: owner, its number, its times."""
    if times is None and len(rest) > BLOCK:
        cuts = [slice(k, k + BLOCK) for k in range(0, len(rest), BLOCK)]
        parts = [tally(first[c], rest[c], owner[c]) for c in cuts]
        parts = [(f[gram], r[gram], o, t) for f, r, o, gram, t in parts]
        return tally(*(np.concatenate(x) for x in zip(*parts)))
    place, which = ascending(first, rest)
    keys = owner.astype(np.int64) * len(place) + which
    if times is None:
        pairs, times = np.unique(keys, return_counts=True)
    else:
        pairs, at = np.unique(keys, return_inverse=True)
        times = np.bincount(at, times).astype(np.int64)
    return first[place], rest[place], pairs // len(place), pairs % len(place), times


def _combine(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    first, rest, counts = (np.concatenate(x) for x in zip(*parts))
    place, which = distinct(hash_of(ORDER, first, rest))
    total = np.zeros(len(place), np.int64)
    np.add.at(total, which, counts)
    return first[place], rest[place], total


def with_model_name(docs: DataFrame) -> DataFrame:
    """Adds ``_model``: ``=`` and the language, null as ``?``."""
    return docs.withColumn("_model", F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("?")))


def model_sizes(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """Documents and four-grams of each model (_name, _docs, _size)."""
    sizes = counts.groupBy(F.col("_model").alias("_name")).agg(F.count("*").alias("_size"))
    rows = docs.groupBy("_model").agg(F.count("*").alias("_docs")).join(sizes, F.col("_model") == F.col("_name"), "left")
    rows = rows.select(F.col("_model").alias("_name"), "_docs", F.coalesce("_size", F.lit(0)).alias("_size"))
    return written(rows, "ngram-sizes")


def common_models(sizes: DataFrame, n: int, max_grams: int) -> tuple[list[str], list[str], bool]:
    """At most ``n`` names with the most documents and ``max_grams`` n-grams together, those of larger models, and
    whether there are others."""
    large = [r["_name"] for r in sizes.where(F.col("_size") > max_grams).select("_name").collect()]
    small = sizes.where(F.col("_size") <= max_grams)
    rows = small.orderBy(F.desc("_docs"), "_name").limit(n).collect()
    total = np.cumsum([r["_size"] for r in rows])
    common = [r["_name"] for r, held in zip(rows, total) if held <= max_grams]
    return common, large, small.count() > len(common)


def count_ngrams(docs: DataFrame) -> DataFrame:
    """Four-gram counts (_model, first, rest, n) over all documents that pass the base rules."""

    def run(batches):
        held: dict[str, list] = {}
        size = 0

        def flush():
            for name, parts in held.items():
                found = _combine(parts)
                for k in range(0, len(found[0]), GRAM_ROWS):
                    own = [pa.array(x[k : k + GRAM_ROWS]) for x in found]
                    yield pa.RecordBatch.from_arrays([pa.repeat(name, len(own[0])), *own], ["_model", "first", "rest", "n"])
            held.clear()

        for batch in batches:
            for rows in pieces(batch):
                texts = Texts(rows.column(rows.schema.get_field_index("text")))
                good = ~failed(base_figures(texts))
                first, rest, offsets = codes_of(texts)
                names = np.array(rows.column(rows.schema.get_field_index("_model")).to_pylist(), object)
                for name in dict.fromkeys(names):
                    mine = np.repeat((names == name) & good, np.diff(offsets))
                    own_first, own_rest = (first, rest) if mine.all() else (first[mine], rest[mine])
                    for k in range(0, len(own_rest), BLOCK):
                        block = own_first[k : k + BLOCK], own_rest[k : k + BLOCK]
                        place, which = distinct(hash_of(ORDER, *block))
                        parts = held.setdefault(name, [])
                        parts.append((block[0][place], block[1][place], np.bincount(which)))
                        size += len(place)
                        if len(parts) > 64:
                            joined = _combine(parts)
                            size -= sum(len(p[0]) for p in parts) - len(joined[0])
                            held[name] = [joined]
                if size > MAX_GRAMS:
                    yield from flush()
                    size = 0
        yield from flush()
        release()

    small_batches(docs.sparkSession)
    counted = docs.select("_model", "text").mapInArrow(run, "_model string, first int, rest long, n long")
    return counted.groupBy("_model", "first", "rest").agg(F.sum("n").alias("n"))


def _discounts(counts: np.ndarray) -> np.ndarray:
    """Discounts for counts of 0, 1, 2 and more, from the counts of counts."""
    return _discounts_of(*(float((counts == k).sum()) for k in (1, 2, 3, 4)))


def _discounts_of(n1: float, n2: float, n3: float, n4: float) -> np.ndarray:
    if not (n1 and n2 and n3 and n4):
        return np.array([0, 0.5, 0.75, 0.9])
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0, *np.clip(d, [0.01, 0.01, 0.01], [0.99, 1.99, 2.99])])


def _split(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First symbols and others of codes that hold whole n-grams in ``BITS`` a symbol."""
    low = BITS * (ORDER - 1)
    return codes.astype(np.int64) >> low, codes.astype(np.int64) & ((1 << low) - 1)


class Level:
    """The n-grams of one order that some texts hold, in ascending order, so that those of a context are neighbours.

    ``n`` are their counts in the model, ``context`` the numbers of their contexts, ``total`` and ``mass`` those
    contexts' sums of counts and discounts, ``up`` the numbers of the n-grams without their first symbols.
    """

    def __init__(self, n, context, total, mass, up, discounts):
        self.n, self.context, self.total, self.mass, self.up, self.discounts = n, context, total, mass, up, discounts


def _context(order: int, first: np.ndarray | int, rest: np.ndarray, bits: int) -> np.ndarray:
    return np.int64(first) << (bits * (ORDER - 2)) | rest >> bits if order == ORDER else rest >> bits


class Model:
    """Counts of one language as sorted hash arrays: n-grams (hash, n) and contexts (hash, sums of counts and discounts).

    N-grams are given by their first symbol and the others, or, without ``first``, as codes that hold
    the whole n-gram; ``bits`` are those of a symbol.
    """

    def __init__(self, grams: dict[int, tuple], contexts: dict[int, tuple], discounts: dict, bits: int = BITS):
        self.grams, self.contexts, self.discounts, self.bits = grams, contexts, discounts, bits

    @staticmethod
    def built(
        rest: np.ndarray, counts: np.ndarray, first: np.ndarray | None = None, bits: int = BITS, discounts: dict | None = None
    ) -> "Model":
        """From the counts of the longest n-grams; a shorter one counts the different symbols before it."""
        if first is None:
            first, rest = _split(rest)
        grams, contexts, taken = {}, {}, {}
        own, n = rest, counts.astype(np.int64)
        for order in range(ORDER, 0, -1):
            if order < ORDER:
                own, n = np.unique(own & ((1 << (bits * order)) - 1), return_counts=True)
            ahead = first.astype(np.int64) if order == ORDER else 0
            names, at = np.unique(_context(order, ahead, own, bits), return_inverse=True)
            taken[order] = discounts[order] if discounts else _discounts(n)
            total = np.bincount(at, n, len(names)).astype(np.int64)
            mass = np.bincount(at, taken[order][np.minimum(n, 3)], len(names))
            grams[order] = _sorted(hash_of(order, ahead, own), n)
            contexts[order] = _sorted(hash_of(order, 0, names), total, mass)
        return Model(grams, contexts, taken, bits)

    def rows(self) -> list[tuple]:
        return [
            (order, k, values.tobytes())
            for order in self.grams
            for k, values in enumerate((*self.grams[order], *self.contexts[order], self.discounts[order]))
        ]

    @staticmethod
    def of(rows, bits: int = BITS) -> "Model":
        kinds = (np.uint64, np.int64, np.uint64, np.int64, np.float64, np.float64)
        held: dict[int, dict] = {}
        for order, k, values in rows:
            held.setdefault(order, {})[k] = np.frombuffer(values, kinds[k])
        return Model(
            {o: (x[0], x[1]) for o, x in held.items()}, {o: (x[2], x[3], x[4]) for o, x in held.items()},
            {o: x[5] for o, x in held.items()}, bits,
        )

    @staticmethod
    def of_counts(table: pa.Table, bits: int = BITS) -> "Model":
        """From rows (kind, ngram, first, rest, a, b, c, d) as ``needed_counts`` gives them."""
        kind, ngram, first, rest, *figures = (table.column(c).to_numpy() for c in COUNTED)
        figures = np.array(figures).reshape(4, -1)
        grams, contexts, taken = {}, {}, {}
        for order in range(1, ORDER + 1):
            at = np.flatnonzero((kind == 2) & (ngram == order))
            if len(at):
                taken[order] = _discounts_of(*figures[:, at[0]].astype(float))
                at = np.flatnonzero((kind == 0) & (ngram == order))
                grams[order] = _sorted(hash_of(order, first[at], rest[at]), figures[0, at])
                at = np.flatnonzero((kind == 1) & (ngram == order))
                contexts[order] = _sorted(hash_of(order, 0, rest[at]), figures[0, at], taken[order][1:] @ figures[1:, at])
        return Model(grams, contexts, taken, bits)

    @staticmethod
    def _find(table: tuple, hashes: np.ndarray) -> list[np.ndarray]:
        keys, *values = table
        if not len(keys):
            return [np.zeros(len(hashes), x.dtype) for x in values]
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return [np.where(keys[at] == hashes, x[at], 0) for x in values]

    def _levels(self, first: np.ndarray, rest: np.ndarray) -> dict[int, Level]:
        """The levels of different n-grams of full order, which are in ascending order."""
        empty = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0)
        ahead, own, bits = first.astype(np.int64), rest, self.bits
        levels = {}
        for order in range(ORDER, 0, -1):
            context = _context(order, ahead, own, bits)
            new = _changes(context)
            n, = self._find(self.grams.get(order, empty[:2]), hash_of(order, ahead, own))
            total, mass = self._find(self.contexts.get(order, empty), hash_of(order, 0, context[new]))
            below, up = np.unique(own & ((1 << (bits * (order - 1))) - 1), return_inverse=True)
            levels[order] = Level(n, np.cumsum(new) - 1, total, mass, up, self.discounts.get(order, np.zeros(4)))
            ahead, own = 0, below
        return levels

    def _probability(self, levels: dict, order: int, owner: np.ndarray, gram: np.ndarray, less: np.ndarray) -> np.ndarray:
        """Interpolated probabilities of n-grams, ascending by owner and number, with ``less`` taken off their counts."""
        level = levels[order]
        before = level.n[gram]
        n = np.maximum(before - less, 0)
        context = level.context[gram]
        new = _changes(context) | _changes(owner)
        begin, run = np.flatnonzero(new), np.cumsum(new) - 1
        taken = level.discounts[np.minimum(n, 3)]
        total = level.total[context[begin]] - np.add.reduceat(less, begin)
        mass = level.mass[context[begin]] + np.add.reduceat(taken - level.discounts[np.minimum(before, 3)], begin)
        known = total > 0
        share = known / np.maximum(total, 1)
        free = np.where(known, mass * share, 1.0)
        if order == 1:
            below = 1.0 / (1 << self.bits)
        else:
            size = len(levels[order - 1].n)
            pairs, at = np.unique(owner * size + level.up[gram], return_inverse=True)
            gone = np.bincount(at, (less > 0) & (n == 0), len(pairs)).astype(np.int64)
            below = self._probability(levels, order - 1, pairs // size, pairs % size, gone)[at]
        return (n - taken) * share[run] + free[run] * below

    def losses(self, first: np.ndarray, rest: np.ndarray, offsets: np.ndarray, counted: np.ndarray) -> np.ndarray:
        """Sums of negative natural logarithms for each text; the counts of a ``counted`` text are taken off first."""
        n_texts = len(offsets) - 1
        if not len(rest):
            return np.zeros(n_texts)
        owner = np.repeat(np.arange(n_texts, dtype=np.int32), np.diff(offsets))
        first, rest, owner, gram, times = tally(first, rest, owner)
        p = self._probability(self._levels(first, rest), ORDER, owner, gram, np.where(counted[owner], times, 0))
        return np.bincount(owner, -times * np.log(p), n_texts)

    def scores(self, rest: np.ndarray, first: np.ndarray | None = None) -> np.ndarray:
        """Natural logarithms of the probabilities of n-grams of full order."""
        if first is None:
            first, rest = _split(rest)
        place, which = ascending(first, rest)
        every = np.arange(len(place))
        levels = self._levels(first[place], rest[place])
        return np.log(self._probability(levels, ORDER, every * 0, every, every * 0))[which]


def _sorted(hashes: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    by = np.argsort(hashes)
    return hashes[by], *(x[by] for x in values)


def _changes(values: np.ndarray) -> np.ndarray:
    """Whether each value differs from the one before; the first one does."""
    return np.concatenate([np.ones(min(1, len(values)), bool), values[1:] != values[:-1]])


def build_models(counts: DataFrame) -> DataFrame:
    """The arrays (_model, ngram, kind, held) of every model in ``counts``, each built in one task."""

    def build(table: pa.Table) -> pa.Table:
        name = table.column("_model")[0].as_py()
        first, rest, n = (table.column(c).to_numpy() for c in ("first", "rest", "n"))
        orders, kinds, held = (list(x) for x in zip(*Model.built(rest, n, first, CHARACTER).rows()))
        return pa.table(
            {"_model": [name] * len(held), "ngram": pa.array(orders, pa.int32()), "kind": pa.array(kinds, pa.int32()), "held": pa.array(held, pa.binary())}
        )

    return written(counts.groupBy("_model").applyInArrow(build, "_model string, ngram int, kind int, held binary"), "ngram-models")


def needed_counts(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """For each (_model, _part) of the documents, the counts that ``Model.of_counts`` needs to score them.

    Rows of kind 0 are n-grams with their counts, of kind 1 contexts with the sum of counts and the numbers of
    n-grams counted once, twice and more, of kind 2 the numbers of all n-grams counted one to four times.
    """

    def run(rows, texts):
        first, rest, offsets = codes_of(texts)
        owner = np.repeat(np.arange(texts.n), np.diff(offsets))
        groups = mix(rows.column(rows.schema.get_field_index("_group")).to_numpy().astype(np.uint64))
        place, _ = distinct(hash_of(ORDER, first, rest) ^ groups[owner])
        own = rows.take(pa.array(owner[place]))
        return with_columns(own, ["_model", "_part"], first=first[place], rest=rest[place])

    def kept(order):
        return F.col("rest").bitwiseAND(F.lit((1 << (CHARACTER * order)) - 1)).alias("rest")

    def row(kind, order, *figures):
        return [F.lit(kind).alias("kind"), F.lit(order).alias("ngram"), "first", "rest", *(f.cast("long").alias(c) for f, c in zip(figures, "abcd"))]

    def number(condition):
        return F.sum(condition.cast("long"))

    group = F.xxhash64("_model", "_part").alias("_group")
    needs = map_texts(docs.select("_model", "_part", group, "text"), run, "_model string, _part long, first int, rest long")
    needs = written(needs.distinct(), "ngram-needs")
    parts = needs.select("_model", "_part").distinct()
    ahead = F.shiftleft(F.col("first").cast("long"), CHARACTER * (ORDER - 2))
    context = ahead.bitwiseOR(F.shiftright("rest", CHARACTER)).alias("rest")
    n, none, nothing = F.col("n"), F.lit(0), F.lit(0).alias("first")
    found = []
    for order in range(ORDER, 0, -1):
        if order < ORDER:
            needs = needs.select("_model", "_part", nothing, kept(order)).distinct()
            counts = counts.groupBy("_model", nothing, kept(order)).agg(F.count("*").alias("n"))
            counts = written(counts, "ngram-level")
        grams = needs.join(counts, ["_model", "first", "rest"])
        found.append(grams.select("_model", "_part", *row(0, order, n, none, none, none)))
        sums = counts.groupBy("_model", context).agg(
            F.sum("n").alias("a"), number(n == 1).alias("b"), number(n == 2).alias("c"), number(n > 2).alias("d")
        )
        held = needs.select("_model", "_part", context).distinct().join(sums, ["_model", "rest"]).withColumn("first", none)
        found.append(held.select("_model", "_part", *row(1, order, *(F.col(c) for c in "abcd"))))
        few = counts.groupBy("_model").agg(*(number(n == k).alias(c) for k, c in enumerate("abcd", 1)))
        few = parts.join(few, "_model").withColumns({"first": none, "rest": none.cast("long")})
        found.append(few.select("_model", "_part", *row(2, order, *(F.col(c) for c in "abcd"))))
    return reduce(DataFrame.unionByName, found)


def dealt(docs: DataFrame, sizes: DataFrame, part_bytes) -> tuple[DataFrame, DataFrame]:
    """Documents with the ``_part`` of their language that they are dealt to, and the number of parts (_name, _parts)."""
    size = docs.groupBy("_model").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("_bytes"))
    parts = size.join(sizes, size["_model"] == sizes["_name"])
    parts = parts.select("_name", F.greatest(F.ceil(F.col("_bytes") / part_bytes), F.lit(1)).alias("_parts"))
    parts = written(parts, "ngram-parts")
    found = docs.withColumn("_id", F.monotonically_increasing_id())
    found = found.join(parts, found["_model"] == parts["_name"]).withColumn("_part", F.col("_id") % F.col("_parts"))
    return found.drop("_id", "_name", "_parts"), parts


def score(
    docs: DataFrame, counts: DataFrame, sizes: DataFrame, common: list[str], large: list[str], more: bool
) -> DataFrame:
    """All columns of the documents and, new, base figures, surprisal sums and character counts.

    The models of ``common`` are sent to all tasks; if there are ``more``, they meet their documents in parts, and
    of the ``large`` ones only the counts do that a part needs.
    """
    is_common, is_large = F.col("_model").isin(common), F.col("_model").isin(large)
    models = build_models(counts.where(~is_large))
    found: dict[str, list[tuple]] = {}
    for r in models.where(is_common).toLocalIterator():
        found.setdefault(r[0], []).append((r[1], r[2], bytes(r[3])))
    sent = docs.sparkSession.sparkContext.broadcast(found)
    own = [c for c in docs.columns if c not in RESULT and c not in ("_n", "_loss")]
    schema = T.StructType([docs.schema[c] for c in own])
    for name in BASE + ["_n"]:
        schema = schema.add(name, T.LongType())
    schema = schema.add("base_failed", T.BooleanType()).add("_loss", T.DoubleType())
    cache: dict[str, Model] = {}

    def scored(rows, texts, model_of):
        figures = base_figures(texts)
        bad = failed(figures)
        first, rest, offsets = codes_of(texts)
        sizes = np.diff(offsets)
        names = np.array(rows.column(rows.schema.get_field_index("_model")).to_pylist(), object)
        loss = np.zeros(texts.n)
        for name in dict.fromkeys(names):
            mine = names == name
            held = np.repeat(mine, sizes)
            own_first, own_rest = (first, rest) if held.all() else (first[held], rest[held])
            at = np.concatenate([[0], np.cumsum(sizes[mine])])
            loss[mine] = model_of(name).losses(own_first, own_rest, at, ~bad[mine])
        return with_columns(rows, own, **figures, _n=sizes, base_failed=bad, _loss=loss)

    def run(rows, texts):
        def model_of(name):
            if name not in cache:
                cache[name] = Model.of(sent.value.get(name, ()), CHARACTER)
            return cache[name]

        return scored(rows, texts, model_of)

    def scored_part(left: pa.Table, model: Model) -> pa.Table:
        out = []
        for batch in left.combine_chunks().to_batches():
            for rows in pieces(batch):
                out.append(scored(rows, Texts(rows.column(rows.schema.get_field_index("text"))), lambda name: model))
        return pa.Table.from_batches(out) if out else empty

    def with_model(left: pa.Table, right: pa.Table) -> pa.Table:
        return scored_part(left, Model.of(zip(*(right.column(c).to_pylist() for c in ("ngram", "kind", "held"))), CHARACTER))

    def with_counts(left: pa.Table, right: pa.Table) -> pa.Table:
        return scored_part(left, Model.of_counts(right, CHARACTER))

    def met(left: DataFrame, right: DataFrame, function) -> DataFrame:
        return left.groupBy("_model", "_part").cogroup(right.groupBy("_model", "_part")).applyInArrow(function, schema)

    docs = docs.select(*own)
    if not more and not large:
        return map_texts(docs, run, schema)
    empty = to_arrow_schema(schema).empty_table()
    out = map_texts(docs.where(is_common), run, schema)
    if more:
        least = F.greatest(F.lit(PART_BYTES), PART_BYTES_GRAM * F.col("_size"))
        rest, parts = dealt(docs.where(~is_common & ~is_large), sizes, least)
        copies = models.join(parts, models["_model"] == parts["_name"]).drop("_name")
        copies = copies.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))).drop("_parts")
        out = out.unionByName(met(rest, copies, with_model))
    if large:
        rest = written(dealt(docs.where(is_large), sizes, F.lit(PART_BYTES_LARGE))[0], "ngram-dealt", "zstd")
        out = out.unionByName(met(rest, needed_counts(rest, counts.where(is_large)), with_counts))
    return out


def bands(scored: DataFrame) -> DataFrame:
    """Per model (_name): ``_band``, of median surprisal, spread between documents, and spread times root of length.

    The documents that pass the base rules count.  The quantiles come from mergeable sketches, so no
    language is gathered in one task; there is one row per model.
    """
    good = scored.where(~F.col("base_failed")).withColumn("_mean", F.col("_loss") / F.col("_n"))
    quartiles = F.percentile_approx("_mean", [0.25, 0.5, 0.75], 10000).alias("_q")
    middle = written(good.groupBy(F.col("_model").alias("_name")).agg(quartiles), "ngram-middle")
    away = F.sqrt("_n") * F.abs(F.col("_mean") - F.col("_q")[1])
    own = good.join(middle, good["_model"] == middle["_name"]).groupBy("_name", "_q").agg(F.percentile_approx(away, 0.5, 10000).alias("_own"))
    spread = (F.col("_q")[2] - F.col("_q")[0]) / 1.349
    band = F.struct(F.col("_q")[1].alias("middle"), spread.alias("spread"), (F.col("_own") / 0.6745).alias("scaled"))
    return written(own.select("_name", band.alias("_band")), "ngram-bands")


def judge(
    docs: DataFrame, width: float = WIDTH, max_languages: int = MAX_LANGUAGES, max_grams: int = MAX_GRAMS
) -> DataFrame:
    """Documents with base figures, ``base_failed``, ``surprisal`` (nats per character) and ``kept``.

    ``docs`` needs ``text`` and ``lang``.  A document's deviation is the root of the squared spread
    of its language plus the variance that a document of its length has there.  A document that passes
    the base rules is kept unless its surprisal lies more than ``width`` deviations from the median.
    """
    own = [c for c in docs.columns if c not in RESULT]
    named = with_model_name(docs.select(*own))
    counts = written(count_ngrams(named), "ngrams")
    sizes = model_sizes(named, counts)
    common, large, more = common_models(sizes, max_languages, max_grams)
    # It holds the texts, so it is by far the largest table written here.
    scored = written(score(named, counts, sizes, common, large, more), "surprisal", "zstd")
    band = bands(scored)
    scored = scored.join(band, scored["_model"] == band["_name"], "left")
    mean = F.col("_loss") / F.col("_n")
    variance = F.pow(F.col("_band.spread"), F.lit(2)) + F.pow(F.col("_band.scaled"), F.lit(2)) / F.col("_n")
    verdict = F.abs(mean - F.col("_band.middle")) <= width * F.sqrt(variance) + ROUNDING
    return scored.select(
        *own, *BASE, "base_failed", F.when(F.col("_n") > 0, mean).alias("surprisal"),
        (~F.col("base_failed") & F.coalesce(verdict, F.lit(True))).alias("kept"),
    )
