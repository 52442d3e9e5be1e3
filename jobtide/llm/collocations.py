"""Phrases whose words meet more often than chance, mined level by level from counts of shards.

Method: words of every language are counted, then phrases of two words, of three and so on up to
``LONGEST``.  At each length a task counts, shard by shard, every phrase whose parts of one word less are
frequent over all documents, and the counts of all shards are summed.  A shard holds nothing back, so the
sums are exact and no second pass has to ask the shards for what they did not report: each occurrence
of a phrase is sent at most once, however many phrases and shards there are.  A shard is at most about
``SHARD_WORDS`` words of one task, so memory is bounded.

What tasks need to know about all documents reaches them as bitmaps of fixed size, which may let too
much pass but never too little; only exact counts decide.  Words are compared by 64-bit hashes (with
their language); two different ones are taken for equal with a probability of about 2**-64 a pair.

Words are runs of characters other than blank and tab within pieces, and pieces end at ``.,;:!?``, line
feed, vertical tab, form feed and carriage return; A-Z count as a-z.

Nulls: a null text has no word, a null language counts as ``und``.  Repeated rows count each time.  Ties
in score and count come in the order of the phrase's bytes.  Empty tables give no row.  Very long
texts are read whole.  Only text and lang are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm.bloom import bitmap, may_hold
from jobtide.llm.scratch import written
from jobtide.llm.texts import (
    LOWER, Texts, large_batches, mix, pieces, prefix, range_hash, release, sequence_hash, small_batches,
)

SUPPORT, LONGEST, TOP = 100, 5, 2000
SHARD_WORDS = 1 << 22
#: Rows of one batch that leaves a task.
SENT_ROWS = 1 << 16
#: Parts of a language that are ranked by themselves before all are ranked.
SALTS = 64
UNKNOWN = "und"

_BLANK, _END = np.zeros(256, bool), np.zeros(256, bool)
_BLANK[[9, 32]] = True
_END[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
_LANGUAGE = np.uint64(0x8CB92BA72F3D8DD7)
_WORDS = [f"w{i}" for i in range(LONGEST)]


def _with_language(words: np.ndarray, languages: np.ndarray) -> np.ndarray:
    return mix(words + languages * _LANGUAGE)


def _whole(texts: Texts) -> np.ndarray:
    """A hash of each whole text."""
    return range_hash(texts.sums(), texts.offsets[:-1], texts.offsets[1:])


class Piece:
    """Words of some texts: hashes with language, byte ranges, whether the next word is in the same piece."""

    def __init__(self, rows: pa.RecordBatch):
        texts, languages = Texts(rows.column(0)), Texts(rows.column(1))
        self.data = LOWER[texts.data]
        size, inside = len(self.data), ~(_BLANK | _END)[self.data]
        first, last = np.zeros(size, bool), np.zeros(size, bool)
        edges = texts.offsets[(texts.offsets > 0) & (texts.offsets < size)]
        if size:
            first[1:], last[:-1] = ~inside[:-1], ~inside[1:]
            first[0] = last[-1] = True
        first[edges] = last[edges - 1] = True
        self.start, self.end = np.flatnonzero(inside & first), np.flatnonzero(inside & last) + 1
        ends = np.cumsum(_END[self.data])
        owner = np.searchsorted(texts.offsets, self.start, "right") - 1
        self.joined = np.zeros(len(self.start), bool)
        self.joined[:-1] = (ends[self.start[:-1]] == ends[self.start[1:]]) & (owner[:-1] == owner[1:])
        self.names, code = np.unique(np.array(rows.column(1).to_pylist(), object), return_inverse=True)
        self.code = code[owner].astype(np.int32) if len(owner) else np.zeros(0, np.int32)
        self.w = _with_language(range_hash(prefix(self.data), self.start, self.end), _whole(languages)[owner])

    def sizes(self) -> dict[str, int]:
        """The number of words by language."""
        return dict(zip(self.names.tolist(), np.bincount(self.code, minlength=len(self.names)).tolist()))


class Shard:
    """Words of at most about ``SHARD_WORDS`` words of one task, with the number of words by language."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray, dict[str, int]]]):
        own = sum((Counter(sizes) for *_, sizes in parts), Counter())
        self.names, self.sizes = list(own), np.array(list(own.values()), np.int64)
        self.w = np.concatenate([w for w, *_ in parts])
        self.joined = np.concatenate([joined for _, joined, _ in parts])

    def local_support(self, totals: dict[str, int], support: int) -> np.ndarray:
        """For each language the shard's part of the support, rounded up, at least 1."""
        sizes = zip(self.names, self.sizes.tolist())
        return np.array([max(1, -(-support * n // totals[name])) if n else 1 for name, n in sizes], np.int64)

    def phrases(self, alive: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Where phrases of k words start whose parts of k - 1 words are alive, and their hashes."""
        n = len(self.w) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(alive[:n] & alive[1 : n + 1] & (self.joined[:n] if k == 2 else True))
        return at, sequence_hash([self.w[at + i] for i in range(k)])


def shards(batches: Iterator[pa.RecordBatch], words: int, keep: Callable[[Piece], object]) -> Iterator[list]:
    """What is kept of the pieces of each shard of a task, of about so many words at most."""
    held, size = [], 0
    for batch in batches:
        for rows in pieces(batch):
            piece = Piece(rows)
            held.append(keep(piece))
            size += len(piece.w)
            if size >= words:
                yield held
                held, size = [], 0
    if held:
        yield held


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, text, n) of all words; the row of a language without text has the number of its words."""

    def of_piece(p: Piece) -> pa.Table:
        _, at, n = np.unique(p.w, return_index=True, return_counts=True)
        size = p.end[at] - p.start[at]
        offsets = np.concatenate([[0], np.cumsum(size)])
        places = np.repeat(p.start[at] - offsets[:-1], size) + np.arange(offsets[-1])
        words = pa.LargeStringArray.from_buffers(
            len(at), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(p.data[places])
        )
        lang = pa.array(p.names.tolist(), pa.string()).take(pa.array(p.code[at]))
        own = p.sizes()
        return pa.table({
            "lang": pa.concat_arrays([lang, pa.array(list(own), pa.string())]),
            "text": pa.concat_arrays([words.cast(pa.string()), pa.nulls(len(own), pa.string())]),
            "n": np.concatenate([n, list(own.values())]).astype(np.int64),
        })

    def run(batches):
        for parts in shards(batches, limit, of_piece):
            found = pa.concat_tables(parts).group_by(["lang", "text"]).aggregate([("n", "sum")])
            yield from found.select(["lang", "text", "n_sum"]).rename_columns(["lang", "text", "n"]).to_batches()
        release()

    small_batches(texts.sparkSession)
    limit = SHARD_WORDS
    return texts.mapInArrow(run, "lang string, text string, n long").groupBy("lang", "text").agg(F.sum("n").alias("n"))


def hashed(words: DataFrame) -> DataFrame:
    """(lang, text, n) with the word's hash, w."""

    def run(batches):
        for batch in batches:
            languages, texts = Texts(batch.column(0)), Texts(batch.column(1))
            yield batch.append_column("w", pa.array(_with_language(_whole(texts), _whole(languages)).view(np.int64)))

    return words.select("lang", "text", "n").mapInArrow(run, "lang string, text string, n long, w long")


def _alive(shard: Shard, bits: list[np.ndarray]) -> np.ndarray:
    """Where phrases start that pass all filters, of as many words as there are filters."""
    alive = may_hold(bits[0], shard.w)
    for k, held in enumerate(bits[1:], 2):
        at, keys = shard.phrases(alive, k)
        alive = np.zeros(len(alive), bool)
        alive[at[may_hold(held, keys)]] = True
    return alive


def local_counts(texts: DataFrame, filters: list[np.ndarray], k: int) -> DataFrame:
    """(k, w0 to w4, n): the counts, in each shard, of all phrases of k words whose parts pass the filters.

    ``filters`` tell of words, and then of phrases of two words and more, up to k - 1, which may be frequent.
    """
    small_batches(texts.sparkSession)
    sent, limit = texts.sparkSession.sparkContext.broadcast(filters), SHARD_WORDS

    def run(batches):
        for parts in shards(batches, limit, lambda p: (p.w, p.joined, p.sizes())):
            shard = Shard(parts)
            parts.clear()
            at, keys = shard.phrases(_alive(shard, sent.value), k)
            _, one, n = np.unique(keys, return_index=True, return_counts=True)
            at = at[one]
            del keys, one
            for low in range(0, len(at), SENT_ROWS):
                some = at[low : low + SENT_ROWS]
                words = [shard.w[some + i].view(np.int64) if i < k else np.zeros(len(some), np.int64) for i in range(LONGEST)]
                columns = [np.full(len(some), k, np.int32), *words, n[low : low + SENT_ROWS]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["k", *_WORDS, "n"])
        release()

    return texts.mapInArrow(run, f"k int, {', '.join(f'{w} long' for w in _WORDS)}, n long")


def counted(texts: DataFrame, filters: list[np.ndarray], k: int, support: int) -> DataFrame:
    """(k, w0 to w4, n): exact counts of the phrases of k words that reach the support."""
    counts = local_counts(texts, filters, k).groupBy("k", *_WORDS).agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= support)


def phrase_bitmap(phrases: DataFrame, k: int) -> np.ndarray:
    """The bitmap of phrases of k words, by the hash that shards give them."""

    def run(batches):
        for batch in batches:
            key = sequence_hash([c.to_numpy().view(np.uint64) for c in batch.columns])
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64))], ["key"])

    large_batches(phrases.sparkSession)
    return bitmap(phrases.select(*_WORDS[:k]).mapInArrow(run, "key long"), "key")


def frequent_phrases(docs: DataFrame, support: int = SUPPORT) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Frequent phrases (words, a) as arrays of word hashes, frequent words (lang, text, n, w), words by language."""
    texts = docs.select("text", F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"))
    counts = written(word_counts(texts).where((F.col("n") >= support) | F.col("text").isNull()), "phrase-words")
    totals = {r["lang"]: r["n"] for r in counts.where("text is null").collect()}
    words = written(hashed(counts.where("text is not null")), "phrase-hashes")
    known, found = [bitmap(words, "w")], None
    for k in range(2, LONGEST + 1):
        exact = written(counted(texts, known, k, support), "phrase-counts")
        found = exact if found is None else found.unionByName(exact)
        if k < LONGEST:
            known = [*known, phrase_bitmap(exact, k)]
    return found.select(F.slice(F.array(*_WORDS), 1, F.col("k")).alias("words"), F.col("n").alias("a")), words, totals


def _scored(named: DataFrame, phrases: DataFrame, words: DataFrame) -> DataFrame:
    """The named phrases with l, r and score of the lowest-scoring cut, the earliest if several score alike."""
    sizes = phrases.select("words", F.col("a").alias("f")).unionByName(
        words.select(F.array("w").alias("words"), F.col("n").alias("f"))
    )
    part = lambda name, f: sizes.select(F.col("words").alias(name), F.col("f").alias(f))
    cuts = named.withColumn("cut", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    cuts = cuts.withColumns({
        "left": F.slice("words", F.lit(1), F.col("cut")),
        "right": F.slice("words", F.col("cut") + 1, F.size("words") - F.col("cut")),
    }).join(part("left", "l"), "left").join(part("right", "r"), "right")
    big = "cast({} as decimal(38,0))".format
    score = F.expr(f"({big(1000)} * {big('a')} * {big('n')}) div ({big('l')} * {big('r')})")
    cuts = cuts.withColumn("at", F.struct(score.alias("score"), "cut", "l", "r"))
    return cuts.groupBy("words", "lang", "phrase", "a", "n").agg(F.min("at").alias("at")).select("*", "at.*").drop("at")


def _named(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """The phrases with their language and text."""
    parts = phrases.select("words", "a", F.posexplode("words").alias("pos", "w")).join(words.select("w", "lang", "text"), "w")
    in_order = F.sort_array(F.collect_list(F.struct("pos", "text")))
    text: Column = F.array_join(F.transform(in_order, lambda p: p["text"]), " ")
    return parts.groupBy("words", "a").agg(F.min("lang").alias("lang"), text.alias("phrase"))


def collocations(docs: DataFrame, support: int = SUPPORT, top: int = TOP) -> DataFrame:
    """Per language its best phrases: lang, rank, phrase, a, l, r, n, score."""
    phrases, words, totals = frequent_phrases(docs, support)
    inner = F.explode(F.array(F.slice("words", F.lit(1), F.size("words") - 1), F.slice("words", F.lit(2), F.size("words") - 1)))
    longer = phrases.where(F.size("words") > 2).select(inner.alias("words"), F.col("a").alias("outer_a"))
    # A longer phrase as frequent as this one has parts as frequent, so phrases of one word more tell all.
    longer = longer.groupBy("words").agg(F.max("outer_a").alias("outer_a"))
    alone = phrases.join(longer, "words", "left").where(F.coalesce(F.col("outer_a") < F.col("a"), F.lit(True))).drop("outer_a")
    spark = docs.sparkSession
    sizes = spark.createDataFrame(list(totals.items()), "lang string, n long")
    scored = _scored(_named(alone, words).join(sizes, "lang"), phrases, words)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    ranked = first.where(F.col("place") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
