"""Mixing sources to target weights.

Method: the words of each source, its documents in order of (hash bucket, doc_id), are packed into
blocks of ``block_words``; only a source's last block is shorter.  The output consists of shards of
``shard_slots`` slots.  How many slots of a shard each source gets is a multinomial draw with the
probabilities of what the sources still have to give, so the totals meet the targets.  The k-th slot
of a source takes the block that a pseudorandom permutation of its block numbers puts there; each
pass over the blocks has its own permutation.  Slots and blocks are joined by (source, block).  The
last slot of a source takes only the words missing from its target.

The draws need one number per source and shard on the driver, like the weights, which the caller
states per source; everything that grows with documents or words stays distributed.  All draws come
from ``seed`` and hashes, so reruns agree and a lost task gives the same rows again.

Nulls: a null source is a source of its own and the last one, a null text has no words, documents
with a null doc_id come first in their bucket.  Empty texts are in no block; an empty table, or one
without words, gives no slots.  Repeated rows are separate documents.  A very long text spans many
blocks.  Only doc_id, source and text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from jobtide.llm.scratch import written
from jobtide.llm.texts import large_batches

WORD = r"[^\x20\x09-\x0D]+"
BUCKETS = 512
BLOCK_WORDS = 64
SHARD_SLOTS = 65_536
SHARE, MOST = 1.5, 2.0
WEIGHTS = (5.0, 2.0, 1.0)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def repeating(weights=WEIGHTS) -> Callable[[list], list[float]]:
    """Weights for sources in order: the given ones, again and again."""
    return lambda names: [weights[i % len(weights)] for i in range(len(names))]


def target_sizes(sizes: list[int], weights: list[float], share: float = SHARE, most: float = MOST) -> list[float]:
    """Shares ``share`` of all sizes by weight; above ``most`` times a size the excess is dealt anew."""
    goal, out = share * sum(sizes), [0.0] * len(sizes)
    free = set(range(len(sizes)))
    while free:
        left = goal - sum(out[i] for i in range(len(sizes)) if i not in free)
        total = sum(weights[i] for i in free)
        over = {i for i in free if total <= 0 or left * weights[i] / total > most * sizes[i]}
        if not over:
            for i in free:
                out[i] = left * weights[i] / total
            break
        for i in over:
            out[i] = most * sizes[i]
        free -= over
    return out


def _round(x: np.ndarray, key: np.ndarray, k: int) -> np.ndarray:
    y = (x + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) ^ key
    y = (y ^ (y >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    y = (y ^ (y >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return y ^ (y >> np.uint64(32))


ROUNDS = 6


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray, back: bool = False) -> np.ndarray:
    """Each index within [0, size) through the permutation that ``key`` names, or back through it.

    A balanced Feistel network over the next power of four, walked until it is below ``size``.
    """
    x, n, key = (np.asarray(v).astype(np.uint64).copy() for v in (index, size, key))
    half = np.ones(len(x), np.uint64)
    while (small := (np.uint64(1) << (np.uint64(2) * half)) < n).any():
        half[small] += np.uint64(1)
    mask = (np.uint64(1) << half) - np.uint64(1)
    todo = np.arange(len(x))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = x[todo] >> h, x[todo] & m
        for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if back:
                left, right = right ^ (_round(left, k, r) & m), left
            else:
                left, right = right, left ^ (_round(right, k, r) & m)
        x[todo] = (left << h) | right
        todo = todo[x[todo] >= n[todo]]
    return x.astype(np.int64)


def pass_key(source: np.ndarray, turn: np.ndarray, seed: int) -> np.ndarray:
    base = np.asarray(source).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(seed)
    return _round(base + np.asarray(turn).astype(np.uint64) * np.uint64(0xA24BAED4963EE407), base, 7)


def slots_needed(source: int, size: int, target: float, block: int, seed: int) -> tuple[int, int]:
    """How many slots a source fills, and how many words of the last one it takes."""
    want = int(target)
    if not size or not want:
        return 0, 0
    blocks = -(-size // block)
    turns, rest = divmod(want, size)
    tail = size - (blocks - 1) * block
    if not rest:
        turns, rest = turns - 1, size
    key = pass_key(np.array([source]), np.array([turns]), seed)
    short = int(permuted(np.array([blocks - 1]), np.array([blocks]), key, back=True)[0])
    if rest <= short * block:
        slots = -(-rest // block)
        last = rest - (slots - 1) * block
    elif rest - short * block <= tail:
        slots, last = short + 1, rest - short * block
    else:
        after = rest - short * block - tail
        slots = short + 1 + -(-after // block)
        last = after - (slots - short - 2) * block
    return turns * blocks + slots, last


def draw_shards(quotas: list[int], shard_slots: int, seed: int) -> list[tuple[int, int, int, int]]:
    """(shard, source, first slot, slots) for each shard and source that meet in it."""
    left = np.array(quotas, np.int64)
    given, out = np.zeros_like(left), []
    rng = np.random.Generator(np.random.Philox(seed))
    shard = 0
    while left.sum():
        room = min(shard_slots, int(left.sum()))
        counts = np.zeros_like(left)
        while room:
            free = left - counts
            drawn = np.minimum(rng.multinomial(room, free / free.sum()), free)
            counts += drawn
            room -= int(drawn.sum())
        out += [(shard, i, int(given[i]), int(n)) for i, n in enumerate(counts) if n]
        given += counts
        left -= counts
        shard += 1
    return out


def packed(docs: DataFrame, weights: Callable, share: float = SHARE, most: float = MOST) -> tuple[DataFrame, list]:
    """Documents with their size, source figures and word offset in their source; and the sources.

    Offsets come from bucket totals (``BUCKETS`` rows per source) and a window within each bucket, so
    no task holds a whole source.
    """
    spark = docs.sparkSession
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("_print"))
    bucket = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1))), F.lit(BUCKETS)).cast("int")
    sized = written(sized.withColumn("_bucket", bucket), "mix-sizes")
    totals = written(sized.groupBy("source", "_bucket").agg(F.sum("size").alias("_n")), "mix-totals")
    found = totals.groupBy("source").agg(F.sum("_n").alias("n")).collect()
    found = sorted(((r["source"], int(r["n"])) for r in found), key=lambda r: (r[0] is None, (r[0] or "").encode()))
    names, sizes = [r[0] for r in found], [r[1] for r in found]
    targets = target_sizes(sizes, weights(names), share, most)
    table = spark.createDataFrame(
        [(i, n, s, t) for i, (n, s, t) in enumerate(zip(names, sizes, targets))],
        "_source int, _name string, source_size long, target double",
    )
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        F.col("source").alias("_s"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    starts = starts.join(table, F.col("_s").eqNullSafe(F.col("_name"))).drop("_name")
    placed = sized.join(starts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
    order = Window.partitionBy("_source", "_bucket").orderBy("doc_id", "size", "_print")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    offset = F.col("_start") + F.coalesce(F.sum("size").over(earlier), F.lit(0))
    placed = placed.withColumns({"_offset": offset, "_row": F.row_number().over(order)}).drop("_s", "_b", "_start")
    return placed, [(i, s, t) for i, (s, t) in enumerate(zip(sizes, targets))]


def slots(spark, sources: list, block_words: int, shard_slots: int, seed: int) -> DataFrame:
    """Output slots: shard, place in the shard, source, block, and how many of its words to take."""
    needed = [slots_needed(i, size, target, block_words, seed) for i, size, target in sources]
    shards = draw_shards([n for n, _ in needed], shard_slots, seed)
    rows = [
        (shard, i, first, n, -(-sources[i][1] // block_words), needed[i][0] - 1, needed[i][1])
        for shard, i, first, n in shards
    ]
    large_batches(spark)
    drawn = spark.createDataFrame(
        rows, "shard int, _source int, _first long, _count long, _blocks long, _last long, _words long"
    )

    @F.pandas_udf("long")
    def block_of(source: pd.Series, slot: pd.Series, blocks: pd.Series) -> pd.Series:
        turn = slot.to_numpy() // blocks.to_numpy()
        return pd.Series(permuted(slot.to_numpy() % blocks.to_numpy(), blocks.to_numpy(), pass_key(source.to_numpy(), turn, seed)))

    total = sum(n for n, _ in needed)
    spread = drawn.repartition(max(1, min(len(rows), -(-total // SHARD_SLOTS))), "shard", "_source")
    each = spread.withColumn("_slot", F.explode(F.sequence("_first", F.col("_first") + F.col("_count") - 1)))
    # Written, so that the join is planned by the real size and not by that of the draws.
    return written(each.select(
        "shard", F.xxhash64("_source", "_slot", F.lit(seed)).alias("place"), F.col("_source").alias("_slot_source"),
        block_of("_source", "_slot", "_blocks").alias("_slot_block"),
        F.when(F.col("_slot") == F.col("_last"), F.col("_words")).otherwise(F.lit(block_words).cast("long")).alias("_take"),
    ), "mix-slots")


def segments(placed: DataFrame, block_words: int) -> DataFrame:
    """The part of each document in each block it reaches into; a document without words has none.

    ``_from`` and ``_words`` place the part in the block, ``first_word`` in the document.
    """
    low, high = F.col("_offset"), F.col("_offset") + F.col("size")
    reached = F.when(F.col("size") > 0, F.sequence(F.floor(low / block_words), F.floor((high - 1) / block_words)))
    start = F.greatest(low, F.col("_block") * block_words)
    cut = placed.select("*", F.posexplode_outer(reached).alias("_part", "_block"))
    return cut.withColumns({
        "_from": start - F.col("_block") * block_words,
        "first_word": start - low,
        "_words": F.least(high, (F.col("_block") + 1) * block_words) - start,
    })


def _joined(docs, weights, share, most, block_words, shard_slots, seed, how):
    placed, sources = packed(docs, weights, share, most)
    parts = segments(placed, block_words)
    wanted = slots(docs.sparkSession, sources, block_words, shard_slots, seed)
    on = (F.col("_source") == F.col("_slot_source")) & (F.col("_block") == F.col("_slot_block"))
    taken = F.greatest(F.least(F.col("_words"), F.col("_take") - F.col("_from")), F.lit(0))
    taken = F.when(F.col("_take").isNotNull() & F.col("_words").isNotNull(), taken).otherwise(F.lit(0))
    return parts.join(wanted, on, how).withColumn("n_words", taken.cast("long"))


def mix_counts(
    docs: DataFrame, weights: Callable = repeating(), share: float = SHARE, most: float = MOST,
    block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = 7,
) -> DataFrame:
    """Per document: doc_id, size, source_size, target, and the words the mix takes of it."""
    joined = _joined(docs, weights, share, most, block_words, shard_slots, seed, "left")
    keys = ["_source", "_bucket", "_row"]
    same = [F.any_value(c).alias(c) for c in ("doc_id", "size", "source_size", "target")]
    return joined.groupBy(*keys).agg(*same, F.sum("n_words").alias("taken")).drop(*keys)


def mix(
    docs: DataFrame, weights: Callable = repeating(), share: float = SHARE, most: float = MOST,
    block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = 7,
) -> DataFrame:
    """The mixed corpus: shard, place in it, source, block, and the block's parts with their text.

    Ordering by (shard, place, from_word) gives the output sequence.  The parts are worked out on
    numbers alone and meet the texts at the end, by doc_id and a hash of the text, so texts are
    shuffled once; equal rows, which these do not tell apart, are numbered on both sides.
    """
    joined = _joined(docs, weights, share, most, block_words, shard_slots, seed, "inner").where("n_words > 0")
    copy = F.dense_rank().over(Window.partitionBy("doc_id", "_print").orderBy("_source", "_bucket", "_row"))
    part = F.struct(
        "_copy", "shard", "place", F.col("_block").alias("block"), F.col("_from").alias("from_word"), "first_word",
        "n_words", "source_size", "target",
    )
    parts = joined.withColumn("_copy", copy).groupBy("doc_id", "_print").agg(F.collect_list(part).alias("_parts"))
    parts = parts.withColumnsRenamed({"doc_id": "_doc_id", "_print": "_hash"})
    same = Window.partitionBy("doc_id", "_print").orderBy(F.lit(0))
    rows = docs.select("doc_id", "source", "text", F.xxhash64("text").alias("_print")).withColumn("_number", F.row_number().over(same))
    met = rows.join(parts, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("_print") == F.col("_hash")))
    with_space = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    met = met.withColumn("_all", with_space)
    cut = F.transform(
        F.filter("_parts", lambda p: p["_copy"] == F.col("_number")),
        lambda p: p.withField("text", F.array_join(
            F.slice("_all", (p["first_word"] + 1).cast("int"), p["n_words"].cast("int")), ""
        )),
    )
    found = met.select("doc_id", "source", F.explode(cut).alias("_p"))
    return found.select(
        "_p.shard", "_p.place", "source", "_p.block", "_p.from_word", "doc_id", "_p.first_word", "_p.n_words",
        "_p.source_size", "_p.target", "_p.text",
    )
