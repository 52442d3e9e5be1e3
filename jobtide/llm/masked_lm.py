"""Language-model scoring by masked pseudo-likelihood.

Method: a bidirectional window network, trained in numpy, predicts every token from the tokens on
both sides of it: embeddings of ``SIDE`` tokens on each side, a tanh layer, and a softmax in two levels,
over groups of ``GROUP`` classes and over the classes of the token's group.  A document's score is the sum of the log-probabilities of its tokens, each given its
surroundings: that of its class, and that of the word within its class.

Tokens are words; their classes are the most frequent words of the whole corpus, counted in Spark, and
buckets by their last ``ENDING`` bytes for all others, so that a bucket tells of language and form.  There are ``FREQUENT`` classes of one word, and ``MORE`` more for every
doubling of the corpus beyond ``FROM`` words.  A word has in its bucket its share of the bucket's
tokens in the whole corpus.  The ``COMMON`` words that are the most frequent in buckets are sent to the
tasks with their shares; all others are joined in Spark.  Training covers the corpus: in each round every task trains, from the
same parameters, on the places of its documents that fall to the round, and Spark averages the
parameters by the number of words trained on.  A hash of document and place deals the places over
``DRAW`` rounds, so after as many rounds every token has been a target once.  What is gathered grows
with the input, while the model that is sent back has a fixed size.

Nulls: a null text has no token, a sum of 0 and no mean; so does an empty text.  Repeated rows get
equal scores, but for rounding.  Words equally frequent come in the order of their hashes.  An empty corpus leaves the
model untrained.  Very long texts are scored whole.  Only doc_id and text are read, so other columns
cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.scratch import written
from jobtide.llm.texts import LOWER, Texts, Words, map_texts, mix, one_thread, pieces, release, small_batches, sums_by

CLASSES, FREQUENT = 512, 160
GROUP = 32
ENDING = 3
BUCKETS = CLASSES - 1 - FREQUENT
MORE, FROM = 16, 1 << 20
COMMON = 1 << 17
SIDE, WIDTH, HIDDEN = 2, 16, 32
ROUNDS, DRAW, BATCH, RATE = 2, 2, 1024, 0.1
STEP = 4096
#: Different words a task counts before it hands its counts on and starts anew.
REMEMBERED = 1 << 20


def buckets_of(texts: Texts, words: Words) -> np.ndarray:
    """The bucket of each word, by its last bytes with A-Z as a-z; a frequent word does not use its own."""
    data = np.concatenate([np.zeros(ENDING, np.uint8), LOWER[texts.data]])
    ending = np.zeros(len(words.hashes), np.uint64)
    for k in range(ENDING):
        held = words.end - words.start > k
        ending |= np.where(held, data[words.end + ENDING - 1 - k], 0).astype(np.uint64) << np.uint64(8 * k)
    return (mix(ending) % np.uint64(BUCKETS)).astype(np.int32)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, bucket, n): how often each word, by its hash, occurs in all documents."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for rows in pieces(batch):
                texts = Texts(rows.column(0))
                words = texts.words(fold=True)
                found, one, n = np.unique(words.hashes, return_index=True, return_counts=True)
                held.append((found, buckets_of(texts, words)[one], n))
                size += len(found)
                if size > REMEMBERED:
                    held = [_merged(held)]
                    size = len(held[0][0])
                if size > REMEMBERED // 2 and len(held) == 1:
                    yield _rows(*held[0])
                    held, size = [], 0
        if held:
            yield _rows(*_merged(held))
        release()

    def _rows(words, buckets, n):
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(buckets), pa.array(n)], ["word", "bucket", "n"])

    small_batches(docs.sparkSession)
    counted = docs.select("text").mapInArrow(run, "word long, bucket int, n long")
    return counted.groupBy("word", "bucket").agg(F.sum("n").alias("n"))


def _merged(parts):
    words, buckets, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(words, kind="stable")
    words = words[order]
    at = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]])) if len(words) else np.zeros(0, np.int64)
    return words[at], buckets[order][at], np.add.reduceat(n[order], at) if len(at) else n


def frequent_count(tokens: int) -> int:
    """How many words have a class of their own in a corpus of so many tokens."""
    return FREQUENT + int(MORE * max(0.0, np.log2(max(tokens, 1) / FROM)))


def frequent_words(docs: DataFrame, counts: DataFrame | None = None) -> np.ndarray:
    """Hashes of the most frequent words, ``frequent_count`` of them, ascending."""
    counts = written(word_counts(docs), "lm-words") if counts is None else counts
    tokens = counts.agg(F.sum("n")).first()[0] or 0
    rows = counts.orderBy(F.desc("n"), "word").limit(frequent_count(tokens)).collect()
    return np.sort(np.array([r["word"] for r in rows], np.int64).view(np.uint64))


def class_count(frequent: np.ndarray) -> int:
    """Classes with the one outside texts; places of missing frequent words stay empty."""
    return 1 + max(FREQUENT, len(frequent)) + BUCKETS


def classes_of(texts: Texts, words: Words, frequent: np.ndarray) -> np.ndarray:
    """Class of each word: 0 is outside a text, then frequent words, then buckets."""
    out = buckets_of(texts, words).astype(np.int64) + class_count(frequent) - BUCKETS
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, words.hashes), len(frequent) - 1)
        known = frequent[at] == words.hashes
        out[known] = at[known] + 1
    return out


class Shares:
    """The words in buckets: their shares there, those of the most common ones and counts of the others."""

    def __init__(self, counts: DataFrame, frequent: np.ndarray, common: int = COMMON):
        own = counts.where(~F.col("word").isin(frequent.view(np.int64).tolist())) if len(frequent) else counts
        totals = dict(own.groupBy("bucket").agg(F.sum("n")).collect())
        self.totals = F.array(*[F.lit(float(totals.get(k, 1))) for k in range(BUCKETS)])
        steps = own.groupBy(F.floor(4 * F.log2("n")).alias("step")).agg(F.count("*").alias("words"), F.min("n").alias("n"))
        least, held = None, 0
        for r in sorted(steps.collect(), key=lambda r: -r["step"]):
            held += r["words"]
            if held > common:
                break
            least = r["n"]
        top = own.where(F.lit(False) if least is None else F.col("n") >= least)
        top = top.select("word", self.logarithm().alias("v")).toArrow()
        words = top.column("word").to_numpy().view(np.uint64)
        order = np.argsort(words)
        self.words, self.values = words[order], top.column("v").to_numpy()[order]
        self.others = own if least is None else own.where(F.col("n") < least)

    def logarithm(self):
        """The logarithm of a word's share, from columns bucket and n; a word without a count counts once."""
        return F.log(F.coalesce("n", F.lit(1)) / F.get(self.totals, F.col("bucket")))


def surroundings(classes: np.ndarray, first: np.ndarray, places: np.ndarray | None = None) -> np.ndarray:
    """For each token, or those at some places, the classes of the ``SIDE`` tokens on each side (tokens by places)."""
    # Texts are laid out with empty places between them, so that no place needs a test.
    shift = np.repeat(np.arange(1, len(first)) * SIDE, np.diff(first))
    spaced = np.zeros(len(classes) + len(first) * SIDE, np.int64)
    own = np.arange(len(classes)) + shift
    spaced[own] = classes
    at = own if places is None else own[places]
    out = np.empty((len(at), 2 * SIDE), np.int64)
    for k, step in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
        out[:, k] = spaced[at + step]
    return out


class Network:
    """Parameters in one float32 vector: embedding, hidden layer, and output layers of groups and classes."""

    @staticmethod
    def shapes(classes: int) -> dict[str, tuple]:
        groups = -(-classes // GROUP)
        return {
            "E": (classes, WIDTH), "W": (2 * SIDE * WIDTH, HIDDEN), "b": (HIDDEN,),
            "G": (HIDDEN, groups), "g": (groups,), "O": (groups, HIDDEN, GROUP), "c": (groups, GROUP),
        }

    def __init__(self, flat: np.ndarray | None = None, classes: int = CLASSES):
        shapes = self.shapes(classes)
        fresh = flat is None
        if fresh:
            size = sum(int(np.prod(s)) for s in shapes.values())
            flat = (np.random.default_rng(5).standard_normal(size) * 0.1).astype(np.float32)
        self.flat = np.array(flat, np.float32)
        for name, part in self.parts(self.flat, classes).items():
            setattr(self, name, part)
        if fresh and classes % GROUP:
            # Places of the last group that no class has.
            self.c[-1, classes % GROUP :] = -30
        self.classes, self.squares = classes, None

    @classmethod
    def parts(cls, flat: np.ndarray, classes: int) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in cls.shapes(classes).items():
            size = int(np.prod(shape))
            out[name] = flat[at : at + size].reshape(shape)
            at += size
        return out

    def gradient(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The gradient of the mean log loss of a batch."""
        n = len(target)
        flat = np.zeros_like(self.flat)
        d = self.parts(flat, self.classes)
        x = self.E[around].reshape(n, -1)
        h = np.tanh(x @ self.W + self.b)
        group, member = np.divmod(target, GROUP)
        p = _softmax(h @ self.G + self.g)
        p[np.arange(n), group] -= 1
        p /= n
        d["G"][:], d["g"][:] = h.T @ p, p.sum(axis=0)
        d_h = p @ self.G.T
        order, groups, edges = _by_group(group)
        own = h[order]
        p = self._within(own, groups, edges)
        p += self.c[group[order]]
        p = _softmax(p)
        p[np.arange(n), member[order]] -= 1
        p /= n
        back = np.empty_like(own)
        for k, low, high in zip(groups, edges, edges[1:]):
            np.matmul(own[low:high].T, p[low:high], out=d["O"][k])
            np.matmul(p[low:high], self.O[k].T, out=back[low:high])
        d["c"][groups] = np.add.reduceat(p, edges[:-1], axis=0)
        d_h[order] += back
        d_h *= 1 - h * h
        d["W"][:], d["b"][:] = x.T @ d_h, d_h.sum(axis=0)
        d_x = (d_h @ self.W.T).reshape(n * 2 * SIDE, WIDTH)
        # Short keys are sorted by radix.
        met = around.ravel().astype(np.uint16 if self.classes < 1 << 16 else np.int64)
        order = np.argsort(met, kind="stable")
        met = met[order]
        at = np.flatnonzero(np.concatenate([[True], met[1:] != met[:-1]]))
        d["E"][met[at]] = np.add.reduceat(d_x[order], at, axis=0)
        return flat

    def _within(self, own: np.ndarray, groups: list[int], edges: list[int]) -> np.ndarray:
        """What the hidden layer adds to the classes of each row's group; the rows come by group."""
        out = np.empty((len(own), GROUP), np.float32)
        for k, low, high in zip(groups, edges, edges[1:]):
            np.matmul(own[low:high], self.O[k], out=out[low:high])
        return out

    def train(self, around: np.ndarray, target: np.ndarray, rate: float) -> None:
        """One step of Adagrad on the mean log loss of a batch."""
        gradient = self.gradient(around, target)
        if self.squares is None:
            self.squares = np.full(len(self.flat), 1e-8, np.float32)
        step = gradient * gradient
        self.squares += step
        np.sqrt(self.squares, out=step)
        gradient *= rate
        gradient /= step
        self.flat -= gradient

    def log_probabilities(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The log-probability of each target, given the classes around it."""
        # What an embedding adds to the hidden layer at each place is looked up instead of multiplied.
        tables = [self.E @ self.W[k * WIDTH : (k + 1) * WIDTH] for k in range(2 * SIDE)]
        out = np.empty(len(target), np.float32)
        for low in range(0, len(target), STEP):
            part, goal = around[low : low + STEP], target[low : low + STEP]
            h = tables[0][part[:, 0]] + self.b
            for k in range(1, 2 * SIDE):
                h += tables[k][part[:, k]]
            np.tanh(h, out=h)
            group, member = np.divmod(goal, GROUP)
            found = _log_softmax_at(h @ self.G + self.g, group)
            order, groups, edges = _by_group(group)
            z = self._within(h[order], groups, edges)
            z += self.c[group[order]]
            found[order] += _log_softmax_at(z, member[order])
            out[low : low + STEP] = found
        return out


def _softmax(z: np.ndarray) -> np.ndarray:
    np.exp(np.clip(z, -60, 60, out=z), out=z)
    z /= z.sum(axis=1, keepdims=True)
    return z


def _log_softmax_at(z: np.ndarray, column: np.ndarray) -> np.ndarray:
    np.clip(z, -60, 60, out=z)
    own = z[np.arange(len(z)), column]
    return own - np.log(np.exp(z, out=z).sum(axis=1))


def _by_group(group: np.ndarray) -> tuple[np.ndarray, list[int], list[int]]:
    """Rows in the order of their groups, the groups that occur, and where each begins and the last ends."""
    order = np.argsort(group.astype(np.uint16), kind="stable")
    ordered = group[order]
    edges = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(group) else np.zeros(0, np.int64)
    return order, ordered[edges].tolist(), [*edges.tolist(), len(group)]


def rounds_of(words: Words, draw: int) -> np.ndarray:
    """The round of 0 to ``draw`` - 1 in which each token is a target, by its document and place in it."""
    total = np.zeros(len(words.hashes) + 1, np.uint64)
    np.cumsum(words.hashes, out=total[1:])
    document = mix(total[words.first[1:]] - total[words.first[:-1]])
    place = np.arange(len(words.hashes)) - np.repeat(words.first[:-1], words.counts())
    return mix(np.repeat(document, words.counts()) + place.astype(np.uint64)) % np.uint64(draw)


def train(docs: DataFrame, frequent: np.ndarray, rounds: int = ROUNDS, draw: int = DRAW) -> np.ndarray:
    """Parameters after the rounds; the same documents in the same partitions give the same ones.

    Every token is a target if there are as many rounds as ``draw`` or more.
    """
    spark = docs.sparkSession
    flat = Network(classes=class_count(frequent)).flat
    for turn in range(rounds):
        sent = spark.sparkContext.broadcast((flat, frequent))

        def run(batches, sent=sent, turn=turn):
            one_thread()
            start, known = sent.value
            network, seen = Network(start, class_count(known)), 0
            around, target = [], []
            for batch in batches:
                for rows in pieces(batch):
                    texts = Texts(rows.column(0))
                    words = texts.words(fold=True)
                    classes = classes_of(texts, words, known)
                    drawn = np.flatnonzero(rounds_of(words, draw) == turn % draw)
                    around.append(surroundings(classes, words.first, drawn))
                    target.append(classes[drawn])
                    if sum(map(len, target)) >= BATCH:
                        x, y = np.concatenate(around), np.concatenate(target)
                        order = np.argsort(mix(np.arange(len(y), dtype=np.uint64)))
                        x, y = x[order], y[order]
                        for low in range(0, len(y), BATCH):
                            network.train(x[low : low + BATCH], y[low : low + BATCH], RATE / (1 + turn))
                        seen += len(y)
                        around, target = [], []
            if target and sum(map(len, target)):
                x, y = np.concatenate(around), np.concatenate(target)
                network.train(x, y, RATE / (1 + turn))
                seen += len(y)
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(start), dtype=np.int32)), pa.array(network.flat.astype(np.float64) * seen),
                     pa.array(np.full(len(start), seen))], ["i", "v", "n"],
                )

        small_batches(spark)
        parts = docs.select("text").mapInArrow(run, "i int, v double, n long")
        mean = parts.groupBy("i").agg((F.sum("v") / F.sum("n")).alias("v")).toArrow()
        if mean.num_rows:
            flat = flat.copy()
            flat[mean.column("i").to_numpy()] = mean.column("v").to_numpy()
    return flat


def score(
    docs: DataFrame, flat: np.ndarray, frequent: np.ndarray, counts: DataFrame | None = None, common: int = COMMON
) -> DataFrame:
    """Per document row: doc_id, n_tokens, log_likelihood (nats) and mean_log_likelihood.

    ``counts`` are the words of the corpus, by default those of the documents.
    """
    shares = Shares(written(word_counts(docs), "lm-words") if counts is None else counts, frequent, common)
    sent = docs.sparkSession.sparkContext.broadcast((flat, frequent, shares.words, shares.values))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(rows, texts):
        one_thread()
        values, known, held, logarithms = sent.value
        words = texts.words(fold=True)
        classes = classes_of(texts, words, known)
        found = Network(values, class_count(known)).log_probabilities(surroundings(classes, words.first), classes).astype(np.float64)
        other = np.flatnonzero(classes >= class_count(known) - BUCKETS)
        if len(held):
            own = words.hashes[other]
            at = np.minimum(np.searchsorted(held, own), len(held) - 1)
            met = held[at] == own
            found[other[met]] += logarithms[at[met]]
            other = other[~met]
        first = pa.array(np.searchsorted(other, words.first).astype(np.int32))
        bucket = pa.array((classes[other] - class_count(known) + BUCKETS).astype(np.int32))
        rest = pa.StructArray.from_arrays([pa.array(words.hashes[other].view(np.int64)), bucket], ["word", "bucket"])
        return pa.RecordBatch.from_arrays(
            [rows.column(0), rows.column(2), pa.array(words.counts().astype(np.int64)), pa.array(sums_by(found, words.first)),
             pa.ListArray.from_arrays(first, rest)],
            ["doc_id", "row", "n_tokens", "total", "words"],
        )

    schema = f"doc_id {kind}, row long, n_tokens long, total double, words array<struct<word: long, bucket: int>>"
    numbered = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    parts = written(map_texts(numbered, run, schema), "lm-scores")
    joined = parts.select("row", F.explode("words").alias("w")).select("row", "w.*").join(shares.others.drop("bucket"), "word", "left")
    rest = joined.select(F.lit(None).cast(kind).alias("doc_id"), "row", F.lit(None).cast("long").alias("n_tokens"), shares.logarithm().alias("total"))
    found = parts.drop("words").unionByName(rest).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), F.sum("total").alias("log_likelihood")
    )
    mean = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    return found.select("doc_id", "n_tokens", "log_likelihood", mean.alias("mean_log_likelihood"))


def pseudo_likelihood(docs: DataFrame) -> DataFrame:
    """Scores of all documents by a model trained on them."""
    counts = written(word_counts(docs), "lm-words")
    frequent = frequent_words(docs, counts)
    return score(docs, train(docs, frequent), frequent, counts)
