"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

Method: words and beginnings of words that come up more often in toxic than in other labelled documents
form a lexicon, each with a strength: the lower bound of its log odds ratio.  A document is described by
``FEATURES``: densities and counts of words by strength, and of a fixed list of insults, the closeness of
such words to words for the second person, capitals, punctuation, and spellings that hide a word.
Spark MLlib fits gradient-boosted trees to them, and isotonic regression, on documents that the trees
have not seen, turns their output into a probability.

The labelled documents are learnt from in ``FOLDS`` parts: a document's features, when it is learnt from,
come from a lexicon without its own part.  Documents that share the least hash of their word triples
(copies, mostly) stay in one part and are learnt from once.  The model is fitted on a bounded sample: at
most ``SAMPLE`` labelled documents, the first by a hash of their id, and a lexicon of at most ``TERMS``
entries, the strongest.  Scoring covers all documents, and whole texts.

Nulls: a null text counts as empty; rows without a label or doc_id are not learnt from but scored; a null
doc_id is scored and counts as not held out.  A doc_id with several labels counts with the smallest, and
one with several texts is learnt from once.  Repeated rows get equal scores.  Without labels of both
kinds the score is the share of toxic ones, and 0.5 without any.  Only doc_id and text are read, so other
columns cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.passage_quality import held_out
from jobtide.llm.scratch import written
from jobtide.llm.texts import SPACE, Texts, map_texts, mix, prefix, range_hash, sums_by

SAMPLE, TERMS = 20_000, 1 << 14
FOLDS, CALIBRATION = 3, 4
#: Code points in the beginnings of words that the lexicon may hold.
BEGINNINGS = (3, 4, 5, 6)
#: Documents a term is in at least, and strengths that are told apart.
LEAST, LEVELS = 3, (1.5, 3.0, 4.5)
#: Words on each side that count as close.
NEAR = 5
TREES, DEPTH, STEP, BINS = 30, 4, 0.2, 64
THRESHOLD = 0.7

#: Insults and words for the second person in the languages of the corpus.
INSULTS = """
    idiot idiots idiotic stupid moron moronic loser losers pathetic trash garbage scum clown disgusting worthless
    dumb imbecile fool filthy vermin pig coward liar freak jerk bastard bitch shit crap asshole fuck fucking
    useless ugly hate retard dämlich dumm trottel arschloch scheiße abschaum versager widerlich wertlos
    imbécile crétin connard salaud merde ordure minable dégoûtant nul idiota estúpido imbécil basura asqueroso
    inútil payaso mierda cabrón
""".split()
SECOND_PERSON = """
    you your yours yourself u ur du dich dir dein deine deinen deiner euch tu toi ton tes vous votre vos tú ti
    usted ustedes vosotros
""".split()

FEATURES = (
    "size", *(f"density_{i}" for i in range(len(LEVELS))), *(f"count_{i}" for i in range(len(LEVELS))), "strongest",
    "insult_density", "insult_count", "near_second_person", "closeness", "second_person_density", "capital_share",
    "capital_word_share", "mark_density", "exclamations", "repeated_marks", "hidden_rate", "hidden_hits", "stretched_rate",
)

_LETTER, _CAPITAL, _MARK, _DIGIT = (np.zeros(256, bool) for _ in range(4))
_LETTER[97:123] = _LETTER[65:91] = _LETTER[128:] = True
_CAPITAL[65:91] = _DIGIT[48:58] = True
_MARK[[ord(c) for c in "!?.,;:'\"()-#*$%&@|<>/\\^~_+="]] = True
#: Signs that stand for letters, and signs that are put between letters.
_STANDS = dict(zip("013457@$!|", "oieastasil"))
_BETWEEN = "*._-"
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[[ord(c) for c in _STANDS]] = [ord(c) for c in _STANDS.values()]
_DROPPED = np.zeros(256, bool)
_DROPPED[[ord(c) for c in _BETWEEN]] = True
_HIDING = _DROPPED | np.isin(np.arange(256), [ord(c) for c in _STANDS])


def folded(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z and the capitals of Latin-1 as small letters."""
    out = data.copy()
    out[_CAPITAL[data]] += 32
    if len(data) > 1:
        second = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
        out[second] += 32
    return out


def _runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs within texts, and offsets of the texts among the runs."""
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(inside))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, offsets)


class Vocabulary:
    """Words of texts as hashes: runs of letters and digits, small, with the hashes of their beginnings."""

    def __init__(self, texts: Texts):
        self.data = folded(texts.data)
        self.start, self.end, self.first = _runs((_LETTER | _DIGIT)[self.data], texts.offsets)
        self.sums = prefix(self.data)
        self.words = range_hash(self.sums, self.start, self.end)
        self.letters = np.flatnonzero((self.data & 0xC0) != 0x80)

    def beginnings(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Which words have at least so many code points, and the hashes of their first ones."""
        at = np.searchsorted(self.letters, self.start) + size
        ends = np.append(self.letters, len(self.data))
        end = ends[np.minimum(at, len(ends) - 1)]
        long = np.flatnonzero((at < len(ends)) & (end <= self.end))
        return long, mix(range_hash(self.sums, self.start[long], end[long]) + np.uint64(size))

    def terms(self):
        """Pairs of places among the words and hashes: all words, then their beginnings of each size."""
        yield np.arange(len(self.words)), self.words
        for size in BEGINNINGS:
            yield self.beginnings(size)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def word_hashes(words: list[str]) -> np.ndarray:
    """Ascending hashes of given words, as ``Vocabulary`` has them."""
    column = Texts(pa.array(words))
    return np.unique(range_hash(prefix(folded(column.data)), column.offsets[:-1], column.offsets[1:]))


def _held(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are in a sorted array, and where."""
    if not len(sorted_keys):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return sorted_keys[at] == keys, at


@dataclass
class Lexicon:
    """Term hashes, ascending, with their strengths: a row without each fold, then one of all folds."""

    terms: np.ndarray
    strengths: np.ndarray

    @staticmethod
    def of(terms: np.ndarray, toxic: np.ndarray, other: np.ndarray, all_toxic: np.ndarray, all_other: np.ndarray) -> "Lexicon":
        """From documents by term and fold; the last two are the documents of each fold."""
        rows = []
        for left_out in [*np.eye(FOLDS, dtype=bool), np.zeros(FOLDS, bool)]:
            a, b = toxic[:, ~left_out].sum(axis=1), other[:, ~left_out].sum(axis=1)
            p, n = all_toxic[~left_out].sum(), all_other[~left_out].sum()
            ratio = np.log((a + 0.5) / (p + 1)) - np.log((b + 0.5) / (n + 1))
            bound = ratio - np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
            rows.append(np.where(a >= LEAST - 1, np.maximum(bound, 0), 0))
        order = np.argsort(terms)
        return Lexicon(terms[order], np.array(rows, np.float32)[:, order])

    def strength(self, words: Vocabulary, version: np.ndarray) -> np.ndarray:
        """For each word the greatest strength of it and its beginnings; ``version`` is by text."""
        out = np.zeros(len(words.words), np.float32)
        of = np.repeat(version, np.diff(words.first))
        for places, keys in words.terms():
            known, at = _held(self.terms, keys)
            places = places[known]
            out[places] = np.maximum(out[places], self.strengths[of[places], at[known]])
        return out


def _unhidden(texts: Texts) -> tuple[Vocabulary, np.ndarray, np.ndarray]:
    """Words as meant where signs hide them: their vocabulary, the text of each, and all such words by text."""
    start, end, first = _runs(~SPACE[texts.data], texts.offsets)
    owner = np.repeat(np.arange(texts.n), np.diff(first))
    body = _LETTER[texts.data]
    count = lambda mask: np.concatenate([[0], np.cumsum(mask)])
    places = np.flatnonzero(body)
    # A word reaches from its first to its last letter; a sign that stands for a letter may also lead.
    low = np.append(places, len(body))[np.searchsorted(places, start)]
    high = np.append(places, 0)[np.maximum(np.searchsorted(places, end) - 1, 0)] + 1 if len(places) else end
    leads = (low > start) & np.isin(texts.data[np.maximum(low - 1, 0)], [ord(c) for c in _STANDS if c not in "!|"])
    low = np.where(leads, low - 1, low)
    good = (low < high) & (low >= start) & (high <= end)
    start, end, owner = low[good], high[good], owner[good]
    hides, letters = count(_HIDING[texts.data]), count(body)
    mixed = (hides[end] > hides[start]) & (letters[end] - letters[start] >= 2)
    start, end, owner = start[mixed], end[mixed], owner[mixed]
    size = end - start
    offsets = np.concatenate([[0], np.cumsum(size)])
    data = texts.data[np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])]
    kept = ~_DROPPED[data]
    bounds = count(kept)[offsets]
    column = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(start), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(_PLAIN[data[kept]].copy())]
    )
    return Vocabulary(Texts(column.cast(pa.large_string(), safe=False))), owner, np.bincount(owner, minlength=texts.n)


def features(texts: Texts, lexicon: Lexicon, version: np.ndarray, insults: np.ndarray, persons: np.ndarray) -> np.ndarray:
    """A row of ``FEATURES`` for each text (float32)."""
    words = Vocabulary(texts)
    strength = lexicon.strength(words, version)
    n = np.diff(words.first)
    some = np.maximum(n, 1)
    by_text = lambda x: sums_by(x.astype(np.int64), words.first)
    insult, person = _held(insults, words.words)[0], _held(persons, words.words)[0]
    counts = [by_text(strength >= level) for level in LEVELS]
    strongest = np.zeros(texts.n, np.float32)
    np.maximum.at(strongest, words.owners(), strength)
    hit = insult | (strength >= LEVELS[1])
    gap = _gaps(person, words.first)
    near = by_text(hit & (gap <= NEAR))
    closest = np.full(texts.n, np.inf)
    np.minimum.at(closest, words.owners()[hit], gap[hit])
    data = texts.data
    by_byte = lambda mask: sums_by(mask.astype(np.int64), texts.offsets)
    letters, capital = by_byte(_LETTER[data]), np.concatenate([[0], np.cumsum(_CAPITAL[data])])
    loud = (capital[words.end] - capital[words.start] == words.end - words.start) & (words.end - words.start > 1)
    calls = (data == ord("!")) | (data == ord("?"))
    again, thrice = np.zeros(len(data), bool), np.zeros(len(data), bool)
    again[1:] = calls[1:] & calls[:-1]
    small = words.data
    thrice[2:] = _LETTER[small[2:]] & (small[2:] < 128) & (small[2:] == small[1:-1]) & (small[2:] == small[:-2])
    hidden, of, hidden_n = _unhidden(texts)
    # A stem may be several words of the vocabulary; each belongs to the text of its stem.
    meant = lexicon.strength(hidden, version[of]) >= LEVELS[1]
    meant |= _held(insults, hidden.words)[0]
    hidden_hits = np.bincount(of[hidden.owners()], meant, texts.n)
    size = np.maximum(np.diff(texts.offsets), 1)
    columns = [
        np.log1p(n), *(c / some for c in counts), *(np.log1p(c) for c in counts), strongest,
        by_text(insult) / some, np.log1p(by_text(insult)), near / np.maximum(by_text(hit), 1), 1 / (1 + closest),
        by_text(person) / some, by_byte(_CAPITAL[data]) / np.maximum(letters, 1), by_text(loud) / some,
        by_byte(_MARK[data]) / size, by_byte(calls) / some, by_byte(again) / some, hidden_n / some,
        np.log1p(hidden_hits), by_byte(thrice) / some,
    ]
    return np.stack(columns, axis=1).astype(np.float32)


def _gaps(marked: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each word the distance in words to the nearest marked one of its text."""
    n = len(marked)
    low, high = np.repeat(first[:-1], np.diff(first)), np.repeat(first[1:], np.diff(first))
    at, places = np.arange(n), np.flatnonzero(marked)
    if not len(places):
        return np.full(n, np.inf)
    k = np.searchsorted(places, at, "right")
    before = np.where(k > 0, places[np.maximum(k - 1, 0)], -1)
    after = np.where(k < len(places), places[np.minimum(k, len(places) - 1)], n)
    return np.minimum(np.where(before >= low, at - before, np.inf), np.where(after < high, after - at, np.inf))


def sampled(docs: DataFrame, labels: DataFrame, label: str, sample: int) -> DataFrame:
    """(doc_id, label, text, part) of at most ``sample`` labelled documents, one of those with one part."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # At most ``sample`` ids, so they may be sent to all tasks.
    met = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    one = met.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def run(rows, texts):
        shingles, first = texts.words(fold=True).shingles(3)
        least = np.zeros(texts.n, np.uint64)
        some = np.flatnonzero(np.diff(first))
        if len(some):
            least[some] = np.minimum.reduceat(shingles, first[some])
        part = pa.array(mix(least).view(np.int64))
        return pa.RecordBatch.from_arrays([*rows.columns, part], ["doc_id", "label", "text", "part"])

    one = one.select(F.col("doc_id").cast("string").alias("doc_id"), "label", "text")
    held = written(map_texts(one, run, "doc_id string, label int, text string, part long"), "toxic-sample")
    kept = held.groupBy("part", "label").agg(F.min("doc_id").alias("doc_id"))
    return held.join(kept, ["part", "label", "doc_id"])


def _fold(part: np.ndarray) -> np.ndarray:
    return (part.view(np.uint64) % np.uint64(FOLDS)).astype(np.int64)


def lexicon_of(sample: DataFrame, terms: int = TERMS) -> Lexicon:
    """The strongest terms of the sample, counted once a document in Spark."""
    columns = [f"{kind}{k}" for kind in ("t", "o") for k in range(FOLDS)]

    def run(rows, texts):
        words = Vocabulary(texts)
        owner = words.owners()
        parts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for places, keys in words.terms():
            parts[0].append(keys)
            parts[1].append(owner[places])
        keys, of = (np.concatenate(p) for p in parts)
        _, once = np.unique(mix(keys + of.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)), return_index=True)
        keys, of = keys[once], of[once]
        label = rows.column(1).to_numpy().astype(bool)
        column = np.where(label[of], 0, FOLDS) + _fold(rows.column(3).to_numpy())[of]
        found, place = np.unique(keys, return_inverse=True)
        n = np.bincount(place * 2 * FOLDS + column, minlength=len(found) * 2 * FOLDS).reshape(-1, 2 * FOLDS)
        return pa.RecordBatch.from_arrays(
            [pa.array(found.view(np.int64)), *(pa.array(n[:, k].astype(np.int64)) for k in range(2 * FOLDS))], ["term", *columns]
        )

    counted = map_texts(sample.select("doc_id", "label", "text", "part"), run, f"term long, {', '.join(f'{c} long' for c in columns)}")
    total = lambda kind: sum((F.col(f"{kind}{k}") for k in range(1, FOLDS)), F.col(f"{kind}0"))
    found = counted.groupBy("term").agg(*[F.sum(c).alias(c) for c in columns]).where(total("t") >= LEAST)
    fold = F.pmod(F.shiftrightunsigned("part", 1) % FOLDS * 2 + F.col("part").bitwiseAND(F.lit(1)), F.lit(FOLDS))
    sizes = np.zeros((2, FOLDS), np.int64)
    for r in sample.groupBy("label", fold.alias("fold")).count().collect():
        sizes[0 if r["label"] else 1, r["fold"]] += r["count"]
    ratio = F.log((total("t") + 0.5) / float(sizes[0].sum() + 1)) - F.log((total("o") + 0.5) / float(sizes[1].sum() + 1))
    bound = ratio - F.sqrt(1 / (total("t") + 0.5) + 1 / (total("o") + 0.5))
    top = found.where(bound >= LEVELS[0]).orderBy(bound.desc(), "term").limit(terms).toArrow()
    n = np.stack([top.column(c).to_numpy() for c in columns], axis=1).astype(np.int64)
    return Lexicon.of(top.column("term").to_numpy().view(np.uint64), n[:, :FOLDS], n[:, FOLDS:], *sizes)


@dataclass
class Model:
    """Without trees the score is ``rate``."""

    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    rate: float = 0.5


def described(rows: DataFrame, lexicon: Lexicon, kept: list[str], version: str | None = None) -> DataFrame:
    """The kept columns and a vector of features; ``version`` names the column with the fold to leave out."""
    sent = rows.sparkSession.sparkContext.broadcast((lexicon, word_hashes(INSULTS), word_hashes(SECOND_PERSON)))

    def run(batch, texts):
        held, insults, persons = sent.value
        if version is None:
            chosen = np.full(texts.n, FOLDS)
        else:
            chosen = _fold(batch.column(batch.schema.get_field_index(version)).to_numpy())
        x = features(texts, held, chosen, insults, persons)
        flat = pa.ListArray.from_arrays(pa.array(np.arange(texts.n + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
        columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
        return pa.RecordBatch.from_arrays([*columns, flat], [*kept, "x"])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept)
    found = map_texts(rows, run, f"{kinds}, x array<float>")
    return found.withColumn("x", array_to_vector(F.col("x").cast("array<double>")))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> Model:
    """The model from at most ``sample`` labelled documents."""
    held = written(sampled(docs, labels, label, sample), "toxic-learnt")
    lexicon = lexicon_of(held)
    to_calibrate = F.pmod(F.xxhash64("part"), F.lit(CALIBRATION)) == 0
    x = described(held, lexicon, ["label", "part"], "part").withColumn("to_calibrate", to_calibrate)
    x = written(x.withColumn("label", F.col("label").cast("double")), "toxic-features")
    sizes = {(r["to_calibrate"], r["label"]): r["count"] for r in x.groupBy("to_calibrate", "label").count().collect()}
    everything = sum(sizes.values())
    rate = sum(n for (_, y), n in sizes.items() if y) / everything if everything else 0.5
    if not all(sizes.get((False, y)) for y in (0.0, 1.0)):
        return Model(lexicon, None, None, rate)
    trees = GBTClassifier(
        featuresCol="x", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, maxBins=BINS, minInstancesPerNode=5, seed=7
    ).fit(x.where(~F.col("to_calibrate")).coalesce(4).sortWithinPartitions("part", "label"))
    seen = _probability(trees, x.where("to_calibrate")).groupBy(F.round("p", 3).alias("p"))
    seen = seen.agg(F.avg("label").alias("label"), F.count("*").cast("double").alias("weight"))
    if not all(sizes.get((True, y)) for y in (0.0, 1.0)):
        return Model(lexicon, trees, None, rate)
    steps = IsotonicRegression(featuresCol="p", labelCol="label", weightCol="weight").fit(seen.coalesce(1))
    return Model(lexicon, trees, steps, rate)


def _probability(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    kept = [c for c in rows.columns if c != "x"]
    return trees.transform(rows).select(*kept, vector_to_array("probability")[1].alias("p"))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per document row: doc_id, held_out, score and predicted."""
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    if model.trees is None:
        found = rows.select("doc_id", "held_out", F.lit(float(model.rate)).alias("score"))
    else:
        found = _probability(model.trees, described(rows, model.lexicon, ["doc_id", "held_out"]))
        if model.calibration is None:
            found = found.withColumnRenamed("p", "score")
        else:
            found = model.calibration.transform(found).select("doc_id", "held_out", F.col("prediction").alias("score"))
        found = found.withColumn("score", F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)))
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
