"""Quality classifier: attention-based multiple-instance learning over passages.

Method: a whole text is cut into passages of ``PASSAGE_WORDS`` words.  Each passage is encoded by how
often classes of neighbouring characters follow each other and by a few figures of its words.  Gated
attention, learnt from document labels alone, weighs the passages; the weighted passage gives the
score.  Only the text enters the encoding.

The model is fitted on a bounded sample of labelled documents: at most ``SAMPLE`` documents, the first
by a hash of their id, of at most ``SAMPLE_PASSAGES`` passages each.  Scoring covers all documents.

Nulls: a null text counts as empty and has one empty passage; rows without a label or doc_id are not
learnt from but scored; a null doc_id is scored and counts as not held out.  Repeated rows get equal
scores; a doc_id with several labels counts with the smallest, one with several texts is learnt from once.  Without any label every score is 0.5.
Very long texts are read whole.  Only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.llm.texts import SPACE, Texts, map_texts, mix

PASSAGE_WORDS = 64
SAMPLE, SAMPLE_PASSAGES = 4000, 64
HIDDEN, EPOCHS, RATE, DECAY = 16, 250, 0.02, 1e-4
CLASSES = 9
FEATURES = CLASSES * CLASSES + 4

#: Character classes: 0 blank, 1 line end, 2 small, 3 capital, 4 digit, 5 mark, 6 ! or ?, 7 sign, 8 other.
_CLASS = np.full(256, 7, np.uint8)
_CLASS[SPACE] = 0
_CLASS[10] = 1
_CLASS[97:123] = 2
_CLASS[65:91] = 3
_CLASS[48:58] = 4
_CLASS[[ord(c) for c in ".,;:'\"()-"]] = 5
_CLASS[[ord(c) for c in "!?"]] = 6
_CLASS[128:] = 8


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def encoded(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages (float32), and the offsets of the texts among the passages."""
    words = texts.words()
    counts = words.counts()
    parts = np.maximum(-(-counts // PASSAGE_WORDS), 1)
    first = np.zeros(texts.n + 1, np.int64)
    np.cumsum(parts, out=first[1:])
    total = int(first[-1])
    within = np.arange(len(words.hashes)) - np.repeat(words.first[:-1], counts)
    of_word = np.repeat(first[:-1], counts) + within // PASSAGE_WORDS
    # A passage reaches from its first word to that of the next one; the first one also has what precedes.
    starts = np.repeat(texts.offsets[:-1], parts)
    leads = (within % PASSAGE_WORDS == 0) & (within > 0)
    starts[of_word[leads]] = words.start[leads]
    sizes = np.diff(np.append(starts, len(texts.data)))
    of_byte = np.repeat(np.arange(total), sizes)
    classes = _CLASS[texts.data].astype(np.int64)
    pair = classes[:-1] * CLASSES + classes[1:]
    same = np.ones(max(len(classes) - 1, 0), bool)
    edges = texts.offsets[1:-1]
    same[edges[(edges > 0) & (edges < len(classes))] - 1] = False
    codes = (of_byte[:-1] * (CLASSES * CLASSES) + pair)[same]
    followed = np.bincount(codes, minlength=total * CLASSES * CLASSES).reshape(total, -1)
    out = np.zeros((total, FEATURES), np.float32)
    out[:, : CLASSES * CLASSES] = np.sqrt(followed / np.maximum(followed.sum(axis=1, keepdims=True), 1))
    n = np.bincount(of_word, minlength=total)
    keys = mix(words.hashes + of_word.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
    _, at = np.unique(keys, return_index=True)
    distinct = np.bincount(of_word[at], minlength=total)
    again = (words.hashes[1:] == words.hashes[:-1]) & (of_word[1:] == of_word[:-1])
    out[:, -4] = np.log1p(n)
    out[:, -3] = np.bincount(of_word, words.end - words.start, total) / np.maximum(n, 1) / 10
    out[:, -2] = distinct / np.maximum(n, 1)
    out[:, -1] = np.bincount(of_word[1:][again], minlength=total) / np.maximum(n, 1)
    return out, first


class Model:
    """Gated attention over passages: weights softmax(w (tanh(x V) * sigmoid(x U)))."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
        self.p = {
            "V": small(FEATURES, HIDDEN), "U": small(FEATURES, HIDDEN), "w": small(HIDDEN),
            "c": small(FEATURES), "b": np.zeros(1, np.float32),
        }
        self.mean, self.scale = np.zeros(FEATURES, np.float32), np.ones(FEATURES, np.float32)

    def forward(self, x: np.ndarray, first: np.ndarray):
        p = self.p
        t, g = np.tanh(x @ p["V"]), 1 / (1 + np.exp(-(x @ p["U"])))
        e = np.exp(np.clip((t * g) @ p["w"], -30, 30))
        owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
        a = e / np.add.reduceat(e, first[:-1])[owner]
        z = np.add.reduceat(a[:, None] * x, first[:-1], axis=0)
        return t, g, a, z, owner, z @ p["c"] + p["b"][0]

    def scores(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        x = (x - self.mean) / self.scale
        logit = self.forward(x, first)[-1].astype(np.float64)
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))

    @staticmethod
    def fitted(x: np.ndarray, first: np.ndarray, y: np.ndarray) -> "Model":
        """Full-batch Adam on the log loss of the documents; every passage list has a member."""
        m = Model()
        m.mean, m.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        x = ((x - m.mean) / m.scale).astype(np.float32)
        rate = float(np.clip(y.mean(), 0.02, 0.98))
        m.p["b"][0] = np.log(rate / (1 - rate))
        first_moment = {k: np.zeros_like(v) for k, v in m.p.items()}
        second_moment = {k: np.zeros_like(v) for k, v in m.p.items()}
        for step in range(1, EPOCHS + 1):
            t, g, a, z, owner, logit = m.forward(x, first)
            d_logit = ((1 / (1 + np.exp(-logit)) - y) / len(y)).astype(np.float32)
            d_z = d_logit[:, None] * m.p["c"]
            d_a = np.einsum("ij,ij->i", x, d_z[owner])
            d_e = a * (d_a - np.add.reduceat(a * d_a, first[:-1])[owner])
            d_h = d_e[:, None] * m.p["w"]
            gradient = {
                "c": z.T @ d_logit, "b": np.array([d_logit.sum()]), "w": (t * g).T @ d_e,
                "V": x.T @ (d_h * g * (1 - t * t)), "U": x.T @ (d_h * t * g * (1 - g)),
            }
            for k, v in m.p.items():
                d = gradient[k] + (DECAY * v if k != "b" else 0)
                first_moment[k] = 0.9 * first_moment[k] + 0.1 * d
                second_moment[k] = 0.99 * second_moment[k] + 0.01 * d * d
                v -= RATE * (first_moment[k] / (1 - 0.9**step)) / (np.sqrt(second_moment[k] / (1 - 0.99**step)) + 1e-8)
        return m


def sampled(docs: DataFrame, labels: DataFrame, label: str, sample: int) -> DataFrame:
    """(doc_id, label, passages, features) of the documents to learn from; at most ``sample``, one row of each id."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def run(rows, texts):
        x, first = encoded(texts)
        return pa.RecordBatch.from_arrays(
            [rows.column(0), rows.column(1), pa.array(np.diff(first)),
             pa.array([x[first[k] : first[k + 1]].tobytes() if first[k + 1] - first[k] <= SAMPLE_PASSAGES else None for k in range(texts.n)], pa.binary())],
            ["doc_id", "label", "passages", "features"],
        )

    met = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    found = met.groupBy(F.col("doc_id").cast("long").alias("doc_id"), "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return map_texts(found, run, "doc_id long, label int, passages long, features binary").where("features is not null")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Model | None:
    """The model from the sample, which the driver holds: at most ``sample`` * ``SAMPLE_PASSAGES`` passages."""
    rows = sampled(docs, labels, label, sample).toArrow().sort_by("doc_id")
    if not rows.num_rows:
        return None
    x = np.frombuffer(b"".join(rows.column("features").to_pylist()), np.float32).reshape(-1, FEATURES)
    first = np.concatenate([[0], np.cumsum(rows.column("passages").to_numpy())])
    return Model.fitted(x, first, rows.column("label").to_numpy().astype(np.float32))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per document row: doc_id, held_out, score and predicted."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(rows, texts):
        if sent.value is None:
            found = np.full(texts.n, 0.5)
        else:
            found = sent.value.scores(*encoded(texts))
        return pa.RecordBatch.from_arrays(
            [rows.column(0), rows.column(1), pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
            ["doc_id", "held_out", "score", "predicted"],
        )

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(rows, run, f"doc_id {kind}, held_out boolean, score double, predicted int")
