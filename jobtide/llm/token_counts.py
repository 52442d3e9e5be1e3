"""Token counts per section by offset-mapped attribution.

Method: every whole document is encoded once.  The bytes of the tokens, laid end to end, are the
bytes of the text, so running token sizes give each token's byte span and from it its span of code
points.  Spans are interval-joined to the document's sections.  Rule for a token that crosses a
boundary: it counts for the section that holds most of its characters, and for the earlier one of
equals; a token that no section touches counts for the row with a null section.

The vocabulary is a file of byte-pair ranks (base64 token and rank a line), read by the driver from
the given path and sent to the tasks.

Nulls: a null text has no token; a null doc_id is reported as null.  Sections without tokens count
0.  An empty text has one empty line.  Repeated rows are reported each.  Very long texts are encoded
whole.  Sections may overlap; of two that hold a token alike, the one that starts earlier counts,
then the one with the smaller end.  Only doc_id, text and the sections are read, so other columns
cannot clash.
"""

from __future__ import annotations

import base64
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.line_dedup import Points
from jobtide.llm.texts import Texts, map_texts, ship

# Fixed value: how the vocabulary's texts are split before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

_encoders: dict[int, "Encoder"] = {}


class Encoder:
    """Byte-pair encoder that also knows the size of each token in bytes."""

    def __init__(self, ranks: bytes):
        table = {}
        for line in ranks.splitlines():
            if line:
                token, rank = line.split()
                table[base64.b64decode(token)] = int(rank)
        self.inner = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.sizes = np.zeros(max(table.values(), default=-1) + 1, np.int64)
        for token, rank in table.items():
            self.sizes[rank] = len(token)

    def ends(self, text: str) -> np.ndarray:
        """Byte offset at which each token of the text ends."""
        return np.cumsum(self.sizes[self.inner.encode_to_numpy(text, disallowed_special=())])


def allocated(start: np.ndarray, end: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each token [start, end) the section [low, high) it counts for, -1 for none.

    Sections come ordered by (low, high).
    """
    out = np.full(len(start), -1)
    if not len(low):
        return out
    if (low[1:] >= high[:-1]).all():
        at = np.searchsorted(low, start, "right") - 1
        inside = (at >= 0) & (end <= high[at])
        out[inside] = at[inside]
        todo = np.flatnonzero(~inside)
        reach = high
    else:
        todo = np.arange(len(start))
        reach = np.maximum.accumulate(high)
    for k in todo.tolist():
        first, last = np.searchsorted(reach, start[k], "right"), np.searchsorted(low, end[k])
        if first < last:
            held = np.minimum(high[first:last], end[k]) - np.maximum(low[first:last], start[k])
            best = int(held.argmax())
            if held[best] > 0:
                out[k] = first + best
    return out


def _counted(docs: DataFrame, vocabulary: str, sections_of: Callable) -> DataFrame:
    spark = docs.sparkSession
    ship(spark)
    with open(vocabulary, "rb") as f:
        sent = spark.sparkContext.broadcast(f.read())
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(rows, texts):
        key = hash(sent.value)
        if key not in _encoders:
            _encoders.clear()
            _encoders[key] = Encoder(sent.value)
        encoder = _encoders[key]
        before = np.zeros(len(texts.data) + 1, np.int64)
        np.cumsum(texts.characters(), out=before[1:])
        columns = [[], [], [], [], []]
        names, lows, highs = sections_of(rows)
        for k, text in enumerate(rows.column(rows.schema.get_field_index("text")).to_pylist()):
            ends = texts.offsets[k] + encoder.ends(text or "")
            starts = np.concatenate([texts.offsets[k : k + 1], ends[:-1]])[: len(ends)]
            base = before[texts.offsets[k]]
            low, high = lows[k], highs[k]
            found = allocated(before[starts + 1] - 1 - base, before[ends] - base, low, high)
            counts = np.bincount(found + 1, minlength=len(low) + 1)
            shown = slice(None) if counts[0] else slice(1, None)
            columns[0].append(np.full(len(low) + 1, k)[shown])
            columns[1].append(([None] + list(names[k]))[shown])
            columns[2].append(np.append(-1, low)[shown])
            columns[3].append(np.append(-1, high)[shown])
            columns[4].append(counts[shown])
        if not rows.num_rows:
            columns = [[np.zeros(0, np.int64)], [[]], *[[np.zeros(0, np.int64)]] * 3]
        low, high = np.concatenate(columns[2]).astype(np.int64), np.concatenate(columns[3]).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [
                rows.column(0).take(pa.array(np.concatenate(columns[0]))),
                pa.array([x for part in columns[1] for x in part], pa.string()),
                pa.array(low, mask=low < 0), pa.array(high, mask=high < 0), pa.array(np.concatenate(columns[4]).astype(np.int64)),
            ],
            ["doc_id", "section", "first_char", "end_char", "n_tokens"],
        )

    return map_texts(docs, run, f"doc_id {kind}, section string, first_char long, end_char long, n_tokens long")


def line_sections(rows: pa.RecordBatch):
    """Each line with its line feed as a section, named by its number from 0."""
    points = Points(rows.column(rows.schema.get_field_index("text")))
    start, end, first = points.lines()
    last = np.zeros(len(start), bool)
    last[first[1:] - 1] = True
    end = np.where(last, end, end + 1)
    base = np.repeat(points.offsets[:-1], np.diff(first))
    cut = lambda x: [x[a:b] for a, b in zip(first[:-1], first[1:])]
    return [map(str, range(b - a)) for a, b in zip(first[:-1], first[1:])], cut(start - base), cut(end - base)


def tokens_by_line(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, section, first_char, end_char, n_tokens) for each line of each document."""
    return _counted(docs.select("doc_id", "text"), vocabulary, line_sections)


def tokens_by_section(docs: DataFrame, sections: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """As ``tokens_by_line`` for given sections: (doc_id, section, first_char, end_char), in code points.

    A document without sections has at most its row with a null section.  Sections with a null bound
    are left out.
    """
    bounds = F.struct(*[F.col(c).cast(k).alias(c) for c, k in (("first_char", "long"), ("end_char", "long"), ("section", "string"))])
    given = sections.where("first_char is not null and end_char is not null").groupBy(F.col("doc_id").alias("_doc_id"))
    given = given.agg(F.array_sort(F.collect_list(bounds)).alias("_sections"))
    joined = docs.select("doc_id", "text").join(given, F.col("doc_id") == F.col("_doc_id"), "left").drop("_doc_id")
    joined = joined.withColumns({
        "_names": F.transform("_sections", lambda s: s["section"]),
        "_low": F.transform("_sections", lambda s: s["first_char"]),
        "_high": F.transform("_sections", lambda s: s["end_char"]),
    }).drop("_sections")

    def sections_of(rows):
        get = lambda c: [x or [] for x in rows.column(rows.schema.get_field_index(c)).to_pylist()]
        return get("_names"), [np.array(x, np.int64) for x in get("_low")], [np.array(x, np.int64) for x in get("_high")]

    return _counted(joined, vocabulary, sections_of)
