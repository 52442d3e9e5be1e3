"""Line de-duplication within an edit distance.

Method: the segment-partition join.  A line of l code points is cut into ``distance`` + 1 segments; if
two lines are within the distance, one segment of the shorter (or equally long) line occurs in the
other near the same place.  Every line is entered under its segments and probes, for each admissible
length and segment, the few substrings whose place is compatible with both sides of the text.
Candidates are verified with a banded bit-parallel edit distance.  Lines that links connect form one
group; the first line of a group, by (doc_id, line number), stays and the others are removed.

Lines are the pieces between line feeds, compared as they are.  Lines shorter than ``min_chars`` code
points are never removed: two edits make other words of them.  Equal lines are one line from the
start, known by a 64-bit hash, so a line that a third of all documents hold is compared once.  As
links only serve to connect, first each line is compared with the first line of its segment; after
that, a segment's lines outside its largest group are compared with those of other groups.

Nulls: a null text has no lines and stays null; rows without a doc_id keep all their lines, and
their lines are not counted as a first one.  Empty texts have one empty line, which is kept.  Ties:
rows that share a doc_id are one document, so equal lines of them at the same number all stay.  Very
long lines and texts are read whole.  Other columns pass through unchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.bloom import bitmap, may_hold
from jobtide.llm.components import components
from jobtide.llm.scratch import written
from jobtide.llm.texts import (
    Texts, in_blocks, large_batches, map_texts, mix, pieces, range_hash, release, small_batches, whole_groups,
)

DISTANCE = 2
MIN_CHARS = 20
#: Line hashes a task remembers, so that it enters a frequent line once; then it starts anew.
REMEMBERED = 1 << 18
_MARK = np.uint64(0xA24BAED4963EE407)


class Points(Texts):
    """The texts as code points instead of bytes."""

    def __init__(self, column: pa.Array):
        super().__init__(column)
        begins = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(self.characters(), out=begins[1:])
        self.offsets = begins[self.offsets]
        self.data = np.frombuffer(self.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)


def cut(length: np.ndarray, segment: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of a segment of lines of the lengths; the later segments are the longer ones."""
    parts = distance + 1
    size, longer = length // parts, length % parts
    short = parts - longer
    start = segment * size + np.maximum(segment - short, 0)
    return start, size + (segment >= short)


def window(length, other, segment: int, distance: int):
    """First and last start at which a line probes a segment of lines of ``other`` code points.

    The place must allow the differences left of it, at most ``segment``, and those right of it.
    """
    start, size = cut(other, segment, distance)
    more = length - other
    low = np.maximum(np.maximum(start - segment, start + more - (distance - segment)), 0)
    high = np.minimum(np.minimum(start + segment, start + more + (distance - segment)), length - size)
    return low, high, size


def entries(points: Points, start: np.ndarray, end: np.ndarray, distance: int):
    """(line index, key, is entry) for lines [start, end): entries of segments, and further probes."""
    length = end - start
    sums = points.sums()
    which, keys, role = [], [], []
    everyone = np.arange(len(start))

    def add(lines, low, size, other, segment, entry):
        key = range_hash(sums, start[lines] + low, start[lines] + low + size)
        salt = other.astype(np.uint64) * np.uint64(64) + np.uint64(segment)
        which.append(lines)
        keys.append(mix(key + salt * _MARK))
        role.append(np.full(len(lines), entry))

    for segment in range(distance + 1):
        place, size = cut(length, segment, distance)
        add(everyone, place, size, length, segment, True)
        for less in range(distance + 1):
            other = length - less
            low, high, size = window(length, other, segment, distance)
            for step in range(int((high - low).max(initial=-1)) + 1):
                at = low + step
                lines = np.flatnonzero((at <= high) & ((less > 0) | (at != place)))
                add(lines, at[lines], size[lines], other[lines], segment, False)
    return np.concatenate(which), np.concatenate(keys), np.concatenate(role)


def line_hashes(points: Points, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix(range_hash(points.sums(), start, end) ^ _MARK)


def within(left: list[np.ndarray], right: list[np.ndarray], distance: int) -> np.ndarray:
    """Whether pairs of code point arrays are within the edit distance.

    All pairs advance together, a column at a time; a word of 2 * distance + 1 bits a pair holds the
    band of vertical differences around the diagonal.  Both sides must be longer than the distance,
    and their lengths differ by no more than it.
    """
    if distance > 31:
        raise ValueError("a band of 2 * distance + 1 bits must fit in 64 bits")
    n = len(left)
    out = np.zeros(n, bool)
    rows = np.array([len(x) for x in left])
    order, low = np.argsort(rows, kind="stable"), 0
    while low < n:
        width = max(len(left[order[low]]), 1)
        high = min(n, low + max(1, min(4096, (1 << 22) // width)))
        while high > low + 1 and (high - low) * rows[order[high - 1]] > 1 << 22:
            high = low + (high - low) // 2
        part = order[low:high]
        out[part] = _scores([left[k] for k in part], [right[k] for k in part], distance) <= distance
        low = high
    return out


def _scores(left: list[np.ndarray], right: list[np.ndarray], distance: int) -> np.ndarray:
    d, n = distance, len(left)
    rows, columns = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    a = np.full((rows.max() + 3 * d + 2, n), 0xFFFFFFFF, np.uint32)
    b = np.full((columns.max(), n), 0xFFFFFFFE, np.uint32)
    for k in range(n):
        a[d : d + rows[k], k] = left[k]
        b[: columns[k], k] = right[k]
    one, mask = np.uint64(1), np.uint64((1 << (2 * d + 1)) - 1)
    up = np.full(n, (mask >> np.uint64(d)) << np.uint64(d), np.uint64)
    down = np.zeros(n, np.uint64)
    score = np.full(n, d, np.int64)
    for j in range(len(b)):
        same = np.zeros(n, np.uint64)
        for k in range(2 * d + 1):
            same |= (a[j + k] == b[j]).astype(np.uint64) << np.uint64(k) if j + k < len(a) else np.uint64(0)
        diagonal = ((((same & up) + up) ^ up) | same | down) & mask
        plus = (down | ~(diagonal | up)) & mask
        minus = diagonal & up
        going = j < columns
        first = j + d < rows
        at = np.clip(rows - j - 1 + d, 0, 63).astype(np.uint64)
        step = np.where(
            first, 1 - ((diagonal >> np.uint64(2 * d)) & one).astype(np.int64),
            ((plus >> at) & one).astype(np.int64) - ((minus >> at) & one).astype(np.int64),
        )
        score += np.where(going, step, 0)
        moved = diagonal >> one
        up = (minus | ~(moved | plus)) & mask
        down = moved & plus
    return score


def _lines(rows: pa.RecordBatch, min_chars: int):
    """Code points, line starts and ends, document and line number of the lines that count."""
    points = Points(rows.column(rows.schema.get_field_index("text")))
    start, end, first = points.lines()
    owner = np.repeat(np.arange(points.n), np.diff(first))
    number = np.arange(len(start)) - np.repeat(first[:-1], np.diff(first))
    long = end - start >= min_chars
    return points, start[long], end[long], owner[long], number[long]


def _identified(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("print"), "text"
    )


def occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """(line, doc_id, print, number) of every line that counts; line is its hash."""

    def run(rows, _):
        points, start, end, owner, number = _lines(rows, min_chars)
        take = pa.array(owner)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(line_hashes(points, start, end).view(np.int64)), rows.column(0).take(take),
                rows.column(1).take(take), pa.array(number.astype(np.int32)),
            ],
            ["line", "doc_id", "print", "number"],
        )

    return map_texts(_identified(docs), run, "line long, doc_id long, print long, number int")


def _entered(docs: DataFrame, distance: int, min_chars: int) -> DataFrame:
    """(key, line, entry): the segments under which lines are entered, and those they probe."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            for rows in pieces(batch):
                points, start, end, _, _ = _lines(rows, min_chars)
                hashes, at = np.unique(line_hashes(points, start, end), return_index=True)
                new = np.fromiter((h not in seen for h in hashes.tolist()), bool, len(hashes))
                if len(seen) > REMEMBERED:
                    seen.clear()
                seen.update(hashes[new].tolist())
                hashes, at = hashes[new], at[new]
                which, keys, entry = entries(points, start[at], end[at], distance)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(hashes[which].view(np.int64)), pa.array(entry)],
                    ["key", "line", "entry"],
                )
        release()

    small_batches(docs.sparkSession)
    return docs.where("text is not null").select("text").mapInArrow(run, "key long, line long, entry boolean")


def _texts_of(docs: DataFrame, wanted: DataFrame, min_chars: int) -> DataFrame:
    """(line, text) of the wanted lines; a bitmap of fixed size spares most others the shuffle."""
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(wanted, "line"))

    def run(rows, _):
        points, start, end, _, _ = _lines(rows, min_chars)
        hashes, at = np.unique(line_hashes(points, start, end), return_index=True)
        held = may_hold(bits.value, hashes.view(np.int64))
        texts = [points.data[start[k] : end[k]].tobytes().decode("utf-32-le") for k in at[held]]
        return pa.RecordBatch.from_arrays(
            [pa.array(hashes[held].view(np.int64)), pa.array(texts, pa.string())], ["line", "text"]
        )

    found = map_texts(docs.where("text is not null").select("text"), run, "line long, text string")
    return found.join(wanted, "line", "left_semi").dropDuplicates(["line"])


#: Lines of one segment that are compared in one piece of work.
BLOCK = 1024


def _histogram(lines: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.bincount(x & 31, minlength=32) for x in lines]).astype(np.int32)


def verified(rows: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) within the distance among entries and probes (key, line, entry, label, text).

    Lines that already have one label are not compared.  Nothing but links leaves a task.
    """

    def links(table: pa.Table, edges: np.ndarray):
        text = Points(table.column("text").combine_chunks())
        lines = [text.data[text.offsets[k] : text.offsets[k + 1]] for k in range(text.n)]
        ids, labels, entry = (table.column(c).to_numpy() for c in ("line", "label", "left"))
        sizes, counts = np.array([len(x) for x in lines]), _histogram(lines)
        left, right = [], []
        for low, high in zip(edges[:-1], edges[1:]):
            mine, others = low + np.flatnonzero(entry[low:high]), low + np.flatnonzero(~entry[low:high])
            for i in mine:
                near = others[(labels[others] != labels[i]) & (np.abs(sizes[others] - sizes[i]) <= distance)]
                near = near[np.abs(counts[near] - counts[i]).sum(axis=1) <= 2 * distance]
                left.append(np.full(len(near), i))
                right.append(near)
        none = np.zeros(0, np.int64)
        left, right = np.concatenate(left or [none]), np.concatenate(right or [none])
        swap = ids[left] > ids[right]
        left, right = np.where(swap, right, left), np.where(swap, left, right)
        _, once = np.unique(np.stack([ids[left], ids[right]]), axis=1, return_index=True)
        left, right = left[once], right[once]
        close = within([lines[k] for k in left], [lines[k] for k in right], distance)
        return pa.RecordBatch.from_arrays([pa.array(ids[left[close]]), pa.array(ids[right[close]])], ["a", "b"])

    def run(batches):
        for table, edges in whole_groups(batches, ["key", "x", "y"]):
            yield links(table, edges)

    large_batches(rows.sparkSession)
    sides = rows.drop("entry")
    dealt = in_blocks(rows.where("entry").drop("entry"), sides, "key", "line", BLOCK)
    return dealt.mapInArrow(run, "a long, b long").distinct()


def line_groups(docs: DataFrame, distance: int = DISTANCE, min_chars: int = MIN_CHARS) -> DataFrame:
    """(node, label) of all lines that are within the distance of another line, by line hash."""
    if not 0 <= distance < min_chars:
        raise ValueError("lines that count must be longer than the distance")
    by_key = F.expr("min(line) over (partition by key) <> max(line) over (partition by key)")
    entered = F.expr("max(entry) over (partition by key)")
    met = _entered(docs, distance, min_chars).withColumns({"_met": by_key, "_entered": entered})
    met = written(met.where("_met and _entered").groupBy("key", "line").agg(F.max("entry").alias("entry")), "lines-met")
    texts = written(_texts_of(docs, met.select("line").distinct(), min_chars), "lines-texts")
    rows = met.join(texts, "line")
    stars = met.where("entry").groupBy("key").agg(F.min("line").alias("line"))
    first = rows.join(stars.withColumnRenamed("line", "_first"), "key")
    first = first.withColumns({"entry": F.col("line") == F.col("_first"), "label": F.col("line")}).drop("_first")
    links = written(verified(first, distance), "lines-links")
    labels = components(links, "a", "b").withColumnRenamed("node", "line")
    rest = rows.join(labels, "line", "left").withColumn("label", F.coalesce("label", "line"))
    rest = rest.withColumn("_mixed", F.expr("min(label) over (partition by key) <> max(label) over (partition by key)"))
    more = verified(rest.where("_mixed").drop("_mixed"), distance)
    return components(written(links.unionByName(more), "lines-links"), "a", "b")


def repeated_lines(docs: DataFrame, distance: int = DISTANCE, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line to remove: doc_id, print (a hash of the text), number, and the line that stays."""
    found = written(occurrences(docs, min_chars), "lines-found")
    labels = line_groups(docs, distance, min_chars).withColumnRenamed("node", "line")
    # Lines that occur once and have no near line need no label; the rest is a small part.
    counts = found.groupBy("line").agg(F.min(F.struct("doc_id", "number", "print")).alias("first"), F.count("*").alias("n"))
    counts = counts.join(labels, "line", "left").withColumn("label", F.coalesce("label", "line"))
    groups = counts.groupBy("label").agg(F.min("first").alias("first"), F.sum("n").alias("n")).where("n > 1")
    repeated = counts.drop("first", "n").join(groups.drop("n"), "label").select("line", "first")
    gone = found.join(repeated, "line")
    gone = gone.where("doc_id <> first.doc_id or number <> first.number or print <> first.print")
    return gone.select(
        "doc_id", "print", "number", F.col("first.doc_id").alias("kept_doc_id"), F.col("first.number").alias("kept_number")
    )


def without_repeats(docs: DataFrame, distance: int = DISTANCE, min_chars: int = MIN_CHARS) -> DataFrame:
    """All documents with repeated lines removed, and new, n_lines and removed (line numbers, ascending).

    A document whose lines all go keeps an empty text.
    """
    gone = repeated_lines(docs, distance, min_chars).groupBy("doc_id", "print")
    gone = gone.agg(F.sort_array(F.collect_set("number")).alias("_removed"))
    gone = gone.withColumnsRenamed({"doc_id": "_doc_id", "print": "_print"})
    own = [c for c in docs.columns if c not in ("n_lines", "removed")]
    on = (docs["doc_id"].cast("long") == gone["_doc_id"]) & (F.xxhash64(docs["text"]) == gone["_print"])
    joined = docs.join(gone, on, "left")
    lines = F.split("text", "\n", -1)
    kept = F.filter(lines, lambda _, i: ~F.array_contains("_removed", i))
    text = F.when(F.col("_removed").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return joined.select(
        *[text.alias("text") if c == "text" else docs[c] for c in own],
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce("_removed", F.array().cast("array<int>")).alias("removed"),
    )
