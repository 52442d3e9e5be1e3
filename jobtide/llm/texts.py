"""Whole Arrow text columns as numpy arrays: words, lines and their 64-bit hashes.

Everything here works on the UTF-8 bytes of many texts at once, inside Arrow-batched tasks.  A word
is a run of characters other than blank, tab, line feed, vertical tab, form feed and carriage
return.  Hashes are polynomial over the bytes modulo 2**64, so the hash of any byte range costs one
subtraction, and are then mixed; they do not depend on the process, the batch or the machine.  Two
different strings share a hash with a probability of about 2**-64.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import reduce
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts are handled in pieces of about so many bytes; one longer text is a piece of its own.
PIECE_BYTES = 1 << 20
#: Rows in one Arrow batch, so that a batch of long texts stays small.
BATCH_ROWS = 256
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def ship(spark: SparkSession) -> None:
    """Sends this package's code to the executors, once a session, as ``--py-files`` would."""
    context = spark.sparkContext
    if getattr(context, "_jobtide_llm_sent", False):
        return
    package = Path(__file__).parent.parent
    target = Path(tempfile.mkdtemp(prefix="jobtide-code-")) / "jobtide_code.zip"
    with zipfile.ZipFile(target, "w") as out:
        for file in (package / "__init__.py", *sorted((package / "llm").glob("*.py"))):
            out.write(file, f"jobtide/{file.relative_to(package)}")
    context.addPyFile(str(target))
    context._jobtide_llm_sent = True


def small_batches(spark: SparkSession) -> None:
    """Bounds the rows of an Arrow batch in this session, for tables with whole texts."""
    ship(spark)
    spark.conf.set(BATCH_CONF, str(BATCH_ROWS))


def large_batches(spark: SparkSession) -> None:
    """Spark's usual Arrow batches in this session, for tables with a few numbers a row."""
    ship(spark)
    spark.conf.set(BATCH_CONF, "10000")


def release() -> None:
    """Gives freed memory back, as the worker waits for its next task beside the executor's JVM."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def one_thread() -> None:
    """Keeps numpy's matrix products to the task's own core; for small ones its threads mostly wait, at full load."""
    for path in (Path(np.__file__).parent.parent / "numpy.libs").glob("*openblas*"):
        library = ctypes.CDLL(str(path))
        for name in ("scipy_openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(1)
                break


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            _powers[k] = np.cumprod(table)
    return _powers[0], _powers[1]


def prefix(data: np.ndarray) -> np.ndarray:
    """Prefix sums of the polynomial hash; ``range_hash`` reads ranges off them."""
    power, _ = _tables(max(len(data) + 1, PIECE_BYTES + 1))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges [start, end); equal contents have equal hashes."""
    _, inverse = _tables(len(sums))
    raw = (sums[end] - sums[start]) * inverse[start]
    return mix(raw + (end - start).astype(np.uint64) * _STEP)


def sums_by(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values in each range between neighbouring offsets; empty ranges give 0."""
    kind = np.float64 if values.dtype.kind == "f" else np.int64
    total = np.zeros(len(values) + 1, kind)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


class Texts:
    """The texts of one Arrow string column; null counts as empty."""

    def __init__(self, column: pa.Array):
        if pa.types.is_string_view(column.type):
            column = column.cast(pa.large_string())
        kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
        self.n = len(column)
        buffers = column.buffers()
        if self.n and buffers[1] is not None:
            at = np.frombuffer(buffers[1], kind, self.n + 1, column.offset * np.dtype(kind).itemsize)
            at = at.astype(np.int64)
        else:
            at = np.zeros(self.n + 1, np.int64)
        if at[-1] > at[0]:
            self.data = np.frombuffer(buffers[2], np.uint8, int(at[-1] - at[0]), int(at[0]))
        else:
            self.data = np.zeros(0, np.uint8)
        #: Byte offsets of the texts.
        self.offsets = at - at[0]
        self._sums = None

    def sums(self) -> np.ndarray:
        if self._sums is None:
            self._sums = prefix(self.data)
        return self._sums

    def words(self, fold: bool = False) -> "Words":
        """Words and their hashes; ``fold`` hashes A-Z as a-z."""
        size, inside = len(self.data), ~SPACE[self.data]
        before, after = np.zeros(size, bool), np.zeros(size, bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = self.offsets[(self.offsets > 0) & (self.offsets < size)]
        before[edges] = False
        after[edges - 1] = False
        start = np.flatnonzero(inside & ~before)
        end = np.flatnonzero(inside & ~after) + 1
        sums = prefix(LOWER[self.data]) if fold else self.sums()
        return Words(range_hash(sums, start, end), start, end, np.searchsorted(start, self.offsets))

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte starts and ends of the lines between line feeds, and offsets of the texts in them.

        A text has one line more than line feeds, so an empty text has one empty line.
        """
        breaks = np.flatnonzero(self.data == 10)
        owner = np.searchsorted(self.offsets, breaks, "right") - 1
        counts = np.bincount(owner, minlength=self.n) + 1
        first = np.zeros(self.n + 1, np.int64)
        np.cumsum(counts, out=first[1:])
        start, end = np.empty(first[-1], np.int64), np.empty(first[-1], np.int64)
        is_first, is_last = np.zeros(first[-1], bool), np.zeros(first[-1], bool)
        is_first[first[:-1]] = True
        is_last[first[1:] - 1] = True
        start[is_first], start[~is_first] = self.offsets[:-1], breaks + 1
        end[is_last], end[~is_last] = self.offsets[1:], breaks
        return start, end, first

    def characters(self) -> np.ndarray:
        """For each byte, whether it begins a code point."""
        return (self.data & 0xC0) != 0x80


class Words:
    """Words of several texts: hashes, byte ranges, and the offsets of the texts among them."""

    def __init__(self, hashes, start, end, first):
        self.hashes, self.start, self.end, self.first = hashes, start, end, first

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of ``size`` words from each word on, and whether they all lie in one text."""
        n = len(self.hashes)
        found = np.zeros(n, np.uint64)
        last = np.repeat(self.first[1:], np.diff(self.first))
        whole = np.arange(n) + size <= last
        if n >= size:
            with np.errstate(over="ignore"):
                found[: n - size + 1] = sequence_hash([self.hashes[k : n - size + 1 + k] for k in range(size)])
        return found, whole

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all ``size``-word shingles in order, and the offsets of the texts among them.

        A text with fewer words, but at least one, has its whole word sequence as its only shingle.
        """
        found, whole = self.windows(size)
        counts = self.counts()
        short = np.flatnonzero((counts > 0) & (counts < size))
        for k in short:
            lo, hi = self.first[k], self.first[k + 1]
            found[lo] = sequence_hash([self.hashes[i : i + 1] for i in range(lo, hi)])[0]
            whole[lo] = True
        first = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64)), out=first[1:])
        return found[whole], first


def sequence_hash(parts: list[np.ndarray]) -> np.ndarray:
    """Hash of the sequence of values that the arrays hold at each place."""
    with np.errstate(over="ignore"):
        start = np.full(len(parts[0]), len(parts), np.uint64)
        return mix(reduce(lambda total, part: total * _BASE + part, parts, start))


def pieces(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cuts a batch by rows into pieces of about ``PIECE_BYTES`` of the column."""
    offsets = Texts(batch.column(batch.schema.get_field_index(column))).offsets
    low = 0
    while low < batch.num_rows:
        high = int(np.searchsorted(offsets, offsets[low] + PIECE_BYTES, "right")) - 1
        high = min(max(high, low + 1), batch.num_rows)
        yield batch.slice(low, high - low)
        low = high


def map_texts(
    df: DataFrame, function: Callable[[pa.RecordBatch, Texts], pa.RecordBatch], schema, column: str = "text"
) -> DataFrame:
    """Calls ``function(rows, texts)`` for pieces of every partition and puts its batches together."""

    def run(batches):
        for batch in batches:
            for rows in pieces(batch, column):
                yield function(rows, Texts(rows.column(rows.schema.get_field_index(column))))
        release()

    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def with_columns(rows: pa.RecordBatch, names: list[str], **new) -> pa.RecordBatch:
    """The named columns of the rows, then new ones."""
    kept = [rows.column(rows.schema.get_field_index(n)) for n in names]
    added = [v if isinstance(v, pa.Array) else pa.array(v) for v in new.values()]
    return pa.RecordBatch.from_arrays(kept + added, names=names + list(new))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups from batches sorted by the keys, and where in each table groups begin and end."""

    def edges(table: pa.Table) -> np.ndarray:
        change = np.zeros(max(table.num_rows - 1, 0), bool)
        for key in keys:
            column = table.column(key).to_numpy()
            change |= column[1:] != column[:-1]
        return np.concatenate([[0], np.flatnonzero(change) + 1, [table.num_rows]])

    carry = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if carry is not None:
            table = pa.concat_tables([carry, table]).combine_chunks()
        at = edges(table)
        if len(at) > 2:
            yield table.slice(0, int(at[-2])), at[:-1]
        carry = table.slice(int(at[-2]))
    if carry is not None and carry.num_rows:
        yield carry, np.array([0, carry.num_rows])


def in_blocks(left: DataFrame, right: DataFrame, key: str, member: str, size: int) -> DataFrame:
    """Deals two tables with the same columns into blocks (key, x, y) of about ``size`` members a side.

    Every two rows of one key meet in one block, in which ``left`` tells their sides; a hot key is
    dealt over as many blocks as it needs.
    """
    counts = right.groupBy(key).agg(F.ceil(F.count("*") / size).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64(member), F.col("parts")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    names = [c for c in left.columns if c != key]
    first = left.join(counts, key).select(key, own.alias("x"), every.alias("y"), F.lit(True).alias("left"), *names)
    second = right.join(counts, key).select(key, every.alias("x"), own.alias("y"), F.lit(False).alias("left"), *names)
    return first.unionByName(second).repartition(key, "x", "y").sortWithinPartitions(key, "x", "y")
