"""MinHash near-duplicates with sequential Bayesian verification.

Method: a document's set is its distinct word shingles (A-Z lower-cased), hashed to 64 bits.
Documents with equal sets form one class, known by a 64-bit digest of the set, and only classes are
compared.  MinHash signatures are cut into bands; classes that agree in a whole band are candidates.
A candidate pair is compared one signature batch after another, and given up as soon as the posterior
probability that its similarity reaches the threshold falls below the chosen miss probability
(uniform prior).  Survivors are confirmed exactly on the sets made anew from their whole texts.

Only enough pairs are compared to know the components.  First each class is paired with the first
class of each of its bands.  After those links are joined, a band in which several components meet
is compared again: every class outside the band's largest component with all classes of other
components.  Before that, the shingles that only one of the classes left has are counted; as they
are in no intersection, they bound every similarity of their class, and pairs below the threshold
by that bound are not made.  So no link between components goes untested, a group of copies costs
one pair per member instead of all pairs, and copies that each have changes of their own are told
apart without meeting.

The number of bands is the smallest at which a pair exactly at the threshold shares none with a
probability of ``MISS``.  Nulls: a null text is empty; an empty set links with nothing; rows without
a doc_id are linked with nothing, have no component and are kept.  A text shorter than a shingle has
its whole word sequence as its only shingle.  Repeated rows belong to one class and get one row
each.  Ties: the smallest doc_id stands for a component.  Very long texts are read whole.  Only
doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.llm.bloom import bitmap, may_hold
from jobtide.llm.components import components
from jobtide.llm.scratch import written
from jobtide.llm.texts import (
    Texts, in_blocks, large_batches, map_texts, mix, pieces, sequence_hash, small_batches, whole_groups,
)

ROWS = 7
MISS = 1e-5
#: Signature values compared at a time, and the probability of giving up a pair at the threshold.
BATCH, GIVE_UP = 16, 1e-6
SHINGLE, PERCENT = 5, 80
#: Signature values where groups meet, and classes on a side of one piece of work there.
LONG, BLOCK = 1024, 512


def band_count(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows))


def _multipliers(n: int) -> np.ndarray:
    odd = mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (odd >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def set_of(hashes: np.ndarray) -> np.ndarray:
    """The distinct values, ascending."""
    found = np.sort(hashes)
    return found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) else found


def digest(members: np.ndarray) -> int:
    """One signed 64-bit number for a set of hashes, given ascending."""
    places = mix(members + np.arange(len(members), dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    total = np.add.reduce(places) ^ np.uint64(len(members))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def signatures(hashes: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """MinHash values (documents by ``n``) of documents that all have members."""
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((n, len(first) - 1), np.uint32)
    scratch = np.empty_like(low)
    for k, odd in enumerate(_multipliers(n)):
        np.multiply(low, odd, out=scratch)
        np.minimum.reduceat(scratch, first[:-1], out=out[k])
    return out.T


def _fingerprinted(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """doc_id, copy (a hash of the text), n_shingles, and for texts with words: node, signature (a byte a value), band keys."""
    n = bands * rows

    def run(batch_rows, texts):
        hashes, first = texts.words(fold=True).shingles(shingle)
        counts, nodes = np.zeros(texts.n, np.int64), np.zeros(texts.n, np.int64)
        for k in range(texts.n):
            if first[k + 1] > first[k]:
                members = set_of(hashes[first[k] : first[k + 1]])
                counts[k], nodes[k] = len(members), digest(members)
        held = np.flatnonzero(counts)
        signs, keys = [None] * texts.n, [None] * texts.n
        if len(held):
            starts = np.append(first[held], len(hashes))
            values = np.empty((len(held), n), np.uint32)
            step = 64  # documents at a time, so that their hashes stay in the processor's cache
            for low in range(0, len(held), step):
                part = starts[low : low + step + 1]
                values[low : low + step] = signatures(hashes[part[0] : part[-1]], part - part[0], n)
            short = ((values * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)
            parts = values.reshape(len(held), bands, rows).astype(np.uint64)
            band = sequence_hash([parts[:, :, r].ravel() for r in range(rows)])
            band = mix(band + np.tile(np.arange(bands, dtype=np.uint64), len(held)) * np.uint64(0xA24BAED4963EE407))
            band = band.reshape(len(held), bands).view(np.int64)
            for i, k in enumerate(held):
                signs[k], keys[k] = short[i].tobytes(), band[i]
        return pa.RecordBatch.from_arrays(
            [
                batch_rows.column(batch_rows.schema.get_field_index("doc_id")),
                batch_rows.column(batch_rows.schema.get_field_index("copy")), pa.array(counts),
                pa.array(nodes, mask=counts == 0), pa.array(signs, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
            ],
            ["doc_id", "copy", "n_shingles", "node", "signature", "bands"],
        )

    schema = "doc_id long, copy long, n_shingles long, node long, signature binary, bands array<long>"
    return map_texts(docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("copy")), run, schema)


def least_matches(total: int, percent: int, give_up: float = GIVE_UP) -> np.ndarray:
    """For 0 to ``total`` compared values, the fewest matches with which a pair is not given up.

    A value of one byte also matches by chance; the posterior is a Beta distribution, summed up on a
    grid.
    """
    grid = np.linspace(0, 1, 4001)[1:-1]
    chance = grid + (1 - grid) / 256
    hit, miss = np.log(chance), np.log1p(-chance + 1e-300)
    above = grid >= percent / 100
    out = np.zeros(total + 1, np.int64)
    for n in range(BATCH, total + 1):
        need = out[n - 1]
        while True:
            log = need * hit + (n - need) * miss
            p = np.exp(log - log.max())
            if need >= n or p[above].sum() >= give_up * p.sum():
                break
            need += 1
        out[n] = need
    return out


def _likely(pairs: DataFrame, percent: int, total: int) -> DataFrame:
    """The pairs (a, b) that survive the batches of signature values (sa, sb)."""
    least = least_matches(total, percent)

    def run(batches):
        for batch in batches:
            def matrix(name):
                column = batch.column(batch.schema.get_field_index(name))
                return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, total)

            if not batch.num_rows:
                continue
            left, right = matrix("sa"), matrix("sb")
            alive, matches = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for low in range(0, total, BATCH):
                high = min(low + BATCH, total)
                matches[alive] += (left[alive, low:high] == right[alive, low:high]).sum(axis=1)
                alive = alive[matches[alive] >= least[high]]
            yield batch.select(["a", "b"]).take(pa.array(alive))

    large_batches(pairs.sparkSession)
    return pairs.mapInArrow(run, "a long, b long")


def _exact(pairs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets, from their whole texts (ta, tb), reach the similarity."""

    def run(batches):
        held, last = None, None
        for batch in batches:
            for rows in pieces(batch, "tb"):
                right, first = Texts(rows.column(rows.schema.get_field_index("tb"))).words(fold=True).shingles(shingle)
                names = rows.column(rows.schema.get_field_index("a")).to_numpy(zero_copy_only=False)
                texts = rows.column(rows.schema.get_field_index("ta"))
                linked = np.zeros(rows.num_rows, bool)
                for k in range(rows.num_rows):
                    if names[k] != last:
                        own, _ = Texts(texts.slice(k, 1)).words(fold=True).shingles(shingle)
                        held, last = set_of(own), names[k]
                    other = set_of(right[first[k] : first[k + 1]])
                    both = np.concatenate([held, other])
                    both.sort()
                    shared = int((both[1:] == both[:-1]).sum())
                    linked[k] = 100 * shared >= percent * (len(both) - shared)
                yield rows.select(["a", "b"]).filter(pa.array(linked))

    small_batches(pairs.sparkSession)
    return pairs.mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, classes: DataFrame, texts: DataFrame, shingle: int, percent: int, total: int) -> DataFrame:
    """Links among candidate pairs (a, b): by signature batches, then exactly."""
    signs = classes.select("node", "signature")
    with_a = pairs.join(signs.withColumnsRenamed({"node": "a", "signature": "sa"}), "a")
    with_b = with_a.join(signs.withColumnsRenamed({"node": "b", "signature": "sb"}), "b")
    likely = written(_likely(with_b.select("a", "b", "sa", "sb"), percent, total), "near-likely")
    return _exact(_with_texts(likely, texts), shingle, percent)


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    right = pairs.join(texts.withColumnsRenamed({"node": "b", "text": "tb"}), "b")
    return right.join(texts.withColumnsRenamed({"node": "a", "text": "ta"}), "a").select("a", "b", "ta", "tb")


def _texts_of(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """One text (node, text) for each wanted (node, rep).

    A bitmap of fixed size spares most other texts the shuffle; as another text may carry the same
    doc_id, the digest of its set decides.
    """
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(wanted, "rep"))

    def held(rows, _):
        return rows.filter(pa.array(may_hold(bits.value, rows.column(0).to_numpy(zero_copy_only=False))))

    own = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("rep"), "text")
    found = map_texts(own, held, "rep long, text string").join(wanted, "rep")
    return _with_digest(found, shingle)


def _own_shingles(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, size, own): how many shingles a class has, and how many of them no other one here has."""

    def run(rows, found):
        hashes, first = found.words(fold=True).shingles(shingle)
        sets = [set_of(hashes[first[k] : first[k + 1]]) for k in range(found.n)]
        nodes = np.repeat(rows.column(0).to_numpy(zero_copy_only=False), [len(x) for x in sets])
        members = np.concatenate(sets) if sets else hashes
        return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(members.view(np.int64))], ["node", "member"])

    members = map_texts(texts.select("node", "text"), run, "node long, member long")
    # Each shingle comes back once for the first class that has it, with how many have it.
    counted = members.groupBy("member").agg(F.min("node").alias("node"), F.count("*").alias("n")).where("n = 1")
    return counted.groupBy("node").agg(F.count("*").alias("own"))


def _with_digest(found: DataFrame, shingle: int) -> DataFrame:
    """One text (node, text) for each node."""

    def run(rows, texts):
        hashes, first = texts.words(fold=True).shingles(shingle)
        wanted = rows.column(rows.schema.get_field_index("node")).to_numpy(zero_copy_only=False)
        same = [
            first[k + 1] > first[k] and digest(set_of(hashes[first[k] : first[k + 1]])) == wanted[k]
            for k in range(texts.n)
        ]
        return rows.select(["node", "text"]).filter(pa.array(same, pa.bool_()))

    own = map_texts(found.select("node", "text"), run, "node long, text string")
    return own.dropDuplicates(["node"])


def _long_signatures(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, long): ``LONG`` signature values, a byte each, for groups in which many pairs are near."""

    def run(rows, found):
        hashes, first = found.words(fold=True).shingles(shingle)
        values = signatures(hashes, first, LONG)
        short = ((values * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)
        return pa.RecordBatch.from_arrays([rows.column(0), pa.array([x.tobytes() for x in short], pa.binary())], ["node", "long"])

    return map_texts(texts.select("node", "text"), run, "node long, long binary")


def _across(mixed: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes of different labels in one band that may be linked.

    ``mixed`` has band, node, label, main, centre, size, rest, bands and long.  A pair is looked at
    in the first band it has in common, against the bound by shingles of their own and then batch by
    batch of the long signatures.  Only pairs that survive leave a task.
    """
    least = least_matches(LONG, percent)

    def survivors(table: pa.Table, edges: np.ndarray):
        get = lambda c: table.column(c).to_numpy()
        node, label, main, centre, size, rest, band, left = map(get, ("node", "label", "main", "centre", "size", "rest", "band", "left"))
        bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(len(node), -1)
        signs = np.frombuffer(b"".join(table.column("long").to_pylist()), np.uint8).reshape(-1, LONG)
        found = []
        for low, high in zip(edges[:-1], edges[1:]):
            mine, others = low + np.flatnonzero(left[low:high]), low + np.flatnonzero(~left[low:high])
            mine, others = mine[node[mine] != centre[mine]], others[node[others] != centre[others]]
            step = max(1, 65536 // max(1, len(others)))
            for at in range(0, len(mine), step):
                x, y = np.repeat(mine[at : at + step], len(others)), np.tile(others, len(mine[at : at + step]))
                shared = np.minimum(rest[x], rest[y])
                good = (label[x] != label[y]) & ((label[y] == main[y]) | (node[x] < node[y]))
                good &= 100 * shared >= percent * (size[x] + size[y] - shared)
                x, y = x[good], y[good]
                common = bands[x] == bands[y]
                here = bands[x, common.argmax(axis=1)] == band[x]
                x, y = x[here], y[here]
                matches = np.zeros(len(x), np.int64)
                for first in range(0, LONG, 4 * BATCH):
                    last = first + 4 * BATCH
                    matches += (signs[x, first:last] == signs[y, first:last]).sum(axis=1)
                    alive = matches >= least[last]
                    x, y, matches = x[alive], y[alive], matches[alive]
                found.append((np.minimum(node[x], node[y]), np.maximum(node[x], node[y])))
        a, b = (np.concatenate(v) for v in zip(*found)) if found else (node[:0], node[:0])
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def run(batches):
        for table, edges in whole_groups(batches, ["band", "x", "y"]):
            yield survivors(table, edges)

    small_batches(mixed.sparkSession)
    dealt = in_blocks(mixed.where("label <> main"), mixed, "band", "node", BLOCK)
    return dealt.mapInArrow(run, "a long, b long")


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels (node, label) after further links (a, b), of which only those of the labels are followed."""
    for end in ("a", "b"):
        to = labels.withColumnsRenamed({"node": end, "label": f"label_{end}"})
        links = links.join(to, end, "left").withColumn(f"label_{end}", F.coalesce(f"label_{end}", end))
    further = components(links, "label_a", "label_b").withColumnsRenamed({"node": "old", "label": "new"})
    # A class that only further links reach had no label and was its own.
    alone = further.join(labels, F.col("old") == F.col("node"), "left_anti").select("old", "new")
    moved = labels.join(further, F.col("label") == F.col("old"), "left")
    moved = moved.select("node", F.coalesce("new", "label").alias("label"))
    return written(moved.unionByName(alone.toDF("node", "label")), "near-labels")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, rows: int = ROWS) -> DataFrame:
    """Per document row: doc_id, n_shingles, component_id and kept.

    Documents whose sets have 100 * intersection >= percent * union are linked; ``component_id`` is
    the smallest doc_id reachable, and the document that has it is kept.
    """
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("first.doc_id", "doc_id"))
    return _with_first(docs, shingle, percent, rows).select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def _with_first(docs: DataFrame, shingle: int, percent: int, rows: int = ROWS) -> DataFrame:
    """Per document row doc_id, copy, n_shingles and ``first``, the smallest (doc_id, copy) reachable."""
    bands = band_count(percent, rows)
    total = bands * rows
    prints = written(_fingerprinted(docs, shingle, bands, rows), "near-prints")
    linkable = prints.where("node is not null and doc_id is not null")
    classes = written(
        linkable.groupBy("node").agg(
            F.min("doc_id").alias("rep"), F.min(F.struct("doc_id", "copy")).alias("first"), F.any_value("n_shingles").alias("size"), F.any_value("signature").alias("signature"), F.any_value("bands").alias("bands")
        ),
        "near-classes",
    )
    entries = classes.select(F.explode("bands").alias("band"), "node")
    centres = entries.groupBy("band").agg(F.min("node").alias("centre"), F.count("*").alias("n")).where("n > 1")
    met = written(entries.join(centres.select("band", "centre"), "band"), "near-met")
    stars = met.where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    met_nodes = met.select("node").distinct().join(classes.select("node", "rep"), "node")
    texts = written(_texts_of(docs, written(met_nodes, "near-needed"), shingle), "near-texts")
    labels = components(_confirmed(stars, classes, texts, shingle, percent, total), "a", "b")

    placed = met.join(labels, "node", "left").select("band", "node", "centre", F.coalesce("label", "node").alias("label"))
    placed = written(placed, "near-placed")
    sizes = placed.groupBy("band", "label").count()
    largest = sizes.groupBy("band").agg(
        F.max_by("label", F.struct("count", "label")).alias("main"), F.count("*").alias("parts")
    ).where("parts > 1")
    mixed = written(placed.join(largest.select("band", "main"), "band"), "near-mixed")
    left = mixed.select("node").distinct()
    own = _own_shingles(texts.join(left, "node"), shingle)
    sizes = left.join(classes.select("node", "size"), "node").join(own, "node", "left")
    sizes = sizes.withColumn("rest", F.col("size") - F.coalesce("own", F.lit(0)))
    sizes = written(sizes.where(100 * F.col("rest") >= percent * F.col("size")).drop("own"), "near-sizes")
    kept = classes.select("node", "bands").join(_long_signatures(texts.join(sizes, "node"), shingle), "node")
    mixed = mixed.join(sizes, "node").join(kept, "node")
    across = written(_across(mixed, percent), "near-across")
    labels = _joined(labels, _exact(_with_texts(across, texts), shingle, percent))

    own = classes.select("node", "first").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = own.groupBy("label").agg(F.min("first").alias("first"))
    of_node = own.drop("first").join(least, "label").select("node", "first")
    return prints.select("doc_id", "copy", "n_shingles", "node").join(of_node, "node", "left")


def without_copies(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """All columns of one row of each group of near-duplicates, the one with the smallest doc_id.

    Rows are known by doc_id and a hash of the text; of rows that are equal in both, one stays.
    """
    found = _with_first(docs, shingle, percent).where("doc_id is not null")
    stays = F.col("first").isNull() | (F.col("first") == F.struct("doc_id", "copy"))
    keys = found.groupBy(F.col("doc_id").alias("_doc_id"), F.col("copy").alias("_copy")).agg(
        F.bool_and(stays).alias("_stays"), F.count("*").alias("_rows")
    )
    marked = written(keys.where("not _stays or _rows > 1"), "near-dropped")
    same = (docs["doc_id"] == marked["_doc_id"]) & (F.xxhash64(docs["text"]) == marked["_copy"])
    once = docs.join(marked, same, "left_anti")
    repeated = marked.where("_stays")
    if repeated.isEmpty():
        return once
    whole = F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)])
    simple = [docs[f.name] for f in docs.schema if isinstance(f.dataType, T.AtomicType)]
    again = docs.join(repeated, same).select("_doc_id", "_copy", whole.alias("_whole"), F.struct(*simple).alias("_order"))
    again = again.groupBy("_doc_id", "_copy").agg(F.min_by("_whole", "_order").alias("_whole"))
    return once.unionByName(again.select(*[F.col(f"_whole.c{i}").alias(c) for i, c in enumerate(docs.columns)]))
