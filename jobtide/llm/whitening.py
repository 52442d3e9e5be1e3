"""Whitening of embeddings with distributed block matrices.

Method: every entry c becomes the whole number x = floor(``SCALE`` * c) + ``OFFSET``.  Each different
vector x counts once (the fit list).  Its rows, centred on their mean, get consecutive indexes and go
into an MLlib BlockMatrix A of ``BLOCK`` rows a block; the transpose times A is the scatter matrix, whose
blocks along the rows are multiplied in many tasks and then added.  The driver decomposes that square
matrix, as large as the dimension, with ``eigh``.  All rows, indexed and centred alike, are multiplied
as a second BlockMatrix with the whitening matrix, and joined back by index.  So neither a hot vector
nor a hot id gathers rows in one task.

Nulls and odd rows: rows whose vector is null or has an entry that is null, NaN or infinite are left
out; of the others, those of the most common length count (ties: the longer), others are left out.  A
vector without entries has no component and gives no row.  Repeated rows give repeated results; a null
id is kept as it is.  Equal eigenvalues come in the order in which ``eigh`` finds them.  Directions with
next to no variance (``LEAST`` of the whole) cannot be whitened and are not returned, so a table of equal
vectors, like an empty one, gives no row.  Only the id and the vector are read, so other columns cannot
clash.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm.scratch import written

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
BLOCK = 1024
LEAST = 1e-12


def whole_numbers(rows: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(id, x) of the rows with finite entries, x an array of longs, all of the most common length."""
    entry = lambda v: v.cast("double")
    finite = F.forall(F.col(vector), lambda v: v.isNotNull() & ~F.isnan(entry(v)) & (F.abs(entry(v)) < float("inf")))
    x = F.transform(F.col(vector), lambda v: F.floor(entry(v) * SCALE).cast("long") + OFFSET)
    return rows.where(F.col(vector).isNotNull()).where(finite).select(F.col(id_column).alias("id"), x.alias("x"))


def indexed(rows: DataFrame, name: str) -> DataFrame:
    """The rows written with consecutive numbers in the column index."""
    placed = rows.withColumns({"_part": F.spark_partition_id(), "_id": F.monotonically_increasing_id()})
    placed = placed.withColumn("_place", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).drop("_id")
    held = written(placed, name)
    # One row for every partition that was written.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = held.groupBy("_part").agg((F.max("_place") + 1).alias("_size"))
    first = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_first"))
    return held.join(first, "_part").withColumn("index", F.col("_first") + F.col("_place")).drop("_part", "_place", "_first")


def block_matrix(rows: DataFrame, vector: Column, size: int) -> BlockMatrix:
    """The vectors of indexed rows as a matrix of blocks, all ``size`` columns in one block."""
    placed = rows.select("index", array_to_vector(vector).alias("vector"))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(placed, "vector")).toBlockMatrix(BLOCK, size)


def scatter(a: BlockMatrix, splits: int) -> np.ndarray:
    """The transpose of a matrix times itself, as the sum of the products of ``splits`` groups of row blocks.

    The Python method multiplies all blocks of one result block in one task; the method of the JVM
    matrix that it calls also takes the number of tasks to share them.
    """
    turned = a.transpose()
    product = turned._java_matrix_wrapper.call("multiply", a._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, a.colsPerBlock, a.colsPerBlock).toLocalMatrix().toArray()


class Whitening:
    """Mean, components and variances of a fit list."""

    def __init__(self, fit: DataFrame, size: int):
        self.size, self.fit = size, fit
        sums = fit.select(F.posexplode("x").alias("d", "v")).groupBy("d").agg(F.sum("v").alias("s")).collect()
        self.n = fit.count()
        self.sums = [r["s"] for r in sorted(sums, key=lambda r: r["d"])]
        splits = max(1, min(fit.rdd.getNumPartitions(), -(-self.n // BLOCK)))
        a = block_matrix(fit, self.centred(), size)
        covariance = scatter(a, splits) / self.n
        variances, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
        order = np.argsort(-variances, kind="stable")
        variances, vectors, trace = variances[order], vectors[:, order], float(np.trace(covariance))
        kept = variances > LEAST * trace
        self.variances, vectors = variances[kept], vectors[:, kept]
        self.explained = self.variances / trace if trace > 0 else self.variances
        #: The whitening matrix: a column for each component.
        self.matrix = vectors / np.sqrt(self.variances)
        self.blocks, self.splits = a, splits

    def centred(self) -> Column:
        """x less the mean, as doubles; the mean is taken off the whole numbers before they are rounded."""
        sums = F.array(*[F.lit(s) for s in self.sums])
        return F.zip_with("x", sums, lambda x, s: (x * self.n - s).cast("double") / self.n)

    def deviation(self) -> Column:
        """The sum over dimensions of (n*x - S)**2, exact; null beyond 38 digits."""
        sums = F.array(*[F.lit(s) for s in self.sums])
        part = F.zip_with("x", sums, lambda x, s: (x * self.n - s).cast("decimal(19,0)"))
        add = lambda total, d: (total + (d * d).cast("decimal(38,0)")).cast("decimal(38,0)")
        return F.aggregate(part, F.lit(0).cast("decimal(38,0)"), add)

    def projection(self, components: int) -> BlockMatrix:
        taken = self.matrix[:, :components]
        block = Matrices.dense(taken.shape[0], taken.shape[1], taken.ravel(order="F").tolist())
        spark = self.fit.sparkSession
        return BlockMatrix(spark.sparkContext.parallelize([((0, 0), block)], 1), self.size, taken.shape[1])

    def identity_error(self, components: int) -> float:
        """The largest entry of the covariance of the whitened fit list less the identity."""
        projected = self.blocks.multiply(self.projection(components))
        found = scatter(projected, self.splits) / self.n
        return float(np.abs(found - np.eye(len(found))).max())

    def project(self, rows: DataFrame, components: int) -> DataFrame:
        """(index, whitened) of indexed rows, an array of one double for each component."""
        product = block_matrix(rows, self.centred(), self.size).multiply(self.projection(components))
        as_rows = product.toIndexedRowMatrix()
        found = callMLlibFunc("getIndexedRows", as_rows._java_matrix_wrapper._java_model)
        return found.select("index", vector_to_array("vector").alias("whitened"))


SCHEMA = (
    "{}, component int, n long, deviation decimal(38,0), whitened double, variance double, explained double, "
    "identity_error double"
)


def whiten(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per row and component: id, component (from 1), n, deviation, whitened, variance, explained, identity_error."""
    spark = rows.sparkSession
    held = written(whole_numbers(rows, id_column, vector), "whiten-x")
    lengths = held.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    kind = held.schema["id"].dataType.simpleString()
    empty = spark.createDataFrame([], SCHEMA.format(f"{id_column} {kind}"))
    if lengths is None or lengths["size"] == 0:
        return empty
    held = held.where(F.size("x") == lengths["size"])
    fitted = Whitening(indexed(held.select("x").distinct(), "whiten-fit"), lengths["size"])
    if not len(fitted.variances):
        return empty
    all_rows = indexed(held, "whiten-rows")
    listed = lambda values: F.get(F.array(*[F.lit(float(v)) for v in values]), F.col("pos"))
    found = all_rows.select("index", "id", fitted.deviation().alias("deviation"))
    found = found.join(fitted.project(all_rows, components), "index")
    found = found.select("id", "deviation", F.posexplode("whitened").alias("pos", "whitened"))
    return found.select(
        F.col("id").alias(id_column), (F.col("pos") + 1).alias("component"), F.lit(fitted.n).cast("long").alias("n"),
        "deviation", "whitened", listed(fitted.variances[:components]).alias("variance"),
        listed(fitted.explained[:components]).alias("explained"),
        F.lit(fitted.identity_error(components)).alias("identity_error"),
    )
