"""Embedding whitening with distributed block matrices.

Each distinct vector is one row of the fit list. Rows are centred on the exact
mean of the list, numbered and cut into the blocks of a BlockMatrix; its
transpose times itself is the scatter, added up over all row blocks, of which
only the dimensions-squared result reaches the driver. Its eigenvectors, each
over the root of its eigenvalue, are a small BlockMatrix that the rows are
multiplied by. All of it stays in the JVM but for the local decomposition.

Rows of the table take the projection of their vector over a 128-bit key. Hot
vectors, a bounded number of them, are looked up in a broadcast, so copies of
one vector meet in no task.

Defined results: rows whose vector is null, empty, or holds null or non-finite
entries go, and so do vectors of another length than most; a null id is
carried; repeated rows each get their rows but count once in the fit;
directions without variance (eigenvalue within rounding of zero) have no
component, so equal vectors alone give no rows; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scoreflow.llm.common import written
from scoreflow.llm.vectors import integer_vectors
from scoreflow.operators.joins import join_hot_split

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
# Columns of a block at most, and its bytes.
BLOCK_COLUMNS, BLOCK_BYTES = 1024, 4 << 20
# Row blocks that a task of a product holds at most, beside the partitions set.
TASK_BLOCKS = 16
# Largest dimension whose scatter the driver decomposes.
LARGEST_DIMENSION = 4096


@dataclass(frozen=True)
class Whitening:
    """What was learned: sizes, per-dimension sums, and the eigenpairs."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def matrix(self) -> np.ndarray:
        """Dimensions x components; rows times this are white."""
        return self.vectors / np.sqrt(self.values)


def _numbered(distinct: DataFrame) -> DataFrame:
    """`distinct` with consecutive numbers `row` from 0. Numbers follow the
    partitions of the table, of which only the row counts are summed up."""
    place = F.monotonically_increasing_id()
    placed = distinct.withColumn("part", F.shiftright(place, 33)).withColumn("at", place.bitwiseAND(F.lit((1 << 33) - 1)))
    placed = written(placed, "vectors")
    counts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    before = F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("part", F.coalesce(before, F.lit(0)).alias("start"))
    return placed.join(F.broadcast(starts), "part").withColumn("row", F.col("at") + F.col("start")).drop("part", "at", "start")


def _block_matrix(rows: DataFrame, n: int, dimensions: int) -> BlockMatrix:
    """The blocks of (row bigint, vector array<double>)."""
    found = rows.select("row", array_to_vector("vector").alias("vector"))
    found = MLUtils.convertVectorColumnsFromML(found, "vector")
    columns = min(BLOCK_COLUMNS, dimensions)
    return IndexedRowMatrix(found, n, dimensions).toBlockMatrix(max(1, BLOCK_BYTES // (8 * columns)), columns)


def _rows(matrix: BlockMatrix) -> DataFrame:
    """(index, vector array<double>) of a block matrix, without leaving the JVM."""
    indexed = matrix.toIndexedRowMatrix()
    found = callMLlibFunc("getIndexedRows", indexed._java_matrix_wrapper._java_model)
    return found.select("index", vector_to_array(F.col("vector")).alias("y"))


def _scatter(spark: SparkSession, blocks: BlockMatrix, n: int) -> np.ndarray:
    """Transpose times the matrix itself. The rows, here the inner dimension,
    are split, so that row blocks are multiplied side by side; their products
    are added up. (The Python method has no argument for the splits.)"""
    row_blocks = -(-n // blocks.rowsPerBlock)
    splits = min(row_blocks, max(int(spark.conf.get("spark.sql.shuffle.partitions")), row_blocks // TASK_BLOCKS))
    left, right = blocks.transpose()._java_matrix_wrapper, blocks._java_matrix_wrapper
    product = left.call("multiply", right._java_model, splits)
    return BlockMatrix(product, blocks.colsPerBlock, blocks.colsPerBlock).toLocalMatrix().toArray()


def _small(spark: SparkSession, matrix: np.ndarray, rows: int) -> BlockMatrix:
    """A local matrix as blocks of `rows` rows and all its columns."""
    blocks = []
    for i, at in enumerate(range(0, len(matrix), rows)):
        part = matrix[at : at + rows]
        blocks.append(((i, 0), DenseMatrix(part.shape[0], part.shape[1], part.ravel(order="F").tolist())))
    return BlockMatrix(spark.sparkContext.parallelize(blocks, 1), rows, matrix.shape[1], *matrix.shape)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> tuple[Whitening | None, BlockMatrix | None]:
    """Learns from (row, x): the vectors of the fit list, numbered. Returns the
    centred blocks too."""
    n = vectors.count()
    dimensions = vectors.select(F.size("x").alias("d")).first()
    if dimensions is None:
        return None, None
    dimensions = dimensions.d
    if dimensions > LARGEST_DIMENSION:
        raise ValueError(f"{dimensions} dimensions: the scatter would not fit the driver")
    # Sums as decimals: exact at any number of rows.
    each = vectors.select(F.posexplode("x").alias("dim", "c")).groupBy("dim").agg(F.sum(F.col("c").cast("decimal(20,0)")).alias("s"))
    sums = [int(r.s) for r in sorted(each.collect())]
    # x - S / n from the whole and the remaining part of the mean, each exact
    # to the last bit though x is far from 0.
    whole = F.array(*[F.lit(s // n).cast("bigint") for s in sums])
    rest = F.array(*[F.lit((s % n) / n) for s in sums])
    centre = F.zip_with(F.zip_with("x", whole, lambda c, w: (c - w).cast("double")), rest, lambda c, r: c - r)
    blocks = _block_matrix(vectors.select("row", centre.alias("vector")), n, dimensions)
    covariance = _scatter(vectors.sparkSession, blocks, n) / n
    values, found = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(values)[::-1]
    values, found = values[order], found[:, order]
    trace = float(np.trace(covariance))
    held = values > max(values[0], 0.0) * dimensions * np.finfo(float).eps * 16
    keep = np.flatnonzero(held)[:components]
    return Whitening(n, np.array(sums, dtype=object), values[keep], found[:, keep], trace), blocks


def whiten(rows: DataFrame, model: Whitening, blocks: BlockMatrix) -> tuple[BlockMatrix, float]:
    """The projected rows of the fit list and the largest absolute entry of
    their covariance minus the identity."""
    spark = rows.sparkSession
    projected = blocks.multiply(_small(spark, model.matrix, blocks.colsPerBlock))
    covariance = _scatter(spark, projected, model.n) / model.n
    return projected, float(np.abs(covariance - np.eye(len(model.values))).max())


def whitened_embeddings(
    rows: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    shift: int = SHIFT,
    components: int = COMPONENTS,
) -> DataFrame:
    """One row per kept row: its id, n, deviation, whitened array<double> and
    the arrays explained and identity_error of the whole fit. Vectors are the
    integers floor(scale * entry) + shift."""
    spark = rows.sparkSession
    kept = integer_vectors(rows.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{vector}`").alias("v")), "v", scale, shift)
    keyed = kept.select("id", "x", F.xxhash64(F.lit("a"), "x").alias("k1"), F.xxhash64(F.lit("b"), "x").alias("k2"))
    ids = written(keyed.select("id", "k1", "k2", "x"), "vector_rows")
    vectors = _numbered(ids.groupBy("k1", "k2", "x").agg(F.count(F.lit(1)).alias("copies")))
    model, blocks = fit(vectors)
    schema = "id bigint, n bigint, deviation bigint, whitened array<double>, explained array<double>, identity_error double"
    if model is None or not len(model.values):
        return spark.createDataFrame([], schema).withColumn("id", F.col("id").cast(ids.schema["id"].dataType))
    projected, error = whiten(rows, model, blocks)
    # n * x - S = n * (x - whole) - (S - n * whole), small where x and S are not.
    whole = [int(s) // model.n for s in model.sums]
    rest = [int(s) - model.n * w for s, w in zip(model.sums, whole, strict=True)]
    off = F.zip_with("x", F.array(*[F.lit(w).cast("bigint") for w in whole]), lambda c, w: (c - w) * model.n)
    off = F.zip_with(off, F.array(*[F.lit(r).cast("bigint") for r in rest]), lambda c, r: c - r)
    deviation = F.aggregate(off, F.lit(0).cast("bigint"), lambda a, d: a + d * d)
    facts = vectors.select("row", "k1", "k2", "copies", deviation.alias("deviation"))
    found = facts.join(_rows(projected), F.col("row") == F.col("index")).select("k1", "k2", "copies", "deviation", "y")
    found = written(found, "whitened")
    joined = join_hot_split(ids.select("id", "k1", "k2"), found, ["k1", "k2"], "copies", ids.count())
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.values])
    return joined.select(
        "id",
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        F.col("y").alias("whitened"),
        explained.alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def whitening_digest(rows: DataFrame) -> DataFrame:
    """One row per kept row and component."""
    found = whitened_embeddings(rows)
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c")
    found = found.select("id", "n", "deviation", "identity_error", each)
    return found.select(
        F.col("id").alias("vec_id"),
        (F.col("at") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        F.col("c.whitened").alias("whitened"),
        F.col("c.explained").alias("explained"),
        "identity_error",
    )
