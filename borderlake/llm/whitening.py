"""Embedding whitening: principal components of integer vectors by distributed blocks.

1. Usable vectors become integer vectors x = floor(STEP * c) + SHIFT. The *fit list* has
   each distinct x once; its size n and sums S are exact.
2. Centred rows (x - S/n) are indexed into blocks of BLOCK_ROWS rows, an MLlib
   ``BlockMatrix``. Its transpose times itself is the scatter matrix. The middle dimension of
   that product is cut into splits, as all blocks would else meet in the task of the one
   result block.
3. The driver solves the symmetric eigenproblem of the d x d covariance.
4. The blocks of all rows times the d x k whitening matrix are the projected rows.

x is close to a million while its spread is small, so nothing is multiplied before it is
centred: with S = q*n + r, the entry is (x - q) - r/n, an integer less a fraction.

Bounds. A task holds a block of rows, the driver two d x d matrices (a few thousand
dimensions at most) and, within MLlib's product, the number of each block: 16 bytes for
BLOCK_ROWS rows. Blocks are stored, as the product reads them more than once. A group of equal vectors is reduced to one row in each task first.

Defined cases. Dropped: null vectors, vectors with a null, NaN or infinite entry, empty
vectors, and vectors that do not have the most frequent length (of equally frequent ones the
longer). x is bounded to +-2**62. Repeated rows and null ids give rows of their own; equal
vectors get equal results. A component without variance (eigenvalue at most 1e-12 of the
trace) cannot be scaled to one and is not returned, so a table of one distinct vector gives no
rows, as an empty one does. ``deviation`` is null where it does not fit a long.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import PART_BIT, ROW, stored

#: Entries become integers in steps of 1/STEP, shifted.
STEP = 64
SHIFT = 1_000_000
#: Components returned.
COMPONENTS = 16
#: Rows of a block.
BLOCK_ROWS = 2048
#: Blocks of the middle dimension that one task multiplies.
BLOCKS_PER_SPLIT = 16
#: Share of the trace below which a component counts as without variance.
FLAT = 1e-12
LIMIT = float(2**62)


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id and x of the rows that have a vector of the table's length."""
    vector = F.col("embedding")
    whole = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = embeddings.select("vec_id", "embedding").filter(F.coalesce(whole & (F.size(vector) > 0), F.lit(False)))
    sizes = rows.groupBy(F.size(vector).alias("d")).agg(F.count("*").alias("n"))
    common = sizes.orderBy(F.desc("n"), F.desc("d")).limit(1).select("d")

    def whole_number(c: Column) -> Column:
        scaled = F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), c.cast("double") * STEP))
        return F.floor(scaled) + F.lit(SHIFT).cast("bigint")

    same = rows.filter(F.size(vector) == common.scalar())
    return same.select("vec_id", F.transform(vector, whole_number).alias("x"))


def numbered(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` stored with consecutive numbers ``at``, from 0."""
    marked = stored(rows.withColumn(ROW, F.monotonically_increasing_id()), label)
    part = F.shiftright(ROW, PART_BIT)
    sizes = marked.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
    starts, first = {}, 0
    for row in sizes.orderBy("part").toLocalIterator():  # a row for each partition that wrote the table
        starts[row["part"]], first = first, first + row["size"]
    spark = rows.sparkSession
    table = spark.createDataFrame(list(starts.items()) or [(0, 0)], "part bigint, start bigint")
    own = F.col(ROW).bitwiseAND(F.lit((1 << PART_BIT) - 1))
    return marked.withColumn("part", part).join(F.broadcast(table), "part").withColumn("at", F.col("start") + own).drop("part", "start")


def centred_blocks(rows: DataFrame, mean: tuple[list[int], list[int], int], total: int) -> BlockMatrix:
    """The centred vectors of rows numbered ``at`` as blocks; rows behind the last are zero."""
    whole, rest, n = mean
    q, r = np.array(whole, np.int64), np.array(rest, np.float64) / n
    size = len(q)

    def run(table: pa.Table) -> pa.Table:
        at = table.column("at").to_numpy()
        x = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
        block = np.zeros((BLOCK_ROWS, size))
        block[at % BLOCK_ROWS] = (x - q) - r
        values = block.tobytes(order="F")
        return pa.table({"block": pa.array([at[0] // BLOCK_ROWS], pa.int32()), "values": pa.array([values], pa.binary())})

    keyed = rows.select(F.floor(F.col("at") / BLOCK_ROWS).alias("block"), "at", "x")
    made = stored(keyed.groupBy("block").applyInArrow(run, "block int, values binary"), "whitening-blocks")
    blocks = made.rdd.map(lambda b: ((b["block"], 0), DenseMatrix(BLOCK_ROWS, size, np.frombuffer(b["values"]))))
    return BlockMatrix(blocks, BLOCK_ROWS, size, math.ceil(total / BLOCK_ROWS) * BLOCK_ROWS, size)


def scatter(blocks: BlockMatrix) -> np.ndarray:
    """transpose(A) * A, its middle dimension cut into splits that tasks multiply apart.
    The Python method does not pass the number of splits on, hence the call of MLlib's own."""
    splits = max(1, math.ceil(blocks.numRowBlocks / BLOCKS_PER_SPLIT))
    left, right = blocks.transpose()._java_matrix_wrapper, blocks._java_matrix_wrapper
    product = left.call("multiply", right._java_model, splits)
    return BlockMatrix(product, blocks.colsPerBlock, blocks.colsPerBlock).toLocalMatrix().toArray()


def whitening_matrix(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvectors over the root of their eigenvalue, as columns, and the explained shares."""
    trace = float(np.trace(covariance))
    if trace <= 0:
        return np.zeros((len(covariance), 0)), np.zeros(0)
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > FLAT * trace]
    return vectors[:, order] / np.sqrt(values[order]), values[order] / trace


def projected(blocks: BlockMatrix, matrix: np.ndarray, spark: SparkSession) -> DataFrame:
    """(at, w): the rows of blocks times the matrix."""
    size, k = matrix.shape
    right = spark.sparkContext.parallelize([((0, 0), DenseMatrix(size, k, matrix.ravel(order="F")))], 1)
    product = blocks.multiply(BlockMatrix(right, size, k, size, k))

    def rows(block) -> Iterator[tuple[int, list[float]]]:
        (index, _), values = block
        for i, row in enumerate(values.toArray().tolist()):
            yield index * BLOCK_ROWS + i, row

    return spark.createDataFrame(product.blocks.flatMap(rows), "at bigint, w array<double>")


def deviation(x: Column, sums: list[int], n: int) -> Column:
    """Sum over the dimensions of (n*x - S)^2, exact; null where a long cannot hold it."""
    wide = "decimal(38,0)"
    s = F.array(*[F.lit(str(v)).cast(wide) for v in sums])
    apart = F.zip_with(x, s, lambda a, b: F.try_subtract(F.try_multiply(a.cast(wide), F.lit(n).cast(wide)).cast(wide), b).cast(wide))
    total = F.aggregate(
        apart, F.lit(0).cast(wide), lambda sum_, v: F.try_add(sum_, F.try_multiply(v, v).cast(wide)).cast(wide)
    )
    return total.try_cast("bigint")


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """For each row with a usable vector, its whitened coordinates: vec_id, n, deviation, w
    (array), at, and the shares ``explained`` (array) and ``identity_error`` of the fit."""
    spark = embeddings.sparkSession
    kind = dict(embeddings.dtypes)["vec_id"]
    rows = numbered(usable(embeddings), "whitening-rows")
    fit = numbered(rows.groupBy("x").agg(F.min("at").alias("first")), "whitening-fit")
    size = fit.select(F.size("x")).head()
    empty = f"vec_id {kind}, at bigint, n bigint, deviation bigint, w array<double>, explained array<double>, identity_error double"
    if size is None:
        return spark.createDataFrame([], empty)
    sums_of = [F.sum(F.col("x")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(size[0])]
    n, *sums = fit.agg(F.count("*").alias("n"), *sums_of).head()
    sums = [int(s) for s in sums]
    mean = ([s // n for s in sums], [s % n for s in sums], n)
    matrix, explained = whitening_matrix(scatter(centred_blocks(fit, mean, n)) / n, components)
    if not len(explained):
        return spark.createDataFrame([], empty)
    total = rows.count()
    placed = projected(centred_blocks(rows, mean, total), matrix, spark).filter(F.col("at") < total)
    found = rows.select("vec_id", "at", deviation(F.col("x"), sums, n).alias("deviation")).join(placed, "at")
    done = stored(found, "whitening-projected")
    error = identity_error(done.join(fit.select(F.col("first").alias("at")), "at", "left_semi"), n, len(explained))
    return done.select(
        "vec_id", "at", F.lit(n).cast("bigint").alias("n"), "deviation", "w",
        F.array(*[F.lit(float(e)) for e in explained]).alias("explained"), F.lit(error).alias("identity_error"),
    )


def identity_error(fitted: DataFrame, n: int, k: int) -> float:
    """The largest entry of the covariance of the projected fit list minus the identity."""
    vectors = MLUtils.convertVectorColumnsFromML(fitted.select(array_to_vector("w").alias("w")), "w")
    matrix = RowMatrix(vectors, n, k)
    means = np.array([float(v) for v in fitted.agg(*[F.avg(F.col("w")[i]) for i in range(k)]).head()])
    gram = matrix.computeGramianMatrix().toArray() / n - np.outer(means, means)
    return float(np.abs(gram - np.eye(k)).max())


def whitened_components(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row for each vector and component, numbered from 1 by falling eigenvalue."""
    rows = whiten(embeddings, components)
    each = F.posexplode(F.arrays_zip("w", "explained")).alias("at", "c")
    return rows.select("vec_id", "n", "deviation", "identity_error", each).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation",
        F.col("c.w").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error",
    )
