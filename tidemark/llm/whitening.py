"""Whitening of embeddings by MLlib's singular value decomposition of the centred, distributed rows.

Entries become integers x, so sums, means and squared deviations are exact. With n rows, the right singular
vectors of the centred rows are the unit eigenvectors of their covariance V, and a singular value s gives the
eigenvalue s*s/n: MLlib has no divisor of its own there. The trace of V does not come from the
singular values, of which only the first may be wanted, but from the exact deviations.

MLlib sums the products of the rows in tasks and sends the driver one matrix of dimension squared; rows never come
to the driver. Its size rests on the dimension alone, which MOST_DIMENSIONS bounds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm._common import col, stored, trimmed

COMPONENTS = 32
#: Entries become floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Beyond it a matrix of dimension squared is too much for the driver.
MOST_DIMENSIONS = 8192
#: Singular values below this share of the largest are noise of the decomposition and give no component.
LEAST_SHARE = 1e-6
#: Entries of this size and more are left out, so that sums and deviations stay exact.
_MOST_ENTRY = float(1 << 31)


def integer_vectors(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, x array<long>) of the rows whose vector is there and has finite entries alone.

    Vectors of another length than the commonest (of equals the longest) have no place in the space and are
    left out, as are empty vectors and those with entries of 2**31 and more.
    """
    vector = col(vector_col)
    sound = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < _MOST_ENTRY))
    rows = embeddings.where(vector.isNotNull() & (F.size(vector) > 0) & sound)
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + F.lit(SHIFT).cast("long"))
    rows = stored(rows.select(col(id_col).alias("id"), x.alias("x")), "vectors")
    lengths = rows.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).limit(1).first()
    return rows if lengths is None else rows.where(F.size("x") == lengths["length"])


def dimension_sums(vectors: DataFrame) -> tuple[int, list[int], int]:
    """(rows, sum of each dimension, more than any entry lies from the mean of its dimension); as many numbers as dimensions reach the driver."""
    entries = vectors.select(F.posexplode("x").alias("place", "x"))
    found = entries.groupBy("place").agg(F.count("*").alias("n"), F.sum("x").alias("sum"), F.min("x").alias("least"), F.max("x").alias("most"))
    found = sorted(found.limit(MOST_DIMENSIONS + 1).collect(), key=lambda r: r["place"])
    if not found:
        return 0, [], 0
    if len(found) > MOST_DIMENSIONS:
        raise ValueError(f"vectors have more than {MOST_DIMENSIONS} dimensions")
    return found[0]["n"], [r["sum"] for r in found], max(r["most"] - r["least"] for r in found) + 1


def _longs(values: list[int]) -> Column:
    return F.lit(np.array(values, np.int64))


def _about_whole_mean(x: Column, n: int, sums: list[int]) -> Column:
    """x - S//n by dimension: small numbers, exact."""
    return F.zip_with(x, _longs([s // n for s in sums]), lambda a, q: a - q)


def centred(x: Column, n: int, sums: list[int]) -> Column:
    """x - S/n by dimension; only the fraction of the mean is rounded before the difference is."""
    rest = F.lit(np.array([s % n / n for s in sums]))
    return F.zip_with(_about_whole_mean(x, n, sums), rest, lambda a, r: a.cast("double") - r)


def deviation(x: Column, n: int, sums: list[int], reach: int) -> Column:
    """Sum of (n*x - S)**2 over dimensions, exact: by longs where no row can pass their range, else by decimals of 38 digits."""
    kind, one = ("long", "long") if len(sums) * (n * reach) ** 2 < 1 << 63 else ("decimal(38,0)", "decimal(19,0)")
    times = F.lit(n).cast(one)
    scaled = F.zip_with(_about_whole_mean(x, n, sums), _longs([s % n for s in sums]), lambda a, r: (a.cast(one) * times - r).cast(kind))
    return F.aggregate(scaled, F.lit(0).cast(kind), lambda acc, a: (acc + a * a).cast(kind)).cast("decimal(38,0)")


def _row_matrix(vectors: DataFrame, column: Column) -> RowMatrix:
    rows = vectors.select(array_to_vector(column).alias("v"))
    return RowMatrix(MLUtils.convertVectorColumnsFromML(rows, "v"))


def principal_components(vectors: DataFrame, n: int, sums: list[int], components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of the covariance, by falling eigenvalue."""
    matrix = _row_matrix(vectors, centred(F.col("x"), n, sums))
    # all of them: for fewer MLlib would iterate to a tolerance instead of solving to double precision
    svd = matrix.computeSVD(len(sums), computeU=False, rCond=LEAST_SHARE)
    values = np.asarray(svd.s.toArray()) ** 2 / n
    kept = int((values > 0).sum())
    return values[: min(kept, components)], np.asarray(svd.V.toArray())[:, : min(kept, components)]


def _projected(n: int, sums: list[int], projection: np.ndarray, schema: pa.Schema) -> Callable:
    whole, rest = np.array([s // n for s in sums], np.int64), np.array([s % n / n for s in sums])

    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(whole))
            white = ((x - whole) - rest) @ projection
            ends = pa.array(np.arange(len(white) + 1, dtype=np.int32) * white.shape[1])
            lists = pa.ListArray.from_arrays(ends, pa.array(white.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("deviation"), lists], schema=schema)

    return run


def identity_error(white: DataFrame, n: int, components: int) -> float:
    """The largest absolute entry of the covariance of ``whitened`` minus the identity."""
    means = white.select(F.posexplode("whitened").alias("place", "w")).groupBy("place").agg(F.avg("w").alias("mean"))
    means = [r["mean"] for r in sorted(means.collect(), key=lambda r: r["place"])]
    about = F.zip_with("whitened", F.lit(np.array(means)), lambda w, m: w - m)
    gram = _row_matrix(white, about)._java_matrix_wrapper.call("computeGramianMatrix")
    return float(np.abs(gram.toArray() / n - np.eye(components)).max())


def whitened_embeddings(
    embeddings: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """(vec_id, n, deviation decimal(38,0), whitened array, explained array, identity_error) of every sound vector.

    Rows whose vector is null or has null or non-finite entries are left out (integer_vectors tells what else).
    Rows without an id and repeated rows count as rows of their own. Components without variance (equal vectors,
    dimensions that depend on others, fewer rows than dimensions) have no whitened form and are left out of
    the arrays; with equal rows alone, or an empty table, the result is empty. Signs of components are those of
    one decomposition, the same for all rows. Other columns are ignored.
    """
    spark, kind = embeddings.sparkSession, embeddings.schema[id_col].dataType
    name = kind.simpleString()
    vectors = integer_vectors(embeddings, id_col, vector_col)
    n, sums, reach = dimension_sums(vectors)
    result = f"vec_id {name}, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    if not n or reach == 1:
        return spark.createDataFrame([], result)
    rows = vectors.withColumn("deviation", deviation(F.col("x"), n, sums, reach))
    total = rows.agg(F.sum(F.col("deviation").cast("decimal(38,0)")).alias("sum")).first()["sum"]
    with localcontext() as exact:
        exact.prec = 60
        trace = float(Decimal(total) / Decimal(n) ** 3)
    values, vectors_of = principal_components(vectors, n, sums, components)
    schema = pa.schema([("id", to_arrow_type(kind)), ("deviation", pa.decimal128(38, 0)), ("whitened", pa.list_(pa.float64()))])
    made = rows.mapInArrow(_projected(n, sums, vectors_of / np.sqrt(values), schema), f"id {name}, deviation decimal(38,0), whitened array<double>")
    white = stored(made, "whitened")
    error = identity_error(white, n, len(values))
    return white.select(
        F.col("id").alias("vec_id"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.lit(values / trace).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def whitened_components(embeddings: DataFrame) -> DataFrame:
    """A row for each vector and component of whitened_embeddings: (vec_id, component, n, deviation long, whitened, explained, identity_error).

    ``deviation`` is null where a long cannot hold it, from a few million rows on; ``deviation_exact`` always has it.
    """
    white = whitened_embeddings(embeddings)
    parts = F.arrays_zip("whitened", "explained")
    each = white.select("vec_id", "n", "deviation", "identity_error", F.posexplode(parts).alias("place", "part"))
    return each.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        "n",
        F.col("deviation").try_cast("long").alias("deviation"),
        F.col("part.whitened").alias("whitened"),
        F.col("part.explained").alias("explained"),
        "identity_error",
        F.col("deviation").alias("deviation_exact"),
    )
