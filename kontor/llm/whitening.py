"""Whitening of embedding vectors by the leading components of their covariance.

Vectors become whole numbers, and each distinct one counts once.  Sums, covariance, and
the check of the result are taken over that list: every task sums its own rows, and the
parts are added up by Spark, d (d + 1) / 2 numbers in all.  Only that matrix, whose size
depends on the vectors' length alone, comes to the driver; `spectrum` finds its
leading eigenpairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kontor.llm import spectrum
from kontor.llm.topk import whole
from kontor.operators.sizing import written

# Longest vectors: their covariance, 32 MB, is all that the driver and a task hold at once.
MOST_COMPONENTS = 2_048


@dataclass(frozen=True)
class Whitener:
    """n vectors with sums S, the trace of their covariance, its leading eigenvalues, and their vectors as rows."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """One row for each vector, one column for each component."""
        centre = np.array([total / self.n for total in self.sums])
        return (x - centre) @ self.vectors.T / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """The exact sum of (n x - S)^2 of each vector; raises where a long cannot hold it."""
        largest = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        if largest**2 * len(self.sums) < 2**63:
            return ((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(axis=1)
        exact = [sum((self.n * int(a) - total) ** 2 for a, total in zip(one, self.sums)) for one in x]
        return np.array(exact, np.int64)


def _vectors(x: pa.Array) -> np.ndarray:
    """Vectors of one length as a matrix of whole numbers."""
    return x.flatten().to_numpy().reshape(len(x), -1)


def _total(fit: DataFrame, part: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
    """The sum over all blocks x of the fit list of the vector `part`(x), in longs or doubles; tasks add up their own first."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if len(batch):
                here = part(_vectors(batch.column("x")))
                total = here if total is None else total + here
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["place", "part"])

    rows = fit.mapInArrow(sums, f"place int, part {kind}").groupBy("place").agg(F.sum("part").alias("part"))
    return rows.orderBy("place").toPandas()["part"].to_numpy()


def _products(fit: DataFrame, rows: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum of r r' over all rows r = `rows`(x), a symmetric matrix, of which the upper half is added up."""
    upper = np.triu_indices(size)

    def part(x: np.ndarray) -> np.ndarray:
        found = rows(x)
        return (found.T @ found)[upper]

    matrix = np.zeros((size, size))
    matrix[upper] = _total(fit, part, "double")
    return np.triu(matrix) + np.triu(matrix, 1).T


def fit(distinct: DataFrame, size: int, components: int = 4) -> Whitener:
    """The whitener of different vectors (x) of `size` numbers each."""
    if size > MOST_COMPONENTS:
        raise ValueError(f"vectors of {size} components; at most {MOST_COMPONENTS} can be whitened")
    n, *totals = (int(one) for one in _total(distinct, lambda x: np.concatenate([[len(x)], x.sum(axis=0)]), "long"))
    centre = np.array([total / n for total in totals])
    covariance = _products(distinct, lambda x: x - centre, size) / n
    values, vectors = spectrum.leading(covariance, components)
    return Whitener(n, totals, float(np.trace(covariance)), values, vectors)


def identity_error(whitener: Whitener, distinct: DataFrame) -> float:
    """The largest absolute entry of the whitened list's covariance minus the identity, from passes over the list."""
    size = len(whitener.values)
    if not size:
        return 0.0
    mean = _total(distinct, lambda x: whitener.whitened(x).sum(axis=0), "double") / whitener.n
    covariance = _products(distinct, lambda x: whitener.whitened(x) - mean, size) / whitener.n
    return float(np.abs(covariance - np.eye(size)).max())


def usual_length(vectors: DataFrame) -> int:
    """The length that most vectors have, the shorter one where that ties; 0 without vectors that have any components."""
    lengths = vectors.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n")).filter("size > 0")
    first = lengths.orderBy(F.desc("n"), "size").first()
    return 0 if first is None else first["size"]


def whiten(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 4, scale: int = 256,
) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): each row's coordinates on the leading components.

    Components of a vector become floor(scale * c).  Rows whose vector is null, or holds a null
    or not finite entry, are left out; of vectors of several lengths only those count whose
    length most different vectors have.  Rows with a null or repeated key stay, equal
    vectors count once in the fit.  Components whose eigenvalue cannot be told from zero are left
    out, so fewer than two different vectors give no rows; an empty table gives none.
    """
    vectors = whole(df, key, vector, scale)
    # Read by every pass of the fit, hence written.
    distinct = written(vectors.select("x").dropDuplicates(["x"]), "whitening-fit")
    schema = T.StructType([
        T.StructField("key", vectors.schema["key"].dataType), T.StructField("component", T.IntegerType()),
        T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
        T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType()),
    ])
    size = usual_length(distinct)
    if not size:
        return df.sparkSession.createDataFrame([], schema)
    distinct = distinct.filter(F.size("x") == size)
    whitener = fit(distinct, size, components)
    error = identity_error(whitener, distinct)
    count = len(whitener.values)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if count and len(batch):
                x = _vectors(batch.column("x"))
                row = np.arange(len(x)).repeat(count)
                yield pa.RecordBatch.from_arrays([
                    batch.column("key").take(pa.array(row)), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(row), whitener.n)), pa.array(whitener.deviations(x)[row]),
                    pa.array(whitener.whitened(x).ravel()), pa.array(np.tile(whitener.values / whitener.trace, len(x))),
                    pa.array(np.full(len(row), error)),
                ], schema.names)

    return vectors.filter(F.size("x") == size).mapInArrow(each, schema)
