"""Exact top-k search by inner product, with bounds from segment statistics.

A vector is cut into equal segments.  With mean m and deviation s of a segment of n
components, the squared distance of two vectors is at least the sum over segments of
n ((m - m')^2 + (s - s')^2); as |q|^2 and |x|^2 are known, their inner product is at most
the sum of n (m m' + s s').  More segments give a closer bound, down to segments of two
components.  Each block of vectors is bounded against a block of queries from coarse to
fine; only pairs whose bound reaches the query's k-th best score so far are looked at
again.  What is left is multiplied out, the highest bounds first, as they raise that score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kontor.operators.sizing import written

COARSEST, FINER = 4, 4
QUERY_BLOCK = 1_024
VECTOR_BLOCK = 2_048
# What rounding can take from a bound, for each unit of the norms' product.
ROUNDING = 1e-9
# Below this share of pairs alive, a level looks at each query's own vectors.
SPARSE = 0.125
LOWEST, NO_KEY = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def whole(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(key, x) with x = floor(scale * component) as longs; rows with a null or not finite component are left out."""
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").alias("x")).filter("x IS NOT NULL")
    finite = F.forall("x", lambda one: one.isNotNull() & ~F.isnan(one) & (F.abs(one.cast("double")) < float("inf")))
    rows = rows.filter(finite)
    return rows.withColumn("x", F.transform("x", lambda one: F.floor(one.cast("double") * scale)))


def _statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of the segments, each times the root of the segment's length.

    Vectors are filled up with zeros to a whole number of segments, which changes no product.
    """
    size = max(1, -(-vectors.shape[1] // segments))
    filled = np.zeros((len(vectors), size * segments))
    filled[:, : vectors.shape[1]] = vectors
    cut = filled.reshape(len(vectors), segments, size)
    return np.concatenate([cut.mean(axis=2), cut.std(axis=2)], axis=1) * np.sqrt(size)


def segment_counts(dim: int) -> list[int]:
    """Numbers of segments from coarse to fine; the last ones hold two components."""
    most = max(1, -(-dim // 2))
    counts = []
    count = COARSEST
    while count < most:
        counts.append(count)
        count *= FINER
    return [*counts, most]


class Block:
    """Vectors of one length with their statistics, coarse to fine."""

    def __init__(self, keys: np.ndarray, vectors: np.ndarray):
        self.keys, self.vectors = keys, vectors
        self.levels = [_statistics(vectors, count) for count in segment_counts(vectors.shape[1])]
        self.largest = int(np.abs(vectors).max(initial=0))

    @classmethod
    def opened(cls, dim: int, keys: bytes, x: bytes) -> Block:
        known = np.frombuffer(keys, np.int64)
        return cls(known, np.frombuffer(x, np.int64).reshape(len(known), dim))


class Best:
    """The k best of each query so far: higher scores first, then smaller keys.

    `floor` is a score that k vectors are known to reach; `seen` and `multiplied` count pairs.
    """

    def __init__(self, queries: int, k: int):
        self.k = k
        self.scores = np.full((queries, k), LOWEST)
        self.keys = np.full((queries, k), NO_KEY)
        self.floor = np.full(queries, LOWEST)
        self.seen = self.multiplied = 0

    def add(self, query: int, scores: np.ndarray, keys: np.ndarray) -> None:
        scores, keys = np.concatenate([self.scores[query], scores]), np.concatenate([self.keys[query], keys])
        order = np.lexsort((keys, ~scores))[: self.k]
        self.scores[query], self.keys[query] = scores[order], keys[order]
        self.floor[query] = max(self.floor[query], self.scores[query, -1])


def products(vectors: np.ndarray, query: np.ndarray, small: bool) -> np.ndarray:
    """Exact inner products; in floating point where no sum can leave the whole numbers it holds."""
    return (vectors.astype(float) @ query.astype(float)).astype(np.int64) if small else vectors @ query


def search(queries: Block, block: Block, best: Best) -> None:
    """Improve `best` by the vectors of `block`."""
    dim = queries.vectors.shape[1]
    slack = 1 + ROUNDING * dim * queries.largest * block.largest
    small = dim * queries.largest * block.largest < 2**52
    alive = np.ones((len(queries.keys), len(block.keys)), bool)
    bounds = np.empty(alive.shape)
    best.seen += alive.size
    for level, (ours, theirs) in enumerate(zip(queries.levels, block.levels)):
        rows, columns = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        if alive.sum() < SPARSE * len(rows) * len(columns):
            for query in rows:
                left = np.flatnonzero(alive[query])
                bounds[query, left] = theirs[left] @ ours[query] + slack
        else:
            bounds[np.ix_(rows, columns)] = ours[rows] @ theirs[columns].T + slack
        if level == 0:
            _seed(queries, block, best, bounds, small)
        alive &= bounds >= best.floor[:, None]
    for query in np.flatnonzero(alive.any(axis=1)):
        left = np.flatnonzero(alive[query] & (block.keys != queries.keys[query]))
        left = left[np.argsort(-bounds[query, left], kind="stable")]
        at = 0
        while at < len(left) and bounds[query, left[at]] >= best.floor[query]:
            some = left[at:at + max(4 * best.k, at // 2)]
            some = some[bounds[query, some] >= best.floor[query]]
            at += max(4 * best.k, at // 2)
            best.multiplied += len(some)
            scores = products(block.vectors[some], queries.vectors[query], small)
            good = scores >= best.floor[query]
            best.add(query, scores[good], block.keys[some][good])


def _seed(queries: Block, block: Block, best: Best, bound: np.ndarray, small: bool) -> None:
    """A first floor for queries that have none: the k-th score among the vectors with the highest coarse bounds."""
    size = min(4 * best.k, len(block.keys))
    for query in np.flatnonzero(best.floor == LOWEST):
        top = np.argpartition(-bound[query], size - 1)[:size]
        top = top[block.keys[top] != queries.keys[query]]
        if len(top) >= best.k:
            best.multiplied += len(top)
            best.floor[query] = np.sort(products(block.vectors[top], queries.vectors[query], small))[-best.k]


def _blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Rows packed by vector length into blocks of at most about `size`: (dim, keys, x)."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        for batch in batches:
            for key, vector in zip(batch["key"], batch["x"]):
                one = held.setdefault(len(vector), [])
                one.append((key, vector))
                if len(one) == size:
                    yield _packed(len(vector), held.pop(len(vector)))
        for dim, one in held.items():
            yield _packed(dim, one)

    return written(rows.mapInPandas(pack, "dim int, keys binary, x binary"), name)


def _packed(dim: int, rows: list) -> pd.DataFrame:
    keys = np.array([key for key, _ in rows], np.int64)
    vectors = np.array([vector for _, vector in rows], np.int64).reshape(len(rows), dim)
    return pd.DataFrame({"dim": [dim], "keys": [keys.tobytes()], "x": [vectors.tobytes()]})


def top_k(
    df: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 5, scale: int = 256,
) -> DataFrame:
    """(query, rank, key, score): each query's `k` highest inner products with the other rows of `df`.

    Ties go to the smaller key; fewer rows give fewer ranks.  Components become
    floor(scale * x) first.  Keys are longs.  Vectors that are null or hold a null or not finite component,
    and rows with a null key, take no part; vectors of another length are not compared, an
    empty one scores 0 with others.  Rows that share a query's key are its own and left
    out; of repeated rows each is a candidate, and repeated queries are one.  Queries and
    vectors meet block by block; a task keeps the best of the query block in hand only.
    """
    rows = whole(df, key, vector, scale).filter("key IS NOT NULL")
    asked = whole(queries, key, vector, scale).filter("key IS NOT NULL").dropDuplicates(["key"])
    ours = _blocks(asked, QUERY_BLOCK, "topk-queries").toDF("query_dim", "query_keys", "query_x")
    theirs = _blocks(rows, VECTOR_BLOCK, "topk-vectors")
    tasks = max(1, min(theirs.count(), df.sparkSession.sparkContext.defaultParallelism))
    # Packed blocks, each query block against each vector block: the stated query set against all rows.
    pairs = ours.repartition(max(1, ours.count())).crossJoin(theirs.repartition(tasks))
    found = pairs.mapInPandas(_searched(k), "query long, key long, score long")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "key")))
    return ranked.filter(F.col("rank") <= k).select("query", "rank", "key", "score")


def _searched(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mark = asked = best = None
        for batch in batches:
            for dim, query_keys, query_x, key_dim, keys, x in batch.itertuples(index=False):
                if (dim, query_keys) != mark:
                    if best is not None:
                        yield _rows(asked, best)
                    mark, asked = (dim, query_keys), Block.opened(dim, query_keys, query_x)
                    best = Best(len(asked.keys), k)
                if dim == key_dim:
                    search(asked, Block.opened(dim, keys, x), best)
        if best is not None:
            yield _rows(asked, best)

    return run


def _rows(asked: Block, best: Best) -> pd.DataFrame:
    query, place = np.nonzero(best.keys != NO_KEY)
    return pd.DataFrame({
        "query": asked.keys[query], "key": best.keys[query, place], "score": best.scores[query, place],
    })
