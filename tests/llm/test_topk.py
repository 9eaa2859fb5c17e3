"""Exact search against all products."""

import math
import random

from kontor.llm import topk


def brute(rows, queries, k, scale=256):
    def whole(vector):
        bad = vector is None or any(x is None or not math.isfinite(x) for x in vector)
        return None if bad else [math.floor(scale * x) for x in vector]

    vectors = [(key, whole(vector)) for key, vector in rows if key is not None and whole(vector) is not None]
    result = set()
    for query, x in {q: w for q, v in queries if q is not None and (w := whole(v)) is not None}.items():
        scores = [(sum(a * b for a, b in zip(x, y)), key) for key, y in vectors if key != query and len(y) == len(x)]
        scores.sort(key=lambda one: (-one[0], one[1]))
        result |= {(query, rank, key, score) for rank, (score, key) in enumerate(scores[:k], 1)}
    return result


def found(spark, rows, queries, k=5):
    schema = "vec_id long, embedding array<float>, score string, x int"
    frame = lambda some: spark.createDataFrame([(*row, "s", 1) for row in some], schema)
    return {tuple(row) for row in topk.top_k(frame(rows), frame(queries), k=k).collect()}


def test_clusters_and_ties(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    monkeypatch.setattr(topk, "VECTOR_BLOCK", 16)
    chance = random.Random(3)
    centres = [[chance.gauss(0, 1) for _ in range(19)] for _ in range(4)]
    rows = [(i, [round(c + chance.gauss(0, 0.1), 3) for c in chance.choice(centres)]) for i in range(90)]
    rows += [(100 + i, rows[7][1]) for i in range(20)]
    queries = rows[::10]
    rows = [(key, [float(x) for x in vector]) for key, vector in rows]
    import numpy as np

    exact = [(key, np.array(vector, np.float32).astype(float).tolist()) for key, vector in rows]
    assert found(spark, rows, queries) == brute(exact, exact[::10], 5)


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [-1.0, -2.0]),
        (6, [0.5, 0.5]), (6, [0.5, 0.5]), (7, [1.0]), (8, []), (9, []), (None, [1.0, 2.0]), (10, [0.0, 0.0]), (0, [3.0, 3.0]),
    ]
    queries = [rows[0], rows[1], rows[8], rows[9], rows[11]]
    assert found(spark, rows, queries) == brute(rows, queries, 5)


def test_empty(spark):
    assert found(spark, [], []) == set()
    assert found(spark, [(1, [1.0])], []) == set()


def test_less_than_half_multiplied_out(spark):
    """The vectors of the test tables point almost evenly in all directions, so bounds have little to go by."""
    import numpy as np

    rows = topk.whole(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet"), "vec_id", "embedding", 256).collect()
    keys, vectors = np.array([row.key for row in rows]), np.array([row.x for row in rows], np.int64)
    asked = topk.Block(keys[keys % 50 == 0], vectors[keys % 50 == 0])
    best = topk.Best(len(asked.keys), 5)
    topk.search(asked, topk.Block(keys, vectors), best)
    assert best.seen == len(asked.keys) * len(keys) and best.multiplied < best.seen / 2, best.multiplied / best.seen
    scores = asked.vectors @ vectors.T
    scores[asked.keys[:, None] == keys] = topk.LOWEST
    for query, one in enumerate(scores):
        order = np.lexsort((keys, ~one))[:5]
        assert best.keys[query].tolist() == keys[order].tolist() and best.scores[query].tolist() == one[order].tolist()


def test_levels():
    assert [topk.segment_counts(dim) for dim in (0, 1, 7, 8, 64, 768)] == [[1], [1], [4], [4], [4, 16, 32], [4, 16, 64, 256, 384]]
