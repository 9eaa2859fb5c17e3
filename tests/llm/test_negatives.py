"""Mining against all products, the curve against its definition, and what the zone maps spare."""

import itertools
import math
import random

import numpy as np
from pyspark.sql import functions as F

from kontor.llm import hilbert, negatives

SCHEMA = "vec_id long, embedding array<float>, label int, key string, x int"


def single(vector):
    return np.array(vector, np.float32).astype(float).tolist()


def brute(rows, anchors, scale=256):
    def part(some):
        return [(key, label, [math.floor(scale * c) for c in v]) for key, v, label in some
                if None not in (key, v, label) and v and all(c is not None and math.isfinite(c) for c in v)]

    everything, asked = part(rows), {}
    for key, label, x in sorted(part(anchors), reverse=True):
        asked[key] = (label, x)
    result = []
    for anchor, (label, x) in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(x, y)), key, other == label) for key, other, y in everything
                        if key != anchor and len(x) == len(y))
        for score, positive, _ in [one for one in scored if one[2]][:5]:
            fits = [(s, key) for s, key, same in scored if not same and 30 * -score <= 100 * -s <= 90 * -score]
            result += [(anchor, positive, rank, key, -score, -s) for rank, (s, key) in enumerate(fits[:10], 1)]
    return sorted(result)


def found(spark, rows, anchors):
    frame = lambda some: spark.createDataFrame([(*row, "s", 1) for row in some], SCHEMA)
    return sorted(tuple(row) for row in negatives.mine(frame(rows), frame(anchors)).collect())


def clustered(count, dim, seed, spread=0.1, labels=3):
    """Vectors around six centres; labels run across them."""
    chance = random.Random(seed)
    centres = [[chance.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    return [(i, single([c + chance.gauss(0, spread) for c in centres[i % 6]]), chance.randrange(labels)) for i in range(count)]


def test_clusters_and_copies(spark, monkeypatch):
    for name, size in (("BLOCK", 16), ("PACK", 7), ("ZONES", 5)):
        monkeypatch.setattr(negatives, name, size)
    rows = clustered(180, 9, 3)
    rows += [(1000 + i, rows[7][1], i % 2) for i in range(60)]
    assert found(spark, rows, rows[::12]) == brute(rows, rows[::12])


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0], 1), (1, None, 1), (2, [1.0, None], 1), (3, [float("nan"), 1.0], 1), (4, [float("inf"), 1.0], 1),
        (5, [1.0, 1.0], None), (6, [0.5, 0.5], 2), (6, [0.5, 0.5], 2), (7, [1.0], 1), (8, [], 1), (None, [1.0, 2.0], 1),
        (9, [2.0, 2.0], 1), (10, [0.0, 0.0], 1), (11, [0.0, 0.0], 2), (0, [3.0, 3.0], 1), (12, [-5.0, 0.0], 1), (13, [0.9, 0.3], 2),
        (14, [1.0], 2), (15, [0.7], 2), (16, [1.25], 1),
    ]
    anchors = [rows[0], rows[14], rows[8], rows[9], rows[10], rows[12], rows[18], rows[1], rows[11], rows[11]]
    assert found(spark, rows, anchors) == brute(rows, anchors) != []


def test_empty(spark):
    assert found(spark, [], []) == []
    assert found(spark, [(1, [1.0], 1)], []) == []
    assert found(spark, [(1, [1.0], 1)], [(1, [1.0], 1)]) == []


def test_bounds_hold_all_products():
    chance = np.random.default_rng(4)
    for scale in (10, 10**6):
        x, a = chance.integers(-scale, scale, (40, 11)), chance.integers(-scale, scale, (9, 11))
        least, most = negatives.bounds(a, x.min(axis=0)[None], x.max(axis=0)[None])
        scores = a @ x.T
        assert (least <= scores).all() and (scores <= most).all()
        assert (negatives.bounds(a, x, x)[1] - scores).max() < 1 + 1e-6 * scale**2


def test_zone_maps_spare_most_blocks(spark, monkeypatch):
    for name, size in (("BLOCK", 16), ("PACK", 64)):
        monkeypatch.setattr(negatives, name, size)
    frame = spark.createDataFrame([(*row, "s", 1) for row in clustered(960, 12, 8, spread=0.02)], SCHEMA)
    rows = negatives.candidates(frame, "vec_id", "embedding", "label", 256)
    stored = negatives.blocks(rows)
    zones = negatives._packs(stored.select("dim", "block", "label", "lo", "hi"), 64, ("lo", "hi"))
    windows = rows.filter("key % 40 = 0").select(
        F.col("key").alias("anchor"), F.lit(0).alias("place"), "label", F.lit(400_000).cast("long").alias("low"),
        F.lit(10**9).cast("long").alias("high"), "x", F.size("x").alias("dim"),
    )
    read = negatives.full_choice(negatives._packs(windows, 64, ("x",)), zones, False).agg(F.sum(F.size("windows"))).first()[0]
    assert 0 < read < 0.25 * windows.count() * stored.count()


def test_curve_visits_neighbours():
    for dims, bits in ((1, 3), (2, 1), (2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(2**bits), repeat=dims)))
        places = hilbert.places(cells, bits)
        order = sorted(range(len(cells)), key=places.__getitem__)
        assert len(set(places)) == len(cells)
        assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()
