"""The factorisation machine against its definition, and held-out quality."""

import zlib

import numpy as np
import pytest

from __spark_entry__ import queries
from kontor.llm import quality

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def result(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    return queries()["op8_quality"](spark, SF).join(labels, "doc_id", "left").toPandas()


def test_held_out_quality(result):
    fold = result.doc_id.map(lambda key: zlib.crc32(str(key).encode()) % 4 == 2)
    assert (fold == result.held_out).all() and len(result) == 1000
    held = result[result.held_out & result.quality.notna()]
    good, bad = held[held.quality == 1].score.to_numpy(), held[held.quality == 0].score.to_numpy()
    assert (good[:, None] > bad).mean() > 0.95
    assert (held.predicted == held.quality).mean() > 0.9
    assert result.score.between(0, 1).all() and (result.predicted == (result.score >= 0.7)).all()


def test_score_is_the_sum_over_pairs():
    chance = np.random.default_rng(3)
    numbers = chance.normal(size=(40, 4))
    words = [np.unique(chance.integers(0, quality.WORDS, 6)) for _ in range(40)]
    model = quality.fit(words, numbers, (numbers[:, 0] > 0).astype(float))
    places, values = model.vector(words[0], numbers[0])
    raw = model.bias + model.weights[places] @ values
    for i in range(len(places)):
        for j in range(i + 1, len(places)):
            raw += model.factors[places[i]] @ model.factors[places[j]] * values[i] * values[j]
    assert model.score(words[0], numbers[0]) == pytest.approx(1 / (1 + np.exp(-raw)))


def test_labels_of_the_held_out_fold_are_never_read(spark):
    from pyspark.sql import functions as F

    from kontor.llm.frames import learn_rows

    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    spoilt = labels.withColumn("quality", F.when(learn_rows(F.col("doc_id")), F.col("quality")).otherwise(1 - F.col("quality")))
    first, again = quality.train(docs, labels), quality.train(docs.repartition(3), spoilt)
    assert np.array_equal(first.weights, again.weights) and np.array_equal(first.factors, again.factors)


def test_odd_rows(spark):
    docs = [(1, "good words here", 15), (2, None, None), (3, "", 0), (None, "x", -5), (None, None, None), (4, "日本 " * 50_000, 3), (1, "good words here", 15)]
    labels = [(1, 1), (2, 0), (None, 1), (3, None), (99, 0), (1, 1)]
    docs = spark.createDataFrame([(*row, "k", [1.0]) for row in docs], "doc_id long, text string, n_chars long, key string, numbers array<double>")
    found = quality.quality(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(found) == 7 and all(0 <= row.score <= 1 and row.held_out is not None for row in found)


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a", 1)], "doc_id long, text string, n_chars long")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [(row.score, row.predicted) for row in quality.quality(docs, none).collect()] == [(0.5, 0)]
    assert quality.quality(docs.limit(0), none).count() == 0
