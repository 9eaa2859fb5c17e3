"""Quality scores: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j); the pairs are summed in
linear time as half of (sum v_i x_i)^2 - sum (v_i x_i)^2, factor by factor.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kontor.llm.frames import learn_rows
from kontor.operators.sizing import written

WORD_BITS = 14
WORDS = 1 << WORD_BITS
BINS = 12
FACTORS = 6
EPOCHS = 6
RATE = 0.08
PENALTY = 2e-4
# Learned from about this many labelled documents, picked by a hash of their key.
LABELLED = 6_000
WORDS_KEPT = 500_000

_PLACES: dict[str, int] = {}


def _place(word: str) -> int:
    """The bucket of a word, kept for the words the worker has seen lately."""
    place = _PLACES.get(word)
    if place is None:
        if len(_PLACES) > WORDS_KEPT:
            _PLACES.clear()
        place = _PLACES[word] = xxhash.xxh32_intdigest(word, 7) % WORDS
    return place


# --- features -------------------------------------------------------------------
STATISTICS = (
    "log bytes", "log words", "log lines", "bytes a word", "upper case", "digits", "marks", "beyond ASCII",
    "different words", "different lines", "words without letters", "words ending in marks", "commonest mark", "short lines",
)


def statistics(text: str) -> list[float]:
    data = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256) if data else np.zeros(256, np.int64)
    size = max(1, len(data))
    words, lines = text.split(), [line for line in text.split("\n") if line.strip()]
    n_words, n_lines = max(1, len(words)), max(1, len(lines))
    marks = counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()
    rare = np.r_[counts[33:39], counts[40:44], counts[47], counts[58:63], counts[64], counts[91:97], counts[123:127]]
    return [
        np.log1p(len(data)), np.log1p(len(words)), np.log1p(len(lines)), len(data) / n_words,
        counts[65:91].sum() / size, counts[48:58].sum() / size, marks / size, counts[128:].sum() / size,
        len(set(words)) / n_words, len(set(lines)) / n_lines,
        sum(not any(map(str.isalpha, word)) for word in words) / n_words,
        sum(not word[-1].isalnum() for word in words) / n_words, rare.max() / size,
        sum(len(line) < 30 for line in lines) / n_lines,
    ]


def word_places(text: str) -> np.ndarray:
    return np.unique(np.fromiter((_place(word) for word in set(text.lower().split())), np.int64))


@dataclass(frozen=True)
class Model:
    """Bin borders of the statistics and metadata, and the machine's weights."""

    borders: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def vector(self, words: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and values of what is not zero: words of length one together, and a bin for each number."""
        bins = (numbers[:, None] > self.borders).sum(axis=1)
        places = np.concatenate([words, WORDS + np.arange(len(numbers)) * BINS + bins])
        values = np.concatenate([np.full(len(words), 1 / np.sqrt(max(1, len(words)))), np.ones(len(numbers))])
        return places, values

    def score(self, words: np.ndarray, numbers: np.ndarray) -> float:
        places, values = self.vector(words, numbers)
        return 1 / (1 + np.exp(-self._raw(places, values)[0]))

    def _raw(self, places: np.ndarray, values: np.ndarray):
        scaled = self.factors[places] * values[:, None]
        total = scaled.sum(axis=0)
        pairs = 0.5 * (total @ total - (scaled * scaled).sum())
        return self.bias + self.weights[places] @ values + pairs, scaled, total


def numbers_of(text: str, metadata: Sequence[float]) -> np.ndarray:
    return np.array([*statistics(text), *(np.log1p(max(0.0, one)) if one == one else 0.0 for one in metadata)])


def fit(words: list[np.ndarray], numbers: np.ndarray, labels: np.ndarray, seed: int = 11) -> Model:
    """Logistic loss, AdaGrad, one document at a time, in an order the seed gives."""
    chance = np.random.default_rng(seed)
    borders = np.quantile(numbers, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    size = WORDS + numbers.shape[1] * BINS
    weights, factors = np.zeros(size), chance.normal(0, 0.02, (size, FACTORS))
    seen_w, seen_v = np.full(size, 1e-6), np.full((size, FACTORS), 1e-6)
    bias = float(np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1)))
    model = Model(borders, bias, weights, factors)
    vectors = [model.vector(one, row) for one, row in zip(words, numbers)]
    for _ in range(EPOCHS):
        for i in chance.permutation(len(vectors)):
            places, values = vectors[i]
            raw, scaled, total = model._raw(places, values)
            slope = 1 / (1 + np.exp(-raw)) - labels[i]
            step = slope * values + PENALTY * weights[places]
            seen_w[places] += step * step
            weights[places] -= RATE * step / np.sqrt(seen_w[places])
            push = slope * values[:, None] * (total - scaled) + PENALTY * factors[places]
            seen_v[places] += push * push
            factors[places] -= RATE / 4 * push / np.sqrt(seen_v[places])
    return model


# --- the operator ---------------------------------------------------------------
def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    metadata: Sequence[str] = ("n_chars",), bound: int = LABELLED,
) -> Model | None:
    """A model from about `bound` labelled documents outside the held-out fold; None without any.

    Labelled rows with a null key or label take no part, labels without a document neither;
    a null text is empty, a null number 0.
    """
    marked = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("int").alias("label")).dropna()
    marked = marked.filter(learn_rows(F.col("key")))
    share = min(1.0, bound / max(1, marked.count()))
    marked = written(marked.filter(F.pmod(F.xxhash64("key", F.lit(1)), F.lit(1 << 20)) / (1 << 20) < share), "labels")
    joined = _inputs(docs, text, metadata, key).join(F.broadcast(marked), "key")  # at most about `bound` rows
    features = joined.select("label", _featured(F.col("text"), F.col("numbers")).alias("x"), F.xxhash64("key", "text").alias("o"))
    rows = features.select("label", "x.*", "o").toPandas().sort_values(["o", "label"])
    if rows.empty:
        return None
    return fit([np.asarray(one, np.int64) for one in rows["words"]], np.array(rows["numbers"].tolist()), rows["label"].to_numpy(float))


def _inputs(docs: DataFrame, text: str, metadata: Sequence[str], *keys: str) -> DataFrame:
    numbers = [F.coalesce(F.col(f"`{one}`").cast("double"), F.lit(0.0)) for one in metadata]
    return docs.select(
        *[F.col(f"`{key}`").alias("key") for key in keys], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
        (F.array(*numbers) if numbers else F.array().cast("array<double>")).alias("numbers"),
    )


def _featured(text: Column, metadata: Column) -> Column:
    @F.pandas_udf("words array<long>, numbers array<double>")
    def each(texts: pd.Series, more: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({
            "words": [word_places(one) for one in texts],
            "numbers": [numbers_of(one, also) for one, also in zip(texts, more)],
        })

    return each(text, metadata)


def scored(spark: SparkSession, model: Model | None, text: Column, metadata: Column) -> Column:
    """The score, 0 to 1, of a text (not null) with its numbers; 0.5 for all without a model."""
    if model is None:
        return F.lit(0.5)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def each(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, numbers in batches:
            yield pd.Series([
                shared.value.score(word_places(one), numbers_of(one, more)) for one, more in zip(texts, numbers)
            ], dtype=float)

    return each(text, metadata)


def quality(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    metadata: Sequence[str] = ("n_chars",), threshold: float = 0.7,
) -> DataFrame:
    """(key, held_out, score, predicted) of every row of `docs`, a null text scored as an empty one."""
    model = train(docs, labels, key, text, label, metadata)
    rows = _inputs(docs, text, metadata, key)
    rows = rows.select("key", scored(docs.sparkSession, model, F.col("text"), F.col("numbers")).alias("score"))
    return rows.select(
        "key", (~learn_rows(F.col("key"))).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
