"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from kontor.llm.frames import ROW, field, packed, unpacked

UNKNOWN = "und"
ORDERS = 3
BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
SMOOTHING = 0.5
# Learned from about this many documents of a language, picked by a hash of their rows.
DOCUMENTS_PER_LANGUAGE = 2_000
# A text is counted in blocks, so that a very long one needs no more memory.
BLOCK = 1 << 18

_FACTORS = [np.uint64(one) for one in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def _letters() -> np.ndarray:
    """The character itself for letters of the basic plane, 32 (a gap) for all others."""
    return np.array([ord(c) if (c := chr(i)).isalpha() else 32 for i in range(1 << 16)], np.uint64)


_TABLE: list[np.ndarray] = []


def gram_counts(text: str) -> np.ndarray:
    """How often each bucket occurs among the 1- to 3-grams of the lower-case text; non-letters are gaps."""
    if not _TABLE:
        _TABLE.append(_letters())
    counts = np.zeros(BUCKETS, np.int64)
    text = text.lower()
    for at in range(0, len(text), BLOCK):
        part = text[max(0, at - ORDERS + 1):at + BLOCK]
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        letters = np.where(points < 1 << 16, _TABLE[0][points & 0xFFFF], points.astype(np.uint64))
        mixed = np.zeros(len(letters), np.uint64)
        for order in range(ORDERS):
            mixed = mixed[: len(letters) - order] + letters[order:] * _FACTORS[order]
            spread = (mixed ^ (mixed >> np.uint64(29))) * _FACTORS[3] + np.uint64(order)
            spread = spread[max(0, min(at, ORDERS - 1) - order):]  # grams that end before this block are counted
            counts += np.bincount((spread >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), minlength=BUCKETS)
    counts[_gap_buckets()] = 0
    return counts


def _gap_buckets() -> list[int]:
    """The bucket of the single gap, which says nothing about a language."""
    value = (32 * int(_FACTORS[0])) % 2**64
    return [((value ^ value >> 29) * int(_FACTORS[3])) % 2**64 >> 64 - BUCKET_BITS]


@dataclass(frozen=True)
class Model:
    """Languages, their log priors, and the log probability of each bucket in each language."""

    languages: list[str]
    priors: np.ndarray
    matrix: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        counts = gram_counts(text)
        seen = np.flatnonzero(counts)
        # Every character is part of a gram of each order: a third of the evidence is its own.
        logits = self.priors + counts[seen].astype(np.float64) @ self.matrix[seen] / ORDERS
        odds = np.exp(logits - logits.max())
        best = int(odds.argmax())
        return self.languages[best], float(odds[best] / odds.sum())


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", per_language: int = DOCUMENTS_PER_LANGUAGE) -> Model:
    """A model from rows with a text and a language; rows without either are left out.

    About `per_language` documents of each language are read, picked by a hash of the row, in
    any order with the same result.  The matrix is languages x 32,768 numbers: its size depends on the closed set
    of language codes alone.  Without labelled rows the model knows no language.
    """
    plain = [F.col(f"`{field.name}`") for field in labelled.schema if isinstance(field.dataType, AtomicType)]
    share = (F.pmod(F.xxhash64(*plain), F.lit(1 << 20)) / (1 << 20)).alias("place")
    rows = labelled.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"), share).dropna()
    sizes = {row.lang: row.n for row in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros(0), np.zeros((BUCKETS, 0)))
    languages = sorted(sizes)
    bounds = F.create_map(*[F.lit(x) for one in languages for x in (one, min(1.0, per_language / sizes[one]))])
    picked = rows.filter(F.col("place") < F.element_at(bounds, F.col("lang"))).drop("place")
    sums = picked.mapInPandas(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros((BUCKETS, len(languages)))
    place = {one: i for i, one in enumerate(languages)}
    table = sums.toPandas()
    counts[table["bucket"], table["lang"].map(place)] = table["n"]
    matrix = np.log((counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * BUCKETS))
    priors = np.log(np.array([sizes[one] for one in languages]) / sum(sizes.values()))
    return Model(languages, priors, matrix)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[str, np.ndarray] = {}
    for rows in batches:
        for text, lang in zip(rows["text"], rows["lang"]):
            sums[lang] = sums.get(lang, 0) + gram_counts(text)
    for lang, counts in sums.items():
        seen = np.flatnonzero(counts)
        yield pd.DataFrame({"lang": lang, "bucket": seen.astype(np.int32), "n": counts[seen]})


def predicted(spark: SparkSession, model: Model, text: Column) -> Column:
    """struct<lang, score> of a text: `und` with score 0 if it is null or has no letter."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def each(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([shared.value.predict(one) for one in texts], columns=["lang", "score"])

    return each(text)


def accepted(df: DataFrame, model: Model, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows whose language is known with a score of at least `least`; columns unchanged.

    A null text, an empty one, and one without letters are rejected.
    """
    rows = packed(df).withColumn("found", predicted(df.sparkSession, model, field(text)))
    kept = rows.filter((F.col("found.lang") != UNKNOWN) & (F.col("found.score") >= least))
    return unpacked(kept.select(ROW))
