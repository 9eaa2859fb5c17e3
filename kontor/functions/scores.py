"""Scores of one entity's candidate labels, held as `array<struct<label, score>>`.

The candidates of an entity travel inside its row, so softmax, arg-max and the
confidence cascade need no exchange at all.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kontor import fixed_values as V
from kontor.functions.text import as_col


def pair_up(labels: Column | str, scores: Column | str) -> Column:
    """An array of labels and an array of scores, position by position."""
    return F.zip_with(
        as_col(labels), as_col(scores),
        lambda label, score: F.struct(label.alias("label"), score.cast("double").alias("score")),
    )


def softmax(scored: Column | str) -> Column:
    """Scores made to add to one over the entity's candidates."""
    scored = as_col(scored)
    top = F.array_max(F.transform(scored, lambda c: c["score"]))
    powers = F.transform(scored, lambda c: F.exp(c["score"] - top))
    total = F.aggregate(powers, F.lit(0.0), lambda acc, power: acc + power)
    return F.transform(
        scored,
        lambda c: F.struct(c["label"].alias("label"), (F.exp(c["score"] - top) / total).alias("score")),
    )


def best(scored: Column | str) -> Column:
    """The highest scored candidate; of equal scores the first label by name."""
    ranked = F.array_min(
        F.transform(
            as_col(scored),
            lambda c: F.struct((-c["score"]).alias("rank"), c["label"].alias("label"), c["score"].alias("score")),
        )
    )
    return F.when(
        ranked.isNotNull(), F.struct(ranked["label"].alias("label"), ranked["score"].alias("score"))
    )


def cascade(
    category: Column | str, category_score: Column | str,
    subcategory: Column | str, subcategory_score: Column | str,
    min_score: float = V.MIN_SCORE, unknown: str = V.UNKNOWN,
) -> Column:
    """Low category score gives (unknown, unknown), low subcategory score the category.

    Only strictly lower scores are low; a missing score is low.
    """
    sure = F.coalesce(as_col(category_score) >= min_score, F.lit(False))
    sub_sure = F.coalesce(as_col(subcategory_score) >= min_score, F.lit(False))
    return F.struct(
        F.when(sure, as_col(category)).otherwise(F.lit(unknown)).alias("category"),
        F.when(~sure, F.lit(unknown)).when(sub_sure, as_col(subcategory)).otherwise(as_col(category))
        .alias("subcategory"),
    )
