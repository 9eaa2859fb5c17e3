"""Score tables in long form (one row per entity and label), and the scorer hook."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kontor import fixed_values as V
from kontor.operators.projection import quoted


def best_label(scores: DataFrame, entity: str, label: str = "label", score: str = "score") -> DataFrame:
    """The top label of each entity, ties by label; a struct minimum, combined on the map side."""
    top = F.min(F.struct((-quoted(score)).alias("rank"), quoted(label).alias("label")))
    return scores.groupBy(quoted(entity)).agg(top.alias("__top")).select(
        quoted(entity), F.col("__top.label").alias("label"), (-F.col("__top.rank")).alias("score")
    )


def softmax_scores(scores: DataFrame, entity: str, label: str = "label", score: str = "score") -> DataFrame:
    """Scores of each entity made to add to one: one exchange, as an entity has no more rows than there are labels."""
    own = Window.partitionBy(quoted(entity))
    shifted = scores.withColumn("__power", F.exp(quoted(score) - F.max(quoted(score)).over(own)))
    return shifted.select(
        quoted(entity), quoted(label).alias("label"), (F.col("__power") / F.sum("__power").over(own)).alias("score")
    )


def scorer(load: Callable[[], Callable[[list[str], list[list[str]]], list[list[float]]]], rows_at_once: int = V.MODEL_BATCH):
    """Wrap a model as a function of (text, candidate labels) giving one score per label.

    `load` runs once per Python worker and returns a callable over a few texts and their
    label lists, `rows_at_once` in a call.  Rows without text or candidates are not scored.
    """

    @F.arrow_udf("array<double>")
    def score(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        model = load()
        for texts, labels in batches:
            rows = list(zip(texts.to_pylist(), labels.to_pylist()))
            wanted = [i for i, (text, names) in enumerate(rows) if text is not None and names]
            result: list[list[float] | None] = [None] * len(rows)
            for at in range(0, len(wanted), rows_at_once):
                some = wanted[at:at + rows_at_once]
                given = model([rows[i][0] for i in some], [rows[i][1] for i in some])
                for i, values in zip(some, given):
                    result[i] = list(values)
            yield pa.array(result, type=pa.list_(pa.float64()))

    # Never run the model again for a filter the optimiser would push below it.
    return score.asNondeterministic()
