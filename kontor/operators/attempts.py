"""Outcome of repeated model calls, from a table of attempts.

An attempts table has `entity`, `attempt` (1, 2, 3 ...), `stage` (two-prompt only),
`text` (the reply) and `error`.  Only the first `tries` attempts count, so an
entity needs a fixed handful of columns, filled by one aggregate with map-side
combine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kontor import fixed_values as V
from kontor.functions.prompts import flat_cost, tokens
from kontor.functions.replies import checked_pair
from kontor.functions.text import strip
from kontor.operators.projection import quoted


def first_decisive(
    attempts: DataFrame, entity: str, tries: int = V.MAX_ATTEMPTS, retry_on: str = V.RATE_LIMIT_ERROR
) -> DataFrame:
    """Single prompt: the first attempt that did not fail with a rate-limit error.

    An entity whose tries all hit the limit has no decisive attempt: its row is
    there with NULL text and error, and stays pending.
    """
    retried = F.coalesce(F.contains(F.col("error"), F.lit(retry_on)), F.lit(False))
    counts = (F.col("attempt") <= tries) & ~retried
    chosen = F.min(F.when(counts, F.struct("attempt", "text", "error")))
    return attempts.groupBy(quoted(entity)).agg(chosen.alias("__one")).select(
        quoted(entity), F.col("__one.attempt").alias("attempt"),
        F.col("__one.text").alias("text"), F.col("__one.error").alias("error"),
    )


def _slot(stage: int, attempt: int) -> str:
    return f"__s{stage}a{attempt}"


def _slots(attempts: DataFrame, entity: str, tries: int) -> DataFrame:
    def filled(stage: int, attempt: int) -> Column:
        here = (F.col("stage") == stage) & (F.col("attempt") == attempt)
        return F.max(F.when(here, F.struct("text", "error"))).alias(_slot(stage, attempt))

    wanted = [filled(stage, attempt) for attempt in range(1, tries + 1) for stage in (1, 2)]
    return attempts.filter(F.col("attempt") <= tries).groupBy(quoted(entity)).agg(*wanted)


def two_stage_outcome(
    attempts: DataFrame, entity: str, taxonomy, tries: int = V.MAX_ATTEMPTS, unknown: str = V.UNKNOWN
) -> DataFrame:
    """Two prompts: stage 1 gives the category, stage 2 the subcategory, each attempt asking both.

    An invalid stage-1 reply ends in (unknown, unknown), an invalid stage-2 reply in
    (category, category).  An error in either stage starts the next attempt; after the
    last one it ends like an invalid reply.  `taxonomy` is a `Taxonomy`.  Fewer attempts than `tries` without an
    ending leave NULL labels: still pending.
    """
    result = _slots(attempts, entity, tries)
    for attempt in range(1, tries + 1):
        first = F.col(_slot(1, attempt))
        reply = F.when(first["error"].isNull(), strip(first["text"]))
        result = taxonomy.add_labels(result.withColumn(f"__c{attempt}", reply), f"__c{attempt}", f"__l{attempt}")

    outcome = F.lit(None).cast("struct<category:string,subcategory:string>")
    for attempt in range(tries, 0, -1):
        last = F.lit(attempt == tries)
        first, second = F.col(_slot(1, attempt)), F.col(_slot(2, attempt))
        category, labels = F.col(f"__c{attempt}"), F.col(f"__l{attempt}")
        nothing_to_ask = F.size(labels) == 0
        failed = first.isNull() | first["error"].isNotNull()
        second_failed = ~nothing_to_ask & (second.isNull() | second["error"].isNotNull())
        both_unknown = F.struct(F.lit(unknown).alias("category"), F.lit(unknown).alias("subcategory"))
        same = F.struct(category.alias("category"), category.alias("subcategory"))
        outcome = (
            F.when(failed, F.when(last & first.isNotNull(), both_unknown).otherwise(outcome))
            .when(labels.isNull(), both_unknown)
            .when(second_failed, F.when(last & second.isNotNull(), same).otherwise(outcome))
            .when(nothing_to_ask, same)
            .otherwise(checked_pair(category, strip(second["text"]), labels, unknown))
        )
    return result.withColumn("__o", outcome).select(
        quoted(entity), F.col("__o.category").alias("category"), F.col("__o.subcategory").alias("subcategory")
    )


def tally(requests: DataFrame, price: float = V.FLAT_PRICE_PER_1M, per_reply: int = V.TALLY_REPLY_TOKENS) -> DataFrame:
    """Tokens and cost of a request log: `prompt` per call, `valid` telling whether the reply counted."""
    used = tokens("prompt") + F.when(F.col("valid"), F.lit(per_reply)).otherwise(F.lit(0))
    return requests.agg(
        F.count("*").alias("requests"), F.coalesce(F.sum(used), F.lit(0)).alias("total_tokens")
    ).withColumn("cost", flat_cost("total_tokens", price))
