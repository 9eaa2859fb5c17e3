"""File streams into append-only tables, keyed tables and first-of-key tables; cached look-ups and joined streams.

Every query carries a checkpoint, so a restart continues after the last finished
micro-batch, and writes in a way that a repeated micro-batch does not show.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState
from pyspark.sql.types import StructType

from kontor.sources.versions import VersionedTable


def file_stream(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", files_per_batch: int = 1000
) -> DataFrame:
    """New files at a path (or glob) as a stream, a bounded number per micro-batch."""
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch).load(path)


def _run(writer) -> StreamingQuery:
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


@contextmanager
def _empty_batches(spark: SparkSession, allowed: bool) -> Iterator[None]:
    """Whether a query started here runs micro-batches without rows, which move watermarks and time-outs on."""
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, str(allowed).lower())
    try:
        yield
    finally:
        spark.conf.set(name, before)


def append(
    stream: DataFrame, target: str, checkpoint: str, fmt: str = "parquet", empty_batches: bool = True
) -> StreamingQuery:
    """Add everything that has arrived to a file table and stop.

    State that times out by the clock would go on with empty micro-batches for ever: leave them out there.
    """
    with _empty_batches(stream.sparkSession, empty_batches):
        return _run(
            stream.writeStream.format(fmt).outputMode("append")
            .option("checkpointLocation", checkpoint).option("path", target)
        )


def for_each_batch(stream: DataFrame, save: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Save micro-batch by micro-batch; `save` must be repeatable for a batch number."""
    return _run(stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint))


def upsert(
    stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], order: Sequence[str]
) -> VersionedTable:
    """Insert or replace by key.  Each micro-batch writes only its own rows.

    A batch is known by the id the checkpoint gave its query and by its number, so a new
    checkpoint, which counts from 0 again, replaces nothing.
    """
    table = VersionedTable(stream.sparkSession, target, keys, order, stream.schema)

    def save(rows: DataFrame, batch: int) -> None:
        table.upsert(rows, batch, _query_id(stream.sparkSession, checkpoint))

    for_each_batch(stream, save, checkpoint)
    return table


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id in the checkpoint's metadata, written before the first batch."""
    line = spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()[0]
    return json.loads(line)["id"]


def first_of_key(
    stream: DataFrame, keys: Sequence[str], event_time: str | None = None, delay: str = "1 hour"
) -> DataFrame:
    """The first row of each key over the whole stream.

    The state holds every key seen.  With `event_time` it is dropped once the
    watermark has passed, for streams whose repeats lie close together.
    """
    if event_time is None:
        return stream.dropDuplicates(list(keys))
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def cached_records(stream: DataFrame, key: str, record: Sequence[str], order: str, ttl_ms: int) -> DataFrame:
    """Look-ups with the record an earlier micro-batch found for the same key.

    A row whose record columns (texts) are all NULL is a look-up without a result.  A key's record is the
    first one found, by `order`, in the first micro-batch that finds any; rows of that batch keep their own,
    as they were looked up at once, and all later rows of the key get the cached one.  It is forgotten
    `ttl_ms` milliseconds after it was found.  Rows of one key are passed through, never gathered.  Write it
    without empty micro-batches.
    """
    names = list(record)
    state_schema = T.StructType([T.StructField("until", T.LongType()), *(T.StructField(name, T.StringType()) for name in names)])

    def look_up(_, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        now = state.getCurrentProcessingTimeMs()
        until, *known = state.get if state.exists else (now,)
        first = None
        for batch in batches:
            if until > now:
                for name, value in zip(names, known):
                    batch[name] = pd.Series([value] * len(batch), index=batch.index, dtype=object)
            else:
                found = batch[batch[names].notna().any(axis=1)]
                if len(found):
                    best = found.loc[found[order].idxmin()]
                    if first is None or best[order] < first[order]:
                        first = best
            yield batch
        if first is not None:
            until = now + ttl_ms
            state.update((until, *(None if pd.isna(first[name]) else first[name] for name in names)))
        if until > now:
            state.setTimeoutDuration(until - now)
        elif state.exists:
            state.remove()

    return stream.groupBy(key).applyInPandasWithState(look_up, stream.schema, state_schema, "append", "ProcessingTimeTimeout")


def left_join(
    left: DataFrame, right: DataFrame, key: str, time: str, right_time: str, within: str, delay: str = "1 hour"
) -> DataFrame:
    """Left rows with the right rows of the same key that come up to `within` after them, by event time.

    Both sides may arrive in any order and up to `delay` late.  A left row without a match comes out once
    the watermark has passed the end of its time, so the state holds no older rows.  `right` shares
    no other column name than `key` with `left`.
    """
    early = left.withWatermark(time, delay)
    late = right.withColumnRenamed(key, "__key").withWatermark(right_time, delay)
    near = F.col(right_time).between(F.col(time), F.col(time) + F.expr(f"INTERVAL {within}"))
    return early.join(late, (early[key] == late["__key"]) & near, "leftOuter").drop("__key")
