"""Numbering and running totals over a whole table, without one global window.

The table is range-partitioned by the order and written once to the shared
folder.  Each row knows its partition and its place in it; only one row per
partition (its size) takes part in the prefix sum that turns both into a global
number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kontor.operators.projection import quoted
from kontor.operators.sizing import written

# monotonically_increasing_id puts the partition above bit 33, the place below.
_PLACE_BITS = 33


def _sliced(df: DataFrame, order: Sequence[str]) -> DataFrame:
    columns = [quoted(name).asc_nulls_last() for name in order]
    columns.append(F.xxhash64(*(quoted(name) for name in df.columns)))
    slot = F.monotonically_increasing_id()
    ordered = df.repartitionByRange(*columns).sortWithinPartitions(*columns).withColumn("__slot", slot)
    kept = written(ordered, "ordered")
    return kept.withColumns({
        "__slice": F.shiftright("__slot", _PLACE_BITS).cast("int"),
        "__place": F.col("__slot").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)),
    }).drop("__slot")


def _with_offset(sliced: DataFrame, measure: Column, name: str) -> DataFrame:
    """Add the total of `measure` over all earlier slices.

    The window sees one row per slice, i.e. at most the number of shuffle
    partitions, which also bounds what is broadcast.
    """
    before = Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sliced.groupBy("__slice").agg(measure.alias("__size"))
    offsets = sizes.select("__slice", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias(name))
    return sliced.join(F.broadcast(offsets), "__slice")


def number_rows(df: DataFrame, order: Sequence[str], name: str = "row_no") -> DataFrame:
    """Dense numbers 1..n by `order`; ties go by the row's hash, so only equal rows could change places in a rerun."""
    numbered = _with_offset(_sliced(df, order), F.count("*"), "__before")
    return numbered.select(*(quoted(c) for c in df.columns), (F.col("__before") + F.col("__place") + 1).alias(name))


def running_total(df: DataFrame, order: Sequence[str], value: str, name: str) -> DataFrame:
    """Sum of `value` over all rows up to and including this one, by `order`."""
    sliced = _with_offset(_sliced(df, order), F.sum(quoted(value)), "__before")
    here = Window.partitionBy("__slice").orderBy("__place").rowsBetween(Window.unboundedPreceding, 0)
    return sliced.select(
        *(quoted(c) for c in df.columns),
        (F.col("__before") + F.coalesce(F.sum(quoted(value)).over(here), F.lit(0))).alias(name),
    )


def batches(df: DataFrame, order: Sequence[str], size: int, name: str = "batch_no") -> DataFrame:
    """Fixed-size batches 0, 1, 2 ... by `order`; also keeps the row number."""
    numbered = number_rows(df, order)
    return numbered.withColumn(name, F.floor((F.col("row_no") - 1) / size).cast("bigint"))


def rate_slots(df: DataFrame, order: Sequence[str], per_minute: int, name: str = "minute_no") -> DataFrame:
    """The minute in which each request may go out when `per_minute` are allowed."""
    return batches(df, order, per_minute, name)


def rate_audit(log: DataFrame, ts: str, per_minute: int) -> DataFrame:
    """Minutes of a real request log that hold more than the allowed number."""
    minute = F.window(quoted(ts), "1 minute")
    return (
        log.groupBy(minute.alias("__minute")).agg(F.count("*").alias("requests"))
        .filter(F.col("requests") > per_minute)
        .select(F.col("__minute.start").alias("minute"), "requests")
    )


def rate_audit_sliding(log: DataFrame, ts: str, per_minute: int, slice_minutes: int = 60) -> DataFrame:
    """Times at which more than the allowed number lie within the last 60 seconds, wherever a minute begins.

    Requests are counted by their exact time first.  The times are cut into slices, and those of a slice's last
    minute go to the next one as well, so each window lies within one slice and none runs over all rows.
    """
    minute, length = 60_000_000, slice_minutes * 60_000_000
    kind = log.schema[ts].dataType
    counts = log.filter(quoted(ts).isNotNull()).groupBy(F.unix_micros(quoted(ts).cast("timestamp")).alias("__at")).agg(F.count("*").alias("n"))
    own = F.floor(F.col("__at") / length)
    both = F.when(F.col("__at") >= (own + 1) * length - minute, F.array(own, own + 1)).otherwise(F.array(own))
    window = Window.partitionBy("__slice").orderBy("__at").rangeBetween(1 - minute, Window.currentRow)
    seen = counts.withColumn("__slice", F.explode(both)).withColumn("requests", F.sum("n").over(window))
    found = seen.filter((F.col("__slice") == own) & (F.col("requests") > per_minute))
    return found.select(F.timestamp_micros("__at").cast(kind).alias(ts), "requests")


def progress(df: DataFrame, order: Sequence[str], done: Column) -> DataFrame:
    """Running count of finished rows and its share of all rows, by `order`."""
    flagged = df.withColumn("__done", F.coalesce(done, F.lit(False)).cast("bigint"))
    counted = running_total(flagged, order, "__done", "done_so_far")
    total = counted.agg(F.count("*")).scalar()
    return counted.drop("__done").withColumn("done_share", F.col("done_so_far") / total)


def surrogate_ids(df: DataFrame, keys: Sequence[str], ordinal: str, name: str) -> DataFrame:
    """Dense ids 1..n for the distinct non-NULL keys, in order of first appearance.

    The distinct keys are numbered slice by slice like any table.
    """
    present = df
    for key in keys:
        present = present.filter(quoted(key).isNotNull())
    firsts = present.groupBy(*(quoted(key) for key in keys)).agg(F.min(quoted(ordinal)).alias("__first"))
    return number_rows(firsts, ["__first", *keys], name).drop("__first")
