"""Mixing sources to target weights by nested hash thresholds.

Every row gets a number that depends on its key alone.  A source whose target is
`q` whole passes and a rest takes each row `q` times and the rows below a threshold
once more.  Sizes are summed by source and hash bucket; only the bucket in which a
budget ends is looked at again, with ten more bits, until one hash value is left.
No row is sorted, and a larger budget keeps all rows of a smaller one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kontor.llm.frames import field, packed, unpacked, word_count
from kontor.operators.sizing import written

UNIT_BITS = 60
STEP_BITS = 10
WEIGHTS = (5, 2, 1)


def unit(keys: Sequence[Column]) -> Column:
    """60 bits of the MD5 of the keys (null counts as empty), the same in every run."""
    text = F.concat_ws(":", *[F.coalesce(key.cast("string"), F.lit("")) for key in keys])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, UNIT_BITS // 4), 16, 10).cast("long")


def targets(totals: DataFrame, weights: Sequence[float], share: float, repeats: int) -> DataFrame:
    """(source, total, target) from (source, total).

    Sources by code point, null last, take `weights` in turn and share `share` of all
    sizes; a target stops at `repeats` times the source's size and the excess goes to
    the others by weight.  Ordered by how early a source is full, the common level is
    the largest of (budget left) / (weight left).  One row per source is in play.
    """
    everything = Window.partitionBy()
    place = (F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(one)) for one in weights]), place + 1)
    rows = totals.withColumn("weight", weight).withColumn("cap", repeats * F.col("total"))
    fill = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    budget = share * F.sum("total").over(everything)
    full = F.coalesce(F.sum("cap").over(before), F.lit(0))
    rows = rows.withColumn("level", (budget - full) / F.sum("weight").over(after))
    target = F.least(F.col("cap").cast("double"), F.max("level").over(everything) * F.col("weight"))
    return rows.select("source", "total", target.alias("target"))


def thresholds(units: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, repeats: int = 2) -> DataFrame:
    """Per source what to take, from units (source, size, unit).

    Returns (source, total, target, passes, whole, edge, edge_rows, edge_taken): each row
    `passes` times; once more if `whole`, or its unit is below `edge`, or it is one of the
    first `edge_taken` of the `edge_rows` rows at `edge`.  The edge is rounded to the nearer side.
    """
    totals = units.groupBy("source").agg(F.sum("size").cast("long").alias("total"))
    goal = targets(totals, weights, share, repeats)
    passes = F.when(F.col("total") > 0, F.floor(F.col("target") / F.col("total"))).otherwise(0).cast("int")
    state = goal.withColumn("passes", passes).withColumn("left", F.col("target") - F.col("passes") * F.col("total"))
    state = written(state.withColumn("edge", F.lit(0).cast("long")), "mix-state")
    for shift in range(UNIT_BITS - STEP_BITS, -1, -STEP_BITS):
        state = written(_refined(units, state, shift), "mix-state")
    each = F.col("edge_size") / F.col("edge_rows")
    taken = F.least(F.floor(F.col("left") / each + 0.5), F.col("edge_rows"))
    return state.select(
        "source", "total", "target", "passes", F.col("edge").isNull().alias("whole"), "edge", "edge_rows",
        F.coalesce(taken, F.lit(0)).cast("long").alias("edge_taken"),
    )


def _refined(units: DataFrame, state: DataFrame, shift: int) -> DataFrame:
    """The state with the edge known `STEP_BITS` more bits; null where the budget takes all."""
    inside = units.alias("u").join(
        state.select("source", "edge").alias("s"),
        F.col("u.source").eqNullSafe(F.col("s.source"))
        & (F.shiftright("u.unit", shift + STEP_BITS) == F.col("s.edge")),
    )
    sums = inside.groupBy(F.col("u.source").alias("source"), F.shiftright("u.unit", shift).alias("bucket")).agg(
        F.sum("size").cast("long").alias("edge_size"), F.count("*").alias("edge_rows")
    )
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("before", F.sum("edge_size").over(ahead) - F.col("edge_size")).alias("h")
    kept = [name for name in state.columns if name not in ("edge", "left", "edge_rows", "edge_size")]
    crossing = (
        F.col("t.source").eqNullSafe(F.col("h.source")) & (F.col("h.before") <= F.col("t.left"))
        & (F.col("h.before") + F.col("h.edge_size") > F.col("t.left"))
    )
    return state.alias("t").join(sums, crossing, "left").select(
        *[f"t.{name}" for name in kept], (F.col("t.left") - F.coalesce("h.before", F.lit(0))).alias("left"),
        F.col("h.bucket").alias("edge"), "h.edge_rows", "h.edge_size",
    )


def with_times(rows: DataFrame, limits: DataFrame, source: Column, number: Column) -> DataFrame:
    """Add `times` and the limits' columns to rows.

    Rows that share the edge value (equal in key and text) are counted in the order of a
    hash of all their columns, and only these are gathered.
    """
    joined = rows.withColumn("__unit", number).join(
        limits.withColumnRenamed("source", "__source"), source.eqNullSafe(F.col("__source"))
    )
    at_edge = F.coalesce(F.col("__unit") == F.col("edge"), F.lit(False)) & (F.col("edge_rows") > 1)
    below = F.col("whole") | F.coalesce(F.col("__unit") < F.col("edge"), F.lit(False))
    single = F.coalesce(F.col("__unit") == F.col("edge"), F.lit(False)) & (F.col("edge_taken") > 0)
    plain = joined.filter(~at_edge) if _has_ties(limits) else joined
    result = plain.withColumn("times", F.col("passes") + (below | single).cast("int"))
    if _has_ties(limits):
        content = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{name}`") for name in rows.columns])))
        place = F.row_number().over(Window.partitionBy("__source", "__unit").orderBy(content))
        tied = joined.filter(at_edge).withColumn("__place", place)
        more = (F.col("__place") <= F.col("edge_taken")).cast("int")
        result = result.unionByName(tied.withColumn("times", F.col("passes") + more).drop("__place"))
    return result


def _has_ties(limits: DataFrame) -> bool:
    return not limits.filter((F.col("edge_rows") > 1) & (F.col("edge_taken") > 0)).isEmpty()


def sized(df: DataFrame, source: str = "source", text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, source, size, unit): what mixing has to know, a small part of the table, written once."""
    return written(df.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{source}`").alias("source"), word_count(F.col(f"`{text}`")).alias("size"),
        unit([F.col(f"`{key}`"), F.col(f"`{text}`")]).alias("unit"),
    ), "mix-units")


def mixed_sizes(
    df: DataFrame, source: str = "source", text: str = "text", key: str = "doc_id",
    weights: Sequence[float] = WEIGHTS, share: float = 1.5, repeats: int = 2,
) -> DataFrame:
    """One row per document: key, size, source_size, target of its source, taken, times.

    A null text has size 0, a null source is a source of its own, repeated rows are
    counted and taken one by one, an empty table gives no rows.
    """
    units = sized(df, source, text, key)
    limits = thresholds(units, weights, share, repeats)
    rows = with_times(units, limits, F.col("source"), F.col("unit"))
    return rows.select(
        "key", "size", F.col("total").alias("source_size"), "target",
        (F.col("times") * F.col("size")).cast("long").alias("taken"), "times",
    )


def mix(
    df: DataFrame, source: str = "source", text: str = "text", key: str = "doc_id",
    weights: Sequence[float] = WEIGHTS, share: float = 1.5, repeats: int = 2,
) -> DataFrame:
    """The mixed corpus: the rows of `df`, each as often as the mix takes it, columns unchanged.

    Texts stay whole.  Nulls, ties and empty tables as in `mixed_sizes`.
    """
    limits = written(thresholds(sized(df, source, text, key), weights, share, repeats), "mix-limits")
    rows = with_times(packed(df), limits, field(source), unit([field(key), field(text)]))
    repeated = rows.filter(F.col("times") > 0).select("__row", F.explode(F.sequence(F.lit(1), "times")))
    return unpacked(repeated)
