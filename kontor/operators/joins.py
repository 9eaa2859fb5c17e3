"""Joins of the enrichment chain.

No join here carries a hint for a side that grows with the data.  Sort-merge
joins on hot keys are split by AQE; keys known to be hot in advance (missing
ids, repeated names) can be spread with `spread_join`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kontor.operators.dedup import latest_per_key
from kontor.operators.projection import drop_if_present, pick, quoted, require_distinct_names


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    tests = [left[f"`{key}`"].eqNullSafe(right[f"`__{key}`"]) for key in keys]
    condition = tests[0]
    for test in tests[1:]:
        condition = condition & test
    return condition


def _marked(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({key: f"__{key}" for key in keys})


def left_join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """All left rows with their right columns; a missing key matches a missing key.

    Right duplicates multiply.  Columns other than the key must differ in name.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    extra = [name for name in right.columns if name not in keys]
    require_distinct_names(left.columns + extra)
    marked = _marked(right, keys)
    joined = left.join(marked, _same(left, marked, keys), "left")
    return joined.select(*(left[f"`{name}`"] for name in left.columns), *(marked[f"`{name}`"] for name in extra))


def merge_contacts(register: DataFrame, contacts: DataFrame, key: str = "IDI") -> DataFrame:
    """Register rows with contact columns (left join on the register id)."""
    return left_join_null_safe(register, contacts, key)


def merge_classes(
    contacts: DataFrame, classified: DataFrame, key: str = "IDI",
    labels: Sequence[str] = ("Category", "Subcategory"),
) -> DataFrame:
    """Add the labels; the right side is pruned to key and labels before the join."""
    return left_join_null_safe(contacts, pick(classified, [key, *labels]), key)


def not_done(candidates: DataFrame, done: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Candidates without a finished row.

    The done side is made distinct first, so a key repeated there costs one row;
    a left anti join, unlike NOT IN, is indifferent to missing keys on the right.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    marked = _marked(pick(done, keys).distinct(), keys)
    return candidates.join(marked, _same(candidates, marked, keys), "left_anti")


def with_key_in(rows: DataFrame, keys: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows whose key occurs among `keys`, missing ones too; repeats there multiply nothing."""
    marked = _marked(pick(keys, names).distinct(), names)
    return rows.join(marked, _same(rows, marked, names), "left_semi")


def overlay(
    base: DataFrame, newer: DataFrame, keys: Sequence[str] | str, order: Sequence[str] = ()
) -> DataFrame:
    """Union by key where the newer whole record wins; in one input the last by `order` wins."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    both = base.withColumn("__rank", F.lit(0)).unionByName(newer.withColumn("__rank", F.lit(1)))
    return latest_per_key(both, keys, ["__rank", *order]).drop("__rank")


def merge_progress(
    rows: DataFrame, progress: DataFrame, key: str = "IDI",
    labels: Sequence[str] = ("Category", "Subcategory"), order: Sequence[str] = (),
) -> DataFrame:
    """Fill labels from an earlier output, matched by key; own labels stay where progress has none.

    Of repeated progress rows the last by `order` counts, and among equals the last by label.
    """
    right = pick(progress, [key, *labels, *order]).withColumnsRenamed({name: f"__done_{name}" for name in (*labels, *order)})
    last = latest_per_key(right, [key], [f"__done_{name}" for name in (*order, *labels)])
    joined = left_join_null_safe(rows, last.drop(*(f"__done_{name}" for name in order if name not in labels)), key)
    present = set(rows.columns)
    filled = {
        name: F.coalesce(quoted(f"__done_{name}"), quoted(name) if name in present else F.lit(None).cast("string"))
        for name in labels
    }
    return drop_if_present(joined.withColumns(filled), [f"__done_{name}" for name in labels])


def spread_join(
    left: DataFrame, right: DataFrame, key: str, hot: Column, pieces: int = 64, how: str = "left"
) -> DataFrame:
    """Equi-join with the hot keys spread over `pieces` tasks.

    `hot` is a condition on the key column, e.g. `F.col("IDI").isNull()` or a list
    of names; it holds for few keys.  Left rows of a hot key are dealt out by row
    position, right rows of a hot key (few, since the right side is unique or
    nearly so) are copied to each piece.  Nothing is lost or doubled; kinds of join that
    keep unmatched right rows, of which there would be copies, raise.

    The position is taken after a local sort by row hash: a task that is run again
    after a lost executor deals the same rows to the same pieces whatever order
    they are fetched in, and even identical rows are spread.
    """
    if how not in ("inner", "left", "left_outer", "leftouter", "left_anti", "left_semi"):
        raise ValueError(f"a {how} join cannot be spread")
    keys = [key, "__piece"]
    ordered = left.sortWithinPartitions(F.xxhash64(*(quoted(name) for name in left.columns)))
    dealt = ordered.withColumn(
        "__piece", F.when(hot, F.pmod(F.monotonically_increasing_id(), F.lit(pieces))).otherwise(F.lit(0)).cast("int")
    )
    copied = right.withColumn(
        "__piece", F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(pieces - 1))).otherwise(F.array(F.lit(0))))
    )
    marked = _marked(copied, keys)
    joined = dealt.join(marked, _same(dealt, marked, keys), how)
    if how in ("left_anti", "left_semi"):
        return joined.drop("__piece")
    extra = [name for name in right.columns if name != key]
    return joined.select(*(dealt[f"`{name}`"] for name in left.columns), *(marked[f"`{name}`"] for name in extra))


def by_distinct_name(df: DataFrame, name: str, look_up) -> DataFrame:
    """Run `look_up` once per distinct name and give the result to every row of that name.

    `look_up` takes a DataFrame with the single column `name` and adds columns; the
    rows keep their own ids.  Distinct is partially aggregated before its exchange,
    and AQE splits the join back where one name holds many rows.
    """
    found = look_up(df.select(quoted(name)).distinct())
    if found.columns[0] != name:
        raise ValueError("the lookup must keep the name as its first column")
    return left_join_null_safe(df, found, name)


def rejoin(main: DataFrame, rest: DataFrame, key: str = "idi") -> DataFrame:
    """Put a vertically split table together again."""
    return main.join(rest, key)


def candidates(df: DataFrame, labels: Column, name: str = "candidate") -> DataFrame:
    """One row per entity and candidate label, from the label array in the row itself (no cross join)."""
    return df.withColumn(name, F.explode(labels.cast(T.ArrayType(T.StringType()))))


def with_surrogate_ids(
    rows: DataFrame, category_ids: DataFrame, subcategory_ids: DataFrame,
    category: str = "Category", subcategory: str = "Subcategory",
) -> DataFrame:
    """Category id by name, then subcategory id by (category id, name).

    Left joins without a hint: a row without category or subcategory keeps NULL ids.
    """
    first = category_ids.select("category_id", F.col("Category").alias("__category"))
    second = subcategory_ids.select(
        "subcategory_id", F.col("category_id").alias("__parent"), F.col("Subcategory").alias("__subcategory")
    )
    step = rows.join(first, rows[f"`{category}`"] == first["__category"], "left").drop("__category")
    return step.join(
        second,
        (step["category_id"] == second["__parent"]) & (step[f"`{subcategory}`"] == second["__subcategory"]),
        "left",
    ).drop("__parent", "__subcategory")
