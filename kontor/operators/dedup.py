"""One row per key.

`row_number() = 1` over a key is planned with a group limit on both sides of the
exchange: each map task hands on at most one row per key, so a key that holds a
third of the table still shuffles one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kontor.operators.projection import quoted


def _names(keys: Sequence[str] | str) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _ranked(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    window = Window.partitionBy(*(quoted(key) for key in keys)).orderBy(*order)
    return df.withColumn("__row", F.row_number().over(window)).filter(F.col("__row") == 1).drop("__row")


def first_per_key(df: DataFrame, keys: Sequence[str] | str, order: Sequence[str] | str) -> DataFrame:
    """Keep the first row of each key by `order`; rows without a key count as one key."""
    return _ranked(df, _names(keys), [quoted(name).asc_nulls_last() for name in _names(order)])


def latest_per_key(df: DataFrame, keys: Sequence[str] | str, order: Sequence[str] | str) -> DataFrame:
    """Keep the last row of each key by `order`."""
    return _ranked(df, _names(keys), [quoted(name).desc_nulls_last() for name in _names(order)])


def first_current(
    rows: DataFrame, entity: str, order: Sequence[str] | str, struck: Column, value: Column, name: str,
    usable: Column | None = None,
) -> DataFrame:
    """The first value per entity whose row is neither struck out nor unusable.

    Rows are dropped before the exchange and limited to one per entity and task.
    """
    keep = ~F.coalesce(struck, F.lit(False))
    if usable is not None:
        keep = keep & F.coalesce(usable, F.lit(False))
    return first_per_key(rows.filter(keep), entity, order).select(quoted(entity), value.alias(name))


def key_counts(df: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Rows per key, missing keys as one key; the base of report and probe."""
    return df.groupBy(*(quoted(key) for key in _names(keys))).agg(F.count("*").alias("n"))


def dedup_report(df: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """One row: total, unique and duplicate rows by key."""
    return key_counts(df, keys).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.count("*").alias("unique_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"),
    )


def repeated_keys(df: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Every key held by more than one row, with its count."""
    return key_counts(df, keys).filter(F.col("n") > 1)


def has_duplicates(df: DataFrame, keys: Sequence[str] | str) -> bool:
    return not repeated_keys(df, keys).limit(1).isEmpty()
