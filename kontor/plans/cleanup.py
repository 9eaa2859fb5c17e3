"""CSV clean-up jobs that rewrite their input or write beside it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from kontor.operators.dedup import dedup_report, first_per_key
from kontor.operators.projection import drop_if_present
from kontor.sources.store import replace_csv
from kontor.sources.tabular import ORDINAL, scan_csv


def remove_duplicates(
    spark: SparkSession, source: str, target: str | None = None, key: str = "IDI"
) -> DataFrame:
    """Keep the first row per key, in the order rows were written; returns the one-row report (total, unique, duplicates).

    Without duplicates nothing is sorted, and an input that is its own target is left alone.
    """
    rows = scan_csv(spark, source, ordinal=True)
    counts = dedup_report(rows, key).first()
    if counts["duplicate_rows"]:
        replace_csv(first_per_key(rows, key, ORDINAL).drop(ORDINAL), target or source)
    elif target not in (None, source):
        replace_csv(rows.drop(ORDINAL), target)
    return spark.createDataFrame([counts], "total_rows long, unique_rows long, duplicate_rows long")


def drop_columns(
    spark: SparkSession, source: str, target: str | None = None,
    columns: Sequence[str] = ("idi", "company_name"),
) -> list[str]:
    """Rewrite without the columns, matched by exact case; returns the remaining names.

    A scan cannot hold `idi` beside `IDI`, so unwanted columns get a name of their
    own first and are dropped under it.
    """
    aside = {name: f"__drop_{name}" for name in columns}
    rows = drop_if_present(scan_csv(spark, source, rename=aside), list(aside.values()))
    replace_csv(rows, target or source)
    return rows.columns
