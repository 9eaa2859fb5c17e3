"""Lineage cuts in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from kontor.session import scratch_path


def written(df: DataFrame, label: str = "step") -> DataFrame:
    """Write `df` below the shared folder and read it back: one pass, columnar, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
