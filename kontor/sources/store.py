"""Paths and tables: staged replacement, typed tables, layout.

Spark's overwrite deletes the target before it reads, so a job whose output is
its input must write beside it and swap.  All file work goes through Hadoop's
FileSystem, hence to whatever storage the path names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession

from kontor.operators.projection import quoted
from kontor.operators.reports import observed


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def delete(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a job has written this folder to its end."""
    return exists(spark, f"{path}/_SUCCESS")


def make_folder(spark: SparkSession, path: str) -> None:
    _fs(spark, path).mkdirs(_path(spark, path))


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder."""
    return [entry.getPath().getName() for entry in _fs(spark, path).listStatus(_path(spark, path))]


def rename(spark: SparkSession, source: str, target: str) -> None:
    if not _fs(spark, source).rename(_path(spark, source), _path(spark, target)):
        raise OSError(f"could not move {source} to {target}")


def data_files(spark: SparkSession, path: str) -> Iterator[str]:
    """Data files at a path as the storage lists them, hidden ones left out; read no further than needed."""
    if not exists(spark, path):
        return
    entries = _fs(spark, path).listStatusIterator(_path(spark, path))
    while entries.hasNext():
        entry = entries.next()
        if entry.isFile() and not entry.getPath().getName().startswith(("_", ".")):
            yield entry.getPath().toString()


def _backup(path: str) -> str:
    head, _, tail = path.rstrip("/").rpartition("/")
    return f"{head}/_previous-{tail}"


def recover(spark: SparkSession, path: str) -> None:
    """Bring back the previous version if a swap was cut off between its two moves."""
    if not exists(spark, path) and exists(spark, _backup(path)):
        rename(spark, _backup(path), path)


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let `write` fill a staging folder, then put it in place of `path`.

    The old version is moved aside first and deleted last, so a whole version
    exists at every moment; `recover` completes an interrupted swap.
    """
    path = path.rstrip("/")
    recover(spark, path)
    head, _, tail = path.rpartition("/")
    staging = f"{head}/_staging-{tail}-{uuid.uuid4().hex}"
    write(staging)
    if exists(spark, path):
        if exists(spark, _backup(path)):
            delete(spark, _backup(path))
        rename(spark, path, _backup(path))
    rename(spark, staging, path)
    if exists(spark, _backup(path)):
        delete(spark, _backup(path))


def replace_parquet(df: DataFrame, path: str) -> None:
    replace(df.sparkSession, path, lambda staging: df.write.parquet(staging))


def replace_csv(df: DataFrame, path: str) -> None:
    """Rewrite a CSV folder from data that may come from it."""
    from kontor.sources.tabular import write_csv

    replace(df.sparkSession, path, lambda staging: write_csv(df, staging))


def promote(spark: SparkSession, temporary: str, final: str) -> None:
    """Make a finished temporary folder the final one."""
    replace(spark, final, lambda staging: rename(spark, temporary, staging))


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    recover(spark, path)
    if exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()
) -> int:
    """A Parquet table laid out for the usual access paths; gives the number of rows, counted as they are written.

    With `partition_by` the rows are rebalanced, not repartitioned: a value that
    holds a third of the rows is written by many tasks, a rare one by one.
    Sorting within the files makes the Parquet minima and maxima selective.
    """
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    if sort_by:
        rows = rows.sortWithinPartitions(*(quoted(name) for name in (*partition_by, *sort_by)))
    counted, count = observed(rows)
    writer = counted.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return count.get["n"]


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str], sort_by: Sequence[str] = ()) -> None:
    """Rewrite only the partitions that `df` has rows of; files of all others are not touched.

    A first write makes the table.  `df` may come from the table itself: its new files lie in a staging
    folder until all are there.  A job that ends while they are moved can leave partitions without files,
    so `df` has to be one that can be made again.
    """
    rows = df.hint("rebalance", *partition_by)
    if sort_by:
        rows = rows.sortWithinPartitions(*(quoted(name) for name in (*partition_by, *sort_by)))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """A catalogue table with one sorted file a bucket, so that joins and groups by the key need no exchange.

    Tables meet without one if they have the same number of buckets: pick it once, by the
    largest table, so that a bucket fits a task.  `path` puts the files elsewhere than the warehouse.
    """
    writer = df.repartition(buckets, quoted(key)).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def create_if_missing(spark: SparkSession, table: str, ddl: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet")


def insert_absent(df: DataFrame, path: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Append the rows whose key the table does not have; the first of a repeated key goes in.

    A replay finds its keys present and adds nothing.
    """
    from kontor.operators.dedup import first_per_key
    from kontor.operators.joins import not_done

    present = read_or_empty(df.sparkSession, path, df.schema)
    not_done(first_per_key(df, keys, order), present, keys).write.mode("append").parquet(path)
