"""CSV scans and sinks: all columns text, one null convention, defined row order."""

from __future__ import annotations

import csv
import io
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kontor import fixed_values as V
from kontor.functions.text import blank_to_null, missing_to_null
from kontor.operators.filters import split_by
from kontor.operators.projection import ensure_columns, pick, quoted, require_distinct_names
from kontor.operators.reports import key_set, observed
from kontor.sources.store import data_files, exists

# Without column pruning a row's cells are counted whatever columns are asked for.
READ = {"header": "true", "escape": '"', "mode": "PERMISSIVE", "columnPruning": "false"}
MALFORMED = "__malformed"
WRITE = {
    "header": "true", "escape": '"', "emptyValue": "", "nullValue": "",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}
ORDINAL = "ordinal"


def header(spark: SparkSession, path: str) -> list[str] | None:
    """Column names as written in a data file, cases, quoted line breaks and all; None without any."""
    for file in data_files(spark, path):
        names = spark.read.options(escape='"', multiLine="true", inferSchema="false").csv(file).first()
        if names is not None:
            return ["" if name is None else name.removeprefix("\ufeff") for name in names]
    return None


def cells(line: Column) -> Column:
    """Number of cells of a line as written; commas in quoted cells separate nothing."""
    bare = F.regexp_replace(line, r'(?s)(^|,)"(?:[^"]|"")*+"(?=,|\z)', "$1")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def scan_csv(
    spark: SparkSession, path: str, rename: Mapping[str, str] | None = None,
    tokens: Sequence[str] = V.MISSING_TOKENS, strip_blanks: bool = False, ordinal: bool = False, multi_line: bool = True,
    keep_malformed: bool = False,
) -> DataFrame:
    """A CSV file or folder with a header line, every column as text.

    * columns are named by position after `rename` (exact case), because Spark
      cannot tell `idi` from `IDI` later; names that still clash raise
    * without `rename` a file whose header differs from the first one's raises
    * missing-value tokens, or with `strip_blanks` any blank text, become NULL
    * header lines repeated by earlier appends are dropped
    * a row with fewer cells than the header has NULLs for the rest; one with more raises, as its last cells
      would be lost.  With `keep_malformed` both stay, their line as written in the column
      `__malformed`, for `split_malformed`; that column is NULL for all other rows
    * `ordinal` adds a sortable row order: time the file was written, file, place of the split, row

    With `multi_line` a quoted cell may hold line breaks, so a file is read by one task:
    write many moderate files, or turn it off where no cell holds any.
    """
    written = header(spark, path)
    if written is None:
        raise ValueError(f"no CSV header below {path}")
    names = [(rename or {}).get(name, name) for name in written]
    require_distinct_names(names)
    require_distinct_names([*names, MALFORMED])
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*names, MALFORMED]])
    checked = "true" if names != written else "false"  # enforceSchema: headers are not compared
    options = READ | {"multiLine": str(multi_line).lower(), "enforceSchema": checked, "columnNameOfCorruptRecord": MALFORMED}
    rows = spark.read.schema(schema).options(**options).csv(path)
    if not keep_malformed:
        lost = F.when(cells(F.col(MALFORMED)) > len(names), F.raise_error(
            F.concat(F.lit(f"a row with more cells than the header below {path}: "), MALFORMED)).cast("boolean"))
        rows = rows.filter(F.coalesce(lost, F.lit(True))).drop(MALFORMED)
    if ordinal:
        place = F.struct(
            F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        )
        rows = rows.withColumn(ORDINAL, place)
    repeated = F.lit(True)
    for name, original in zip(names, written):
        repeated = repeated & quoted(name).eqNullSafe(F.lit(original))
    rows = rows.filter(~repeated)
    fold = blank_to_null if strip_blanks else (lambda c: missing_to_null(c, tokens))
    return rows.withColumns({name: fold(quoted(name)) for name in names})


def scan_or_empty(spark: SparkSession, path: str, columns: Sequence[str], **options) -> DataFrame:
    """An earlier output, or an empty table with its columns if there is none yet."""
    if exists(spark, path) and header(spark, path) is not None:
        return scan_csv(spark, path, **options)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    return spark.createDataFrame([], schema)


def as_text(df: DataFrame) -> DataFrame:
    """String columns for a text sink; arrays become comma text."""
    def text(field: T.StructField):
        if isinstance(field.dataType, T.ArrayType):
            return F.array_join(quoted(field.name), ",").alias(field.name)
        return quoted(field.name).cast("string").alias(field.name)

    return df.select(*(text(field) for field in df.schema.fields))


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite a CSV folder; never the one `df` reads, see `store.replace_csv` for that."""
    as_text(df).write.mode("overwrite").options(**WRITE).csv(path)


def append_csv(df: DataFrame, path: str) -> int:
    """Add rows; every file carries its own header, so none is repeated inside one.  Gives their number, counted on the way.

    Columns go in the order of the present header; other names than its raise.
    """
    spark = df.sparkSession
    present = header(spark, path) if exists(spark, path) else None
    if present is not None and sorted(present) != sorted(df.columns):
        raise ValueError(f"columns {df.columns} do not fit the header {present} below {path}")
    rows, count = observed(as_text(df if present is None else pick(df, present)))
    rows.write.mode("append").options(**WRITE).csv(path)
    return count.get["n"]


def append_reconciled(df: DataFrame, path: str) -> None:
    """Add rows to a CSV folder whose header wins: extra columns are dropped, missing ones blank.

    The first write orders the columns by name.
    """
    spark = df.sparkSession
    present = header(spark, path) if exists(spark, path) else None
    names = present or sorted(df.columns)
    append_csv(pick(ensure_columns(df, {name: None for name in names}), names), path)


def split_malformed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of a scan with `keep_malformed`: those with all their cells, and the lines of the others as (line)."""
    good, bad = split_by(df, F.col(MALFORMED).isNull())
    return good.drop(MALFORMED), bad.select(F.col(MALFORMED).alias("line"))


def write_with_rejects(df: DataFrame, valid: Column, path: str, error_path: str) -> None:
    """Valid rows to one CSV folder, the others to an error folder; one bad row stops nothing."""
    good, bad = split_by(df, valid)
    write_csv(good, path)
    write_csv(bad, error_path)


def records_to_columns(df: DataFrame, record: str, names: Sequence[str] | None = None) -> DataFrame:
    """A map column to one column per key, missing keys NULL.

    The names become the table's schema.  Where the caller does not state them, all keys
    are looked up and come to the driver in order.
    """
    if names is None:
        names = sorted(row[0] for row in key_set(df, record).collect())
    kept = [quoted(name) for name in df.columns if name != record]
    return df.select(*kept, *(F.try_element_at(quoted(record), F.lit(name)).alias(name) for name in names))
