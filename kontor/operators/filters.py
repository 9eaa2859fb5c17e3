"""Row predicates and splits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kontor import fixed_values as V
from kontor.functions.text import has_text
from kontor.operators.projection import quoted


def any_of(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (quoted(name).isNotNull() for name in columns))


def with_any(df: DataFrame, columns: Sequence[str] = V.CONTACT_COLUMNS) -> DataFrame:
    """Rows with at least one of the columns."""
    return df.filter(any_of(columns))


def with_all(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where every column holds text, blank counting as missing."""
    return df.filter(reduce(lambda a, b: a & b, (has_text(quoted(name)) for name in columns)))


def pending(label: str = "Category", needed: str | None = "Purpose") -> Column:
    """Not labelled yet and, if `needed` is given, ready to be."""
    unlabelled = quoted(label).isNull()
    return unlabelled & quoted(needed).isNotNull() if needed else unlabelled


def sentinel_pending(
    category: str = "Category", subcategory: str = "Subcategory", unknown: str = V.UNKNOWN
) -> Column:
    """Pending by sentinel: both labels unknown or missing.  Never NULL, so `~` is the exact complement."""
    def missing(name: str) -> Column:
        return F.coalesce(quoted(name), F.lit(unknown)) == unknown

    return missing(category) & missing(subcategory)


def split_by(df: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """Valid rows and rejected rows; an unknown verdict is a rejection."""
    verdict = F.coalesce(valid, F.lit(False))
    return df.filter(verdict), df.filter(~verdict)


def drop_failed(df: DataFrame, record: str) -> DataFrame:
    """Rows whose record struct is there and has at least one field."""
    fields = [quoted(record)[name].isNotNull() for name in df.schema[record].dataType.names]
    return df.filter(quoted(record).isNotNull() & reduce(lambda a, b: a | b, fields))
