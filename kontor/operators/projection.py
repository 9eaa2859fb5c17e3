"""Column-list operators."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def pick(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns in order; a missing one is an error."""
    return df.select(*(quoted(name) for name in columns))


def drop_if_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop by exact name, ignoring what is missing; `drop` alone would also hit other cases."""
    unwanted = set(columns)
    return pick(df, [name for name in df.columns if name not in unwanted])


def all_but(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Everything outside `columns`, plus the key."""
    listed = set(columns)
    return pick(df, [name for name in df.columns if name not in listed] + [key])


def require_distinct_names(names: Sequence[str]) -> None:
    clashes = sorted(name for name, n in Counter(name.lower() for name in names).items() if n > 1)
    if clashes:
        raise ValueError(f"column names clash without case: {', '.join(clashes)}")


def normalise_names(df: DataFrame) -> DataFrame:
    """Lower-case names with `_` for blanks; clashing names raise."""
    names = [name.lower().replace(" ", "_") for name in df.columns]
    require_distinct_names(names)
    return df.toDF(*names)


def reshape(df: DataFrame, fields: Mapping[str, Column | str]) -> DataFrame:
    """A new record layout: output name to source column or expression."""
    return df.select(
        *((quoted(source) if isinstance(source, str) else source).alias(name) for name, source in fields.items())
    )


def ensure_columns(df: DataFrame, defaults: Mapping[str, str | None]) -> DataFrame:
    """Add the string columns that are missing, with a constant."""
    present = set(df.columns)
    added = {name: F.lit(value).cast("string") for name, value in defaults.items() if name not in present}
    return df.withColumns(added) if added else df


def vertical_split(df: DataFrame, main: Sequence[str], key: str) -> tuple[DataFrame, DataFrame]:
    """Main columns and the rest, the key in both.

    Two projections of one source: each side prunes its scan to its own columns,
    which at scale is cheaper than caching the full width.
    """
    return pick(df, main), all_but(df, main, key)
