"""Small helpers the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space of the word rules: space and the ASCII controls 9 to 13, nothing else.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

ROW = "__row"


def packed(df: DataFrame) -> DataFrame:
    """The whole row as one struct, so that working columns cannot clash with columns of the caller."""
    return df.select(F.struct(*[F.col(f"`{name}`") for name in df.columns]).alias(ROW))


def unpacked(df: DataFrame) -> DataFrame:
    return df.select(f"{ROW}.*")


def field(name: str) -> Column:
    """Column `name` of a packed row."""
    return F.col(f"{ROW}.`{name}`")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def learn_rows(key: Column) -> Column:
    """Whether a row may be learned from: the remainder of crc32 of the key's text by 4 is not 2."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4, F.lit(0)) != 2
