"""Model replies to labels, with the fallback rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kontor import fixed_values as V
from kontor.functions.text import as_col, strip


def two_lines(text: Column | str) -> Column:
    """First line as category, second as subcategory; NULL if there is no second line.

    The `Category:` and `Subcategory:` marks are removed, and a category is cut
    at its first colon.
    """
    lines = F.split(strip(text), "\n")
    category = strip(F.replace(F.get(lines, F.lit(0)), F.lit("Category:"), F.lit("")))
    category = strip(F.get(F.split(category, ":"), F.lit(0)))
    subcategory = strip(F.replace(F.get(lines, F.lit(1)), F.lit("Subcategory:"), F.lit("")))
    return F.when(
        F.size(lines) >= 2, F.struct(category.alias("category"), subcategory.alias("subcategory"))
    )


def checked_pair(
    category: Column | str, subcategory: Column | str, labels: Column | str, unknown: str = V.UNKNOWN
) -> Column:
    """Unknown category gives (unknown, unknown), unknown subcategory gives the category.

    `labels` is the array of subcategories the taxonomy has for the category, NULL
    if it does not have the category.  The comparison is exact and case-sensitive.
    """
    category, subcategory, labels = as_col(category), as_col(subcategory), as_col(labels)
    known = F.coalesce(F.array_contains(labels, subcategory), F.lit(False))
    return F.struct(
        F.when(labels.isNull(), F.lit(unknown)).otherwise(category).alias("category"),
        F.when(labels.isNull(), F.lit(unknown)).when(known, subcategory).otherwise(category).alias("subcategory"),
    )
