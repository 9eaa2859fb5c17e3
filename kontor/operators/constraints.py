"""Keys, uniqueness and references of the normalised model, checked as data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kontor.operators.projection import quoted

COMPANIES = (
    "IDI string, Ditta string, `Forma giuridica` string, Sede string, Registration_date string, "
    "Registered_address string, Purpose string"
)
CATEGORIES = "category_id bigint, Category string, description string"
SUBCATEGORIES = "subcategory_id bigint, category_id bigint, Subcategory string"
COMPANY_CATEGORIES = "IDI string, category_id bigint, subcategory_id bigint"


def _counts(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    return df.groupBy(*(quoted(column) for column in columns)).agg(F.count("*").alias(name))


def _missing(column: str, known: str) -> Column:
    """1 for a value that refers to nothing; a missing value refers to nothing to begin with."""
    return (quoted(column).isNotNull() & F.col(known).isNull()).cast("bigint")


def _flagged(df: DataFrame, column: str, target: DataFrame, name: str) -> DataFrame:
    """Add whether `target` has the value, as a column that is null if not."""
    keys = target.select(quoted(column)).distinct().withColumn(name, F.lit(True))
    return df.join(keys, column, "left")


def _repeated(count: str, *parts: str) -> Column:
    """Number of keys that more than one row holds; keys with a missing part do not conflict."""
    filled = reduce(lambda a, b: a & b, (quoted(part).isNotNull() for part in parts))
    return F.count_if((F.col(count) > 1) & filled)


def _primary(count: str, key: str) -> Column:
    """Number of repeated keys, a missing key counting as one more."""
    return F.count_if((F.col(count) > 1) | (quoted(key).isNull() & F.col(count).isNotNull()))


def model_report(
    companies: DataFrame, categories: DataFrame, subcategories: DataFrame, links: DataFrame
) -> DataFrame:
    """One row per declared constraint of the model with its number of violations.

    The large tables are read once: links with the label tables' keys joined as flags and
    counted per company id, companies counted per id, and both counts put side by side.
    """
    labelled = _flagged(_flagged(links, "category_id", categories, "__category"), "subcategory_id", subcategories, "__sub")
    per_id = labelled.groupBy("IDI").agg(
        F.count("*").alias("links"), F.sum(_missing("category_id", "__category")).alias("no_category"),
        F.sum(_missing("subcategory_id", "__sub")).alias("no_sub"),
    )
    sides = _counts(companies, ["IDI"], "companies").join(per_id, "IDI", "full")
    large = sides.agg(
        _primary("companies", "IDI").alias("pk_companies"), _primary("links", "IDI").alias("pk_company_categories"),
        F.sum(F.when(quoted("IDI").isNotNull() & F.col("companies").isNull(), F.col("links"))).alias("fk_link_company"),
        F.sum("no_category").alias("fk_link_category"), F.sum("no_sub").alias("fk_link_subcategory"),
    )
    owned = _flagged(subcategories, "category_id", categories, "__category")
    small = [
        _counts(categories, ["category_id"], "n").agg(_primary("n", "category_id").alias("pk_categories")),
        _counts(categories, ["Category"], "n").agg(_repeated("n", "Category").alias("uq_category")),
        _counts(subcategories, ["subcategory_id"], "n").agg(_primary("n", "subcategory_id").alias("pk_subcategories")),
        _counts(subcategories, ["category_id", "Subcategory"], "n").agg(
            _repeated("n", "category_id", "Subcategory").alias("uq_subcategory")
        ),
        owned.agg(F.sum(_missing("category_id", "__category")).alias("fk_subcategory_category")),
    ]
    return reduce(DataFrame.unionByName, (_lines(one) for one in (large, *small)))


def _lines(counts: DataFrame) -> DataFrame:
    """One row for each column of a one-row table."""
    each = F.array(*(
        F.struct(F.lit(name).alias("constraint"), F.coalesce(quoted(name), F.lit(0)).cast("bigint").alias("violations"))
        for name in counts.columns
    ))
    return counts.select(F.inline(each))
