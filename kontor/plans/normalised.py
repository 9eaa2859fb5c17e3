"""A flat classified table to companies, categories, subcategories and links."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kontor import fixed_values as V
from kontor.operators import constraints
from kontor.operators.dedup import first_per_key
from kontor.operators.joins import with_surrogate_ids
from kontor.operators.numbering import number_rows
from kontor.operators.projection import pick, quoted
from kontor.operators.sizing import written
from kontor.sources.dictionary import KeyDictionary
from kontor.sources.store import create_if_missing, write_table


@dataclass(frozen=True)
class Model:
    companies: DataFrame
    categories: DataFrame
    subcategories: DataFrame
    links: DataFrame

    def report(self) -> DataFrame:
        return constraints.model_report(self.companies, self.categories, self.subcategories, self.links)

    def counts(self) -> DataFrame:
        tables = {"companies": self.companies, "categories": self.categories, "subcategories": self.subcategories}
        lines = [
            df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n") for name, df in tables.items()
        ]
        return lines[0].unionByName(lines[1]).unionByName(lines[2])

    def stored(self, path: str) -> Model:
        """Write the four tables and give them back as read from there."""
        write_table(self.companies, f"{path}/companies", sort_by=["IDI"])
        write_table(self.categories, f"{path}/categories")
        write_table(self.subcategories, f"{path}/subcategories")
        write_table(self.links, f"{path}/company_categories", sort_by=["IDI"])
        read = self.companies.sparkSession.read
        return Model(
            read.schema(self.companies.schema).parquet(f"{path}/companies"),
            read.schema(self.categories.schema).parquet(f"{path}/categories"),
            read.schema(self.subcategories.schema).parquet(f"{path}/subcategories"),
            read.schema(self.links.schema).parquet(f"{path}/company_categories"),
        )


def label_tables(rows: DataFrame, ordinal: str) -> tuple[DataFrame, DataFrame]:
    """Category and subcategory tables with ids in order of first appearance.

    The base rows are grouped once, to distinct pairs; both tables come from those.
    """
    pairs = written(rows.groupBy("Category", "Subcategory").agg(F.min(quoted(ordinal)).alias("__seen")), "pairs")
    pairs = pairs.filter(F.col("Category").isNotNull())
    firsts = pairs.groupBy("Category").agg(F.min("__seen").alias("__seen"))
    categories = number_rows(firsts, ["__seen", "Category"], "category_id").select(
        "category_id", "Category", F.lit(None).cast("string").alias("description")
    )
    named = pairs.filter(F.col("Subcategory").isNotNull())
    numbered = number_rows(named, ["__seen", "Category", "Subcategory"], "subcategory_id")
    subcategories = numbered.join(categories.select("Category", "category_id"), "Category").select(
        "subcategory_id", "category_id", "Subcategory"
    )
    return categories, subcategories


CATEGORY_KEY = T.StructType([T.StructField("Category", T.StringType())])
SUBCATEGORY_KEY = T.StructType([T.StructField("category_id", T.LongType()), T.StructField("Subcategory", T.StringType())])


def lasting_label_tables(rows: DataFrame, ordinal: str, path: str, load: str) -> tuple[DataFrame, DataFrame]:
    """The label tables of all loads below `path`: known names keep their ids, this load's new ones are numbered on."""
    pairs = written(rows.groupBy("Category", "Subcategory").agg(F.min(quoted(ordinal)).alias("__seen")), "pairs")
    kept = KeyDictionary(rows.sparkSession, f"{path}/categories", CATEGORY_KEY, "category_id")
    ids = kept.extend(pairs, "__seen", load)
    named = pairs.join(ids, "Category").select("category_id", "Subcategory", "__seen")
    subcategories = KeyDictionary(rows.sparkSession, f"{path}/subcategories", SUBCATEGORY_KEY, "subcategory_id")
    return (
        ids.select("category_id", "Category", F.lit(None).cast("string").alias("description")),
        subcategories.extend(named, "__seen", load).select("subcategory_id", "category_id", "Subcategory"),
    )


def normalise(flat: DataFrame, ordinal: str, key: str = "IDI", ids: str | None = None, load: str | None = None) -> Model:
    """First row per id, label tables, and one link per company.

    With `ids`, a folder, label ids last over loads, which `load` tells apart; without, each
    call numbers from 1.  A company without a known category or subcategory keeps a link with NULL ids.  The
    deduplicated rows feed all four tables, so they are written once, from one reading of
    the input, and each use reads its own columns.
    """
    columns = [*V.COMPANY_COLUMNS, "Category", "Subcategory", ordinal]
    rows = written(first_per_key(pick(flat, columns), key, ordinal), "deduplicated")
    if ids is None:
        categories, subcategories = label_tables(rows, ordinal)
    else:
        categories, subcategories = lasting_label_tables(rows, ordinal, ids, load)
    linked = with_surrogate_ids(pick(rows, [key, "Category", "Subcategory"]), categories, subcategories)
    return Model(
        pick(rows, V.COMPANY_COLUMNS), categories, subcategories,
        pick(linked, [key, "category_id", "subcategory_id"]),
    )


def create_schema(spark: SparkSession, database: str = "default") -> None:
    """The four tables, if they are missing."""
    tables = {
        "companies": constraints.COMPANIES, "categories": constraints.CATEGORIES,
        "subcategories": constraints.SUBCATEGORIES, "company_categories": constraints.COMPANY_CATEGORIES,
    }
    for name, columns in tables.items():
        create_if_missing(spark, f"{database}.{name}", columns)
