"""The two-level taxonomy: a nested JSON document or a nested table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "categories array<struct<category:string, subcategories:array<string>>>"


class Taxonomy:
    """Categories in file order, each with its subcategories in file order.

    `categories` has the columns `position, category, subcategories`.  Prompts and
    scorers hold the whole taxonomy in every row: it is a fixed dimension.
    """

    def __init__(self, categories: DataFrame):
        self.categories = categories.select("position", "category", "subcategories")

    @classmethod
    def read_json(cls, spark: SparkSession, path: str, multi_line: bool = True) -> "Taxonomy":
        """From JSON files of one document each, or, without `multi_line`, of one a line; positions count within a document."""
        nested = spark.read.schema(SCHEMA).option("multiLine", multi_line).json(path)
        return cls.from_nested(nested)

    @classmethod
    def from_nested(cls, nested: DataFrame) -> "Taxonomy":
        """From a table with the document's `categories` array."""
        rows = nested.select(F.posexplode("categories").alias("position", "c"))
        return cls(rows.select("position", "c.category", "c.subcategories"))

    def pairs(self) -> DataFrame:
        """One row per (category, subcategory) with both list positions."""
        return self.categories.select(
            "category", "position", F.posexplode("subcategories").alias("sub_position", "subcategory")
        )

    def _in_order(self, item: Column) -> Column:
        ordered = F.array_sort(F.collect_list(F.struct(F.col("position"), item.alias("item"))))
        return F.transform(ordered, lambda one: one["item"])

    def labels(self) -> Column:
        """All categories as an array, in file order: a scalar subquery."""
        return self.categories.agg(self._in_order(F.col("category"))).scalar()

    def categories_text(self) -> Column:
        return self.categories.agg(F.array_join(self._in_order(F.col("category")), ", ")).scalar()

    def text(self) -> Column:
        """The block of the single prompt: category, colon, comma-separated subcategories."""
        line = F.concat(
            F.lit("\n"), "category", F.lit(":\n"), F.array_join("subcategories", ", "), F.lit("\n")
        )
        return self.categories.agg(F.array_join(self._in_order(line), "")).scalar()

    def label_lists(self) -> DataFrame:
        """`category, subcategories` for joins; no hint, Spark goes by the size."""
        return self.categories.select("category", "subcategories")

    def add_labels(self, df: DataFrame, category: str, name: str = "labels") -> DataFrame:
        """Add the subcategory array of the row's category; NULL for an unknown category."""
        dim = self.label_lists().select(F.col("category").alias("__listed"), F.col("subcategories").alias(name))
        return df.join(dim, df[f"`{category}`"] == dim["__listed"], "left").drop("__listed")

    def known(self, df: DataFrame, category: str, subcategory: str, name: str = "known") -> DataFrame:
        """Whether the pair is in the taxonomy, compared exactly."""
        tagged = self.add_labels(df, category, "__labels")
        hit = F.array_contains(F.col("__labels"), F.col(f"`{subcategory}`"))
        return tagged.withColumn(name, F.coalesce(hit, F.lit(False))).drop("__labels")
