"""Surrogate ids that last over loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kontor.operators.joins import not_done
from kontor.operators.numbering import number_rows
from kontor.operators.projection import quoted
from kontor.sources import store


class KeyDictionary:
    """Keys and their ids, one folder a load at `path/load=<name>`.

    A known key keeps its id; a load numbers its new keys after the largest id so far, in order of
    first appearance.  A load counts once its folder is finished: repeated it adds nothing, and
    one that broke off is made anew, from the same ids on.  Loads follow one another; two at
    a time would number from the same place.
    """

    def __init__(self, spark: SparkSession, path: str, keys: T.StructType, name: str):
        self.spark, self.path, self.keys, self.name = spark, path.rstrip("/"), keys, name
        self.schema = T.StructType([*keys.fields, T.StructField(name, T.LongType())])

    def entries(self) -> DataFrame:
        """All keys with their ids."""
        loads = store.folders(self.spark, self.path) if store.exists(self.spark, self.path) else []
        paths = [f"{self.path}/{load}" for load in loads if store.finished(self.spark, f"{self.path}/{load}")]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def extend(self, rows: DataFrame, ordinal: str, load: str) -> DataFrame:
        """Give ids to the keys of `rows` that have none; returns all entries.  Rows with a missing key get none."""
        target = f"{self.path}/load={load}"
        if not store.finished(self.spark, target):
            names, known = self.keys.names, self.entries()
            present = rows.dropna(subset=names).groupBy(*(quoted(name) for name in names))
            new = not_done(present.agg(F.min(quoted(ordinal)).alias("__first")), known, names)
            largest = known.agg(F.coalesce(F.max(quoted(self.name)), F.lit(0))).first()[0]
            numbered = number_rows(new, ["__first", *names], self.name).drop("__first")
            numbered = numbered.withColumn(self.name, quoted(self.name) + largest)
            numbered.select(*(quoted(name) for name in self.schema.names)).write.mode("overwrite").parquet(target)
        return self.entries()
