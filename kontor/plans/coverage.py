"""Contact coverage by category, kept up to date batch by batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kontor.operators.dedup import latest_per_key
from kontor.operators.joins import with_key_in
from kontor.operators.reports import contact_coverage
from kontor.sources import store
from kontor.sources.versions import VersionedTable

COUNTS = ("total", "has_phone", "has_email", "has_website")


class MaintainedCoverage:
    """A keyed company table at `path/rows` and its counts by category at `path/coverage`.

    An upsert looks up only the keys it brings: their old rows are subtracted, their new ones
    added, and that difference is kept at `path/deltas/batch=<number>`.  The counts of the categories it touches
    are then the sums of their differences, and only their partitions are rewritten.  Each step
    can be repeated: a batch that broke off is applied again as a whole, one that is through changes nothing.
    Batches of one table are numbered upwards and applied one after the other.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, by: str, order: Sequence[str], schema: T.StructType):
        self.spark, self.path, self.key, self.by, self.order = spark, path.rstrip("/"), key, by, list(order)
        self.rows = VersionedTable(spark, f"{self.path}/rows", [key], order, schema)
        counts = [T.StructField(name, T.LongType()) for name in COUNTS]
        self.schema = T.StructType([*counts, T.StructField(by, schema[by].dataType)])

    def apply(self, rows: DataFrame, batch: int) -> None:
        """Upsert one batch and bring the counts of its categories up to date."""
        delta = f"{self.path}/deltas/batch={batch}"
        if not store.finished(self.spark, delta):
            self._difference(rows).write.mode("overwrite").parquet(delta)
        self.rows.upsert(rows, batch)
        touched = self._deltas(f"{self.path}/deltas/batch={batch}").select(self.by)
        known = with_key_in(self._deltas(*self._finished()), touched, [self.by])
        store.replace_partitions(self._sums(known), f"{self.path}/coverage", [self.by])

    def _difference(self, rows: DataFrame) -> DataFrame:
        """Counts by category that the batch adds or takes away, categories left as they were dropped."""
        old = self.rows.current(rows)
        both = old.withColumn("__batch", F.lit(0)).unionByName(rows.withColumn("__batch", F.lit(1)))
        new = latest_per_key(both, self.key, [*self.order, "__batch"]).drop("__batch")
        gone = contact_coverage(old, self.by).withColumns({name: -F.col(name) for name in COUNTS})
        change = self._sums(contact_coverage(new, self.by).unionByName(gone))
        return change.filter(" OR ".join(f"{name} <> 0" for name in COUNTS))

    def _sums(self, counts: DataFrame) -> DataFrame:
        sums = counts.groupBy(self.by).agg(*(F.sum(name).alias(name) for name in COUNTS))
        return sums.select(*self.schema.names)

    def _finished(self) -> list[str]:
        folder = f"{self.path}/deltas"
        names = store.folders(self.spark, folder) if store.exists(self.spark, folder) else []
        return [f"{folder}/{name}" for name in names if store.finished(self.spark, f"{folder}/{name}")]

    def _deltas(self, *paths: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*paths)

    def coverage(self) -> DataFrame:
        """(category, total, has_phone, has_email, has_website) of the categories that have companies."""
        stored = store.read_or_empty(self.spark, f"{self.path}/coverage", self.schema)
        return stored.filter(F.col("total") > 0).select(self.by, *COUNTS)

    def recounted(self) -> DataFrame:
        """The same from all rows."""
        return contact_coverage(self.rows.current(), self.by)
