"""A keyed table that takes upserts batch by batch.

Each batch lands in a folder of its own, so a batch costs its own rows and not a
rewrite of the table, and a replayed batch overwrites only itself.  A folder is named
by its place in the order of arrival, and by the run and number of its batch: two
runs count from 0 each without meeting.  A folder counts once its write has ended; one that broke
off is neither read nor folded, and its batch writes it anew.  Readers take the latest row per key.
`compact` folds all folders into one now and then.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kontor.operators.dedup import latest_per_key
from kontor.operators.joins import with_key_in
from kontor.sources import store

FOLD = "fold"


class VersionedTable:
    """Rows at `path/version=<place>.<run>.<batch>`; a fold is `<place>.fold`, names of folded batches at `path/_folded`."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], schema):
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.order, self.schema = list(keys), list(order), schema

    def upsert(self, rows: DataFrame, batch: int, run: str = "") -> None:
        """Write one batch of a run, reduced to its latest row per key.

        The same batch of the same run again replaces itself; once folded it adds nothing.
        """
        name = f"{run}.{batch}"
        if store.exists(self.spark, f"{self.path}/_folded/{name}"):
            return
        found = self._folders()
        places = [version for version in found if version.partition(".")[2] == name]
        place = places[0] if places else f"{self._next(found)}.{name}"
        latest_per_key(rows, self.keys, self.order).write.mode("overwrite").parquet(f"{self.path}/version={place}")

    @staticmethod
    def _next(found: list[str]) -> str:
        return f"{1 + max((int(version.partition('.')[0]) for version in found), default=0):012d}"

    def versions(self) -> list[str]:
        """Names of the finished folders in order of arrival."""
        return [name for name in self._folders() if store.finished(self.spark, f"{self.path}/version={name}")]

    def _folders(self) -> list[str]:
        if not store.exists(self.spark, self.path):
            return []
        names = store.folders(self.spark, self.path)
        return sorted(name.partition("=")[2] for name in names if name.startswith("version="))

    def _all(self, versions: list[str]) -> DataFrame:
        if not versions:
            return self.spark.createDataFrame([], self.schema).withColumn("version", F.lit(""))
        paths = [f"{self.path}/version={version}" for version in versions]
        place = F.regexp_extract(F.col("_metadata.file_path"), r"/version=(\d{12})\.", 1)
        return self.spark.read.schema(self.schema).parquet(*paths).withColumn("version", place)

    def current(self, keys: DataFrame | None = None) -> DataFrame:
        """The latest row of each key: by `order`, and by arrival where that ties; with `keys` only of those."""
        rows = self._all(self.versions())
        if keys is not None:
            rows = with_key_in(rows, keys, self.keys)
        return latest_per_key(rows, self.keys, [*self.order, "version"]).drop("version")

    def compact(self) -> None:
        """Fold all finished folders into one, and remove just these.

        The fold is moved in whole, and its batches are noted, before the old folders go; what
        is left of an interrupted fold is folded again, which changes nothing.
        """
        found = self.versions()
        if len(found) < 2:
            return
        staging = f"{self.path}/_fold"
        latest = latest_per_key(self._all(found), self.keys, [*self.order, "version"]).drop("version")
        latest.write.mode("overwrite").parquet(staging)
        place = self._next(self._folders())
        for version in found:
            name = version.partition(".")[2]
            if name != FOLD:
                store.make_folder(self.spark, f"{self.path}/_folded/{name}")
        store.rename(self.spark, staging, f"{self.path}/version={place}.{FOLD}")
        for version in found:
            store.delete(self.spark, f"{self.path}/version={version}")
