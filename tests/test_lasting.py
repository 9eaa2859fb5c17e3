"""Tables that are kept up to date over loads: folds, ids, counts, partitions, buckets."""

import os
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from kontor.operators.joins import rejoin
from kontor.plans import normalised
from kontor.plans.coverage import MaintainedCoverage
from kontor.session import scratch_path
from kontor.sources import store
from kontor.sources.dictionary import KeyDictionary
from kontor.sources.versions import VersionedTable
from kontor.workload.storing import partition_replace, pruned_balances

SF = "/root/testdata/sf0.001"


def values(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


# --- versions -------------------------------------------------------------------
def test_a_batch_that_broke_off_is_neither_read_nor_folded(spark, tmp_path):
    frame = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x")], "k string, o int, v string")
    table = VersionedTable(spark, str(tmp_path / "t"), ["k"], ["o"], frame.schema)
    table.upsert(frame.filter("k = 'a'"), 0)
    table.upsert(spark.createDataFrame([("c", 1, "x")], frame.schema), 2)
    broken = tmp_path / "t" / "version=000000000003..1"
    frame.filter("k = 'b'").write.parquet(str(broken))
    (broken / "_SUCCESS").unlink()
    assert values(table.current().select("k")) == [("a",), ("c",)]
    table.compact()
    assert broken.exists() and len(table.versions()) == 1
    table.upsert(frame.filter("k = 'b'"), 1)
    table.upsert(frame.filter("k = 'a'"), 0)
    assert values(table.current().select("k")) == [("a",), ("b",), ("c",)] and len(table.versions()) == 2
    table.compact()
    assert values(table.current().select("k")) == [("a",), ("b",), ("c",)]


# --- ids ------------------------------------------------------------------------
KEY = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())])


def extend(spark, path, load, *rows):
    frame = spark.createDataFrame([(*row, i) for i, row in enumerate(rows)], "a string, b int, place int")
    return dict((tuple(row)[:2], row.id) for row in KeyDictionary(spark, path, KEY, "id").extend(frame, "place", load).collect())


def test_ids_last(spark, tmp_path):
    path = str(tmp_path / "ids")
    first = extend(spark, path, "1", ("x", 1), ("m", 1), ("x", 1), (None, 1), ("x", None))
    assert first == {("x", 1): 1, ("m", 1): 2}
    second = extend(spark, path, "2", ("a", 1), ("m", 1), ("x", 2))
    assert second == first | {("a", 1): 3, ("x", 2): 4}
    assert extend(spark, path, "2", ("a", 1), ("new", 1)) == second
    assert extend(spark, path, "3") == second
    assert extend(spark, path, "4", ("z", 0)) == second | {("z", 0): 5}


def test_a_load_that_broke_off_gives_its_ids_again(spark, tmp_path):
    path = str(tmp_path / "ids")
    extend(spark, path, "1", ("x", 1))
    extend(spark, path, "2", ("y", 1), ("z", 1))
    os.remove(f"{path}/load=2/_SUCCESS")
    assert extend(spark, path, "3", ("w", 1)) == {("x", 1): 1, ("w", 1): 2}
    assert extend(spark, path, "2", ("y", 1), ("z", 1)) == {("x", 1): 1, ("w", 1): 2, ("y", 1): 3, ("z", 1): 4}


def test_a_second_load_of_the_model_keeps_its_ids(spark, tmp_path):
    columns = [*normalised.V.COMPANY_COLUMNS, "Category", "Subcategory", "ordinal"]

    def model(load, *rows):
        data = [(key, *[None] * (len(columns) - 4), category, subcategory, i) for i, (key, category, subcategory) in enumerate(rows)]
        schema = ", ".join(f"`{name}` {'int' if name == 'ordinal' else 'string'}" for name in columns)
        flat = spark.createDataFrame(data, schema)
        return normalised.normalise(flat, "ordinal", ids=str(tmp_path / "labels"), load=load)

    assert normalised.V.COMPANY_COLUMNS[0] == "IDI"
    first = model("1", ("1", "B", "x"), ("2", "A", None), ("3", None, "x"))
    assert values(first.links) == [("1", 1, 1), ("2", 2, None), ("3", None, None)]
    second = model("2", ("9", "A", "x"), ("1", "B", "x"), ("8", "0", "y"))
    assert values(second.links) == [("1", 1, 1), ("8", 3, 3), ("9", 2, 2)]
    assert values(second.categories.select("category_id", "Category")) == [(1, "B"), (2, "A"), (3, "0")]
    assert values(second.subcategories) == [(1, 1, "x"), (2, 2, "x"), (3, 3, "y")]


# --- counts ---------------------------------------------------------------------
SCHEMA = "key string, place int, category string, phone_numbers string, email string, website string"


def maintained(spark, path):
    schema = spark.createDataFrame([], SCHEMA).schema
    return MaintainedCoverage(spark, path, "key", "category", ["place"], schema)


def test_counts_follow_upserts(spark, tmp_path):
    kept = maintained(spark, str(tmp_path / "t"))
    batches = [
        [("a", 1, "X", "1", None, None), ("b", 1, "X", None, "e", None), ("c", 1, None, None, None, "w"), (None, 1, "X", "1", "e", "w")],
        [("a", 2, "Y", None, None, None), ("a", 1, "Z", "1", "1", "1"), ("b", 0, "Z", "late", None, None)],
        [("b", 1, "X", "same order, later", None, None), ("c", 3, "Y", None, None, None), (None, 2, "X", None, None, None)],
        [],
    ]
    for number, rows in enumerate(batches):
        kept.apply(spark.createDataFrame(rows, SCHEMA), number)
        assert values(kept.coverage()) == values(kept.recounted())
    assert values(kept.coverage()) == [("X", 2, 1, 0, 0), ("Y", 2, 0, 0, 0)]
    for number, rows in enumerate(batches):  # each once more
        kept.apply(spark.createDataFrame(rows, SCHEMA), number)
    assert values(kept.coverage()) == [("X", 2, 1, 0, 0), ("Y", 2, 0, 0, 0)]


def test_counts_survive_a_crash_at_any_step(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([("a", 2, "Y", None, None, None), ("n", 1, "Y", "1", None, None)], SCHEMA)
    for step, broken in enumerate((VersionedTable, store)):
        kept = maintained(spark, str(tmp_path / f"t{step}"))
        kept.apply(spark.createDataFrame([("a", 1, "X", "1", "e", None)], SCHEMA), 0)
        with monkeypatch.context() as patch:
            def stop(*_, **__):
                raise OSError

            patch.setattr(broken, "upsert" if broken is VersionedTable else "replace_partitions", stop)
            try:
                kept.apply(rows, 1)
            except OSError:
                pass
        kept.apply(rows, 1)
        assert values(kept.coverage()) == values(kept.recounted()) == [("Y", 2, 1, 0, 0)]


# --- partitions and buckets -----------------------------------------------------
def files(path):
    found = {}
    for folder, _, names in os.walk(path):
        found |= {os.path.join(folder, name): os.stat(os.path.join(folder, name)).st_mtime_ns for name in names if name.endswith(".parquet")}
    return found


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(10)] + [(10, None)], "v int, k string")
    store.replace_partitions(rows, path, ["k"], ["v"])
    before = files(path)
    stored = spark.read.schema("v int, k string").parquet(path)
    store.replace_partitions(stored.filter("k = 'b'").withColumn("v", -F.col("v")), path, ["k"])
    after = files(path)
    assert {name: time for name, time in before.items() if "k=b" not in name} == {name: time for name, time in after.items() if "k=b" not in name}
    assert not {name for name in after if "k=b" in name} & set(before)
    spark.catalog.refreshByPath(path)
    expected = [(-i if i % 2 else i, "ab"[i % 2]) for i in range(10)] + [(10, None)]
    assert values(spark.read.schema("v int, k string").parquet(path)) == sorted(expected, key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_filtered_dimension_prunes_partitions(spark):
    assert "dynamicpruning" in plan(partition_replace(spark, SF))
    path = scratch_path(spark, "none")
    store.replace_partitions(spark.createDataFrame([(1, 1.0, "nowhere")], "key long, balance double, place string"), path, ["place"])
    assert pruned_balances(spark, SF, path).count() == 0


def test_buckets_join_without_an_exchange(spark):
    left = spark.range(100).select(F.col("id").alias("idi"), (F.col("id") * 2).alias("a"))
    right = spark.range(50, 150).select(F.col("id").alias("idi"), (F.col("id") * 3).alias("b"))
    names = ["bucketed_" + uuid.uuid4().hex for _ in range(2)]
    for name, rows in zip(names, (left, right)):
        store.save_bucketed(rows, name, "idi", 4, scratch_path(spark, "bucketed"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = rejoin(*map(spark.table, names))
        assert "Exchange" not in plan(joined) and "Bucketed: true" in joined._jdf.queryExecution().toString()
        assert "Exchange" not in plan(spark.table(names[0]).groupBy("idi").count())
        assert values(joined) == sorted(((i, i * 2, i * 3) for i in range(50, 100)), key=repr)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
