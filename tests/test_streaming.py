from pyspark.sql import functions as F

from kontor.streaming import incremental


def arrive(spark, path, *rows):
    frame = spark.createDataFrame(list(rows), "k string, o int, v string")
    frame.coalesce(1).write.mode("append").parquet(path)
    return frame.schema


def stream(spark, path, schema):
    return incremental.file_stream(spark, path, schema, files_per_batch=1)


def state(table):
    return sorted((row["k"], row["v"]) for row in table.current().collect())


def test_upserts_arrive_in_batches_and_survive_a_restart(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / name) for name in ("in", "out", "cp"))
    arrive(spark, source, ("a", 1, "one"), ("b", 1, "one"), ("a", 2, "two"))
    schema = arrive(spark, source, ("a", 3, "three"))
    table = incremental.upsert(stream(spark, source, schema), target, checkpoint, ["k"], ["o"])
    assert state(table) == [("a", "three"), ("b", "one")] and len(table.versions()) == 2
    arrive(spark, source, ("b", 0, "late"), ("c", 1, "new"))
    again = incremental.upsert(stream(spark, source, schema), target, checkpoint, ["k"], ["o"])
    assert state(again) == [("a", "three"), ("b", "one"), ("c", "new")] and len(again.versions()) == 3
    idle = incremental.upsert(stream(spark, source, schema), target, checkpoint, ["k"], ["o"])
    assert len(idle.versions()) == 3


def test_a_batch_that_fails_is_repeated_without_a_trace(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / name) for name in ("in", "out", "cp"))
    schema = arrive(spark, source, ("a", 1, "one"))
    from kontor.sources.versions import VersionedTable

    table = VersionedTable(spark, target, ["k"], ["o"], schema)

    def crash_after_write(rows, batch):
        table.upsert(rows, batch)
        raise RuntimeError("executor lost")

    try:
        incremental.for_each_batch(stream(spark, source, schema), crash_after_write, checkpoint)
        raise AssertionError("must fail")
    except Exception as error:
        assert "executor lost" in str(error)
    incremental.for_each_batch(stream(spark, source, schema), table.upsert, checkpoint)
    assert state(table) == [("a", "one")] and len(table.versions()) == 1


def test_append_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / name) for name in ("in", "out", "cp"))
    schema = arrive(spark, source, ("a", 1, "x"), ("b", 1, "y"))
    for _ in range(2):
        incremental.append(stream(spark, source, schema), target, checkpoint)
    assert spark.read.parquet(target).count() == 2


def test_first_of_key(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / name) for name in ("in", "out", "cp"))
    arrive(spark, source, ("a", 1, "x"), ("a", 1, "x"))
    schema = arrive(spark, source, ("a", 2, "y"), ("b", 1, "z"))
    incremental.append(incremental.first_of_key(stream(spark, source, schema), ["k"]), target, checkpoint)
    assert sorted(row["k"] for row in spark.read.parquet(target).collect()) == ["a", "b"]


def test_first_of_key_with_a_bounded_state(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / name) for name in ("in", "out", "cp"))
    schema = arrive(spark, source, ("a", 1, "x"), ("a", 2, "x"), ("b", 2, "x"))
    timed = stream(spark, source, schema).withColumn("ts", F.timestamp_seconds("o"))
    incremental.append(incremental.first_of_key(timed, ["k"], "ts", "10 seconds"), target, checkpoint)
    assert spark.read.parquet(target).count() == 2
