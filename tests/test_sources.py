import pytest
from pyspark.sql import functions as F

from kontor.operators.projection import pick
from kontor.plans import cleanup, enrichment, normalised
from kontor.session import drop_scratch, scratch_path, scratch_root
from kontor.sources import store, tabular
from kontor.sources.versions import VersionedTable


def rows(df, *names):
    return sorted((tuple(row[name] for name in names) for row in df.collect()), key=repr)


def csv_folder(tmp_path, *texts):
    folder = tmp_path / "in"
    folder.mkdir()
    for i, text in enumerate(texts):
        (folder / f"part-{i}.csv").write_text(text, encoding="utf-8")
    return str(folder)


def test_scan(spark, tmp_path):
    path = csv_folder(tmp_path, 'IDI,Phone Numbers,Purpose\n1,0911234567,"a, ""b""\nc"\n2,NA,\n3,,"x"\n4,nan, \n')
    found = tabular.scan_csv(spark, path)
    assert rows(found, "IDI", "Phone Numbers", "Purpose") == [
        ("1", "0911234567", 'a, "b"\nc'), ("2", None, None), ("3", None, "x"), ("4", None, " ")]
    assert rows(tabular.scan_csv(spark, path, strip_blanks=True), "IDI", "Phone Numbers", "Purpose")[3] == ("4", "nan", None)


def test_scan_with_names_that_differ_by_case(spark, tmp_path):
    path = csv_folder(tmp_path, "idi,company_name,IDI,x\n1,n,2,3\n")
    with pytest.raises(ValueError, match="idi"):
        tabular.scan_csv(spark, path)
    found = tabular.scan_csv(spark, path, rename={"idi": "source_idi"})
    assert found.columns == ["source_idi", "company_name", "IDI", "x"] and found.first()["IDI"] == "2"
    assert cleanup.drop_columns(spark, path) == ["IDI", "x"]
    assert rows(tabular.scan_csv(spark, path), "IDI", "x") == [("2", "3")]


def test_repeated_headers_and_empty_files(spark, tmp_path):
    path = csv_folder(tmp_path, "a,b\n1,2\na,b\n3,4\n", "a,b\n")
    assert rows(tabular.scan_csv(spark, path), "a", "b") == [("1", "2"), ("3", "4")]
    only = tmp_path / "h.csv"
    only.write_text("a,b\n")
    assert tabular.scan_csv(spark, str(only)).count() == 0
    missing = tabular.scan_or_empty(spark, str(tmp_path / "none"), ["a", "Phone Numbers"])
    assert missing.count() == 0 and missing.columns == ["a", "Phone Numbers"]


def test_row_order_over_files(spark, tmp_path):
    path = csv_folder(tmp_path, "k,v\na,1\nb,2\na,3\n", "k,v\nb,4\nc,5\n,6\n,7\n")
    assert tuple(cleanup.remove_duplicates(spark, path, key="k").first()) == (7, 4, 3)
    assert rows(tabular.scan_csv(spark, path), "k", "v") == [("a", "1"), ("b", "2"), ("c", "5"), (None, "6")]


def test_write_keeps_text_as_it_is(spark, tmp_path):
    frame = spark.createDataFrame([("1", ' lead "quoted", back\\slash\n\nend '), ("2", None)], "k string, v string")
    tabular.write_csv(frame, str(tmp_path / "out"))
    assert rows(tabular.scan_csv(spark, str(tmp_path / "out")), "k", "v") == rows(frame, "k", "v")


def test_append_reconciles_columns(spark, tmp_path):
    path = str(tmp_path / "out")
    tabular.append_reconciled(spark.createDataFrame([("2", "1")], "b string, a string"), path)
    tabular.append_reconciled(spark.createDataFrame([("3", "x")], "a string, extra string"), path)
    found = tabular.scan_csv(spark, path)
    assert found.columns == ["a", "b"] and rows(found, "a", "b") == [("1", "2"), ("3", None)]


def test_records_to_columns(spark):
    frame = spark.sql("SELECT map('b', '1', 'a', '2') AS r UNION ALL SELECT map('c', '3')")
    assert tabular.records_to_columns(frame, "r").columns == ["a", "b", "c"]
    assert tabular.records_to_columns(frame, "r", ["c"]).columns == ["c"]


# --- staged replacement -----------------------------------------------------------
def test_replace_reads_its_own_target(spark, tmp_path):
    path = str(tmp_path / "t")
    store.replace_parquet(spark.range(3).toDF("id"), path)
    store.replace_parquet(spark.read.parquet(path).filter("id > 0"), path)
    assert rows(spark.read.parquet(path), "id") == [(1,), (2,)]
    assert sorted(entry.name for entry in tmp_path.iterdir() if not entry.name.startswith(".")) == ["t"]


def test_failed_write_leaves_the_target(spark, tmp_path):
    path = str(tmp_path / "t")
    store.replace_parquet(spark.range(3).toDF("id"), path)
    with pytest.raises(Exception):
        store.replace_parquet(spark.range(2).select(F.raise_error(F.lit("no")).alias("id")), path)
    assert spark.read.parquet(path).count() == 3


def test_interrupted_swap_is_completed(spark, tmp_path):
    path = str(tmp_path / "t")
    store.replace_parquet(spark.range(3).toDF("id"), path)
    store.rename(spark, path, str(tmp_path / "_previous-t"))
    assert store.read_or_empty(spark, path, "id bigint").count() == 3
    store.replace_parquet(spark.range(1).toDF("id"), path)
    assert spark.read.parquet(path).count() == 1


def test_promote(spark, tmp_path):
    store.replace_parquet(spark.range(3).toDF("id"), str(tmp_path / "final"))
    spark.range(5).write.parquet(str(tmp_path / "temp"))
    store.promote(spark, str(tmp_path / "temp"), str(tmp_path / "final"))
    assert spark.read.parquet(str(tmp_path / "final")).count() == 5 and not (tmp_path / "temp").exists()


def test_append_goes_by_the_header(spark, tmp_path):
    path = str(tmp_path / "t")
    tabular.append_csv(spark.createDataFrame([("1", "2")], "a string, b string"), path)
    tabular.append_csv(spark.createDataFrame([("4", "3")], "b string, a string"), path)
    assert rows(tabular.scan_csv(spark, path), "a", "b") == [("1", "2"), ("3", "4")]
    with pytest.raises(ValueError, match="do not fit"):
        tabular.append_csv(spark.createDataFrame([("4", "3")], "b string, c string"), path)


def test_scan_rejects_files_with_other_headers(spark, tmp_path):
    path = tmp_path / "t"
    path.mkdir()
    (path / "1.csv").write_text("a,b\n1,2\n")
    (path / "2.csv").write_text("b,a\n4,3\n")
    with pytest.raises(Exception, match="header"):
        tabular.scan_csv(spark, str(path)).collect()


def test_first_after_appends_is_the_older_row(spark, tmp_path):
    for i in range(4):
        path = str(tmp_path / f"t{i}")
        for value in ("old", "new"):
            tabular.append_csv(spark.createDataFrame([("k", value)], "IDI string, v string"), path)
        cleanup.remove_duplicates(spark, path)
        assert rows(tabular.scan_csv(spark, path), "v") == [("old",)]


def test_insert_absent(spark, tmp_path):
    path = str(tmp_path / "t")
    store.insert_absent(spark.createDataFrame([("a", 2), ("a", 1), (None, 3)], "k string, v int"), path, ["k"], ["v"])
    store.insert_absent(spark.createDataFrame([("a", 0), ("b", 9), (None, 0)], "k string, v int"), path, ["k"], ["v"])
    assert rows(spark.read.parquet(path), "k", "v") == [("a", 1), ("b", 9), (None, 3)]


# --- versions ---------------------------------------------------------------------
def test_versions(spark, tmp_path):
    schema = spark.createDataFrame([], "k string, o int, v string").schema
    kept = VersionedTable(spark, str(tmp_path / "t"), ["k"], ["o"], schema)
    assert kept.current().count() == 0
    one = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], schema)
    two = spark.createDataFrame([("a", 2, "tie"), ("b", 0, "late")], schema)
    kept.upsert(one, 0)
    kept.upsert(two, 1)
    expected = [("a", 2, "tie"), ("b", 1, "z")]
    assert rows(kept.current(), "k", "o", "v") == expected
    kept.upsert(two, 1)
    kept.compact()
    assert rows(kept.current(), "k", "o", "v") == expected and len(kept.versions()) == 1
    kept.upsert(one, 0)
    assert rows(kept.current(), "k", "o", "v") == expected
    kept.compact()
    assert len(kept.versions()) == 1
    kept.upsert(spark.createDataFrame([("a", 2, "newest")], schema), 2)
    kept.compact()
    assert rows(kept.current(), "k", "v") == [("a", "newest"), ("b", "z")] and len(kept.versions()) == 1


def test_a_new_run_after_a_fold_loses_nothing(spark, tmp_path):
    schema = spark.createDataFrame([], "k int, o int").schema
    kept = VersionedTable(spark, str(tmp_path / "t"), ["k"], ["o"], schema)
    kept.upsert(spark.createDataFrame([(1, 1)], schema), 0, "old")
    kept.upsert(spark.createDataFrame([(2, 1)], schema), 1, "old")
    kept.compact()
    kept.upsert(spark.createDataFrame([(3, 1), (1, 1)], schema), 0, "new")
    kept.compact()
    assert rows(kept.current(), "k") == [(1,), (2,), (3,)]


def test_interrupted_fold_is_folded_again(spark, tmp_path):
    schema = spark.createDataFrame([], "k int, o int").schema
    kept = VersionedTable(spark, str(tmp_path / "t"), ["k"], ["o"], schema)
    for batch in range(3):
        kept.upsert(spark.createDataFrame([(batch, 1)], schema), batch)
    left = kept.versions()[0]
    spark.read.parquet(f"{tmp_path}/t/version={left}").write.parquet(f"{tmp_path}/kept")
    kept.compact()
    store.rename(spark, f"{tmp_path}/kept", f"{tmp_path}/t/version={left}")
    kept.compact()
    assert rows(kept.current(), "k") == [(0,), (1,), (2,)] and len(kept.versions()) == 1


# --- tables -----------------------------------------------------------------------
FLAT = (
    "IDI string, Ditta string, `Forma giuridica` string, Sede string, Registration_date string, Registered_address string, "
    "Purpose string, Address string, `Phone Numbers` string, Email string, Website string, Category string, Subcategory string, "
    "url string, ordinal int"
)


def flat(spark, *keys):
    return spark.createDataFrame(
        [(idi, f"n{i}", "AG", "S", "Registered on 01.02.2003", "r", "p", None, phone, None, None, c, s, "u", i)
         for i, (idi, phone, c, s) in enumerate(keys)], FLAT)


def test_flat_model(spark, tmp_path):
    model = enrichment.flat_model(flat(spark, ("1", "0", "A", "a"), ("2", None, None, None)))
    assert model.companies.columns[4] == "registration_date" and model.metadata.columns == ["url", "ordinal", "idi"]
    assert rows(enrichment.load_report(model), "table", "n") == [("companies", 2), ("company_metadata", 2)]
    model.register_views()
    assert spark.table(enrichment.CONTACTS_VIEW).count() == 1
    assert rows(spark.table(enrichment.STATS_VIEW), "category", "total", "has_phone") == [("A", 1, 1), (None, 1, 0)]
    model.write(str(tmp_path / "db"))
    stored = spark.read.parquet(str(tmp_path / "db" / "companies"))
    assert stored.filter("category = 'A'").count() == 1
    assert "PartitionFilters: [isnotnull(category" in stored.filter("category = 'A'")._jdf.queryExecution().executedPlan().toString()


def test_normalised_model(spark, tmp_path):
    source = flat(
        spark, ("2", None, "B", "x"), ("1", None, "A", "x"), ("2", None, "Z", "z"), ("3", None, "B", "y"),
        ("4", None, None, None), ("5", None, "A", None))
    model = normalised.normalise(source, "ordinal")
    assert rows(model.categories, "category_id", "Category") == [(1, "B"), (2, "A")]
    assert rows(model.subcategories, "subcategory_id", "category_id", "Subcategory") == [(1, 1, "x"), (2, 2, "x"), (3, 1, "y")]
    assert rows(model.links, "IDI", "category_id", "subcategory_id") == [
        ("1", 2, 2), ("2", 1, 1), ("3", 1, 3), ("4", None, None), ("5", 2, None)]
    assert model.report().filter("violations > 0").isEmpty()
    assert rows(model.counts(), "table", "n") == [("categories", 2), ("companies", 5), ("subcategories", 3)]
    stored = model.stored(str(tmp_path / "db"))
    assert stored.links.count() == 5 and stored.report().filter("violations > 0").isEmpty()


def test_bucketed_join_needs_no_exchange(spark):
    spark.sql("DROP TABLE IF EXISTS one")
    spark.sql("DROP TABLE IF EXISTS two")
    store.save_bucketed(spark.range(100).toDF("idi"), "one", "idi", 4)
    store.save_bucketed(spark.range(100).toDF("idi"), "two", "idi", 4)
    store.create_if_missing(spark, "one", "idi bigint")
    joined = spark.table("one").hint("merge").join(spark.table("two"), "idi")
    assert joined.count() == 100 and "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()


def test_hot_category_is_rebalanced(spark, tmp_path):
    frame = spark.range(1000).select(F.when(F.col("id") % 3 == 0, F.col("id") % 10).otherwise(99).alias("category"), "id")
    store.write_table(frame, str(tmp_path / "t"), ["category"], ["id"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1000


def test_scratch_is_the_named_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(scratch_root(spark)) and scratch_path(spark, "x") != scratch_path(spark, "x")


def test_local_scratch_lies_in_the_warehouse_and_goes(spark, tmp_path):
    class Here:
        class sparkContext:
            master, applicationId, given = "local[2]", "test", []
            getCheckpointDir = staticmethod(lambda: f"{Here.sparkContext.given[0]}/id" if Here.sparkContext.given else None)
            setCheckpointDir = staticmethod(lambda path: Here.sparkContext.given.append(path))
            getConf = staticmethod(dict)

        class conf:
            get = staticmethod(lambda key, default=None: str(tmp_path) if key == "spark.sql.warehouse.dir" else default)

    assert scratch_root(Here) == f"{tmp_path}/scratch"


def test_scratch_is_dropped(spark):
    from kontor.operators.sizing import written

    path = scratch_path(spark, "x").rpartition("/")[0]
    written(spark.range(1))
    assert store.exists(spark, path)
    drop_scratch(spark)
    assert not store.exists(spark, path)


class Elsewhere:
    """A cluster session without a shared folder."""

    class sparkContext:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(dict)

    class conf:
        get = staticmethod(lambda key, default=None: default)


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Elsewhere)


def test_pick_fails_on_a_missing_column(spark):
    with pytest.raises(Exception, match="nothing"):
        pick(spark.range(1), ["nothing"])


MALFORMED = 'a,b\n1,2\n3\n4,5,6\n7,8\n"x,1","y\nz"\n"q, ""r""","s",\n9,5" pipe\n'


def test_rows_with_cells_too_many_raise(spark, tmp_path):
    found = tabular.scan_csv(spark, csv_folder(tmp_path, MALFORMED))
    for asked in (found, found.select("b"), found.groupBy().count()):
        with pytest.raises(Exception, match="more cells than the header"):
            asked.collect()


def test_no_cell_of_a_malformed_row_is_lost(spark, tmp_path):
    for multi_line in (True, False):
        text = MALFORMED if multi_line else MALFORMED.replace("y\nz", "yz")
        path = str(tmp_path / f"{multi_line}.csv")
        (tmp_path / f"{multi_line}.csv").write_text(text)
        good, bad = tabular.split_malformed(tabular.scan_csv(spark, path, keep_malformed=True, multi_line=multi_line))
        assert rows(good, "a", "b") == [("1", "2"), ("7", "8"), ("9", '5" pipe'), ("x,1", "y\nz" if multi_line else "yz")]
        assert rows(bad, "line") == [('"q, ""r""","s",',), ("3",), ("4,5,6",)]
        assert bad.count() == 3 and good.select("b").count() == 4


def test_short_rows_have_nulls(spark, tmp_path):
    found = tabular.scan_csv(spark, csv_folder(tmp_path, "a,b,c\n1,2,3\n4\n5,,\n"))
    assert rows(found, "a", "b", "c") == [("1", "2", "3"), ("4", None, None), ("5", None, None)]


def test_headers_with_line_breaks_and_gaps(spark, tmp_path):
    path = csv_folder(tmp_path, '﻿"first\nname",,"b, c"\n1,2,3\n')
    assert tabular.header(spark, path) == ["first\nname", "", "b, c"]
    found = tabular.scan_csv(spark, path, rename={"": "gap"})
    assert rows(found, "first\nname", "gap", "b, c") == [("1", "2", "3")]


def test_a_reject_sink_is_a_table_like_any_other(spark, tmp_path):
    good, bad = tabular.split_malformed(tabular.scan_csv(spark, csv_folder(tmp_path, MALFORMED), keep_malformed=True))
    tabular.write_csv(bad, str(tmp_path / "bad"))
    assert rows(tabular.scan_csv(spark, str(tmp_path / "bad")), "line") == rows(bad, "line")
