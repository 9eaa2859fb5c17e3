"""Rounds saved by batch, counts taken along, the SQL functions, the sliding audit, and state over restarts."""

import datetime
import time

import pytest
from pyspark.sql import functions as F

from kontor.functions import contacts, dates, links, sql, text
from kontor.operators import numbering
from kontor.plans import classification, enrichment
from kontor.sources import store, tabular
from kontor.sources.taxonomy import Taxonomy
from kontor.streaming import incremental


def values(df, *names):
    return sorted((tuple(row[name] for name in names) if names else tuple(row) for row in df.collect()), key=repr)


def taxonomy(spark):
    entry = "struct<category:string,subcategories:array<string>>"
    return Taxonomy.from_nested(spark.createDataFrame([([("A", ["x", "y"]), ("B", ["z"])],)], f"categories array<{entry}>"))


# --- saved rounds ---------------------------------------------------------------
def rows(spark, *keys):
    return spark.createDataFrame([(key, "Name", "text") for key in keys], "IDI string, Ditta string, Purpose string")


def answers(log, broken=()):
    """Each asked key is noted; key 3 fails with an error, all others are in A, x."""
    def answer(asked):
        keys = sorted(row["IDI"] for row in asked.select("IDI").collect())
        log.append(keys)
        if set(keys) & set(broken):
            raise OSError("the line went dead")
        error = F.when(F.col("IDI") == "3", "429")
        staged = asked.select("IDI", F.explode(F.array(F.lit(1), F.lit(2))).alias("stage"))
        return staged.select(
            "IDI", F.lit(1).alias("attempt"), "stage", F.when(error.isNull(), F.when(F.col("stage") == 1, "A").otherwise("x")).alias("text"),
            error.alias("error"),
        )

    return answer


def test_two_prompts_go_on_where_they_broke_off(spark, tmp_path):
    output, errors, log, told = str(tmp_path / "out"), str(tmp_path / "errors"), [], []
    some = rows(spark, *"12345")

    def run(broken=()):
        return classification.run_two_prompts_saved(
            some, None, "IDI", taxonomy(spark), answers(log, broken), output, errors, 2, report=told.append)

    with pytest.raises(OSError):
        run(broken="5")
    assert log == [["1", "2"], ["3", "4"], ["5"]]
    assert values(tabular.scan_csv(spark, output), "IDI", "Category") == [("1", "A"), ("2", "A"), ("4", "A")]
    found = run()
    assert log[3:] == [["3", "5"]]  # the failed row and the one never asked
    assert values(found, "IDI", "Category", "Subcategory") == [
        ("1", "A", "x"), ("2", "A", "x"), ("3", None, None), ("4", "A", "x"), ("5", "A", "x")]
    assert [(one["labelled"], one["failed"]) for one in told][0] == (2, 0)
    failed = values(tabular.scan_csv(spark, errors), "IDI", "attempt")
    assert failed == sorted(set(failed)) and {key for key, _ in failed} == {"3"}


def test_scores_are_saved_by_batch(spark, tmp_path):
    from kontor.operators.scoring import scorer

    def load():
        return lambda texts, labels: [[1.0 if label in ("B", "z") else 0.0 for label in some] for some in labels]

    output, told = str(tmp_path / "out"), []
    some = rows(spark, *"123")
    args = (some, None, "IDI", "Ditta", "Purpose", taxonomy(spark), scorer(load), output)
    classification.run_by_scores_saved(*args, size=2, rounds=1, report=told.append)
    assert [row["IDI"] for row in tabular.scan_csv(spark, output).orderBy("IDI").collect()] == ["1", "2"]
    found = classification.run_by_scores_saved(*args, size=2, report=told.append)
    assert values(found, "IDI", "Category", "Subcategory") == [(key, "B", "z") for key in "123"]
    assert [one["labelled"] for one in told] == [2, 1]


def test_rows_without_a_key_are_not_saved(spark, tmp_path):
    with pytest.raises(ValueError, match="IDI"):
        classification.run_two_prompts_saved(
            rows(spark, "1", None), None, "IDI", taxonomy(spark), answers([]), str(tmp_path / "o"), str(tmp_path / "e"))


# --- counts ---------------------------------------------------------------------
def test_writes_count_their_rows(spark, tmp_path):
    frame = spark.range(1000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3).cast("string").alias("v"))
    assert store.write_table(frame, str(tmp_path / "t"), partition_by=["v"], sort_by=["k"]) == 1000
    assert store.write_table(frame.limit(0), str(tmp_path / "none")) == 0
    assert tabular.append_csv(frame, str(tmp_path / "c")) == 1000
    assert tabular.append_csv(frame.filter("v = '1'").select("v", "k"), str(tmp_path / "c")) == 333
    assert tabular.append_csv(frame.filter("k = 'none'"), str(tmp_path / "c")) == 0


def test_the_load_report_reads_no_table(spark):
    model = enrichment.Directory(None, None, {})
    counted = enrichment.Directory(spark.range(1).toDF("idi"), None, {"companies": 5, "company_metadata": 7})
    report = enrichment.load_report(counted)
    assert values(report, "table", "n") == [("companies", 5), ("company_metadata", 7)] and model.counts == {}
    assert "Scan parquet" not in report._jdf.queryExecution().toString()


# --- SQL functions --------------------------------------------------------------
TEXTS = [
    None, "", " ", "CHE-123.456.789", "x CHE-123.456.789 (y)", "CHE-12.456.789", "Registered on 05.03.1999", "Registered on 31.02.2020",
    "Registered on 01.01.1799", "Registered on 01.01.1800", "Registered on 31.12.2030", "Registered on 01.01.2031", "Registered 5.3.1999",
    "091 123 45 67", "+41 91 123 45 67", "www.a1234567890.ch", "mailto:a@b.ch", "mailto:a@b.ch?subject=x", "a@b", "a@b.c", " a@b.ch ",
    "a@b.ch\n", "www.A.ch", "HTTP://A.ch", " www.a.ch", "(091) 123-4567 and (092) 765-4321, c@d.org, e@f.org", "\x1c x ",
    "Bär & Söhne*~", "/p?q", "//host/x", "../up", "#top", "ftp:x", "q'uote",
]


def test_sql_functions_say_the_same(spark):
    sql.register(spark)
    phone = r"\(\d{3}\) \d{3}-\d{4}"
    frame = spark.createDataFrame([(one,) for one in TEXTS], "t string")
    base = F.lit("https://h.ch")
    pairs = {
        "strip_text(t)": text.strip("t"), "blank_to_null(t)": text.blank_to_null("t"), "register_id(t)": contacts.register_id("t"),
        "digits_of(t)": contacts.digits("t"), "is_phone(t)": contacts.is_phone("t"), "is_email(t)": contacts.is_email("t"),
        "is_website(t)": contacts.is_website("t"), "normalise_website(t)": contacts.normalise_website("t"),
        "email_from_link(t)": contacts.email_from_link("t"), "first_email(t)": contacts.first_email("t"),
        f"phones_in_text(t, r'{phone}')": contacts.phones_in_text("t", phone),
        f"join_list(phones_in_text(t, r'{phone}'))": text.join_list(contacts.phones_in_text("t", phone)),
        "registration_date(t)": dates.registration_date("t"), "iso_date(registration_date(t))": dates.iso_date(dates.registration_date("t")),
        "form_encode(t)": links.form_encode("t"), "search_url(t, 'https://h.ch/?q=', '&x')": links.search_url("t", "https://h.ch/?q=", "&x"),
        "resolve_link('https://h.ch', t)": links.resolve(base, F.col("t")),
    }
    assert {name.split("(")[0] for name in pairs} == set(sql.FUNCTIONS)
    both = frame.select("t", *(c for i, (one, other) in enumerate(pairs.items()) for c in (F.expr(one).alias(f"a{i}"), other.alias(f"b{i}"))))
    for row in both.collect():
        for i, name in enumerate(pairs):
            assert row[f"a{i}"] == row[f"b{i}"], (name, row["t"])


def test_the_sql_report_runs_no_python(spark):
    from kontor.workload.joining import contact_report_sql

    plan = contact_report_sql(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "PushedFilters" in plan


# --- the sliding audit ----------------------------------------------------------
def audit(spark, *seconds, limit=2, slice_minutes=60):
    start = datetime.datetime(2024, 1, 1)
    log = spark.createDataFrame([(start + datetime.timedelta(seconds=s) if s is not None else None,) for s in seconds], "ts timestamp")
    found = numbering.rate_audit_sliding(log, "ts", limit, slice_minutes).collect()
    return sorted(((row.ts - start).total_seconds(), row.requests) for row in found)


def test_a_burst_across_a_full_minute_or_slice_is_found(spark):
    assert audit(spark, 50, 70, 80, None) == [(80, 3)]
    assert audit(spark, 3590, 3595, 3600, 3649, 3650) == [(3600, 3), (3649, 4), (3650, 4)]
    assert audit(spark, 0, 30, 60, 90) == []
    assert audit(spark, 7, 7, 7, 7.5) == [(7, 3), (7.5, 4)]


def test_every_slice_length_finds_the_same(spark):
    import random

    chance = random.Random(1)
    seconds = [round(chance.uniform(0, 2000), 3) for _ in range(300)]
    expected = sorted({(s, sum(1 for other in seconds if s - 60 < other <= s)) for s in seconds})
    expected = [one for one in expected if one[1] > 10]
    for minutes in (1, 2, 60):
        assert audit(spark, *seconds, limit=10, slice_minutes=minutes) == expected != []


# --- keyed state ----------------------------------------------------------------
def test_cached_records_last_over_a_restart_until_they_expire(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / name) for name in ("in", "out", "cp"))
    schema = "name string, place long, phone string, mail string"

    def arrive(ttl, *found):
        frame = spark.createDataFrame(list(found), schema)
        frame.coalesce(1).write.mode("append").parquet(source)
        stream = incremental.file_stream(spark, source, frame.schema)
        cached = incremental.cached_records(stream, "name", ["phone", "mail"], "place", ttl)
        incremental.append(cached, target, checkpoint, empty_batches=False)
        return {row.place: (row.phone, row.mail) for row in spark.read.schema(schema).parquet(target).collect()}

    first = arrive(3_600_000, ("a", 2, "late", None), ("a", 1, None, "first"), ("a", 3, None, None), ("b", 4, None, None), (None, 5, "n", None))
    assert first == {1: (None, "first"), 2: ("late", None), 3: (None, None), 4: (None, None), 5: ("n", None)}
    second = arrive(1, ("a", 6, None, None), ("a", 7, "other", "other"), ("b", 8, "b", None), (None, 9, None, None))
    assert {place: second[place] for place in (6, 7, 8, 9)} == {6: (None, "first"), 7: (None, "first"), 8: ("b", None), 9: ("n", None)}
    time.sleep(0.1)
    third = arrive(3_600_000, ("a", 10, None, None), ("b", 11, None, None))
    assert {place: third[place] for place in (10, 11)} == {10: (None, "first"), 11: (None, None)}
