"""Mixing against the definition in SQL, and odd rows."""

import duckdb
import pandas as pd
import pytest
from oracle import connect, differences

from __spark_entry__ import oracle_sql, queries
from kontor.llm import mixing
from kontor.llm.queries import MIX_SQL

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, size string, unit long, times string"


def rows_of(spark, rows):
    return spark.createDataFrame([(*row, "s", 7, "t") for row in rows], SCHEMA)


def by_sql(rows):
    documents = pd.DataFrame(rows, columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"})  # noqa: F841
    return sorted(duckdb.sql(MIX_SQL).fetchall(), key=repr)


def found(spark, rows):
    result = mixing.mixed_sizes(rows_of(spark, rows)).select("key", "size", "source_size", "target", "taken")
    return sorted((tuple(row) for row in result.collect()), key=repr)


def test_table(spark):
    assert differences(queries()["op1_mixing"](spark, SF), connect(SF), oracle_sql()["op1_mixing"]) == []


def test_sources_come_near_their_targets(spark):
    rows = [(i, "w " * (1 + i * 37 % 50), f"src{i % 3}" if i % 2 else "big") for i in range(1_500)]
    result = mixing.mixed_sizes(rows_of(spark, rows)).toPandas().merge(
        pd.DataFrame(rows, columns=["key", "text", "source"])[["key", "source"]], on="key")
    assert (result.taken <= 2 * result["size"]).all()
    sums = result.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), total=("source_size", "first"))
    assert ((sums.taken - sums.target).abs() <= 25).all()
    assert sums.target.sum() == pytest.approx(1.5 * result["size"].sum())


ODD = [
    (1, None, "a"), (2, "", "a"), (3, " \t ", None), (4, "one two", None), (None, "x y z", "b"), (None, None, None), (5, "u v", ""),
    (6, "w " * 50_000, "b"), (7, "é é é", "Z"), *[(8, "same row here", "b")] * 9, (9, "same row here", "b"), (10, "solo", "zz"),
]


def test_odd_rows_match_the_definition(spark):
    assert found(spark, ODD) == by_sql(ODD)


@pytest.mark.parametrize("n", [1, 2, 7, 64])
def test_repeated_rows_are_taken_one_by_one(spark, n):
    rows = [(1, "a b c", "s")] * n + [(2, "q r", "t"), (3, "u v w x", "u")]
    assert found(spark, rows) == by_sql(rows)
    both = mixing.mix(rows_of(spark, rows))
    assert both.count() == sum(taken // size for _, size, _, _, taken in by_sql(rows))


def test_mixed_rows_keep_their_columns(spark):
    frame = rows_of(spark, ODD)
    both = mixing.mix(frame)
    assert both.columns == frame.columns
    sizes = {key: size for key, size, *_ in by_sql(ODD) if key is not None}
    taken = {}
    for row in both.collect():
        taken[row.doc_id] = taken.get(row.doc_id, 0) + sizes.get(row.doc_id, 0)
    want = {}
    for key, _, _, _, value in by_sql(ODD):
        want[key] = want.get(key, 0) + value
    assert all(taken.get(key, 0) == value for key, value in want.items() if key is not None)


def test_empty_and_sizeless(spark):
    assert found(spark, []) == []
    assert mixing.mix(rows_of(spark, [])).count() == 0
    assert [row[1:] for row in found(spark, [(1, "", "a"), (2, None, "b")])] == [(0, 0, 0.0, 0), (0, 0, 0.0, 0)]


def test_reruns_agree(spark):
    rows = [(i, "w " * (i % 9 + 1), f"s{i % 4}") for i in range(300)]
    frame = rows_of(spark, rows)
    first, again = (sorted(map(tuple, mixing.mixed_sizes(one).collect())) for one in (frame, frame.repartition(7)))
    assert first == again


def test_rows_equal_in_key_and_text_are_taken_alike(spark):
    rows = [(i // 40, "w " * (i // 40 + 1), f"s{i % 2}", str(i)) for i in range(240)]
    frame = spark.createDataFrame(rows, "`doc.id` long, `the.text` string, `a.source` string, url string")
    names = {"key": "doc.id", "text": "the.text", "source": "a.source"}
    first, again = (sorted(map(tuple, mixing.mix(one, **names).collect())) for one in (frame, frame.orderBy("url").repartition(5)))
    assert first == again and len({row[0] for row in first}) > 1


def test_targets_fill_up_and_share_the_excess(spark):
    totals = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 100)], "source string, total long")
    goal = {row.source: row.target for row in mixing.targets(totals, (5, 2, 1), 1.5, 2).collect()}
    weights, caps = {"a": 5, "b": 2, "c": 1, None: 5}, {"a": 20, "b": 2000, "c": 2000, None: 200}
    want, budget, left = {}, 1.5 * 2110, set(weights)
    while True:
        level = budget / sum(weights[one] for one in left)
        full = {one for one in left if level * weights[one] > caps[one]}
        if not full:
            break
        for one in full:
            want[one], budget = caps[one], budget - caps[one]
        left -= full
    want |= {one: level * weights[one] for one in left}
    assert goal == pytest.approx(want)
