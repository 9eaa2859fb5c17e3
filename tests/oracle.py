"""Run queries in Spark and their SQL in DuckDB, compare rows, names, types and values."""

from __future__ import annotations

import datetime
import decimal
import math
import pathlib

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = pathlib.Path(sf) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else number
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, dict):
        return tuple(sorted((key, plain(one)) for key, one in value.items()))
    if isinstance(value, (list, tuple)):
        return tuple(plain(one) for one in value)
    return value


def differences(spark_df, connection, sql: str) -> list[str]:
    names = sorted(spark_df.columns)
    result = connection.execute(sql)
    theirs_names = [column[0] for column in result.description]
    theirs_types = {column[0]: str(column[1]) for column in result.description}
    if sorted(theirs_names) != names:
        return [f"columns {names} against {sorted(theirs_names)}"]
    theirs = [tuple(plain(row[theirs_names.index(name)]) for name in names) for row in result.fetchall()]
    mine = [tuple(plain(row[name]) for name in names) for row in spark_df.collect()]
    problems = []
    if any(kind == "HUGEINT" for kind in theirs_types.values()):
        problems.append(f"HUGEINT in {theirs_types}")
    if len(mine) != len(theirs):
        problems.append(f"{len(mine)} rows against {len(theirs)}")
    mine.sort(key=repr)
    theirs.sort(key=repr)
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if wrong:
        problems.append(f"{len(wrong)} rows differ, first: {wrong[0]}")
    return problems
