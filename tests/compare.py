"""Comparing a Spark result with a DuckDB result, order aside."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
}


def star_database(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{directory}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return round(float(value), 6)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(rows, columns: list[str]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def assert_same(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str, types: bool = True) -> int:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    if types:
        expected = {d[0]: str(d[1]) for d in result.description}
        assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == expected
    got, want = rows_of(df.collect(), df.columns), rows_of(result.fetchall(), columns)
    order = sorted(columns)
    assert got == want, (
        f"{sum((got - want).values())} rows only in Spark, {sum((want - got).values())} only in SQL\n"
        f"{order}\nSpark {list((got - want).items())[:3]}\nSQL   {list((want - got).items())[:3]}"
    )
    return sum(got.values())
