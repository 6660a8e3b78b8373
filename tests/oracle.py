"""Compare a Spark result with an SQL result, row for row, order aside."""

from __future__ import annotations

import datetime
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

# Spark type -> type names DuckDB may report for the same thing
SAME_TYPE = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"},
    "date": {"DATE"},
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else float(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([_cell(row[i]) for i in order] for row in rows), key=repr)


def assert_same(df, db, sql: str) -> int:
    """Same column names, types and bag of rows. Returns the number of rows."""
    result = db.sql(sql)
    assert sorted(df.columns) == sorted(result.columns)
    types = dict(zip(result.columns, map(str, result.types)))
    for name, kind in df.dtypes:
        assert types[name] in SAME_TYPE[kind], (name, kind, types[name])
    spark_rows = _rows(df.columns, df.collect())
    sql_rows = _rows(result.columns, result.fetchall())
    assert len(spark_rows) == len(sql_rows)
    for ours, theirs in zip(spark_rows, sql_rows):
        assert ours == theirs
    return len(spark_rows)
