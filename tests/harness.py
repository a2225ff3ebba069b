"""Compare a Spark query with its oracle SQL, value for value."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(plain(row[i]) for i in order) for row in rows),
        key=lambda row: tuple((v is None, str(type(v)), str(v)) for v in row),
    )


def compare(spark_df, connection, sql) -> list[str]:
    """Differences as text; empty when both give the same rows."""
    cursor = connection.execute(sql)
    duck_columns = [d[0] for d in cursor.description]
    duck_types = {d[0]: str(d[1]) for d in cursor.description}
    duck_rows = cursor.fetchall()
    if sorted(spark_df.columns) != sorted(duck_columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(duck_columns)}"]
    spark_rows = [tuple(r) for r in spark_df.collect()]
    a = sorted_rows(spark_df.columns, spark_rows)
    b = sorted_rows(duck_columns, duck_rows)
    problems = []
    if len(a) != len(b):
        problems.append(f"rows {len(a)} != {len(b)}")
    different = [(x, y) for x, y in zip(a, b) if x != y]
    if different:
        problems.append(f"{len(different)} rows differ, first: {different[0]}")
    names = {
        "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
        "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz",
    }
    for field in spark_df.schema.fields:
        if names.get(duck_types[field.name]) != field.dataType.simpleString():
            problems.append(
                f"type of {field.name}: {field.dataType.simpleString()} / {duck_types[field.name]}"
            )
    return problems
