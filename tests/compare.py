"""Run a query on Spark and its SQL on DuckDB, and compare schema and rows."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT", "string": "VARCHAR",
    "double": "DOUBLE", "float": "FLOAT", "boolean": "BOOLEAN", "binary": "BLOB", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, (bytes, bytearray, memoryview)):
        return bytes(value)
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value
    if isinstance(value, Decimal):
        return value.normalize() if value else Decimal(0)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def difference(df, con, sql: str) -> str | None:
    """None when both results agree, else what differs first."""
    names = sorted(df.columns)
    result = con.sql(sql)
    if sorted(result.columns) != names:
        return f"columns: spark {names} duckdb {sorted(result.columns)}"
    duck_types = dict(zip(result.columns, (str(t) for t in result.types)))
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        want = SPARK_TO_DUCK.get(kind, kind.upper())
        if duck_types[field.name] != want:
            return f"type of {field.name}: spark {kind} duckdb {duck_types[field.name]}"
    order = [result.columns.index(n) for n in names]
    spark_rows = Counter(tuple(plain(row[n]) for n in names) for row in df.collect())
    duck_rows = Counter(tuple(plain(row[i]) for i in order) for row in result.fetchall())
    if spark_rows != duck_rows:
        only_spark = list((spark_rows - duck_rows).items())[:2]
        only_duck = list((duck_rows - spark_rows).items())[:2]
        counts = f"{sum(spark_rows.values())} vs {sum(duck_rows.values())} rows"
        return f"{counts}; columns {names}; only spark {str(only_spark)[:600]}; only duckdb {str(only_duck)[:600]}"
    if not spark_rows:
        return "no rows at all"
    return None
