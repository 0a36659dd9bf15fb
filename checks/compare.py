"""Run a registered query on Spark and its SQL in DuckDB, and compare the two results."""

from __future__ import annotations

import decimal
import glob
import os
import time

from pyspark.sql import DataFrame, types as T

_TYPES = {
    "INTEGER": T.IntegerType,
    "BIGINT": T.LongType,
    "VARCHAR": T.StringType,
    "BOOLEAN": T.BooleanType,
    "DATE": T.DateType,
    "DOUBLE": T.DoubleType,
    "TIMESTAMP": (T.TimestampType, T.TimestampNTZType),
}


TIMES: dict[str, float] = {}


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return f"{value:.6g}"
    if isinstance(value, bool):
        return str(value).lower()
    return "" if value is None else str(value)


def _rows(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df: DataFrame, con, sql: str) -> list[str]:
    """What differs between a DataFrame and a query: names, types, number of rows, values."""
    start = time.time()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    expected = _rows(names, cursor.fetchall())
    middle = time.time()
    found = _rows(df.columns, [tuple(r) for r in df.collect()])
    TIMES.update(sql=middle - start, spark=time.time() - middle)
    notes = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} instead of {sorted(names)}"]
    for field in df.schema.fields:
        wanted = _TYPES.get(types[field.name])
        if wanted is None or not isinstance(field.dataType, wanted):
            notes.append(f"type of {field.name}: {field.dataType} against {types[field.name]}")
    if len(found) != len(expected):
        notes.append(f"{len(found)} rows instead of {len(expected)}")
    if found != expected:
        extra = sorted(set(found) - set(expected))[:3]
        missing = sorted(set(expected) - set(found))[:3]
        notes.append(f"columns {sorted(names)}; only in Spark {extra}; only in SQL {missing}")
    return notes
