"""Run a registered query and its DuckDB oracle and compare them as row multisets."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = ["documents", "pages", "conversations", "benchmark", "labels"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def oracle_rows(con, sql: str):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(row[i] for i in order) for row in cursor.fetchall())


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(row) for row in df.select(*names).collect())


def integers_are_long(df) -> bool:
    return not any(f.dataType.typeName() in ("integer", "short", "byte") for f in df.schema)
