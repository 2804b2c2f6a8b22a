"""Small inline corpora."""

from __future__ import annotations

SCHEMA = "tree_id string, path string, content string, size bigint"
BINARY = "tree_id string, path string, content binary, size bigint"


def corpus(spark, files: dict[str, str], tree: str = "t"):
    rows = [(tree, p, c, len(c.encode())) for p, c in files.items()]
    return spark.createDataFrame(rows, SCHEMA)


def binary_corpus(spark, files: dict[str, bytes], tree: str = "t"):
    return spark.createDataFrame([(tree, p, bytearray(c), len(c)) for p, c in files.items()], BINARY)


def rows(df, *columns, order=None):
    picked = df.select(*columns) if columns else df
    out = [tuple(r) for r in picked.collect()]
    return sorted(out, key=lambda r: tuple(str(x) for x in r)) if order is None else sorted(out, key=order)


def values(df, column):
    return sorted(r[0] for r in df.select(column).collect())
