"""Compare a query with its SQL on DuckDB: columns, row count and values."""

from __future__ import annotations

import glob
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    if isinstance(value, dict):
        return sorted((k, _plain(v)) for k, v in value.items())
    return f"{type(value).__name__}:{value}"


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(str([_plain(row[i]) for i in order]) for row in rows)


def compare(spark, con, query, sql: str, sf_dir: str) -> list[str]:
    """Differences between the Spark result and the SQL result; empty when equal."""
    df = query(spark, sf_dir)
    found = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    wanted = _rows(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    problems = []
    if len(found) != len(wanted):
        problems.append(f"rows {len(found)} != {len(wanted)}")
    if found != wanted:
        only = set(found) - set(wanted), set(wanted) - set(found)
        problems.append(f"{len(only[0])} / {len(only[1])} rows differ, e.g. {sorted(only[0])[:2]} != {sorted(only[1])[:2]}")
    return problems
