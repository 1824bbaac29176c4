"""Side-by-side comparison of Spark results and DuckDB oracles."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pandas as pd


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        table = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _kind(value) -> str:
    if isinstance(value, bool) or type(value).__name__ == "bool_":
        return "bool"
    if isinstance(value, (int, float)) or type(value).__name__.startswith(("int", "float", "Decimal")):
        return "number"
    return type(value).__name__.replace("datetime", "Timestamp")


def _cell(value) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return "-"
    if isinstance(value, float) or type(value).__name__.startswith("float"):
        return repr(float(value) + 0.0)
    if type(value).__name__ == "Decimal":
        return repr(float(value))
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    return str(value)


def _rows(columns: list[str], rows: list[tuple], floats: set[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(i: int, value) -> str:
        if columns[i] in floats and value is not None and not isinstance(value, str):
            value = float(value)
        return _cell(value)

    return sorted(tuple(cell(i, row[i]) for i in order) for row in rows)


def compare(spark_df, con: duckdb.DuckDBPyConnection, query: str) -> str | None:
    """None when both sides agree exactly, else what differs."""
    got = [tuple(r) for r in spark_df.collect()]
    cursor = con.execute(query)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    floats = {f for f, t in spark_df.dtypes if t in ("double", "float")}
    duck_floats = {d[0] for d in cursor.description if str(d[1]).startswith(("DOUBLE", "FLOAT", "DECIMAL"))}
    if floats != duck_floats:
        return f"fractional columns differ: {sorted(floats ^ duck_floats)}"
    if len(got) != len(expected):
        return f"rows {len(got)} != {len(expected)}"
    mine = _rows(spark_df.columns, got, floats)
    theirs = _rows(names, expected, floats)
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if wrong:
        header = sorted(names)
        a, b = wrong[0]
        cells = [f"{h}: {x} | {y}" for h, x, y in zip(header, a, b) if x != y]
        return f"{len(wrong)} of {len(mine)} rows differ, first: {cells[:6]} in {a[:4]}"
    return None
