"""Compare a query with its SQL: row count, columns and values, order-insensitive."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{root}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows sorted by their text."""
    frame = frame[sorted(frame.columns)]
    text = frame.apply(lambda column: column.map(_text))
    order = text.apply("\x1f".join, axis=1).sort_values(kind="stable").index if len(text) else []
    return text.loc[order].reset_index(drop=True)


def _text(value) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return "null"
    if isinstance(value, bool) or type(value).__name__ == "bool_":
        return str(bool(value))
    if isinstance(value, (int, float)) or hasattr(value, "dtype"):
        try:
            return repr(float(value))
        except (TypeError, ValueError):
            pass
    return str(value)


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    left, right = normal(spark_frame), normal(sql_frame)
    if list(left.columns) != list(right.columns):
        return f"columns {list(left.columns)} != {list(right.columns)}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    if left.equals(right):
        return None
    unequal = left.ne(right)
    columns = [c for c in left.columns if unequal[c].any()]
    row = unequal.any(axis=1).idxmax()
    return (
        f"{int(unequal.any(axis=1).sum())} rows differ in {columns};"
        f" first: {left.loc[row, columns].to_dict()} != {right.loc[row, columns].to_dict()}"
    )
