"""Compare a query with its SQL in DuckDB, as bags of rows."""

from __future__ import annotations

import os

import duckdb
import pandas as pd


def connect(sf_dir: str):
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for name in os.listdir(sf_dir):
        at = f"{sf_dir}/{name}" + ("/*.parquet" if os.path.isdir(f"{sf_dir}/{name}") else "")
        c.execute(f"create view {name.split('.')[0]} as select * from '{at}'")
    return c


def bag(df: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if v is None or v is pd.NA or v != v:
            return "null"
        return repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return sorted(tuple(cell(v) for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


def same(result: pd.DataFrame, expected: pd.DataFrame) -> None:
    assert sorted(result.columns) == sorted(expected.columns)
    a, b = bag(result), bag(expected)
    assert len(a) == len(b)
    assert a == b, [x for x in zip(a, b, strict=True) if x[0] != x[1]][:3]
