"""Run queries next to their DuckDB statements: python tests/oracle_check.py SF [names]."""

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from cellbulk.adapters import BASE_TABLES  # noqa: E402
from cellbulk.catalog import QUERIES  # noqa: E402
from cellbulk.oracles import oracle_statements  # noqa: E402
from cellbulk.session import local_session  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in BASE_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    columns = []
    for name in frame.columns:
        col = frame[name]
        if pd.api.types.is_bool_dtype(col) and not col.isna().any():
            columns.append([str(bool(v)) for v in col])
        elif pd.api.types.is_numeric_dtype(col):
            columns.append(["" if pd.isna(v) else f"{float(v) + 0.0:.6f}" for v in col])
        else:
            columns.append(["" if v is None or v != v else str(v) for v in col])
    return sorted(zip(*columns)) if columns else []


def compare(spark, con, name: str, sf_dir: str, sql: str) -> str:
    """Empty when both results agree, else what differs first."""
    got = QUERIES[name](spark, sf_dir).toPandas()
    want = con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    a, b = canonical(got), canonical(want)
    if len(a) != len(b):
        extra = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
        return f"rows {len(a)} != {len(b)}; only here / only there: {extra}"
    differing = [(x, y) for x, y in zip(a, b) if x != y]
    return "" if not differing else f"{len(differing)} of {len(a)} differ; {differing[0]}"


if __name__ == "__main__":
    sf = f"/root/testdata/sf{sys.argv[1]}"
    statements = oracle_statements()
    session = local_session(cpus=8)
    session.sparkContext.setLogLevel("ERROR")
    db = connect(sf)
    for key in sys.argv[2:] or list(statements):
        began = time.time()
        try:
            fault = compare(session, db, key, sf, statements[key])
        except Exception as error:  # noqa: BLE001
            fault = f"{type(error).__name__} {str(error)[:500]}"
        print(f"{key:24s} {'ok' if not fault else 'FAIL ' + fault} {time.time() - began:.1f}s",
              flush=True)
    print("no statement:", sorted(set(QUERIES) - set(statements)))
