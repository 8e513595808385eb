"""Compare registered queries with their SQL in DuckDB: ``python tests/check_queries.py [sf] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.reindex(sorted(frame.columns), axis=1)
    for col in frame.columns:
        kind = str(frame[col].dtype)
        if kind.startswith("datetime"):
            frame[col] = frame[col].astype("datetime64[us]")
        elif kind == "float64":
            frame[col] = frame[col].round(6)
    text = frame.astype(object).where(frame.notna(), None).map(
        lambda v: repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    )
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def compare(spark, con, folder: str, name: str, run, sql: str) -> str:
    """Empty if equal, else what differs."""
    got = run(spark, folder)
    ours, theirs = got.toPandas(), con.execute(sql).fetchdf()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    a, b = canonical(ours), canonical(theirs)
    if not a.equals(b):
        rows = (a != b).any(axis=1)
        return f"{rows.sum()} rows differ:\n{a[rows].head(4)}\n{b[rows].head(4)}"
    return ""


def main() -> None:
    from rillstone.plans import CHECKS, QUERIES
    from rillstone.session import build_session

    folder = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(folder), []
    for name in names:
        began = time.time()
        try:
            if name in CHECKS:
                problem = compare(spark, con, folder, name, QUERIES[name], CHECKS[name])
            else:
                problem = "" if QUERIES[name](spark, folder).count() else "no rows"
        except Exception as error:  # noqa: BLE001 - a broken query must not hide the others
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        kind = "sql " if name in CHECKS else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {name} {time.time() - began:.2f}s {problem}", flush=True)
        if problem:
            bad.append(name)
    print(f"{len(names) - len(bad)} of {len(names)} fine; failing: {bad}")


if __name__ == "__main__":
    main()
