"""Compare every registered query with its SQL: python tests/check.py [sf_dir] [names...]."""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
import pandas as pd

from __spark_entry__ import oracle_sql, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows in one order, values as text."""
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        missing = df[c].isna()
        if str(df[c].dtype).startswith(("int", "Int", "float", "Float")):
            df[c] = df[c].astype("float64").map(repr)
        else:
            df[c] = df[c].astype(str)
        df.loc[missing, c] = "<null>"
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} / {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    a, b = normal(got), normal(want)
    if not a.equals(b):
        bad = (a != b).any(axis=1)
        return f"{bad.sum()} rows differ\n{a[bad].head(3)}\n{b[bad].head(3)}"
    return None


def types(df: pd.DataFrame) -> dict[str, str]:
    return {c: str(t) for c, t in sorted(df.dtypes.items())}


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from medvoice.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = build_session(
        "check", "local[8]", 8, {"spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = []
    for name in names:
        start = time.time()
        try:
            got = queries()[name](spark, sf_dir).toPandas()
            took = time.time() - start
            sql = oracle_sql().get(name)
            if sql is None:
                print(f"rows  {name:32} {len(got):7} {took:6.2f}s", flush=True)
                continue
            want = con.execute(sql).df()
            problem = difference(got, want)
            if problem is None and types(got) != types(want):
                print(f"TYPES {name}: {types(got)} / {types(want)}")
        except Exception as error:  # noqa: BLE001
            took, got = time.time() - start, []
            problem = "".join(traceback.format_exception_only(error))[:1500]
        if problem:
            failed.append(name)
        print(f"{'FAIL ' if problem else 'ok   '} {name:32} {len(got):7} {took:6.2f}s {problem or ''}", flush=True)
    missing = sorted(set(oracle_sql()) - set(queries()))
    print("failed:", failed, "oracle without query:", missing)


if __name__ == "__main__":
    main()
