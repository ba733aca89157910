"""Runs registered queries against their SQL in DuckDB and compares whole results."""

from __future__ import annotations

import glob
import os
import time

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype.kind == "M" or (len(df) and df[c].map(lambda v: hasattr(v, "year")).any()):
            df[c] = pd.to_datetime(df[c]).astype("datetime64[s]").astype(str)
        elif df[c].dtype.kind in "fiu" or df[c].map(lambda v: isinstance(v, float)).any():
            df[c] = df[c].astype(float) + 0.0
        else:
            df[c] = df[c].map(lambda v: None if v is None or v is pd.NaT or v != v else str(v))
    return df.sort_values(list(df.columns), na_position="last", ignore_index=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None if equal in columns, rows and every value; else a description."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(set(got.columns) ^ set(want.columns))}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    got, want = _norm(got), _norm(want)
    notes = []
    for c in got.columns:
        a, b = got[c], want[c]
        bad = ~((a == b) | (a.isna() & b.isna()))
        if bad.any():
            i = bad.idxmax()
            notes.append(f"{c}: {int(bad.sum())} differ, e.g. {a[i]!r} vs {b[i]!r}")
    return "; ".join(notes) or None


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from flowledger.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(queries())
    spark, con, failures = local_session(), connect(sf_dir), 0
    for name in names:
        try:
            t0 = time.time()
            df = queries()[name](spark, sf_dir)
            got = df.toPandas()
            t1 = time.time()
            if name not in oracle_sql():
                print(f"{name:30s} rows-only {len(got)} {t1 - t0:.1f}s", flush=True)
                continue
            want = con.execute(oracle_sql()[name]).df()
            t2 = time.time()
            note = difference(got, want)
            failures += note is not None
            print(f"{name:30s} {'OK ' if note is None else 'BAD'} rows={len(got)} spark={t1 - t0:.1f}s "
                  f"duckdb={t2 - t1:.1f}s {note or ''}", flush=True)
        except Exception as e:  # report and go on
            failures += 1
            print(f"{name:30s} ERR {type(e).__name__}: {str(e)[:600]}", flush=True)
    return failures


if __name__ == "__main__":
    import sys

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    raise SystemExit(main(sys.argv[1:]))
