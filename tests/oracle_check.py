"""Runs registered queries in Spark and DuckDB and compares the full results."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_numeric_dtype(df[c]):
            df[c] = df[c].astype("float64")
        else:
            df[c] = df[c].astype(object).where(df[c].notna(), None)
            if df[c].map(lambda v: v is None or isinstance(v, (int, float))).all():
                df[c] = df[c].astype("float64")
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


def difference(spark_df: pd.DataFrame, duck_df: pd.DataFrame) -> str | None:
    if sorted(spark_df.columns) != sorted(duck_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(duck_df.columns)}"
    if len(spark_df) != len(duck_df):
        return f"rows {len(spark_df)} != {len(duck_df)}"
    a, b = canonical(spark_df), canonical(duck_df)
    if a.equals(b):
        return None
    for c in a.columns:
        bad = ~((a[c] == b[c]) | (a[c].isna() & b[c].isna()))
        if bad.any():
            i = bad.idxmax()
            return f"column {c}: {int(bad.sum())} differ, first {a.loc[i].to_dict()} / {b.loc[i].to_dict()}"
    return "types differ"


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from inkveil.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, con = local_session("8"), connect(sf_dir)
    registered, sql = queries(), oracle_sql()
    bad = 0
    for name in names or registered:
        t0 = time.time()
        try:
            got = registered[name](spark, sf_dir).toPandas()
            t1 = time.time()
            if name not in sql:
                print(f"{name:22} no SQL, {len(got)} rows, {t1 - t0:.1f}s", flush=True)
                continue
            found = difference(got, con.execute(sql[name]).df())
        except Exception as e:  # noqa: BLE001
            found, t1, got = f"{type(e).__name__}: {str(e)[:600]}", time.time(), []
        bad += found is not None
        print(f"{name:22} {'ok' if found is None else 'BAD ' + found} {len(got)} rows, spark {t1 - t0:.1f}s, "
              f"duckdb {time.time() - t1:.1f}s", flush=True)
    print("all equal" if not bad else f"{bad} differ")


if __name__ == "__main__":
    main()
