"""Run catalogue queries on Spark and their SQL on DuckDB over the same files and compare."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values in comparable types, rows sorted."""
    out = {}
    for name in sorted(df.columns):
        col = df[name]
        if pd.api.types.is_datetime64_any_dtype(col):
            out[name] = col.astype("datetime64[us]").astype("string")
        elif pd.api.types.is_bool_dtype(col):
            out[name] = col.astype("string")
        elif pd.api.types.is_numeric_dtype(col):
            out[name] = col.astype("float64")
        else:
            out[name] = col.astype("string")
    frame = pd.DataFrame(out)
    return frame.sort_values(list(frame.columns), na_position="first", ignore_index=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str:
    """Empty when equal, else what differs first."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = canonical(got), canonical(want)
    for name in a.columns:
        x, y = a[name], b[name]
        if x.dtype == "float64" and y.dtype == "float64":
            same = np.isclose(x, y, rtol=1e-12, atol=1e-12, equal_nan=True)
        else:
            same = (x.astype("string").fillna("<null>") == y.astype("string").fillna("<null>")).to_numpy()
        if not same.all():
            at = int(np.flatnonzero(~same)[0])
            return f"{name}: {int((~same).sum())} values differ, first {x[at]!r} != {y[at]!r} in {a.loc[at].to_dict()}"
    return ""


def main(sf_dir: str, names: list[str]) -> None:
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import build_session

    spark = build_session()
    con = oracle_connection(sf_dir)
    oracles = oracle_sql()
    bad = 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            got = run(spark, sf_dir).toPandas()
            spent = time.time() - started
            if name not in oracles:
                print(f"rows {name} {len(got)} {spent:.1f}s", flush=True)
                continue
            started = time.time()
            want = con.execute(oracles[name]).df()
            found = difference(got, want)
            note = f"{len(got)} rows spark {spent:.1f}s sql {time.time() - started:.1f}s"
        except Exception as error:  # noqa: BLE001 - a report over all queries
            found, note = f"{type(error).__name__}: {str(error)[:700]}", ""
        bad += bool(found)
        print(f"{'BAD ' if found else 'ok  '} {name} {note} {found}", flush=True)
    print(f"{bad} bad; without query: {sorted(set(oracles) - set(queries()))}")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
