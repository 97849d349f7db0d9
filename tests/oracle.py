"""Side-by-side comparison of a Spark query and its SQL."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both results hold the same rows, otherwise what differs."""
    names = sorted(spark_df.columns)
    ours = [tuple(r[n] for n in names) for r in spark_df.collect()]
    found = con.execute(sql)
    columns = [c[0] for c in found.description]
    if sorted(columns) != names:
        return f"columns {names} against {sorted(columns)}"
    order = [columns.index(n) for n in names]
    theirs = [tuple(r[i] for i in order) for r in found.fetchall()]
    theirs = [tuple(float(v) if type(v).__name__ == "Decimal" else v for v in r) for r in theirs]
    left, right = Counter(ours), Counter(theirs)
    if left == right:
        types = [(n, type(a).__name__, type(b).__name__) for n, a, b in zip(names, ours[0], theirs[0])
                 if ours and a is not None and b is not None and type(a) is not type(b)] if ours and theirs else []
        return f"types {types}" if types else None
    def short(counter):
        return [str(r)[:300] for r in list(counter)[:3]]
    return f"{names}: {len(ours)} rows against {len(theirs)}; only ours {short(left - right)}; only SQL {short(right - left)}"
