"""Compare registered Spark queries with their DuckDB SQL on the same tables.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _normalise(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        s = df[c]
        if pd.api.types.is_datetime64_any_dtype(s):
            if getattr(s.dt, "tz", None) is not None:
                s = s.dt.tz_convert("UTC").dt.tz_localize(None)
            df[c] = s.astype("datetime64[us]")
        elif s.dtype == object:
            df[c] = s.map(lambda v: None if v is None or (isinstance(v, float) and pd.isna(v)) else v)
    df = df.sort_values(list(df.columns), na_position="first", kind="mergesort")
    return df.reset_index(drop=True)


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from __spark_entry__ import oracle_sql, queries

    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = queries()[name](spark, sf_dir)
    got_arrow = sdf.toArrow()
    got = got_arrow.to_pandas()
    t1 = time.time()
    sql = oracle_sql().get(name)
    res = {"name": name, "spark_rows": len(got), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "no-oracle"
        return res
    want_arrow = con.sql(sql).to_arrow_table()
    want = want_arrow.to_pandas()
    res["oracle_rows"] = len(want)
    if sorted(got.columns) != sorted(want.columns):
        res["status"] = f"columns differ: {sorted(got.columns)} vs {sorted(want.columns)}"
        return res
    g_types = {f.name: str(f.type) for f in got_arrow.schema}
    w_types = {f.name: str(f.type) for f in want_arrow.schema}
    if g_types != w_types:
        res["status"] = f"types differ: {g_types} vs {w_types}"
        return res
    g, w = _normalise(got), _normalise(want)
    if len(g) != len(w):
        res["status"] = "row count differs"
        return res
    bad = []
    for c in g.columns:
        gs, ws = g[c], w[c]
        if pd.api.types.is_float_dtype(gs) or pd.api.types.is_float_dtype(ws):
            eq = (gs.astype(float) == ws.astype(float)) | (gs.isna() & ws.isna())
        else:
            eq = (gs.astype(object).where(gs.notna(), None) == ws.astype(object).where(ws.notna(), None)) | (
                gs.isna() & ws.isna()
            )
        if not eq.all():
            i = int((~eq).values.argmax())
            bad.append(f"{c}: {int((~eq).sum())} differ, e.g. {gs.iloc[i]!r} vs {ws.iloc[i]!r}")
    res["status"] = "match" if not bad else "; ".join(bad)
    return res


def main(argv: list[str]) -> int:
    from rill.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = build_session("local[8]", shuffle_partitions=8)
    from __spark_entry__ import queries

    con = duck(sf_dir)
    failures = 0
    for name in names or list(queries()):
        try:
            r = compare(spark, name, sf_dir, con)
        except Exception as exc:  # report and go on
            r = {"name": name, "status": f"error: {type(exc).__name__}: {str(exc)[:400]}"}
        ok = r["status"] in ("match", "no-oracle")
        failures += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    spark.stop()
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
