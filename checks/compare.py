"""Run registered queries against their SQL in DuckDB: ``python -m checks.compare [sf] [name...]``."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from checks.registry import ORACLES, QUERIES
from dossierflow.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]

    def plain(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return "NULL"
        if isinstance(v, float) and v == int(v):
            return str(int(v))
        return str(v).removesuffix(" 00:00:00")

    return sorted(tuple(plain(v) for v in r) for r in frame.itertuples(index=False, name=None))


def difference(spark, con, name: str, sf_dir: str) -> str:
    """Empty when equal, else a short account of the difference."""
    got = QUERIES[name](spark, sf_dir).toPandas()
    want = con.execute(ORACLES[name]).fetchdf()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} / {sorted(want.columns)}"
    g, w = _rows(got), _rows(want)
    if g == w:
        return "" if g else "both empty"
    only_g, only_w = sorted(set(g) - set(w))[:2], sorted(set(w) - set(g))[:2]
    return f"rows {len(g)} / {len(w)}\n  got  {only_g}\n  want {only_w}"


def main(argv: list[str]) -> int:
    sf_dir = f"/root/testdata/sf{argv[0] if argv else '0.01'}"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = database(sf_dir)
    bad = 0
    for name in argv[1:] or QUERIES:
        if name not in ORACLES:
            continue
        t = time.time()
        try:
            found = difference(spark, con, name, sf_dir)
        except Exception as e:  # report and go on
            found = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - t:.1f}s {found}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
