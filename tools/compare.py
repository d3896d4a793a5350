"""Run registered queries on Spark and their SQL oracles on DuckDB; compare.

Usage: python tools/compare.py [sf_dir] [query ids...]
Prints one line per query: status, rows (spark/oracle), and the first
difference. Values are compared after sorting rows; doubles exactly and at
9 significant digits.
"""

from __future__ import annotations

import math
import sys
import time

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

import duckdb  # noqa: E402

from lakemart.plans import bindings  # noqa: E402
from lakemart.plans.catalog import ORACLE, QUERIES  # noqa: E402
from lakemart.session import local_session  # noqa: E402


def norm(v, digits=None):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if digits:
            return float(f"{v:.{digits}g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def rows_of(records, cols, digits=None):
    out = [tuple(norm(r[c], digits) for c in cols) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or sorted(QUERIES)
    spark = local_session(8)
    con = duckdb.connect()
    for t in bindings.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    bad = 0
    for qid in wanted:
        t0 = time.time()
        try:
            df = QUERIES[qid](spark, sf_dir)
            pdf = [r.asDict() for r in df.collect()]
            scols = sorted(df.columns)
        except Exception as e:  # noqa: BLE001
            print(f"ERROR  {qid}: spark {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if qid not in ORACLE:
            print(f"ROWS   {qid}: {len(pdf)} rows ({ts:.1f}s), no oracle")
            continue
        try:
            rel = con.sql(ORACLE[qid])
            ocols = sorted(rel.columns)
            orecs = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
        except Exception as e:  # noqa: BLE001
            print(f"ERROR  {qid}: duckdb {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        if scols != ocols:
            print(f"SCHEMA {qid}: spark {scols} vs oracle {ocols}")
            bad += 1
            continue
        a, b = rows_of(pdf, scols), rows_of(orecs, scols)
        if a == b:
            print(f"OK     {qid}: {len(a)} rows ({ts:.1f}s)")
            continue
        a9, b9 = rows_of(pdf, scols, 9), rows_of(orecs, scols, 9)
        bad += 1
        if a9 == b9:
            print(f"NEAR   {qid}: {len(a)} rows equal at 9 digits only")
            continue
        diff = next(((x, y) for x, y in zip(a9, b9) if x != y), None)
        print(f"DIFF   {qid}: rows {len(a)} vs {len(b)}; cols {scols}; first {diff}")
    print(f"{len(wanted) - bad}/{len(wanted)} ok")


if __name__ == "__main__":
    main()
