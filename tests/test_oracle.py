"""Every registered query against its DuckDB oracle (rows, columns, values).

Runs at sf0.001 to stay quick; the driver repeats the check at sf0.01
(``tools/compare.py`` does the same locally).
"""

from __future__ import annotations

import math

import duckdb
import pytest

from lakemart.plans import bindings
from lakemart.plans.catalog import ORACLE, QUERIES
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in bindings.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(records, cols):
    out = [tuple(_norm(r[c]) for c in cols) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


@pytest.mark.parametrize("qid", sorted(ORACLE))
def test_matches_oracle(spark, duck, qid):
    df = QUERIES[qid](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = _rows([r.asDict() for r in df.collect()], cols)
    rel = duck.sql(ORACLE[qid])
    assert sorted(rel.columns) == cols
    want = _rows([dict(zip(rel.columns, r)) for r in rel.fetchall()], cols)
    assert len(got) == len(want)
    assert got == want


@pytest.mark.parametrize("qid", ["sort_preview", "sort_extract", "sort_metrics", "sort_agg_desc", "extract_vessels"])
def test_order_of_rows(spark, duck, qid):
    """Rows in the order in which they come, which the test above does not see."""
    assert "ORDER BY" in ORACLE[qid].rsplit("FROM", 1)[1]
    got = QUERIES[qid](spark, SF_SMALL)
    rel = duck.sql(ORACLE[qid])
    want = [[_norm(dict(zip(rel.columns, r))[c]) for c in got.columns] for r in rel.fetchall()]
    assert [[_norm(v) for v in r] for r in got.collect()] == want


@pytest.mark.parametrize("qid", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, qid):
    df = QUERIES[qid](spark, SF_SMALL)
    assert df.count() >= 0
    assert len(df.columns) > 0
