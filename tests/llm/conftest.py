from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (id, text) pairs, with columns whose names operators use inside."""
    def make(rows, extra=True):
        df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
        if extra:
            for name in ("norm", "cid", "part", "kept", "score", "x", "set", "key", "row", "spans", "_slot"):
                df = df.selectExpr("*", f"'clash' as {name}")
        return df.repartition(3)
    return make
