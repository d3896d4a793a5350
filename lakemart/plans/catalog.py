"""Registry of bound queries (one per operator id) and their SQL oracles.

``QUERIES[id](spark, sf_dir) -> DataFrame`` and ``ORACLE[id] -> DuckDB SQL``.
Ids without an oracle are checked on rows only (hash keys, model output,
lineage columns). Every query reads the whole bound tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(qid: str, oracle: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        if qid in QUERIES:
            raise ValueError(f"duplicate query id {qid}")
        QUERIES[qid] = fn
        if oracle is not None:
            ORACLE[qid] = oracle
        return fn
    return wrap


def _load() -> None:
    # Importing the modules fills the registry.
    from lakemart.plans.queries import (  # noqa: F401
        q_extract,
        q_forecast,
        q_functions,
        q_gold,
        q_serving,
        q_silver,
        q_sources,
    )


_load()
