"""Broadcast only behind a size check.

Spark's static estimate of a join's output multiplies its inputs, so a
dimension joined to a fixed-size lookup (supplier to nation) is never
broadcast even when tiny. Here the decision is made on the input that
bounds the rows (the dimension's own scan), from optimizer statistics, which
cost no job: file sizes for scans. Above the threshold the join stays a
shuffle join, and AQE may still demote it at runtime once sizes are measured.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Parquet on disk is smaller than rows in memory; scale the file-based estimate.
DEFAULT_EXPANSION = 4.0


def estimated_bytes(df: DataFrame) -> int:
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(size if isinstance(size, int) else size.toString())


def broadcast_threshold(df: DataFrame) -> int:
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def fits_broadcast(bound: DataFrame, expansion: float = DEFAULT_EXPANSION, threshold: int | None = None) -> bool:
    limit = broadcast_threshold(bound) if threshold is None else threshold
    return limit > 0 and estimated_bytes(bound) * expansion <= limit


def broadcast_if_fits(df: DataFrame, bound: DataFrame | None = None, expansion: float = DEFAULT_EXPANSION,
                      threshold: int | None = None) -> DataFrame:
    """``F.broadcast(df)`` when ``bound`` (default ``df``), whose size bounds
    ``df``'s, is estimated under the broadcast threshold; else ``df``."""
    return F.broadcast(df) if fits_broadcast(df if bound is None else bound, expansion, threshold) else df
