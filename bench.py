"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected to the driver). Two passes over the headline queries: the
first (``cold``) includes JVM code generation, JIT and file-listing warm-up;
the second is the steady state and gives ``value`` and ``queries``. Each pass
starts without layer tables: ``layers`` writes all of them (Silver, dimensions,
fact, mart, features) from the raw tables, and the queries behind Silver read
them, as the reference's jobs read its tables. The fitted model is cleared, so
the forest is trained in both passes. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lakemart.plans import layers  # noqa: E402
from lakemart.plans.catalog import QUERIES  # noqa: E402
from lakemart.session import env_int, local_session  # noqa: E402

HEADLINE = [
    "layers",               # every layer table written once from the raw tables
    "silver_landings",      # dedup before filters, quality rules
    "win_latest",           # latest vessel row
    "dedup_date_area",      # sea readings dedup
    "fact_landings",        # star-schema fact with four left joins
    "mart_week",            # weekly mart (volume + fleet + sea + calendar)
    "mart_features",        # lags, rolling means, lead target
    "dash_week_species",    # flagship dashboard widget
    "pred_baseline",        # holdout rows, baseline forecast
    "agg_metrics_by_species",
    "src_csv_variant",      # CSV -> VARIANT Bronze -> typed
    "ml_fit",               # random forest on the feature mart
]


def run(spark, qid: str, sf_dir: str) -> float:
    from lakemart.plans.queries import q_forecast
    q_forecast._MODELS.clear()
    q_forecast._ROWS.clear()
    t0 = time.perf_counter()
    if qid == "layers":
        layers.forget(spark)
        layers.shared(spark, sf_dir).build()
        return time.perf_counter() - t0
    QUERIES[qid](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = env_int("BENCH_CPUS", 8)
    spark = local_session(cores=cpus, shuffle_partitions=max(8, cpus), app="lakemart-bench")
    names = [q for q in HEADLINE if q in QUERIES or q == "layers"]
    cold = {q: round(run(spark, q, sf_dir), 3) for q in names}
    warm = {q: round(run(spark, q, sf_dir), 3) for q in names}
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": round(sum(warm.values()), 3), "unit": "sec",
                      "queries": warm, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cold_total": round(sum(cold.values()), 3), "cold": cold}))


if __name__ == "__main__":
    main()
