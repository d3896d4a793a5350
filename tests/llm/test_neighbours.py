"""Collision-counting search against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemart.llm import neighbours


def brute(rows, k):
    """{query id: [(vec_id, score), ...]} of usable rows by full comparison."""
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    out = {}
    for i, q in zip(ids, x):
        if i % 20 == 0:
            score = (x * q).sum(axis=1)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
            out[int(i)] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def search(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for name in ("v", "row", "size", "block", "group", "rank", "query", "score"):
        df = df.selectExpr("*", f"'clash' as {name}")
    got: dict = {}
    for r in neighbours.nearest(df.repartition(5), F.col("vec_id") % 20 == 0, **more).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {i: [(v, s) for _, v, s in sorted(found)] for i, found in got.items() if [x[0] for x in sorted(found)] == list(range(1, len(found) + 1))}


def recall(got, expected):
    assert got.keys() == {i for i, best in expected.items() if best}
    hit = sum(len({v for v, _ in got.get(i, [])} & {v for v, _ in best}) for i, best in expected.items())
    return hit / sum(map(len, expected.values()))


KINDS = {"uniform": lambda r, n: (x := r.normal(size=(n, 48))) / np.linalg.norm(x, axis=1)[:, None],
         "clusters": lambda r, n: r.normal(size=(30, 48))[r.integers(0, 30, n)] + 0.15 * r.normal(size=(n, 48)),
         "norms": lambda r, n: r.normal(size=(n, 16)) * r.lognormal(0, 1, n)[:, None]}


@pytest.mark.parametrize("kind", KINDS)
def test_recall(spark, kind):
    x = KINDS[kind](np.random.default_rng(2), 3000)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    expected = brute(rows, 20)
    got = search(spark, rows, block=128, query_block=64)  # 24 blocks: three rounds
    assert recall(got, expected) >= 0.95
    for i, found in got.items():  # scores are exact, best first, ties to the smaller id
        assert found == sorted(found, key=lambda f: (-f[1], f[0])) and all(abs(s - float(x[i] @ x[v])) < 1e-9 for v, s in found)


def test_collisions_leave_most_rows_of_clustered_data_unverified():
    r = np.random.default_rng(3)
    x = KINDS["clusters"](r, 4000)
    arrays = neighbours.SortedArrays(x, np.arange(4000), 128, 64, 0.97, 11)
    verified = [arrays.search(i, x[i], 20, None)[2] for i in range(0, 4000, 80)]
    assert np.mean(verified) < 0.15 * 4000
    kept = 0
    for i in range(0, 4000, 80):  # a bound from elsewhere leaves what reaches it
        ids, scores, _ = arrays.search(i, x[i], 20, None)
        more, again, _ = arrays.search(i, x[i], 20, float(scores[9]))
        assert (again >= scores[9]).all()
        kept += len(set(more) & set(ids[:10]))
    assert kept >= 0.95 * 500


def test_reach():
    z = neighbours.reach(128, 64, 0.97)
    r = np.random.default_rng(4)
    x = r.normal(size=20)
    hits = (np.abs(r.normal(size=(4000, 128, 20)) @ x) <= z * np.linalg.norm(x)).sum(axis=1)
    assert 0.96 < (hits >= 64).mean() < 0.98


def test_ties_and_unusable_rows(spark):
    one = [1.0, 0.0, 0.0]
    rows = [(i, one) for i in range(1, 400)] + [(400, [2.0, 0.0, 0.0])]
    got = search(spark, rows, block=64, query_block=8)
    assert got == brute(rows, 20)  # equal scores: the smallest ids, exactly
    odd = [(20, [1.0, 1.0]), (40, None), (60, [0.0, 0.0]), (80, [1.0, None]), (100, [float("nan"), 1.0]), (120, [float("inf"), 1.0]), (140, []),
           (1, [3.0, 1.0]), (2, [-1.0, 0.0]), (160, [1.0, 2.0, 3.0]), (None, [9.0, 9.0]), (20, [1.0, 1.0])]
    found = neighbours.nearest(spark.createDataFrame(odd, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found) == [(20, 1, 1, 4.0), (20, 1, 1, 4.0), (20, 2, 2, -1.0), (20, 2, 2, -1.0)]
    assert search(spark, []) == {} and search(spark, [(1, one)]) == {} and search(spark, [(20, one)]) == {}


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_query_recall(spark, sf):
    from lakemart.llm.queries import op12_neighbours

    folder = f"/root/testdata/{sf}"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    expected = brute(rows, 20)
    got: dict = {}
    for r in op12_neighbours(spark, folder).collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert recall(got, expected) >= 0.95
