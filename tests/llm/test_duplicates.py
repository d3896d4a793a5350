"""Exact and near duplicates, vectors and components against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np

from lakemart.llm import embeddings, exact_dedup, minhash
from lakemart.llm.common import Scratch
from lakemart.llm.components import connected_components


def closure(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rnd = random.Random(1)
    links = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(70)] + [(5, 5), (300, 301), (301, 300)] + [(400, 400 + i) for i in range(1, 50)]
    got = connected_components(spark.createDataFrame(links, "a long, b long"), Scratch(spark)).collect()
    expected = closure({x for l in links for x in l}, links)
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert sorted((r.node, r.component) for r in got) == sorted((n, expected[n]) for n in linked)
    assert connected_components(spark.createDataFrame([], "a long, b long"), Scratch(spark)).collect() == []


def test_exact(spark, frame):
    rows = [(5, "a b"), (3, "ab"), (9, "a\tb "), (4, "ab\x0c"), (1, "ba"), (2, "abc"), (6, None), (7, ""), (8, " \n"), (10, "x" * 5000 + "1"), (11, "x" * 5000 + "2"),
            (12, "x" * 5000 + "1"), (13, "ä b"), (14, "äb"), (None, "solo"), (15, "solo"), (20, "same"), (20, "same"), (16, "a b"), (17, "AB")]
    got = exact_dedup.progressive_dedup(frame(rows), carry={"h": exact_dedup.F.sha2("norm", 256)}).collect()
    norm = {i: "".join(c for c in (t or "") if c not in " \t\n\x0b\x0c\r") for i, t in rows}
    assert len(got) == len(rows)
    for r in got:
        group = [(-(len(t or "")), i is None, i or 0, i) for i, t in rows if norm[i] == norm[r.doc_id]]
        assert (r.keep_id, r.group_size, r.kept) == (min(group)[3], len(group), min(group)[3] == r.doc_id), r
        assert r.h == hashlib.sha256(norm[r.doc_id].encode()).hexdigest()
    assert exact_dedup.progressive_dedup(frame([])).collect() == []


def near_texts():
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(4000)]
    base = [rnd.choice(words) for _ in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 90):  # a family whose members are near the base, each other, or nothing
        copy = list(base)
        for _ in range(rnd.randint(0, 9)):
            copy[rnd.randrange(len(copy))] = rnd.choice(words)
        rows.append((1000 - i, " ".join(copy)))
    chain = [rnd.choice(words) for _ in range(120)]
    for i in range(12):  # each near the one before only
        chain = chain[3:] + [rnd.choice(words) for _ in range(3)]
        rows.append((2000 + i, " ".join(chain)))
    passage = " ".join(rnd.choice(words) for _ in range(60))
    rows += [(3000 + i, " ".join(rnd.choice(words) for _ in range(60)) + " " + passage) for i in range(40)]
    rows += [(4000 + i, rows[3][1].upper() if i % 2 else rows[3][1] + "\n") for i in range(20)]
    return rows + [(5000, None), (5001, ""), (5002, " \t"), (5003, "one two"), (5004, "One  two"), (5005, "one two three"), (5006, "é à ü"), (5007, "É à ü"), (None, rows[0][1]), (5008, "same row here now"), (5008, "same row here now")]


def brute(rows, n):
    sets = {}
    for i, t in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = [x for x in __import__("re").split("[\x20\x09-\x0d]+", low) if x]
        sets[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    ids = [i for i in sets if i is not None and sets[i]]
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return sets, closure([i for i in sets if i is not None], links)


def test_near_duplicates(spark, frame):
    rows = near_texts()
    for n in (4, 5):
        sets, expected = brute(rows, n)
        got = minhash.near_duplicates(frame(rows), words=n).collect()
        assert len(got) == len(rows)
        for r in got:
            own = expected.get(r.doc_id)
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), own, own == r.doc_id), r
    assert minhash.near_duplicates(frame([])).collect() == []
    assert sorted(r.component_id for r in minhash.near_duplicates(frame([(1, None), (2, "")])).collect()) == [1, 2]


def test_families_below_the_threshold_never_meet(spark):
    """2000 sets with 87 of 99 terms in common (similarity 0.78), and some with a few more."""
    rnd = np.random.default_rng(9)
    core = list(range(87))
    family = [(i, i, core + [1000 + 12 * i + k for k in range(12)]) for i in range(2000)]
    kind = "cid long, part long, set array<long>"
    scratch = Scratch(spark)
    assert minhash.meetings(spark.createDataFrame(family, kind).repartition(8), 80, scratch).count() == 0
    mixed = [(i, i % 37 if i % 3 else 99, sorted(set(rnd.integers(0, 40, rnd.integers(1, 45)).tolist()))) for i in range(300)]
    mixed += [(400 + i, 400 + i, list(range(100, 100 + 8 + i % 5))) for i in range(20)]
    for percent in (60, 80):
        got = {(r.x, r.y) for r in minhash.across_parts(spark.createDataFrame(mixed, kind).repartition(4), percent, scratch).collect()}
        for i, (a, p, x) in enumerate(mixed):
            for b, q, y in mixed[i + 1:]:
                both = len(set(x) & set(y))
                if p != q and 100 * both >= percent * (len(x) + len(y) - both):
                    assert (a, b) in got, (percent, a, b)


def test_tensored_keys_find_pairs():
    """Over random pairs at similarity just above 0.8, some table key is shared."""
    rnd, missed = np.random.default_rng(3), 0
    offset, factor = minhash._family(7)
    for _ in range(400):
        a = minhash.splitmix(rnd.integers(0, 2**63, 270).astype(np.uint64))
        b = np.concatenate([a[:240], minhash.splitmix(rnd.integers(0, 2**63, 30).astype(np.uint64))])
        agree = np.array([((a ^ offset[k]) * factor[k]).min() == ((b ^ offset[k]) * factor[k]).min() for k in range(minhash.HASHES)]).reshape(2, minhash.SIDE, minhash.ROWS).all(axis=2)
        missed += not agree.any(axis=1).all()
    assert missed == 0


def test_near_vectors(spark):
    rnd = np.random.default_rng(4)
    centres = rnd.normal(size=(6, 16))
    rows = [(i, (centres[i % 6] + rnd.normal(size=16) * rnd.choice([0.05, 0.2, 0.3])).astype(np.float32).tolist(), int(i % 3)) for i in range(240)]
    rows += [(300 + i, rows[0][1], rows[0][2]) for i in range(30)] + [(400, rows[0][1], None), (401, None, 1), (402, [0.0] * 16, 1), (403, [float("nan")] * 16, 1), (404, [None] + [1.0] * 15, 1),
             (405, [float("inf")] * 16, 1), (406, [1.0, 2.0], 1), (407, [2.0, 4.0], 1), (408, [], 1), (409, [x * 2 for x in rows[1][1]], rows[1][2]), (None, rows[0][1], rows[0][2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "'c' as cid", "1 as links", "2 as key", "3 as v")
    got = embeddings.near_vectors(df, block=50).collect()

    def usable(v, label):
        return label is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    good = [(i, np.array(v, np.float32).astype(float), l) for i, v, l in rows if usable(v, l)]
    links = [(a[0], b[0]) for k, a in enumerate(good) for b in good[k + 1:] if a[2] == b[2] and len(a[1]) == len(b[1]) and a[1] @ b[1] / np.sqrt((a[1] @ a[1]) * (b[1] @ b[1])) >= 0.93]
    n = {}
    for a, b in links:
        n[a], n[b] = n.get(a, 0) + 1, n.get(b, 0) + 1
    expected = closure([r[0] for r in rows if r[0] is not None], [l for l in links if None not in l])
    assert len(got) == len(rows)
    for r in got:
        if r.vec_id is not None:
            assert (r.n_links, r.component_id, r.kept) == (n.get(r.vec_id, 0), expected[r.vec_id], expected[r.vec_id] == r.vec_id), r
    assert embeddings.near_vectors(df.limit(0)).collect() == []


def test_rows_that_repeat_an_id(spark, frame):
    """Each row of an id goes by its own text; two texts of one id join nothing."""
    first, second = (" ".join(f"{k}{i}" for i in range(80)) for k in "ab")
    rows = [(5, first), (5, second), (3, first + " more"), (9, second + " more")]
    got = sorted((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(frame(rows), words=4).collect())
    assert got == [(3, 3, True), (5, 3, False), (5, 5, True), (9, 5, False)]
