"""Near-duplicate vectors by random-hyperplane sign hashing.

Identical vectors of a label are one class. In each of ``tables`` tables a
vector's key is the signs of its products with ``bits`` random hyperplanes;
vectors of a label that share a key are compared by cosine in double precision.
A key with many vectors is cut into blocks of about ``block`` and the blocks
are compared two by two, so a task holds two blocks at most. A pair is counted
in the first table in which it meets, so no pair is ever emitted: a block gives
each vector's number of links and a root that it reaches inside the block, and
the roots go to the distributed components.

A pair at cosine 0.93 agrees in a sign with chance 0.88, so it meets in none of
24 tables of 8 bits with a chance of 0.00002, and less above.

Defined results: null or zero vectors, vectors with null or non-finite
components and vectors without a label link with nothing and are their own
component; vectors of different length are never linked; a null id counts in
others' links but is no component's name; repeated rows are rows of one class.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .components import connected_components


def sign_codes(vectors: np.ndarray, tables: int, bits: int, seed: int) -> np.ndarray:
    """Codes (rows x tables) of the signs at random hyperplanes."""
    planes = np.random.default_rng([seed, vectors.shape[1]]).normal(size=(vectors.shape[1], tables * bits))
    signs = (vectors @ planes > 0).reshape(len(vectors), tables, bits)
    return (signs * (1 << np.arange(bits))).sum(axis=2).astype(np.int32)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _compare(threshold: float):
    """Links of one block, or across two, that meet here for the first time."""

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        table_no, first, second = key[1].as_py(), key[2].as_py(), key[3].as_py()
        column = lambda c: group.column(c).combine_chunks()
        cids, copies, block = (column(c).to_numpy(zero_copy_only=False) for c in ("cid", "copies", "block"))
        x, codes = _matrix(column("v")), _matrix(column("codes")).astype(np.int32)
        norms = np.sqrt((x * x).sum(axis=1))
        near = (x @ x.T) / (norms[:, None] * norms[None, :]) >= threshold
        i, j = np.nonzero(np.triu(near, 1))
        if first != second:
            across = block[i] != block[j]
            i, j = i[across], j[across]
        new = np.ones(len(i), bool)
        for at in range(0, len(i), 200_000):
            part = slice(at, at + 200_000)
            new[part] = ~(codes[i[part], :table_no] == codes[j[part], :table_no]).any(axis=1)
        i, j = i[new], j[new]
        links = np.bincount(i, copies[j], len(x)) + np.bincount(j, copies[i], len(x))
        roots = np.arange(len(x))
        while len(i):
            before = roots.copy()
            least = np.minimum(roots[i], roots[j])
            np.minimum.at(roots, i, least)
            np.minimum.at(roots, j, least)
            roots = roots[roots]
            if (before == roots).all():
                break
        used = links > 0
        return pa.table({"cid": pa.array(cids[used], pa.int64()), "links": pa.array(links[used].astype(np.int64)), "root": pa.array(cids[roots[used]], pa.int64())})

    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.93, tables: int = 24, bits: int = 8, block: int = 1024, seed: int = 5,
                 id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    scratch = Scratch(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v"), F.col(label_col).alias("label"))
    finite = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & finite & F.exists("v", lambda e: e != 0), F.lit(False))
    classes = (rows.filter(usable).groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
               .withColumn("cid", F.monotonically_increasing_id()))
    classes = scratch.table(classes, "vectors-classes")

    def hashed(batches):
        for batch in batches:
            sizes = np.diff(batch.column(1).offsets.to_numpy())
            for size in np.unique(sizes):  # vectors of one length together
                part = batch.filter(pa.array(sizes == size))
                codes = sign_codes(_matrix(part.column(1)), tables, bits, seed)
                offsets = np.arange(len(codes) + 1, dtype=np.int32) * tables
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(offsets, codes.ravel())], ["cid", "codes"])

    codes = scratch.table(classes.select("cid", "v").mapInArrow(hashed, "cid bigint, codes array<int>"), "vectors-codes")
    held = scratch.table(classes.join(codes, "cid"), "vectors-held")
    keys = held.select("cid", F.size("v").alias("size"), "label", F.posexplode("codes").alias("tab", "code")).select("cid", "tab", F.xxhash64("size", "label", "tab", "code").alias("key"))
    crowded = (keys.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
               .select("key", F.ceil(F.col("m") / block).cast("int").alias("blocks")))
    spread = keys.join(crowded, "key").withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    dealt = (spread.select("cid", "tab", "key", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
             .select("cid", "tab", "key", "block", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second")))
    met = (dealt.join(held.select("cid", "v", "codes", "copies"), "cid").groupBy("key", "tab", "first", "second")
           .applyInArrow(_compare(threshold), "cid bigint, links bigint, root bigint"))
    met = scratch.table(met, "vectors-met")
    counts = met.groupBy("cid").agg(F.sum("links").alias("links"))
    parts = connected_components(met.filter("cid != root").select(F.col("cid").alias("a"), F.col("root").alias("b")), scratch, "vectors-parts")
    placed = classes.join(counts, "cid", "left").join(parts.withColumnRenamed("node", "cid"), "cid", "left").select(
        "label", "v", "rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "cid").alias("part"))
    names = placed.groupBy("part").agg(F.min("rep").alias("component_id"))
    placed = placed.join(scratch.table(names, "vectors-names"), "part").select("label", "v", "n_links", "component_id")
    linked = rows.filter(usable).join(placed, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
