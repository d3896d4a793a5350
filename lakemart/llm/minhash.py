"""Near-duplicate texts by MinHash with tensored banding.

Instead of computing a key of ``2 * rows`` minhashes for each of ``side ** 2``
tables, two collections of ``side`` half-keys (``rows`` minhashes each) are
computed, and table (i, j) is keyed by the pair of half-keys (A_i, B_j): 100
tables cost 40 minhashes instead of 400. A half-key that no other set shares
cannot be part of a shared table key, so those are dropped before the pairs are
formed.

Identical sets are one class. Within a table key every class is compared with
one, the class with the most shared half-keys, behind the agreement of the 40
minhashes (one byte each; two sets at the threshold miss it with a chance of
about one in a million). The links found give components. Classes in keys that
still hold several components go through an exact prefix filter: shingles are
ordered by how few of these classes hold them, two sets that reach the
threshold share one among the rarest fifth of the larger and the rarest ninth of
the smaller (at 0.8), and its places bound the overlap.
Pairs inside a component are never formed. Every link is confirmed on the full
sets. A pair at similarity 0.8 shares no table key with a chance of
2 * (1 - 0.8 ** 2) ** 10 = 0.00007, and less above.

Defined results: a text without words has an empty set, links with nothing and
is its own component; a null id links nothing and is its own component (null);
rows that repeat an id are told apart by their texts: each row is linked, named and
judged by its own text's class, and does not join what its namesakes are near.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, in_slots, slices, splitmix, texts_of
from .components import connected_components

ROWS, SIDE = 2, 10
HASHES = 2 * SIDE * ROWS


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``words`` words of the text
    in lower case (A-Z only); fewer words are one run, none an empty set."""
    # bytes.lower and bytes.split know ASCII only: A-Z, and 0x20 and 0x09-0x0D.
    found = text.encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    width = min(words, len(found))
    run = splitmix(hashed[:len(hashed) - width + 1] + np.uint64(width))
    for k in range(1, width):
        run = splitmix(run + hashed[k:len(hashed) - width + 1 + k])
    return np.unique(run)


def _family(seed: int) -> tuple[np.ndarray, np.ndarray]:
    draw = splitmix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
    return draw[:HASHES], draw[HASHES:] | np.uint64(1)


def signatures(docs: DataFrame, words: int, seed: int) -> DataFrame:
    """doc_id, n, digest of the set, half-keys a and b, and the bytes of all
    minhashes in longs."""
    def run(batches):
        offset, factor = _family(seed)
        for ids, texts in slices(batches):
            sets = [shingle_set(t, words) for t in texts]
            sizes = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(sizes)
            least = np.zeros((len(sets), HASHES), np.uint64)
            if full.size:
                flat = np.concatenate([sets[i] for i in full])
                starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
                for k in range(HASHES):
                    least[full, k] = np.minimum.reduceat((flat ^ offset[k]) * factor[k], starts)
            least = splitmix(least)
            half = least.reshape(len(sets), 2 * SIDE, ROWS)
            half = splitmix(half[:, :, 0] + splitmix(half[:, :, 1])).view(np.int64)
            sketch = np.ascontiguousarray((least & np.uint64(255)).astype(np.uint8)).view(np.int64)
            as_list = lambda x: pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], np.ascontiguousarray(x).ravel())
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes), pa.array(digests, pa.binary()), as_list(half[:, :SIDE]), as_list(half[:, SIDE:]), as_list(sketch)],
                                             ["doc_id", "n", "digest", "a", "b", "sketch"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, n bigint, digest binary, a array<bigint>, b array<bigint>, sketch array<bigint>")


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, digest, set): the sets of docs (doc_id, text) as longs."""
    def run(batches):
        for ids, texts in slices(batches):
            sets = [shingle_set(t, words) for t in texts]
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([ids, pa.array(digests, pa.binary()), pa.ListArray.from_arrays(offsets, np.concatenate(sets).view(np.int64))], ["doc_id", "digest", "set"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, digest binary, set array<bigint>")


def agreement(left: str, right: str):
    """How many minhash bytes agree: the bits of each byte of the xor are folded
    into its lowest one, and the bytes without any are counted."""
    differ = F.lit(0)
    for i in range(HASHES // 8):
        x = F.col(left)[i].bitwiseXOR(F.col(right)[i])
        for shift, mask in ((4, 0x0F0F0F0F0F0F0F0F), (2, 0x0303030303030303), (1, 0x0101010101010101)):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift)).bitwiseAND(F.lit(mask))
        differ = differ + F.bit_count(x)
    return HASHES - differ


def meetings(sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs of ``sets`` (cid, part, set) of different parts that meet in a rare
    term (term, size and cid, part, n, at of both sides, x the later one in (n,
    cid)): each pair that reaches the threshold meets in its first common term.

    The larger set x looks up its terms until fewer than the threshold's share
    of them is left; the smaller one y is found under fewer: as x is no smaller, both
    share 2t / (1 + t) of y's terms. Sets with a common core that does not
    reach the threshold have more terms of their own than that, which come
    first, so they never meet, however many they are. Sizes are cut
    into classes one threshold apart, so that x looks into two or three of them.
    """
    terms = sets.select("cid", "part", F.size("set").alias("n"), F.explode("set").alias("term"))
    held = terms.groupBy("term").agg(F.count(F.lit(1)).alias("holders"))
    rarest = Window.partitionBy("cid").orderBy("holders", "term")
    prefix = (terms.join(held.filter("holders > 1"), "term", "left").withColumn("holders", F.coalesce("holders", F.lit(1)))
              .withColumn("at", F.row_number().over(rarest) - 1).filter((F.lit(100) * (F.col("n") - F.col("at")) >= percent * F.col("n")) & (F.col("holders") > 1)))
    prefix = scratch.table(prefix.select("cid", "part", "n", "term", "at"), "minhash-prefix")
    # Of the parts that share a term, two members of the largest never meet.
    largest = (prefix.groupBy("term", "part").agg(F.count(F.lit(1)).alias("m")).groupBy("term")
               .agg(F.max(F.struct("m", "part"))["part"].alias("most"), F.count(F.lit(1)).alias("parts")).filter("parts > 1").select("term", "most"))
    largest = scratch.table(largest, "minhash-largest")
    some = scratch.table(prefix.join(largest, "term"), "minhash-terms")
    size = F.log(F.col("n")) / math.log(100 / percent) if percent < 100 else F.col("n").cast("double")
    down = 1 if percent < 100 else 0
    # A little below the class of the least size: logarithms are not exact.
    classes = F.sequence(F.floor(size - down - 1e-6), F.floor(size))
    named = lambda p: [F.col(c).alias(f"{p}_{c}") for c in ("cid", "part", "n", "at")]
    probe = some.select("term", F.explode(classes).alias("size"), *named("x"), (F.col("part") == F.col("most")).alias("x_most"))
    found = some.filter((100 + percent) * (F.col("n") - F.col("at")) >= 2 * percent * F.col("n"))
    found = found.select("term", F.floor(size).alias("size"), *named("y"), (F.col("part") == F.col("most")).alias("y_most"))
    met = probe.filter("not x_most").join(found, ["term", "size"]).unionByName(probe.filter("x_most").join(found.filter("not y_most"), ["term", "size"]))
    return met.filter((F.col("x_part") != F.col("y_part")) & (F.struct("x_n", "x_cid") > F.struct("y_n", "y_cid"))).drop("x_most", "y_most")


def across_parts(sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs (x, y) of different parts that may reach the threshold, from
    ``sets`` (cid, part, set): none that reaches it is left out."""
    overlap = F.least(F.col("x_n") - F.col("x_at"), F.col("y_n") - F.col("y_at"))
    enough = (100 + percent) * overlap >= percent * (F.col("x_n") + F.col("y_n"))
    met = meetings(sets, percent, scratch).filter(enough)
    return met.select(F.least("x_cid", "y_cid").alias("x"), F.greatest("x_cid", "y_cid").alias("y")).distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, seed: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least id
    reachable by links), kept (it is that id). Sets A and B are linked when
    100 * |A and B| >= percent * |A or B|."""
    scratch = Scratch(docs.sparkSession)
    docs = texts_of(docs, id_col, text_col)
    rows = scratch.table(signatures(docs, words, seed), "minhash-rows")
    classes = (rows.filter("n > 0 and doc_id is not null").groupBy("digest")
               .agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("a").alias("a"), F.first("b").alias("b"), F.first("sketch").alias("sketch"))
               .withColumn("cid", F.monotonically_increasing_id()))
    classes = scratch.table(classes, "minhash-classes")

    # Half-keys that several classes share, then all pairs of them per class.
    halves = classes.select("cid", F.posexplode(F.concat("a", "b")).alias("place", "half"))
    shared = halves.groupBy("place", "half").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    lists = (halves.join(shared, ["place", "half"]).groupBy("cid")
             .agg(F.sum("m").alias("met"), F.collect_list(F.when(F.col("place") < SIDE, F.struct("place", "half"))).alias("a"), F.collect_list(F.when(F.col("place") >= SIDE, F.struct("place", "half"))).alias("b")))
    keys = (lists.select("cid", "met", F.explode("a").alias("a"), "b").select("cid", "met", "a", F.explode("b").alias("b"))
            .select("cid", "met", F.xxhash64("a.place", "a.half", "b.place", "b.half").alias("key")))
    keys = scratch.table(keys, "minhash-keys")

    close = (agreement("x_sketch", "y_sketch") >= HASHES // 2) & (100 * F.least("x_n", "y_n") >= percent * F.greatest("x_n", "y_n"))
    side = lambda p: classes.select(F.col("cid").alias(p), F.col("n").alias(f"{p}_n"), F.col("sketch").alias(f"{p}_sketch"))

    # The full sets of all classes that share a key, in one more scan.
    wanted = scratch.table(classes.join(keys.select("cid").distinct(), "cid").select("cid", "digest", F.col("rep").alias("doc_id")), "minhash-wanted")
    sets = full_sets(in_slots(docs, wanted, "doc_id"), words).join(wanted, ["doc_id", "digest"]).groupBy("cid").agg(F.first("set").alias("set"))
    sets = scratch.table(sets, "minhash-sets")

    def confirmed(pairs: DataFrame, step: str) -> DataFrame:
        """The pairs (x, y) whose full sets reach the threshold."""
        joined = (pairs.join(sets.select(F.col("cid").alias("x"), F.col("set").alias("x_set")), "x")
                  .join(sets.select(F.col("cid").alias("y"), F.col("set").alias("y_set")), "y"))
        common = F.size(F.array_intersect("x_set", "y_set"))
        links = joined.filter(100 * common >= percent * (F.size("x_set") + F.size("y_set") - common)).select(F.col("x").alias("a"), F.col("y").alias("b"))
        return scratch.table(links, f"minhash-links-{step}")

    # Stars: each class with the class of its key that meets most others.
    hubs = (keys.groupBy("key").agg(F.max(F.struct("met", "cid")).alias("hub"), F.count(F.lit(1)).alias("m")).filter("m > 1")
            .select("key", F.col("hub.cid").alias("y")))
    stars = keys.join(hubs, "key").filter("cid != y").select(F.col("cid").alias("x"), "y").distinct()
    stars = scratch.table(stars.join(side("x"), "x").join(side("y"), "y").filter(close).select("x", "y"), "minhash-stars")
    links = confirmed(stars, "stars")
    parts = connected_components(links, scratch, "minhash-first")

    # The rest: classes in keys that hold more than one component.
    placed = keys.join(parts.withColumnRenamed("node", "cid"), "cid", "left").select("key", "cid", F.coalesce("component", "cid").alias("part"))
    placed = scratch.table(placed, "minhash-placed")
    mixed = placed.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low != high").select("key")
    rest = scratch.table(placed.join(mixed, "key").select("cid", "part").distinct(), "minhash-rest")
    scratch.drop("minhash-keys", "minhash-placed")
    across = across_parts(rest.join(sets, "cid").select("cid", "part", "set"), percent, scratch)
    across = across.join(stars, ["x", "y"], "left_anti").join(stars.select(F.col("y").alias("x"), F.col("x").alias("y")), ["x", "y"], "left_anti")
    links = links.unionByName(confirmed(scratch.table(across, "minhash-across"), "across"))
    scratch.drop("minhash-sets", "minhash-prefix", "minhash-terms")
    parts = connected_components(links, scratch, "minhash-last")

    named_parts = classes.join(parts.withColumnRenamed("node", "cid"), "cid", "left").select("digest", "rep", F.coalesce("component", "cid").alias("part"))
    ids = named_parts.groupBy("part").agg(F.min("rep").alias("component_id"))
    of_class = named_parts.join(scratch.table(ids, "minhash-ids"), "part").select("digest", "component_id")
    of_class = scratch.table(of_class, "minhash-of-class")
    full = rows.filter("digest is not null").select("doc_id", "n", "digest").join(of_class, "digest", "left").select("doc_id", "n", "component_id")
    empty = rows.filter("digest is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    whole = full.unionByName(empty)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return whole.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))
