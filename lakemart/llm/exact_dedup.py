"""Exact deduplication by progressive refinement.

Rows are told apart by the length of their normalised text, then by a hash of
its prefix, and only rows that still share both are read in full and hashed.
Two texts are equal when they are identical after deleting the characters
0x20 and 0x09-0x0D. Of equal texts the one with the most code points in the
original text stays, then the smallest id.

Keys, never texts, are shuffled. Group sizes and survivors are partial
aggregates, so a group that holds a third of all rows is reduced in each map
task; rows get their group's verdict by a join that adaptive execution splits.

Defined results: a null text counts as empty and all empty texts are equal; a
null id loses ties and is kept only if its group has no other id; rows that
repeat an id and its text share one verdict (all kept or all dropped).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, in_slots, texts_of

#: The characters that normalisation deletes.
WHITE = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    return F.translate(text, WHITE, "")


def progressive_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 64,
                      carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept and the carried columns.

    ``carry`` maps names to expressions over ``doc_id``, ``text`` and ``norm``
    (the normalised text), computed in the scan. The full read is narrowed to
    rows whose (length, prefix hash) falls in a slot of a surviving one; the
    slots are bounded in number, and rows that share one by chance are hashed
    and found to be alone.
    """
    scratch = Scratch(docs.sparkSession)
    carry = carry or {}
    source = texts_of(docs, id_col, text_col).withColumn("norm", normalised(F.col("text")))
    read = source.select("doc_id", F.length("text").alias("_chars"), F.length("norm").alias("_size"),
                         F.xxhash64(F.substring("norm", 1, prefix_chars)).alias("_prefix"), "norm", "text")
    carried = [e.alias(n) for n, e in carry.items()]
    named = [F.col(n) for n in carry]

    # 1: by length, 2: by prefix within the lengths that several rows share
    keys = scratch.table(read.select("doc_id", "_size", "_prefix", *carried), "dedup-keys")
    # (both from one partial aggregate, so that a hot length is reduced before it moves)
    pairs = keys.groupBy("_size", "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    sizes = pairs.groupBy("_size").agg(F.sum("_n").alias("_m")).filter("_m > 1").select("_size")
    alike = pairs.join(sizes, "_size", "left_semi").filter("_n > 1").select("_size", "_prefix")
    alike = scratch.table(alike, "dedup-alike")

    # 3: full hashes of the rows that are left
    full = in_slots(read, alike, "_size", "_prefix").select("doc_id", "_chars", F.sha2("norm", 256).alias("_full"), *carried)
    full = scratch.table(full, "dedup-full")
    groups = (full.groupBy("_full")
              .agg(F.count(F.lit(1)).alias("group_size"), F.min(F.struct(-F.col("_chars"), F.col("doc_id").isNull(), "doc_id")).alias("_best"))
              .select("_full", "group_size", F.col("_best.doc_id").alias("keep_id")))
    # Written, so that the join's sides are plain exchanges, which a hot hash lets split.
    groups = scratch.table(groups, "dedup-groups")
    grouped = full.join(groups, "_full").select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), *named)
    alone = (in_slots(keys, alike, "_size", "_prefix", how="left_anti")
             .select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), *named))
    return grouped.unionByName(alone)
