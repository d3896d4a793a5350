"""Merkle manifest of a dataset: digests, proofs and verification in Spark SQL.

Each row is a leaf. Per group (source) the leaves ascend by id; while several
nodes remain, each run of ``ARITY`` consecutive ones becomes the digest of their
hex digests, put one after another. What remains is the group's subroot; the
subroots, in the order of the groups, give the root in the same way.

An aligned block of ``ARITY ** LEVELS`` nodes is one row that keeps its lowest
level as one string of hex digests. Fixed-width substrings of it are the runs,
whose digests, joined, are the string of the next level; the substrings left
and right of a node inside its run are its sibling segments. The blocks' roots
are the nodes of the next round, so the rounds grow with the logarithm of the
rows, and a round holds 1 / 256 of the rows of the one before. A block passes
the segments above it down to its members as one array.

A group of any size is numbered without passing through one task: rows are
sorted by range, numbered inside the sorted parts, and the parts' row counts
give each part its offset. A hot group spans many parts.

Defined results: a null field counts as ``-``; a null group is the first one, an
empty name another; null ids come first in a group; rows that repeat an id are
leaves of their own, in the order of their digests (equal rows have equal
digests, so any order gives one result). An empty table has no manifest rows.
A leaf that is alone in its group is the group's subroot and has no siblings
there. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch

#: Nodes of a run, and hex digits of a digest.
ARITY, HEX = 16, 64
#: Levels of a block: 256 nodes, a string of 16 KB.
LEVELS = 2
BLOCK, RUN = ARITY ** LEVELS, ARITY * HEX
PROOF = "array<struct<left:string,right:string>>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the concatenated parts."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*map(field, values))


def fold(node: Column, proof: Column) -> Column:
    """The root that a leaf and its sibling segments give, from the leaf up."""
    return F.aggregate(proof, node, lambda acc, s: digest(s["left"], acc, s["right"]))


def numbered(nodes: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``nodes`` (grp, ord, node, row and others) with pos (from 0, by ord, node
    and row inside a group) and n (the group's nodes). The sort is by range, so
    that no group has to fit one task."""
    order = ("grp", "ord", "node", "row")
    ordered = nodes.repartitionByRange(*order).sortWithinPartitions(*order).drop("ord", "row")
    ordered = scratch.table(ordered.withColumn("at", F.monotonically_increasing_id()), f"{name}-sorted").withColumn("part", F.shiftright("at", 33))
    parts = ordered.groupBy("grp", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    # One row per group and part of the sort, whatever the number of nodes.
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("grp", "part", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("rows").over(Window.partitionBy("grp")).alias("n"))
    placed = ordered.join(scratch.table(offsets, f"{name}-offsets"), ["grp", "part"])
    return placed.withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def blocks(nodes: DataFrame) -> DataFrame:
    """(grp, block, n, members, level0 .., root): the aligned blocks of the nodes
    (grp, pos, n, node and other columns, which the members keep)."""
    kept = [c for c in nodes.columns if c not in ("grp", "n", "pos")]
    held = nodes.groupBy("grp", F.expr(f"pos div {BLOCK}").alias("block")).agg(
        F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct(F.expr(f"cast(pos % {BLOCK} as int)").alias("at"), *kept))).alias("members"))
    held = held.withColumn("level0", F.array_join(F.transform("members", lambda m: m["node"]), ""))
    for i in range(LEVELS):
        below = F.col(f"level{i}")
        runs = F.sequence(F.lit(0), F.expr(f"cast((length(level{i}) - 1) div {RUN} as int)"))
        above = F.array_join(F.transform(runs, lambda k: F.sha2(F.substring(below, k * RUN + 1, F.lit(RUN)), 256)), "")
        held = held.withColumn(f"level{i + 1}", F.when(F.col("n") > ARITY ** i, above).otherwise(below))
    return held.withColumnRenamed(f"level{LEVELS}", "root")


def segments() -> Column:
    """Sibling segments of the member ``at`` of a block inside it, lowest first."""
    out = []
    for i in range(LEVELS):
        run = F.substring(F.col(f"level{i}"), F.expr(f"cast(at div {ARITY ** (i + 1)} as int)") * RUN + 1, F.lit(RUN))
        own = F.expr(f"cast(at div {ARITY ** i} % {ARITY} as int)") * HEX
        pair = F.struct(F.substring(run, F.lit(1), own).alias("left"), F.substring(run, own + HEX + 1, F.lit(RUN)).alias("right"))
        out.append(F.when(F.col("n") > ARITY ** i, F.array(pair)).otherwise(F.array().cast(PROOF)))
    return F.concat(*out)


def opened(held: DataFrame, above: DataFrame) -> DataFrame:
    """The members of the blocks, one a row, with proof: their sibling segments
    up to the root. above: (grp, block, proof of the block and other columns)."""
    facts = [c for c in above.columns if c not in ("grp", "block", "proof")]
    rows = held.drop("root").join(above.withColumnRenamed("proof", "upper"), ["grp", "block"]).select("grp", "block", "n", "upper", *facts, *[f"level{i}" for i in range(LEVELS)], F.inline("members"))
    return rows.withColumn("proof", F.concat(segments(), "upper")).drop("n", "upper", *[f"level{i}" for i in range(LEVELS)])


def raised(nodes: DataFrame, scratch: Scratch, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The block tables from the lowest round up, and (grp, node) of the roots."""
    tables = []
    while True:
        held = scratch.table(blocks(nodes), f"{name}-round{len(tables)}")
        tables.append(held)
        if held.filter(F.col("n") > BLOCK).isEmpty():
            return tables, held.select("grp", F.col("root").alias("node"))
        # A group that has its root goes on as one node without siblings.
        nodes = held.select("grp", F.col("block").alias("pos"), F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"), F.col("root").alias("node"))


def lowered(tables: list[DataFrame], above: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The members of the lowest round with their proofs, from (grp, proof and
    other columns) of the groups. A member's place is its block one round down."""
    above = above.withColumn("block", F.lit(0).cast("long"))
    facts = [c for c in above.columns if c not in ("grp", "block")]
    for k in range(len(tables) - 1, 0, -1):
        place = (F.col("block") * BLOCK + F.col("at")).alias("block")
        above = scratch.table(opened(tables[k], above).select("grp", place, *facts), f"{name}-above{k}")
    return opened(tables[0], above)


def manifest(docs: DataFrame, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), id_col: str = "doc_id", group_col: str = "source",
             carry: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, source, leaf, subroot, root, proof, *carry): one row per document.

    proof is the array of sibling segments (left, right) from the leaf to the
    root; ``fold(leaf, proof)`` is the root. carry: further columns of documents."""
    scratch, carry = Scratch(docs.sparkSession), carry or {}
    # Null groups first, then by the bytes of the name.
    key = F.when(F.col(group_col).isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), F.col(group_col).cast("string")))
    leaves = docs.select(key.alias("grp"), F.col(id_col).alias("ord"), F.col(id_col).alias("doc_id"), leaf(*map(F.col, columns)).alias("node"),
                         F.monotonically_increasing_id().alias("row"), *[c.alias(f"carry{k}") for k, c in enumerate(carry.values())])
    tables, subroots = raised(numbered(scratch.table(leaves, "manifest-leaves"), scratch, "manifest"), scratch, "manifest")
    tops = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("ord"), "node", F.lit(0).alias("row"), F.col("grp").alias("below"))
    upper, root = raised(numbered(tops, scratch, "manifest-top"), scratch, "manifest-top")
    ends = root.select("grp", F.col("node").alias("root"), F.array().cast(PROOF).alias("proof"))  # one row
    sources = lowered(upper, ends, scratch, "manifest-top").select(F.col("below").alias("grp"), F.col("node").alias("subroot"), "root", "proof")
    found = lowered(tables, scratch.table(sources, "manifest-sources"), scratch, "manifest")
    source = F.when(F.col("grp") != "", F.col("grp").substr(F.lit(2), F.length("grp"))).cast(docs.schema[group_col].dataType)
    return found.select("doc_id", source.alias("source"), F.col("node").alias("leaf"), "subroot", "root", "proof", *[F.col(f"carry{k}").alias(name) for k, name in enumerate(carry)])


#: DuckDB SQL of the contract's digests over ``documents``.
SQL = rf"""
WITH RECURSIVE f AS (
  SELECT row_number() OVER () AS rid, doc_id, source, concat(coalesce(concat(strlen(doc_id::VARCHAR), ':', doc_id), '-'), coalesce(concat(strlen(source), ':', source), '-'),
    coalesce(concat(strlen(lang), ':', lang), '-'), coalesce(concat(strlen(n_chars::VARCHAR), ':', n_chars), '-')) AS head, text, translate(text, '{UPPER}', '{LOWER}') AS low,
    xor(4294967295, list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) AS crc FROM documents),
d AS (SELECT rid, doc_id, coalesce('s' || source, '') AS grp, sha256(head || coalesce(concat(strlen(text), ':', text), '-')) AS leaf,
    CASE WHEN crc % 5 = 0 THEN sha256(head || coalesce(concat(strlen(low), ':', low), '-')) END AS low_leaf FROM f),
p AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n FROM d),
t(grp, lev, pos, n, h) AS (SELECT grp, 0, pos, n, leaf FROM p UNION ALL
  SELECT grp, lev + 1, pos // 16, any_value((n + 15) // 16), sha256(string_agg(h, '' ORDER BY pos)) FROM t WHERE n > 1 GROUP BY grp, lev, pos // 16),
s AS (SELECT grp, h, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u(lev, pos, n, h) AS (SELECT 0, pos, n, h FROM s UNION ALL
  SELECT lev + 1, pos // 16, any_value((n + 15) // 16), sha256(string_agg(h, '' ORDER BY pos)) FROM u WHERE n > 1 GROUP BY lev, pos // 16),
a AS (SELECT grp, lev, pos, n, h FROM t UNION ALL SELECT NULL, lev, pos, n, h FROM u),
g AS (SELECT grp, lev, pos, n, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM a WHERE n > 1 WINDOW w AS (PARTITION BY grp, lev, pos // 16 ORDER BY pos)),
k(rid, lev, pos, proof, node) AS (SELECT rid, 0, pos, '', coalesce(low_leaf, leaf) FROM p UNION ALL
  SELECT k.rid, k.lev + 1, k.pos // 16, k.proof || g.l || g.r, sha256(g.l || k.node || g.r) FROM k JOIN p ON p.rid = k.rid JOIN g ON g.grp = p.grp AND g.lev = k.lev AND g.pos = k.pos),
b AS (SELECT rid, arg_max(proof, lev) AS proof, arg_max(node, lev) AS node FROM k GROUP BY rid),
m(rid, lev, pos, proof, node) AS (SELECT b.rid, 0, s.pos, b.proof, b.node FROM b JOIN p ON p.rid = b.rid JOIN s ON s.grp = p.grp UNION ALL
  SELECT m.rid, m.lev + 1, m.pos // 16, m.proof || g.l || g.r, sha256(g.l || m.node || g.r) FROM m JOIN g ON g.grp IS NULL AND g.lev = m.lev AND g.pos = m.pos),
e AS (SELECT rid, arg_max(proof, lev) AS proof, arg_max(node, lev) AS node FROM m GROUP BY rid)
SELECT p.doc_id, p.leaf, s.h AS subroot, u.h AS root, sha256(e.proof) AS proof_sha256, e.node AS folded_root, e.node = u.h AS verified
FROM p JOIN s ON s.grp = p.grp JOIN u ON u.n = 1 JOIN e ON e.rid = p.rid"""
