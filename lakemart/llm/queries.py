"""The operators bound to the given tables, and the SQL of those that have any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe_codec, embeddings, exact_dedup, licenses, manifest, minhash, neighbours, packing, pii, quality, quotes, token_counts
from .common import table, vocabulary


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


def op2_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_quotes(table(spark, sf_dir, "conversations"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.withColumn("base", base).select(
        "doc_id", *[count(k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)],
        F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256"), pii.span_text(F.col("spans")).alias("spans"))


def op4_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.progressive_dedup(table(spark, sf_dir, "documents"), carry={"text_sha256": F.sha2("norm", 256)})
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.round_trip(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op9_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.translate("text", manifest.UPPER, manifest.LOWER)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, manifest.leaf(*fields, lowered))
    found = manifest.manifest(table(spark, sf_dir, "documents"), carry={"tampered": tampered})
    siblings = F.array_join(F.transform("proof", lambda s: F.concat(s["left"], s["right"])), "")
    folded = found.withColumn("folded_root", manifest.fold(F.coalesce("tampered", "leaf"), F.col("proof")))
    return folded.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_statistics(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_minhash, op2_quotes, op3_pii, op4_exact, op5_licenses, op6_packing, op7_embeddings, op8_bpe, op9_counts, op10_quality, op11_manifest, op12_neighbours, op13_alignment)}

ORACLE: dict[str, str] = {
    "op1_minhash": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
r(a, b) AS (SELECT x, y FROM e UNION SELECT y, x FROM e UNION SELECT r.a, t.b FROM r JOIN (SELECT x AS a, y AS b FROM e UNION ALL SELECT y, x FROM e) t ON r.b = t.a),
c AS (SELECT a, min(b) AS m FROM r GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(c.m, w.doc_id)) AS component_id, least(w.doc_id, coalesce(c.m, w.doc_id)) = w.doc_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.a = w.doc_id""",
    "op2_quotes": quotes.SQL,
    "op4_exact": r"""
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(text) DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(text) DESC, doc_id) = doc_id AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)""",
    "op11_manifest": manifest.SQL,
    "op7_embeddings": r"""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings),
e AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_dot_product(a.x, b.x) / (sqrt(list_dot_product(a.x, a.x)) * sqrt(list_dot_product(b.x, b.x))) >= 0.93),
r(a, b) AS (SELECT x, y FROM e UNION SELECT r.a, e.y FROM r JOIN e ON r.b = e.x),
c AS (SELECT a, min(b) AS m FROM r GROUP BY a), k AS (SELECT x, count(*) AS n FROM e GROUP BY x)
SELECT vec_id, coalesce(k.n, 0) AS n_links, least(vec_id, coalesce(c.m, vec_id)) AS component_id, least(vec_id, coalesce(c.m, vec_id)) = vec_id AS kept
FROM v LEFT JOIN k ON k.x = vec_id LEFT JOIN c ON c.a = vec_id""",
}
