"""A corpus pipeline: quality, exact dedup, near-dedup, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one
before kept; all but the last return the columns of ``documents``. ``run``
writes each stage to the shared folder and reads it back. Verdicts are given to
rows, not to ids: a row's key is its id and its place (file and row number), so
rows that repeat an id, or have none, stay or go each by its own text. Of equal
texts of one length the smallest id stays, a null id last. Texts are read where
they lie and are not written again for the keys.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import exact_dedup, minhash, packing, pii, quality
from lakemart.llm.common import Scratch, table, vocabulary


def _keyed(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key of each row, in the order of the ids, and its column's
    name, which no column of ``docs`` has. The place of a row in its file is the
    same at each reading; a table that is not read from files is written first,
    as the order of rows that are computed anew may differ."""
    key = "_row"
    while key in docs.columns:
        key += "_"
    try:
        placed = docs.select("*", F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"),
                                           F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias(key))
    except AnalysisException:
        return _keyed(spark, Scratch(spark).table(docs, "pipeline-rows"))
    return placed, key


def _without(keyed: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """``keyed`` less the rows whose keys ``dropped`` has as doc_id."""
    rows = dropped.select(F.col("doc_id.file").alias("_file"), F.col("doc_id.row").alias("_place"))
    return keyed.join(rows, (keyed[key]["file"] == rows["_file"]) & (keyed[key]["row"] == rows["_place"]), "left_anti").drop(key)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    keyed, key = _keyed(spark, docs)
    scored = quality.classify(keyed.withColumn("doc_id", F.col(key)), table(spark, sf_dir, "labels"), label_id=F.col("doc_id.id"))
    return _without(keyed, key, scored.filter("predicted = 0"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    keyed, key = _keyed(spark, docs)
    return _without(keyed, key, exact_dedup.progressive_dedup(keyed, id_col=key).filter("not kept"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, 0.8) stays."""
    keyed, key = _keyed(spark, docs)
    return _without(keyed, key, minhash.near_duplicates(keyed, words=5, percent=80, id_col=key).filter("not kept"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to their kinds; n_chars follows the text."""
    redacted = pii.redact(docs)
    return redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else redacted


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents' tokens in sequences of at most 4096. The
    executors' heaps are grown by the stages before, so the workers remember fewer words."""
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"), cache_chunks=200_000)


STAGES = [("quality", quality_stage), ("exact_dedup", exact_stage), ("near_dedup", near_stage), ("pii", pii_stage), ("packing", packing_stage)]

#: No SQL states the classifier and the packing; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch, before = table(spark, sf_dir, "documents"), Scratch(spark), []
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), f"pipeline-{name}")
        scratch.drop(*before)
        before = [f"pipeline-{name}"]
    return STAGES[-1][1](spark, docs, sf_dir)
