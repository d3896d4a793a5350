"""Shared helpers: table access, scratch tables, per-worker state, Arrow maps."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.session import scratch_path

#: Texts are handled in slices of at most so many rows and characters inside a
#: task; a slice bounds the memory of a worker, not what is processed.
SLICE_ROWS, SLICE_CHARS = 512, 4_000_000
#: Most numbers that ``in_slots`` broadcasts (8 MB).
SLOTS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Place of a public tokenizer file (the default of the path parameters)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def ship_file(spark: SparkSession, path: str) -> Broadcast:
    """Broadcast a vocabulary file read on the driver (a few MB, fixed size).

    The value is a dict, so that a Python worker can keep what it builds from
    the text (tables, word caches) beside it from task to task.
    """
    return spark.sparkContext.broadcast({"text": Path(path).read_text(encoding="utf-8")})


def built(shared: Broadcast, name: str, build: Callable[[str], object]):
    """The object ``build(text)`` of this worker, built once per worker."""
    state = shared.value
    if name not in state:
        state[name] = build(state["text"])
    return state[name]


def texts_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with null texts as empty ones; no other column is read."""
    return df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    """(ids, texts) of at most SLICE_ROWS rows and about SLICE_CHARS characters."""
    for batch in batches:
        start, n = 0, batch.num_rows
        if not n:
            continue
        sizes = pc.binary_length(batch.column(1).fill_null(""))
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
        while start < n:
            base = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, base + SLICE_CHARS, side="right"))
            stop = min(max(stop, start + 1), start + SLICE_ROWS, n)
            part = batch.slice(start, stop - start)
            yield part.column(0), ["" if t is None else t for t in part.column(1).to_pylist()]
            start = stop


class Scratch:
    """Intermediate tables in the shared folder of ``spark.checkpoint.dir``.

    A table is written once and read back, which cuts the lineage: a lost
    executor costs a re-read. ``drop`` removes a table that nothing reads any more.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        self.drop(name)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            if path := self.paths.pop(name, None):
                jvm = self.spark._jvm
                where = jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def slot(*columns: str) -> Column:
    """One of SLOTS numbers from a hash of the columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(SLOTS))


def in_slots(df: DataFrame, wanted: DataFrame, *columns: str, how: str = "left_semi") -> DataFrame:
    """The rows of ``df`` whose slot some row of ``wanted`` has: all the wanted
    rows, and some others. At most SLOTS numbers are broadcast, whatever the
    sizes, so that a wide table is narrowed in its scan and never shuffled."""
    slots = wanted.select(slot(*columns).alias("_slot")).distinct()
    return df.withColumn("_slot", slot(*columns)).join(F.broadcast(slots), "_slot", how).drop("_slot")


def splitmix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a fixed mixing of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
