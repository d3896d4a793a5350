"""Alignment of two tokenizers' tokens over the same bytes, by interval coalescing.

Both tokenizers cut the same bytes (a space and the text), so a token is an
interval of bytes. All tokens of both kinds are sorted by start (``lexsort``),
a running maximum of ends is taken (``maximum.accumulate``), and a group breaks
where a start reaches that maximum: there both kinds end. Inside a group no two
tokens but the first of each kind start together, so each token after the first
overlaps exactly the token of the other kind that is open at its start: sorted
order alone expands a group of n tokens to its n - 1 links.

How many documents hold an id pair linked is counted over the whole corpus:
tasks number the distinct pairs of a block of documents, the blocks' counts are
summed by pair, and each block gets back the totals of its own pairs. No table
of all pairs is broadcast or collected, and documents meet only their block.

Defined results: null and empty texts, and texts whose joined A or B bytes are
not the space and the text, have no tokens: zeros, no groups and the digest ''.
Special strings inside texts are plain text. Repeated rows, and rows that share
an id or have none, are documents of their own, and are counted as such. Very
long texts are handled whole, one in a slice. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe_codec import SegmentTreeCodec
from .common import Scratch, slices, texts_of

#: A block of documents ends after so many characters: it bounds the memory of
#: a worker and of one group of the last step, not what is processed.
BLOCK_CHARS = 8_000_000
COMMA, BAR, SEMICOLON, END = range(4)


class Piece:
    """The pieces of a sentencepiece model as bytes, and its encoder."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.processor.vocab_size()
        self.token_bytes = [bytes([int(p[3:5], 16)]) if self.processor.is_byte(i) else p.replace("▁", " ").encode()
                            for i, p in enumerate(map(self.processor.id_to_piece, range(size)))]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.processor.encode(texts, num_threads=1)]


class Aligned:
    """The alignment of a slice of texts; places count over the whole slice."""

    def __init__(self, texts: list[str], a: list[np.ndarray], b: list[np.ndarray], sizes: tuple[np.ndarray, np.ndarray]):
        self.n_a, self.n_b = (np.fromiter(map(len, x), np.int64, len(texts)) for x in (a, b))
        self.a, self.b = (np.concatenate([*x, np.empty(0, np.int64)]).astype(np.int64) for x in (a, b))
        size_a, size_b = sizes[0][self.a], sizes[1][self.b]
        starts = np.concatenate([np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b])
        is_b = np.arange(len(starts)) >= len(self.a)
        order = np.lexsort((is_b, starts))
        reach = np.maximum.accumulate(starts[order] + np.concatenate([size_a, size_b])[order])
        first = np.ones(len(order), bool)
        first[1:] = starts[order][1:] >= reach[:-1]
        is_b = is_b[order]
        seen_b = np.cumsum(is_b)
        seen_a = np.arange(1, len(order) + 1) - seen_b
        heads = np.flatnonzero(first)
        #: tokens of each kind in front of each group, and at the end
        self.from_a = np.concatenate([seen_a[heads] - 1, [len(self.a)]])
        self.from_b = np.concatenate([seen_b[heads], [len(self.b)]])
        #: places of the linked tokens
        self.link_a, self.link_b = seen_a[~first] - 1, seen_b[~first] - 1
        self.ends_a, self.ends_b = np.cumsum(self.n_a), np.cumsum(self.n_b)
        #: groups up to the end of each document, and its links
        self.ends = np.searchsorted(self.from_a[:-1], self.ends_a)
        self.n_groups = np.diff(self.ends, prepend=0)
        self.n_links = self.n_a + self.n_b - self.n_groups

    def group_texts(self, names: tuple[list[str], list[str]]) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each document; names: by separator, then id."""
        wide, deep = len(names[0]) // 4, len(names[1]) // 4
        size_a, size_b = np.diff(self.from_a), np.diff(self.from_b)
        mark_a, mark_b = np.full(len(self.a), COMMA), np.full(len(self.b), COMMA)
        mark_a[self.from_a[1:] - 1], mark_b[self.from_b[1:] - 1] = BAR, SEMICOLON
        mark_b[self.ends_b[self.n_b > 0] - 1] = END
        code = np.empty(len(self.a) + len(self.b), np.int64)
        code[np.arange(len(self.a)) + np.repeat(self.from_b[:-1], size_a)] = mark_a * wide + self.a
        code[np.arange(len(self.b)) + np.repeat(self.from_a[1:], size_b)] = len(names[0]) + mark_b * deep + self.b
        parts, out, at = [*map((names[0] + names[1]).__getitem__, code.tolist())], [], 0
        for n in (self.n_a + self.n_b).tolist():
            out.append("".join(parts[at:at + n]))
            at += n
        return out


class Aligner:
    """Encodes with both vocabularies; kept by a worker from task to task."""

    def __init__(self, shared: dict):
        spec = json.loads(shared["text"])
        self.codec = SegmentTreeCodec(json.dumps(spec | {"added_tokens": []}))
        self.piece = Piece(shared["model"])
        a = self.codec.vocab.token_bytes
        self.bytes = [a.get(i, b"") for i in range(max(a) + 1)], self.piece.token_bytes
        self.sizes = tuple(np.fromiter(map(len, x), np.int64, len(x)) for x in self.bytes)
        self.names = tuple([f"{i}{mark}" for mark in (",", "|", ";", "") for i in range(len(x))] for x in self.bytes)
        #: a pair of ids as one number
        self.width = len(self.bytes[1])

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Both encodings; empty where the joined bytes are not those of space and text."""
        raw = [f" {t}" if t else "" for t in texts]
        found = self.codec.encode(raw), self.piece.encode(texts)
        for k, (text, *both) in enumerate(zip(raw, *found)):
            whole = text.encode()
            if any(b"".join(map(table.__getitem__, ids.tolist())) != whole for table, ids in zip(self.bytes, both)):
                found[0][k] = found[1][k] = np.empty(0, np.int64)
        return found

    def align(self, texts: list[str]) -> Aligned:
        return Aligned(texts, *self.encode(texts), self.sizes)


def ship(spark: SparkSession, a_path: str, b_path: str) -> Broadcast:
    """Both vocabulary files (a few MB, fixed size), read on the driver."""
    return spark.sparkContext.broadcast({"text": Path(a_path).read_text(encoding="utf-8"), "model": Path(b_path).read_bytes()})


def _aligner(shared: Broadcast) -> Aligner:
    state = shared.value
    if "aligner" not in state:
        state["aligner"] = Aligner(state)
    return state["aligner"]


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    """Slices of at most a million characters, but for one long text."""
    for ids, texts in slices(batches):
        start = chars = 0
        for k, t in enumerate(texts):
            if k > start and chars + len(t) > 1_000_000:
                yield ids.slice(start, k - start), texts[start:k]
                start, chars = k, 0
            chars += len(t)
        yield ids.slice(start), texts[start:]


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values, kind))


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, a_ids, b_ids, group_a, group_b, link_a, link_b): the ids of both
    tokenizers, the number of tokens of each kind in each group, and the places
    (from 0) of each pair of tokens that overlap."""
    shared = ship(docs.sparkSession, a_path, b_path)

    def run(batches):
        for ids, texts in _small(batches):
            x = _aligner(shared).align(texts)
            of = np.repeat(np.arange(len(texts)), x.n_links)
            yield pa.RecordBatch.from_arrays([
                ids, _lists(x.a, x.n_a, pa.int32()), _lists(x.b, x.n_b, pa.int32()),
                _lists(np.diff(x.from_a), x.n_groups, pa.int32()), _lists(np.diff(x.from_b), x.n_groups, pa.int32()),
                _lists(x.link_a - (x.ends_a - x.n_a)[of], x.n_links, pa.int32()), _lists(x.link_b - (x.ends_b - x.n_b)[of], x.n_links, pa.int32()),
            ], ["doc_id", "a_ids", "b_ids", "group_a", "group_b", "link_a", "link_b"])

    source = texts_of(docs, id_col, text_col)
    lists = ", ".join(f"{c} array<int>" for c in ("a_ids", "b_ids", "group_a", "group_b", "link_a", "link_b"))
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, {lists}")


class _Block:
    """Documents of a block: their distinct pairs and how often each is linked."""

    def __init__(self, number: int):
        self.number, self.rows, self.pairs, self.times, self.chars = number, [], [], [], 0

    def add(self, ids: pa.Array, texts: list[str], x: Aligned, aligner: Aligner) -> None:
        of = np.repeat(np.arange(len(texts)), x.n_links)
        span = len(aligner.bytes[0]) * aligner.width
        keys, times = np.unique(of * span + x.a[x.link_a] * aligner.width + x.b[x.link_b], return_counts=True)
        digests = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in x.group_texts(aligner.names)]
        self.rows.append((ids, x, digests, np.bincount(keys // span, minlength=len(texts))))
        self.pairs.append(keys % span)
        self.times.append(times)
        self.chars += sum(map(len, texts))

    def batches(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        pairs, places, held = np.unique(np.concatenate(self.pairs), return_inverse=True, return_counts=True)
        at = 0
        for (ids, x, digests, distinct), times in zip(self.rows, self.times):
            n, stop = len(ids), at + len(times)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n, self.number)), ids.cast(schema.field("doc_id").type), *(pa.array(c) for c in (x.n_a, x.n_b, x.n_groups, x.n_links)), pa.array(digests, pa.string()),
                _lists(places[at:stop], distinct, pa.int32()), _lists(times, distinct, pa.int32()),
                pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int32()))], schema=schema)
            at = stop
        yield pa.RecordBatch.from_arrays([
            pa.array([self.number]), *(pa.nulls(1, f.type) for f in list(schema)[1:9]),
            _lists(pairs, [len(pairs)], pa.int64()), _lists(held, [len(held)], pa.int32())], schema=schema)


def _totals(left: pa.Table, right: pa.Table) -> pa.Table:
    """A block's documents with the sums over their links."""
    size = len(right)
    counts, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
    place = right.column("place").to_numpy()
    counts[place], best[place] = right.column("documents").to_numpy(), right.column("best").to_numpy()
    pair, times = left.column("pair").combine_chunks(), left.column("times").combine_chunks()
    at, often = pair.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
    ends = np.cumsum(pair.value_lengths().to_numpy())
    out = {c: left.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    for name, value in (("n_best", best), ("count_sum", counts)):
        total = np.concatenate([[0], np.cumsum(often * value[at])])
        out[name] = pa.array(np.diff(total[ends], prepend=0))
    return pa.table(out | {"groups_sha256": left.column("groups_sha256")})


def alignment_statistics(docs: DataFrame, a_path: str, b_path: str, block_chars: int = BLOCK_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256).

    A pair's count is the number of documents that hold it linked; n_best counts
    links whose pair has the highest count of its A id (ties included), count_sum
    sums the counts over the links."""
    spark = docs.sparkSession
    shared, scratch = ship(spark, a_path, b_path), Scratch(spark)
    source = texts_of(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches):
        aligner, number, block = _aligner(shared), TaskContext.get().partitionId() << 32, None
        schema = None
        for ids, texts in _small(batches):
            if schema is None:
                longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
                schema = pa.schema([("block", pa.int64()), ("doc_id", ids.type), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string()),
                                    ("pair", ints), ("times", ints), ("pairs", longs), ("held", ints)])
            block = block or _Block(number)
            block.add(ids, texts, aligner.align(texts), aligner)
            if block.chars >= block_chars:
                yield from block.batches(schema)
                number, block = number + 1, None
        if block:
            yield from block.batches(schema)

    blocks = scratch.table(source.mapInArrow(run, f"block bigint, doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
                                                  "pair array<int>, times array<int>, pairs array<bigint>, held array<int>"), "aligned-blocks")
    seen = (blocks.filter("pairs is not null").select(F.col("block").alias("home"), F.posexplode(F.arrays_zip("pairs", "held")).alias("place", "x"))
            .select("home", "place", F.col("x.pairs").alias("pair"), F.col("x.held").alias("held")))
    width = Piece(shared.value["model"]).processor.vocab_size()
    total = scratch.table(seen.groupBy("pair").agg(F.sum("held").alias("documents")).withColumn("a", F.expr(f"pair div {width}")), "aligned-pairs")
    top = total.groupBy("a").agg(F.max("documents").alias("top"))
    marked = total.join(top, "a").select("pair", "documents", (F.col("documents") == F.col("top")).cast("long").alias("best"))
    back = seen.join(scratch.table(marked, "aligned-best"), "pair").select("home", "place", "documents", "best")
    held = blocks.filter("pairs is null").drop("pairs", "held")
    return held.groupBy("block").cogroup(back.groupBy("home")).applyInArrow(
        _totals, f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")
