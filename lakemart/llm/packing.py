"""Bound-certified best-fit packing of token sequences.

Pieces are spread over partitions of about ``rows_per_part`` pieces by their
row number, so no id can gather rows. Each partition packs its pieces best-fit
decreasing and compares the bins with lower bounds from dual feasible
functions; a partition that meets its bound is certified. Partitions with a
gap hand over their open bins, a few such partitions are joined and packed
again, and the new bins are taken when they are fewer. At last the emptiest
bins of all partitions are pooled in the same way.

Defined results: a null text counts as empty and is one piece (the end token
alone); an empty table gives no row; repeated rows are packed each.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import ChunkCache
from .common import Scratch, built, ship_file, slices, texts_of

# -- tokens ----------------------------------------------------------------
#: A text with any other character, or with "<|", goes to the library whole:
#: for these, lower case, composition and white space agree in every version.
_PLAIN = re.compile("[\\x00\\x02-\\x1b\\x20-\\u02ff\\u2010-\\u2027\\u2030-\\u205e\\u20ac]*")

class WordTokens:
    """Ids of a lower-casing vocabulary as little-endian 32-bit bytes.

    The library's tokens never reach across white space, so each run between
    white space is tokenised once while a worker remembers it. New runs go
    through the library together, with a control character between them whose
    one token cuts their ids apart again. They are normalised already, so they go
    through a copy without the normaliser; the whole library, which texts that are
    not plain need, is built when the first of them comes.
    """

    BETWEEN = "\x01"
    #: Marks that end a word as one run of their own ("'" may begin a contraction).
    MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

    def __init__(self, text: str, cache_chunks: int = 1_000_000):
        self.text, self.library = text, None
        self.words = self._built({**json.loads(text), "normalizer": None})
        (self.cut,) = self.words.encode(self.BETWEEN, add_special_tokens=False).ids
        self.chunks = ChunkCache(cache_chunks)

    @staticmethod
    def _built(spec: dict):
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(json.dumps(spec))
        library.no_truncation()
        library.no_padding()
        return library

    @staticmethod
    def _ids(library, text: str) -> np.ndarray:
        (found,) = library.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, "<u4")

    def whole(self, text: str) -> np.ndarray:
        if self.library is None:
            self.library = self._built(json.loads(self.text))
        return self._ids(self.library, text)

    def _learn(self, chunks: list[str]) -> None:
        for i in range(0, len(chunks), 5000):
            part = chunks[i:i + 5000]
            ids = self._ids(self.words, f" {self.BETWEEN} ".join(part))
            cuts = np.flatnonzero(ids == self.cut)
            if len(cuts) != len(part) - 1:
                raise ValueError("a chunk holds the character that stands between chunks")
            raw = ids.tobytes()
            starts, ends = [0, *(4 * cuts + 4).tolist()], [*(4 * cuts).tolist(), len(raw)]
            self.chunks.values.update(zip(part, [raw[a:b] for a, b in zip(starts, ends)]))

    def encode(self, texts: list[str]) -> list[bytes]:
        self.chunks.room()
        seen = self.chunks.values
        split: list[list[str] | None] = []
        for text in texts:
            if "<|" in text or not _PLAIN.fullmatch(text):
                split.append(None)
            else:
                split.append(unicodedata.normalize("NFC", text).lower().split())
        new = set()
        for chunks in split:
            new.update(chunks or ())
        new.difference_update(seen)
        # A word with marks after it is the word's ids and those of the run of marks.
        marked = {}
        for c in new:
            word = c.rstrip(self.MARKS)
            if len(word) < len(c) and word[-1:].isalpha():
                marked[c] = (word, c[len(word):])
        plain = new.difference(marked)
        for pair in marked.values():
            plain.update(pair)
        self._learn(list(plain.difference(seen)))
        seen.update([(c, seen[word] + seen[marks]) for c, (word, marks) in marked.items()])
        get = seen.__getitem__
        return [self.whole(t).tobytes() if cs is None else b"".join(map(get, cs)) for t, cs in zip(texts, split)]


def token_pieces(docs: DataFrame, vocabulary_path: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
                 with_ids: bool = False, cache_chunks: int = 1_000_000) -> DataFrame:
    """Pieces of at most ``capacity`` ids of each document's ids and the end id:
    doc_id, piece, start, length, ids_crc32 and, if asked for, ids. Only
    documents longer than that are cut. A worker remembers the ids of about
    ``cache_chunks`` runs between white space: memory against time, never results."""
    shared = ship_file(docs.sparkSession, vocabulary_path)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        tokens = built(shared, "words", lambda text: WordTokens(text, cache_chunks))
        for doc_ids, texts in slices(batches):
            rows, piece, start, length, crc, ids = [], [], [], [], [], []
            for row, raw in enumerate(tokens.encode(texts)):
                raw += end
                for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at:at + 4 * capacity]
                    rows.append(row)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            columns = [doc_ids.take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.list_(pa.int32()))] * with_ids, names + ["ids"] * with_ids)

    source = texts_of(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids)


# -- packing ----------------------------------------------------------------
def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset) of each item and the number of bins. Open bins are kept by
    the room they have; a bit mask of rooms in use finds the tightest fit."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, count = 0, 0
    for item, size in zip(order.tolist(), lengths[order].tolist()):
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            own = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, own, count = capacity, count, count + 1
        bins[item], offsets[item] = own, capacity - room
        if room > size:
            by_room[room - size].append(own)
            rooms |= 1 << (room - size)
    return bins, offsets, count


def bin_bound(lengths: np.ndarray, capacity: int, steps: int = 20) -> int:
    """Lower bound on the bins: the best of two families of dual feasible
    functions over the histogram of lengths (any packing's images add up to at
    most one bin's worth). The first rounds sizes over ``capacity - p`` up to a
    whole bin and drops those under ``p``; the second rounds to multiples of 1/k."""
    if not len(lengths):
        return 0
    histogram = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    sizes = np.arange(capacity + 1, dtype=np.int64)
    counts = np.concatenate([[0], np.cumsum(histogram)])
    totals = np.concatenate([[0], np.cumsum(histogram * sizes)])
    p = np.arange(0, capacity // 2 + 1)
    whole = counts[capacity + 1] - counts[capacity - p + 1]
    kept = totals[capacity - p + 1] - totals[p]
    best = int(np.max(-(-(whole * capacity + kept) // capacity)))
    for k in range(1, steps + 1):
        scaled = (k + 1) * sizes
        image = np.where(scaled % capacity == 0, sizes * k, scaled // capacity * capacity)
        best = max(best, -(-int((histogram * image).sum()) // (k * capacity)))
    return best


def _pack_group(round_no: int, capacity: int):
    """Packs a group anew; if it came with bins and they are no more, those stay."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lengths = pdf["length"].to_numpy(np.int64)
        bins, offsets, count = best_fit_decreasing(lengths, capacity)
        known = pdf["sequence_id"].to_numpy()
        if round_no and len(np.unique(known)) <= count:
            ids, offsets, count = known.astype(np.int64), pdf["offset"].to_numpy(np.int64), len(np.unique(known))
        else:
            ids = (np.int64(round_no) << 58) + (pdf["part"].to_numpy(np.int64) << 28) + bins
        _, which = np.unique(ids, return_inverse=True)
        fill = np.bincount(which, weights=lengths).astype(np.int64)
        return pdf.assign(sequence_id=ids, offset=offsets, fill=fill[which], gap=count - bin_bound(lengths, capacity))

    return run


def pack(pieces: DataFrame, capacity: int = 4096, rows_per_part: int = 20_000, parts_joined: int = 4, rounds: int = 3) -> DataFrame:
    """``pieces`` (with ``length`` from 1 to ``capacity``) plus sequence_id and
    offset. Only single numbers (rows, parts with a gap) reach the driver."""
    spark = pieces.sparkSession
    scratch = Scratch(spark)
    names = pieces.columns
    rows = scratch.table(pieces.withColumn("row", F.monotonically_increasing_id()), "pack-pieces")
    parts = max(1, -(-rows.count() // rows_per_part))
    rows = rows.withColumns({"part": F.pmod(F.xxhash64("row"), F.lit(parts)), "sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    schema = rows.withColumns({"fill": F.lit(0).cast("long"), "gap": F.lit(0).cast("long")}).schema
    packed = scratch.table(rows.groupBy("part").applyInPandas(_pack_group(0, capacity), schema), "pack-0")

    def again(packed: DataFrame, open_rows, round_no: int, groups: int) -> DataFrame:
        """Packs the rows that ``open_rows`` names again, in ``groups`` groups."""
        moved = packed.filter(open_rows).withColumn("part", F.pmod(F.xxhash64("part", F.lit(round_no)), F.lit(groups)))
        anew = moved.drop("fill", "gap").groupBy("part").applyInPandas(_pack_group(round_no, capacity), schema)
        out = scratch.table(packed.filter(~open_rows).withColumn("gap", F.lit(0).cast("long")).unionByName(anew), f"pack-{round_no}")
        scratch.drop(f"pack-{round_no - 1}")
        return out

    for round_no in range(1, rounds + 1):
        gaps = packed.filter("gap > 0").select("part").distinct().count()
        if not gaps:
            round_no -= 1
            break
        packed = again(packed, (F.col("gap") > 0) & (F.col("fill") < capacity), round_no, max(1, -(-gaps // parts_joined)))
    if parts > 1:
        # Bins under half full: every partition leaves one at most when certified.
        tails = packed.filter(F.col("fill") <= capacity // 2).count()
        packed = again(packed, F.col("fill") <= capacity // 2, round_no + 1, max(1, -(-tails // rows_per_part)))
    return packed.select(*names, "sequence_id", "offset")


def pack_documents(docs: DataFrame, vocabulary_path: str, capacity: int = 4096, end_id: int = 1, rows_per_part: int = 20_000, with_ids: bool = False,
                   cache_chunks: int = 1_000_000) -> DataFrame:
    """Tokenises, cuts and packs: one row per piece with its sequence and place."""
    return pack(token_pieces(docs, vocabulary_path, capacity, end_id, with_ids=with_ids, cache_chunks=cache_chunks), capacity, rows_per_part)
