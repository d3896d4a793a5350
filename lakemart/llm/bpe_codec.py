"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

A word starts as its bytes. A complete binary tree holds the rank of each
adjacent pair at its leaves and the least rank below at its inner nodes, so the
root says whether a merge is left, and a walk that prefers the left child finds
the leftmost pair of that rank. A merge changes three leaves (the pair itself,
its left neighbour, the pair that vanishes); each is a point update along one
path. The tree of many short words is kept in one array and all of them take a
step at a time; a long word has a tree of its own.

Defined results: null texts count as empty and give no tokens; special strings
inside a text give their id; every row is encoded, repeated rows each on their own.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import ByteVocabulary, ChunkCache
from .common import built, ship_file, slices, texts_of

NONE = np.int32(2**31 - 1)
LONG_WORD = 256      # symbols from which a word gets a tree of its own
TREES = 1 << 20      # leaves handled at a time


class SegmentTreeCodec:
    """Encodes and decodes; keeps the ids of chunks seen in this worker."""

    def __init__(self, text: str, cache_chunks: int = 400_000):
        self.vocab = ByteVocabulary(text)
        self.type = np.uint16 if max(self.vocab.token_bytes) < 2**16 else np.uint32
        self.bytes_to_ids = np.array(self.vocab.byte_id, np.int64)
        keys = np.array([a << 32 | b for a, b, _ in self.vocab.merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([c for _, _, c in self.vocab.merges], np.int64)
        self.rank_of = {(a, b): r for r, (a, b, _) in enumerate(self.vocab.merges)}
        self.special = {t: np.array([i], self.type).tobytes() for t, i in self.vocab.specials.items()}
        self.pieces = self.vocab.token_bytes
        self.cache = ChunkCache(cache_chunks)

    # -- merging ---------------------------------------------------------
    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, NONE where there is none (ids < 0: no symbol)."""
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where((self.keys[at] == wanted) & (left >= 0) & (right >= 0), self.ranks[at], NONE)

    def merge_many(self, words: list[bytes], leaves: int) -> list[bytes]:
        """Ids of words of at most ``leaves`` (a power of two) bytes each."""
        count = len(words)
        lengths = np.fromiter(map(len, words), np.int64, count)
        within = np.arange(leaves) < lengths[:, None]
        symbols = np.full((count, leaves + 1), -1, np.int64)
        symbols[:, :leaves][within] = self.bytes_to_ids[np.frombuffer(b"".join(words), np.uint8)]
        after = np.tile(np.arange(1, leaves + 2), (count, 1))
        before = np.tile(np.arange(-1, leaves), (count, 1))
        tree = np.full((count, 2 * leaves), NONE, np.int32)
        tree[:, leaves:] = self.pair_ranks(symbols[:, :leaves], symbols[:, 1:])
        width = leaves // 2
        while width:
            tree[:, width:2 * width] = np.minimum(tree[:, 2 * width:4 * width:2], tree[:, 2 * width + 1:4 * width:2])
            width //= 2
        # Flat views: one index per word and place. Column ``leaves`` of the
        # linked lists stands for "no symbol".
        t, s, nx, pv = tree.ravel(), symbols.ravel(), after.ravel(), before.ravel()
        live = np.flatnonzero(tree[:, 1] < NONE)
        while live.size:
            roots, base = live * (2 * leaves), live * (leaves + 1)
            top = t[roots + 1]
            node = np.ones(live.size, np.int64)
            for _ in range(leaves.bit_length() - 1):
                node *= 2
                node += t[roots + node] != top
            here = node - leaves
            gone = nx[base + here]
            then = np.minimum(nx[base + gone], leaves)
            left = pv[base + here]
            s[base + here] = self.merged[top]
            s[base + gone] = -1
            nx[base + here] = then
            pv[base + then] = here
            follow = self.pair_ranks(s[base + here], s[base + then])
            lead = np.where(left >= 0, self.pair_ranks(s[base + np.maximum(left, 0)], s[base + here]), NONE)
            # The place before the first symbol has no leaf: its update is
            # sent to the vanished pair's leaf, which is set last.
            nodes = np.stack([here, np.where(left >= 0, left, here), gone]) + leaves
            t[roots + nodes[1]] = lead
            t[roots + nodes[0]] = follow
            t[roots + nodes[2]] = NONE
            while nodes[0, 0] > 1:
                nodes >>= 1
                t[roots + nodes] = np.minimum(t[roots + 2 * nodes], t[roots + 2 * nodes + 1])
            live = live[t[roots + 1] < NONE]
        kept = symbols >= 0
        flat, ends = symbols[kept].astype(self.type), np.cumsum(kept.sum(axis=1))
        raw, size = flat.tobytes(), flat.itemsize
        return [raw[a * size:b * size] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def merge_long(self, word: bytes) -> bytes:
        """The same for one word of any length: O(log n) for each merge."""
        n = len(word)
        leaves = 1 << max(1, (n - 1).bit_length())
        none, rank_of, merged = int(NONE), self.rank_of, self.merged.tolist()
        symbols = [self.vocab.byte_id[b] for b in word]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = [none] * (2 * leaves)
        for i in range(n - 1):
            tree[leaves + i] = rank_of.get((symbols[i], symbols[i + 1]), none)
        for node in range(leaves - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(leaf: int, rank: int) -> None:
            node = leaves + leaf
            tree[node] = rank
            while node > 1:
                node >>= 1
                least = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == least:
                    return
                tree[node] = least

        while (top := tree[1]) < none:
            node = 1
            while node < leaves:
                node *= 2
                if tree[node] != top:
                    node += 1
            here = node - leaves
            gone = after[here]
            then, left = after[gone], before[here]
            symbols[here], symbols[gone] = merged[top], -1
            after[here] = then
            if then < n:
                before[then] = here
            put(here, rank_of.get((symbols[here], symbols[then]), none) if then < n else none)
            put(gone, none)
            if left >= 0:
                put(left, rank_of.get((symbols[left], symbols[here]), none))
        return np.array([x for x in symbols if x >= 0], self.type).tobytes()

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        by_size: dict[int, list[tuple[str, bytes]]] = {}
        out: dict[str, bytes] = {}
        for word in words:
            raw = word.encode()
            if len(raw) > LONG_WORD:
                out[word] = self.merge_long(raw)
            else:
                by_size.setdefault(max(2, 1 << (len(raw) - 1).bit_length()), []).append((word, raw))
        for leaves, group in by_size.items():
            step = max(1, TREES // leaves)
            for i in range(0, len(group), step):
                part = group[i:i + step]
                out.update(zip((w for w, _ in part), self.merge_many([r for _, r in part], leaves)))
        return out

    # -- texts -----------------------------------------------------------
    def encode(self, texts: list[str]) -> list[np.ndarray]:
        self.cache.room()
        seen, special = self.cache.values, self.special
        split = [[(special[p] if is_special else self.vocab.chunks(p)) for p, is_special in self.vocab.segments(t)] for t in texts]
        new: set[str] = set()
        for parts in split:
            for chunks in parts:
                if not isinstance(chunks, bytes):
                    new.update(chunks)
        new.difference_update(seen)
        if new:
            words = {c: self.vocab.words(c) for c in new}
            ids = self.encode_words(list({w for ws in words.values() for w in ws}))
            seen.update((c, ids[ws[0]] if len(ws) == 1 else b"".join([ids[w] for w in ws])) for c, ws in words.items())
        get = seen.__getitem__
        return [np.frombuffer(b"".join([p if isinstance(p, bytes) else b"".join(map(get, p)) for p in parts]), self.type) for parts in split]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.pieces.__getitem__, ids.tolist())).decode("utf-8", "replace")


def codec(shared: Broadcast) -> SegmentTreeCodec:
    return built(shared, "codec", SegmentTreeCodec)


def encode(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>): token ids of each whole text."""
    shared = ship_file(docs.sparkSession, vocabulary_path)

    def run(batches):
        for ids, texts in slices(batches):
            found = codec(shared).encode(texts)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            values = np.concatenate(found).astype(np.int32) if found else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(offsets, values)], ["doc_id", "ids"])

    source = texts_of(docs, id_col, text_col)
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, vocabulary_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text): the text of each list of ids (null: empty). Bytes that
    form no UTF-8 become U+FFFD; an unknown id fails the job."""
    shared = ship_file(encoded.sparkSession, vocabulary_path)

    def run(batches):
        for batch in batches:
            texts = [codec(shared).decode(np.array(x or [], np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    source = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode each text in one pass and keep digests of both:
    (doc_id, n_tokens, ids_sha256, decoded_sha256). The ids digest is over the
    decimal ids joined by commas, the other over the decoded text in UTF-8."""
    shared = ship_file(docs.sparkSession, vocabulary_path)

    def run(batches):
        own = codec(shared)
        names = built(shared, "names", lambda _: [str(i) for i in range(max(own.pieces) + 1)])
        for doc_ids, texts in slices(batches):
            counts, of_ids, of_text = [], [], []
            for ids in own.encode(texts):
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(",".join(map(names.__getitem__, ids.tolist())).encode()).hexdigest())
                of_text.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([doc_ids, pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    source = texts_of(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
