"""Token counts by heap-and-linked-list byte-pair merging.

A word is a doubly linked list of symbols and a heap of its adjacent pairs by
(rank, place). Popping the least pair merges it and pushes the two pairs that
the merge makes; entries whose pair has changed meanwhile are skipped. A word's
count is its first symbols less its merges; no ids are emitted.

Defined results: null texts count as empty (0 bytes, 0 tokens); a special
string inside a text is one token; repeated rows are counted each.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import ByteVocabulary, ChunkCache
from .common import built, ship_file, slices, texts_of


class HeapCounter:
    """Counts tokens; keeps the counts of chunks and words seen in this worker."""

    def __init__(self, text: str, cache_chunks: int = 600_000):
        self.vocab = ByteVocabulary(text)
        #: pair of ids -> rank above the merged id, in one number
        self.pairs = {a << 32 | b: rank << 32 | c for rank, (a, b, c) in enumerate(self.vocab.merges)}
        self.chunks, self.words = ChunkCache(cache_chunks), ChunkCache(cache_chunks)

    def merges(self, word: bytes) -> int:
        """How many merges the word takes until no pair has a rank."""
        pairs, n = self.pairs, len(word)
        symbols = [self.vocab.byte_id[b] for b in word]
        current = [pairs.get(a << 32 | b, -1) for a, b in zip(symbols, symbols[1:])]
        current.append(-1)
        heap = [(pair, i) for i, pair in enumerate(current) if pair >= 0]
        heapify(heap)
        after, before, done = list(range(1, n + 1)), list(range(-1, n - 1)), 0
        while heap:
            pair, here = heappop(heap)
            if current[here] != pair:
                continue
            done += 1
            gone = after[here]
            then, left = after[gone], before[here]
            merged = symbols[here] = pair & 0xFFFFFFFF
            current[gone] = -1
            after[here] = then
            follow = -1
            if then < n:
                before[then] = here
                follow = pairs.get(merged << 32 | symbols[then], -1)
                if follow >= 0:
                    heappush(heap, (follow, here))
            current[here] = follow
            if left >= 0:
                lead = current[left] = pairs.get(symbols[left] << 32 | merged, -1)
                if lead >= 0:
                    heappush(heap, (lead, left))
        return done

    def of_word(self, word: str) -> int:
        known = self.words.values.get(word)
        if known is None:
            raw = word.encode()
            known = self.words.values[word] = len(raw) - (self.merges(raw) if len(raw) > 1 else 0)
        return known

    def count(self, texts: list[str]) -> list[int]:
        self.chunks.room()
        self.words.room()
        seen, out = self.chunks.values, []
        for text in texts:
            total = 0
            for part, is_special in self.vocab.segments(text):
                if is_special:
                    total += 1
                    continue
                chunks = self.vocab.chunks(part)
                try:
                    total += sum(map(seen.__getitem__, chunks))
                except KeyError:
                    for chunk in set(chunks).difference(seen):
                        seen[chunk] = sum(map(self.of_word, self.vocab.words(chunk)))
                    total += sum(map(seen.__getitem__, chunks))
            out.append(total)
        return out


def count_tokens(docs: DataFrame, vocabulary_path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit): UTF-8 bytes and tokens of each
    whole text; over_limit says that there are more than ``limit`` tokens."""
    shared = ship_file(docs.sparkSession, vocabulary_path)

    def run(batches):
        counter = built(shared, "counter", HeapCounter)
        for ids, texts in slices(batches):
            n = counter.count(texts)
            yield pa.RecordBatch.from_arrays([ids, pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                                             ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    source = texts_of(docs, id_col, text_col)
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, n_bytes bigint, n_tokens bigint, over_limit boolean")
