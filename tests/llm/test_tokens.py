"""Encoding, counting and packing against the tokenizers library and exact bounds."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakemart.llm import bpe_codec, packing, token_counts
from lakemart.llm.common import vocabulary

BYTE, WORD = vocabulary("byte_bpe_50k.json"), vocabulary("word_bpe_49k.json")
ODD = ["", " ", "a<|endoftext|>b  <|endoftext|>\n", "<|ENDOFTEXT|>", "  x\n\n y", "É" * 300, "ab" * 3000, "日本語 テキスト", "💩💩 it's WE'LL",
       "\x1c a\x1d", "a\x01b \x01", "x" * 700 + " y", "J̌ İ ß ΑΣ", "\x85a\xa0b", "word, word. word,. word's, 1, 2.", "a" * 20_000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)


@pytest.fixture(scope="module")
def own():
    text = open(BYTE, encoding="utf-8").read()
    return bpe_codec.SegmentTreeCodec(text), token_counts.HeapCounter(text), packing.WordTokens(open(WORD, encoding="utf-8").read())


def same(texts, library, own):
    expected = [e.ids for e in library[0].encode_batch(texts, add_special_tokens=False)]
    ids = own[0].encode(texts)
    assert [x.tolist() for x in ids] == expected
    assert own[1].count(texts) == [len(x) for x in expected]
    assert [own[0].decode(x) for x in ids] == [library[0].decode(x, skip_special_tokens=False) for x in expected]
    expected = [np.array(e.ids, "<u4").tobytes() for e in library[1].encode_batch(texts, add_special_tokens=False)]
    assert own[2].encode(texts) == expected


def test_odd_texts(library, own):
    same(ODD, library, own)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("aAeE '\n\t.,!")), max_size=60), min_size=1, max_size=5))
def test_any_text(library, own, texts):
    same(texts, library, own)


def test_queries_rows(spark, frame, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100, None), (3, "again"), (3, "again"), (None, "no id")]
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe_codec.round_trip(frame(rows), BYTE).collect()}
    expected = set()
    for i, t in rows:
        ids = library[0].encode(t or "", add_special_tokens=False).ids
        expected.add((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == expected
    counts = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(frame(rows), BYTE).collect()), key=str)
    assert counts == sorted(((i, len((t or "").encode()), n := len(library[0].encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t in rows), key=str)
    encoded = bpe_codec.encode(frame(rows), BYTE)
    assert sorted(r.text for r in bpe_codec.decode(encoded, BYTE).collect()) == sorted(t or "" for _, t in rows)
    assert bpe_codec.round_trip(frame([]), BYTE).collect() == [] and token_counts.count_tokens(frame([]), BYTE).collect() == []


def test_best_fit_and_bounds():
    rnd = random.Random(4)
    for _ in range(200):
        sizes = np.array([rnd.randint(1, 20) for _ in range(rnd.randint(0, 9))], np.int64)
        bins, offsets, count = packing.best_fit_decreasing(sizes, 20)
        fill = [0] * count
        for size, own_bin in sorted(zip(sizes, bins), reverse=True):
            fill[own_bin] += size
        assert max(fill, default=0) <= 20 and set(bins) == set(range(count))
        for b in range(count):
            placed = sorted((o, s) for o, s, x in zip(offsets, sizes, bins) if x == b)
            assert all(o == sum(s for _, s in placed[:k]) for k, (o, _) in enumerate(placed))

        def least(rest, rooms):
            if not rest:
                return len(rooms)
            tries = [least(rest[1:], rooms[:i] + [r - rest[0]] + rooms[i + 1:]) for i, r in enumerate(rooms) if r >= rest[0]]
            return min([least(rest[1:], [*rooms, 20 - rest[0]]), *tries]) if len(rooms) < count else min(tries, default=99)

        assert packing.bin_bound(sizes, 20) <= least(sorted(sizes.tolist(), reverse=True), []) <= count


def test_pack_documents(spark, frame, library):
    rnd = random.Random(5)
    words = ["alpha", "Beta", "gamma,", "delta.", "42"]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 60)))) for i in range(300)] + [(900, None), (901, ""), (902, "long " * 500), (700, "twice"), (700, "twice"), (None, "x")]
    for per_part in (10_000, 40):
        packed = packing.pack_documents(frame(rows), WORD, capacity=64, rows_per_part=per_part, with_ids=True).collect()
        bins, documents = {}, {}
        for r in packed:
            bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
            documents.setdefault(r.doc_id, []).append(r)
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length and 0 < r.length <= 64
        for places in bins.values():
            places.sort()
            assert all(o == sum(n for _, n in places[:k]) for k, (o, _) in enumerate(places)) and sum(n for _, n in places) <= 64
        for i, t in rows:
            if i not in (700, None):
                pieces = sorted(documents[i], key=lambda r: r.piece)
                assert [x for r in pieces for x in r.ids] == [*library[1].encode(t or "", add_special_tokens=False).ids, 1]
                assert [r.start for r in pieces] == [64 * k for k in range(len(pieces))] and all(r.length == 64 for r in pieces[:-1])
        assert len(documents[700]) == 2 and len(documents[None]) == 1
        bound = packing.bin_bound(np.array([r.length for r in packed]), 64)
        assert bound <= len(bins) <= bound + (2 if per_part > 100 else 6)
    assert packing.pack_documents(frame([]), WORD).collect() == []


def test_marks_after_a_word_are_learnt_apart_from_it(monkeypatch):
    """A word is learnt once, whatever marks follow it; ids stay the library's."""
    import random

    import numpy as np
    from tokenizers import Tokenizer

    from lakemart.llm import packing
    from lakemart.llm.common import vocabulary

    path = vocabulary("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    words = packing.WordTokens(open(path, encoding="utf-8").read())
    learnt, learn = [], words._learn
    monkeypatch.setattr(words, "_learn", lambda chunks: learnt.extend(chunks) or learn(chunks))
    words.encode(["Hafen*** hafen!? hafen, (hafen) hafen"])
    assert sorted(learnt) == sorted([")", "!?", "(hafen", "***", ",", "hafen"])
    rng = random.Random(5)
    texts = ["".join(rng.choices("abİßéÉsStTd12''.,;!?*$_-<|>()\"\\@&§ª \t\n ", k=rng.randint(0, 40))) for _ in range(3000)]
    expected = [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    assert words.encode(texts) == expected
