"""The Merkle manifest and the alignment of tokenizers against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakemart.llm import alignment, manifest
from lakemart.llm.common import vocabulary

BYTE, PIECE = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
ODD = ["", " ", "a<|endoftext|>b", "<s>x</s><unk><0x41>", "  x\n\n y", "É" * 90, "ab" * 900, "日本語 テキスト", "💩💩 it's WE'LL", "a▁b", "▁",
       "\x00a", "x" * 700 + " y", "J̌ İ ß ΑΣ", "\x85a\xa0b", "word, word. word's, 1, 2.", "\r\n\t "]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    """(root, siblings of each node level by level) by the plain definition."""
    proofs, places, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for k, at in enumerate(places):
            run = level[at // 16 * 16:at // 16 * 16 + 16]
            proofs[k].append(("".join(run[:at % 16]), "".join(run[at % 16 + 1:])))
        level, places = [h(*level[i:i + 16]) for i in range(0, len(level), 16)], [p // 16 for p in places]
    return level[0], proofs


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, proof) of (doc_id, source, lang, n_chars, text) rows."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    by: dict = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, h(*map(field, r)), r[0]))
    groups = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree([x[2] for x in sorted(by[g], key=lambda x: x[:3])]) for g in groups]
    root, upper = tree([t[0] for t in trees])
    return sorted(((x[3], x[2], sub, root, [*p, *u]) for g, (sub, proofs), u in zip(groups, trees, upper) for x, p in zip(sorted(by[g], key=lambda x: x[:3]), proofs)), key=str)


def documents(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    for name in ("grp", "ord", "node", "row", "at", "part", "n", "pos", "block", "proof", "root", "members", "level0", "upper"):
        df = df.selectExpr("*", f"'clash' as {name}")
    return df.repartition(7)


def found(df):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, [tuple(s) for s in r.proof]) for r in df.collect()), key=str)


def test_manifest_shapes(spark):
    rows = [(i, "big", "en", 3, f"text {i}") for i in range(4500)]  # more than 16 blocks: three rounds
    rows += [(10_000 + i, "run", None, i, "É") for i in range(16)] + [(20_000 + i, "run and one", "en", None, None) for i in range(17)]
    rows += [(30_000 + i, f"s{i}", "en", 1, "x") for i in range(300)]  # more sources than a block
    rows += [(1, None, "en", 1, ""), (None, None, None, None, None), (2, "", "en", 1, "a"), (7, "twice", "en", 1, "a"), (7, "twice", "en", 1, "a"), (7, "twice", "en", 1, "b"), (5, "é", "", -1, "long " * 50_000)]
    random.Random(3).shuffle(rows)
    got = manifest.manifest(documents(spark, rows))
    assert found(got) == plain_manifest(rows)
    assert got.filter(manifest.fold(got["leaf"], got["proof"]) != got["root"]).count() == 0
    changed = got.filter(manifest.fold(manifest.digest(got["leaf"]), got["proof"]) == got["root"])
    assert changed.count() == 0  # another leaf never folds to the root


@pytest.mark.parametrize("n", [0, 1, 256, 257])
def test_manifest_sizes(spark, n):
    rows = [(i, "a", "en", i, str(i)) for i in range(n)]
    assert found(manifest.manifest(documents(spark, rows))) == (plain_manifest(rows) if rows else [])


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner({"text": open(BYTE, encoding="utf-8").read(), "model": open(PIECE, "rb").read()})


@pytest.fixture(scope="module")
def library():
    a = Tokenizer.from_file(BYTE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECE)


def plain_alignment(text, library, aligner):
    """(a ids, b ids, groups, links by place) with every pair of tokens compared."""
    if not text:
        return [], [], [], []
    a, b = library[0].encode(" " + text, add_special_tokens=False).ids, library[1].encode(text)
    spell = lambda ids, table: [table[i] for i in ids]
    parts = spell(a, aligner.bytes[0]), spell(b, aligner.bytes[1])
    if any(b"".join(x) != (" " + text).encode() for x in parts):
        return [], [], [], []
    ends = [np.cumsum([len(x) for x in p]).tolist() for p in parts]
    spans = [list(zip([0, *e[:-1]], e)) for e in ends]
    links = [(i, j) for i, (s, e) in enumerate(spans[0]) for j, (t, f) in enumerate(spans[1]) if s < f and t < e]
    groups, low = [], 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        groups.append(tuple([i for i, (s, e) in zip(ids, span) if low <= s and e <= cut] for ids, span in zip((a, b), spans)))
        low = cut
    return a, b, groups, links


def groups_text(groups):
    return ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


def same(texts, library, aligner):
    x = aligner.align(texts)
    lines, at = x.group_texts(aligner.names), 0
    for k, text in enumerate(texts):
        a, b, groups, links = plain_alignment(text, library, aligner)
        assert (x.n_a[k], x.n_b[k], x.n_groups[k], x.n_links[k]) == (len(a), len(b), len(groups), len(links)), text
        assert lines[k] == groups_text(groups)
        own = slice(at, at + len(links))
        assert sorted(zip((x.link_a[own] - (x.ends_a - x.n_a)[k]).tolist(), (x.link_b[own] - (x.ends_b - x.n_b)[k]).tolist())) == sorted(links)
        at += len(links)
    assert at == len(x.link_a)


def test_odd_alignments(library, aligner):
    same(ODD, library, aligner)
    same([], library, aligner)
    same(["", ""], library, aligner)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("aAeErtio '\n\t.,!1")), max_size=60), min_size=1, max_size=4))
def test_any_alignment(library, aligner, texts):
    same(texts, library, aligner)


def test_alignment_statistics(spark, frame, library, aligner):
    words = ["the", "tokenizer", "alignment", "of", "Überraschung", "1234", "foo_bar()", "it's", "💩", "a▁b"]
    rnd = random.Random(8)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100 + i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 40)))) for i in range(120)]
    rows += [(500, None), (501, ""), (7, "again the"), (7, "again the"), (None, "no id of the"), (600, "the " * 3000)]
    plain = [(i, *plain_alignment(t or "", library, aligner)) for i, t in rows]
    count, top = Counter(), Counter()
    for _, a, b, _, links in plain:
        count.update({(a[i], b[j]) for i, j in links})
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    expected = []
    for i, a, b, groups, links in plain:
        pairs = [(a[x], b[y]) for x, y in links]
        digest = h(groups_text(groups)) if a else ""
        expected.append((i, len(a), len(b), len(groups), len(links), sum(count[p] == top[p[0]] for p in pairs), sum(count[p] for p in pairs), digest))
    for chars in (200, 8_000_000):
        got = alignment.alignment_statistics(frame(rows), BYTE, PIECE, block_chars=chars)
        assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(expected, key=str)
    assert alignment.alignment_statistics(frame([]), BYTE, PIECE).collect() == []
    assert alignment.alignment_statistics(frame([(1, None), (2, "")]), BYTE, PIECE).collect() != []
    real = {r.doc_id: r for r in alignment.align(frame([r for r in rows if r[0] not in (7, None)]), BYTE, PIECE).collect()}
    for i, a, b, groups, links in plain:
        if i not in (7, None):
            assert (real[i].a_ids, real[i].b_ids) == (a, b) and sorted(zip(real[i].link_a, real[i].link_b)) == sorted(links)
            assert (real[i].group_a, real[i].group_b) == ([len(g[0]) for g in groups], [len(g[1]) for g in groups])
