"""Personal data, licenses, quality and quotes against brute force and fixtures."""

from __future__ import annotations

import itertools
import random
import re

import duckdb
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

import corpus_pipeline
from lakemart.llm import licenses, pii, quality, queries, quotes
from lakemart.llm.common import Scratch
from tests.conftest import SF_CHECK, SF_SMALL

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(t):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    return {"email": [m.span() for m in EMAIL.finditer(t)], "ip": [m.span() for m in IP.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))],
            "card": [m.span() for m in CARD.finditer(t) if 16 <= len(digits(m)) <= 19 and pii.luhn(digits(m))], "phone": [m.span() for m in PHONE.finditer(t) if 8 <= len(digits(m)) <= 15]}


def test_base_spans():
    rnd = random.Random(3)
    for _ in range(20_000):
        t = "".join(rnd.choice("ab@@..-+0123 456()%4444") for _ in range(rnd.randrange(80)))
        assert pii.base_spans(t) == brute_spans(t), t
    for n in (1000, 300_000):  # the plain patterns are quadratic, so only the short ones are compared
        for t in ("é" * n + "a@b.c", "a" * n, "1" * n, "1." * n, "+1" * n, "a@" * n, "4 " * n, "@" * n):
            found = pii.base_spans(t)
            assert n > 1000 or found == brute_spans(t)
    for t in ("", "0001.2.3.255 256.1.1.1 1.2.3.4.5.6.7.8"):
        assert pii.base_spans(t) == brute_spans(t)


def test_loose_spans_touch_no_base_span():
    rnd = random.Random(4)
    for _ in range(5_000):
        t = "".join(rnd.choice(["555-234-1000 ", "+1 988 555 2000", "a@b.c", "1.2.3.4", "joe (AT) b [dot] org ", "9. 8. 7. 6", " ", "4041894974608795", "(555) 234-1000"]) for _ in range(rnd.randrange(8)))
        base = pii.base_spans(t)
        taken = [s for spans in base.values() for s in spans]
        for kind, pattern in pii._LOOSE.items():
            assert pii.loose_spans(t, base)[kind] == [m.span() for m in pattern.finditer(t) if not any(a < m.end() and m.start() < b for a, b in taken)]
    long = "+1 988 555 2000; 555-234-1000; " * 50_000  # a product of both counts would not end
    assert len(pii.loose_spans(long, pii.base_spans(long))["phone"]) == 50_000
    assert pii.loose_spans("JOE (AT) B2 [DOT] ORG", pii.base_spans(""))["email"]


def test_find_and_redact(spark, frame):
    rows = [(i, f"call 555-234-{1000 + i} or +1 (988) 555-{2000 + i}, mail a{i}@b.com") for i in range(40)] + [(100, None), (101, ""), (102, "order 555-234-9999x"), (None, "ip 1.2.3.4"), (5, "twice 4041894974608795"), (5, "twice 4041894974608795")]
    found = pii.find(frame(rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        for s in r.spans:
            assert s.start < s.end
    by = {r.doc_id: r.spans for r in found}
    text = dict(rows)
    assert all([(s.start, s.end) for s in by[i] if s.base and s.kind == k] == brute_spans(text[i])[kind] for i in range(40) for k, kind in enumerate(pii.KINDS))
    assert any(not s.base for s in by[3]) and by[100] == [] and by[101] == []
    clean = {r.doc_id: r.text for r in pii.redact(frame(rows)).collect()}
    assert clean[3] == "call [PHONE] or [PHONE], mail [EMAIL]" and clean[100] is None and clean[5] == "twice [CARD]" and clean[None] == "ip [IP]"
    assert set(pii.redact(frame(rows)).columns) == set(frame(rows).columns)
    assert pii.find(frame([])).collect() == []


def test_reliabilities():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.4
    ballots = np.stack([np.where(rng.random(4000) < 0.1, 0, np.where((rng.random(4000) < a) == truth, 1, -1)) for a in (0.95, 0.8, 0.7, 0.5)], axis=1)
    patterns, counts = np.unique(ballots, axis=0, return_counts=True)
    p, tables, prior = pii.reliabilities(patterns, counts.astype(float))
    assert abs(prior - 0.4) < 0.05 and tables[0, 1, 2] > tables[2, 1, 2] > tables[3, 1, 2]
    best = dict(zip(map(tuple, patterns), p))
    # As good as Bayes' rule with the true reliabilities, within a hundredth.
    log = sum(np.where(ballots[:, k] == 0, 0, ballots[:, k] * np.log(a / (1 - a))) for k, a in enumerate((0.95, 0.8, 0.7, 0.5))) + np.log(0.4 / 0.6)
    optimal = ((log > 0) == truth).mean()
    assert np.mean([(best[tuple(b)] > 0.5) == t for b, t in zip(ballots, truth)]) > optimal - 0.01


def lis(pairs):
    best = [1] * len(pairs)
    for i in range(len(pairs)):
        best[i] = 1 + max((best[j] for j in range(i) if pairs[j][1] < pairs[i][1]), default=0)
    return max(best, default=0)


def brute_align(a, b):
    n = 0
    while a and b and a[0] == b[0]:
        a, b, n = a[1:], b[1:], n + 1
    while a and b and a[-1] == b[-1]:
        a, b, n = a[:-1], b[:-1], n + 1
    pairs = [(i, b.index(w)) for i, w in enumerate(a) if a.count(w) == 1 and b.count(w) == 1]
    return n, lis(pairs), a, b


def test_patience():
    rnd = random.Random(6)
    for _ in range(3000):
        a, b = ([rnd.choice("abcdefghij") for _ in range(rnd.randrange(14))] for _ in range(2))
        found = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in found) and all(x[0] < y[0] and x[1] < y[1] for x, y in zip(found, found[1:]))
        ends, anchors, *_ = brute_align(a, b)
        assert len(found) >= ends + anchors
        pairs = [(i, v) for i, v in enumerate(rnd.sample(range(20), rnd.randrange(12)))]
        assert len(licenses.increasing(pairs)) == lis(pairs)


def test_scan(spark, frame):
    notice = licenses.TEMPLATES["BSD-notice"]
    rows = [(1, "the of in " * 50 + "Licensed under the Apache License, Version 2.0.\nmore"), (2, ("Released under the MIT License. x " * 400)), (3, "License of the under version"), (4, None), (5, ""),
            (6, "a b " + notice.replace("binary", "compiled") + " c"), (7, licenses.TEMPLATES["GPL-3.0-notice"]), (8, "word " * 50_000), (None, notice)]
    got = {r.doc_id: r for r in licenses.scan_licenses(frame(rows)).collect()}
    assert {i: got[i].license for i in got} == {1: "Apache-2.0", 2: "MIT", 3: None, 4: None, 5: None, 6: "BSD-notice", 7: "GPL-3.0-notice", 8: None, None: "BSD-notice"}
    assert got[1].first_word == 150 and 0.9 < got[6].coverage < 1
    assert licenses.scan_licenses(frame([])).collect() == []


def test_scan_seed_outside():
    """The rarest word of the template stands away from the notice, which lacks it."""
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.8)
    scan = lambda t: scanner.best(scanner.scan(t))
    text = "Version 2 was released in May. " + "some words of other matters in between here " * 5 + "Distributed under the MIT License."
    assert scan(text)[:2] == ("MIT", 0.8)
    assert scan(text.replace("released", "out"))[:2] == ("MIT", 0.8)


def test_scan_close_copies():
    """Two copies in one window leave no word of the template unique; the rarest word stands in its middle."""
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.8)
    scan = lambda t: scanner.best(scanner.scan(t))
    far = " some words of other matters in between here" * 5 + " released under the"
    text = "alpha beta gamma delta eps zeta eta theta Released under the MIT License. Released under the MIT License. iota kappa lambda mu nu xi" + far
    assert scan(text) == ("MIT", 1.0, 8, 12)


def test_scan_all(spark, frame):
    """Every notice of a text is reported, the longer one where two overlap."""
    header, notice, mit = (licenses.TEMPLATES[k] for k in ("Apache-2.0-header", "MIT-notice", "MIT"))
    rows = [(1, f"{header} x {notice} y {mit} z {mit}"), (2, mit.replace("Released", "Given") + " and " + licenses.TEMPLATES["CC-BY-NC-4.0"]), (3, "none"), (4, None)]
    got = {r.doc_id: r for r in licenses.scan_licenses(frame(rows)).collect()}
    n, m = len(licenses.words(header)), len(licenses.words(notice))
    assert [tuple(f) for f in got[1].findings] == [("Apache-2.0-header", 1.0, 0, n - 1), ("MIT-notice", 1.0, n + 1, n + m), ("MIT", 1.0, n + m + 2, n + m + 6), ("MIT", 1.0, n + m + 8, n + m + 12)]
    assert [(f.license, f.coverage) for f in got[2].findings] == [("MIT", 0.8), ("CC-BY-NC-4.0", 1.0)]
    assert (got[1].license, got[1].first_word, got[2].license, got[2].coverage) == ("MIT-notice", n + 1, "CC-BY-NC-4.0", 1.0)
    assert got[3].findings == got[4].findings == [] and got[3].license is None


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old = row[:]
        for j, y in enumerate(b):
            row[j + 1] = old[j] + 1 if x == y else max(old[j + 1], row[j])
    return row[-1]


def brute_places(text, template, need):
    """Every window aligned, the strongest and shortest first, none overlapping one before."""
    n = len(template)
    every = [(lcs(text[i:j], template), i, j - 1) for i in range(len(text)) for j in range(i + 1, min(len(text), i + licenses.WIDTH * n) + 1)]
    out = []
    for place in sorted((p for p in every if p[0] >= need), key=lambda p: (-p[0], p[2] - p[1], p[1])):
        if all(place[2] < p[1] or place[1] > p[2] for p in out):
            out.append(place)
    return out


def test_scan_brute():
    rnd, n_places = random.Random(11), 0
    for _ in range(250):
        template = [rnd.choice("abcdefgh") for _ in range(rnd.randrange(1, 7))]
        text = [w for _ in range(rnd.randrange(4)) for w in [rnd.choice("abcdefghxyz") for _ in range(rnd.randrange(6))] + [w for w in template if rnd.random() < 0.9]]
        text += rnd.choices("abcdefghxyz", k=rnd.randrange(5))
        threshold = rnd.choice([0.5, 0.8, 1.0])
        scanner = licenses.Scanner({"t": " ".join(template)}, threshold)
        _, _, need, counts = scanner.templates[0]
        at = {w: [i for i, x in enumerate(text) if x == w] for w in counts if w in text}
        expected = brute_places(text, template, need)
        assert scanner.places(text, at, template, need, counts) == expected, (text, template, threshold)
        n_places += len(expected)
    assert n_places > 200


def test_scan_by_patience():
    """Notices with a tenth of their words changed, dropped or added are found, nearly all by
    patience, and every place equals the strongest one by exact alignment."""
    rnd = random.Random(5)
    filler = "the of and to in a is this that for software license under use".split() + [f"w{i}" for i in range(60)]
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.8)
    for name, template, need, counts in scanner.templates:
        for _ in range(6):
            copy = [rnd.choice(filler) if rnd.random() < 0.07 else w for w in template if rnd.random() > 0.02]
            text = rnd.choices(filler, k=80) + copy + rnd.choices(filler, k=rnd.randrange(3, 90))
            at = {w: [i for i, x in enumerate(text) if x == w] for w in counts if w in text}
            exact = licenses.apart(sorted(licenses.shortest(text, 0, len(text), template, need), key=lambda p: (-p[0], p[2] - p[1], p[1])))
            assert scanner.places(text, at, template, need, counts) == exact, (name, text)
            assert exact or lcs(copy, template) < need
    assert scanner.settled["patience"] > 0.8 * scanner.settled.total() > 40, scanner.settled


def test_common_words():
    rnd = random.Random(8)
    for _ in range(300):
        a, b = (rnd.choices("abcdef", k=rnd.randrange(1, 80)) for _ in range(2))
        assert licenses.common(a, 0, len(a), licenses.bits_of(b), len(b)) == lcs(a, b)


def test_whole_texts():
    """Whole texts win over the opening notices that they hold."""
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.8)
    for name in ("MIT-text", "BSD-2-Clause-text", "ISC-text", "Zlib-text"):
        assert [f[:2] for f in scanner.scan("Copyright 2001 A. Writer " + licenses.TEMPLATES[name] + " end")] == [(name, 1.0)]


def test_quality(spark, frame):
    found = queries.op10_quality(spark, SF_CHECK).toPandas().merge(pd.read_parquet(f"{SF_CHECK}/labels.parquet"), on="doc_id")
    unseen = found[found.held_out]
    assert ((unseen.predicted == 1) == (unseen.quality == 1)).mean() > 0.95 and found.score.between(0, 1).all()
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(3, None), (None, 1), (3, 1)], "doc_id long, quality int").selectExpr("*", "1 as score", "'x' as x")
    docs = [(i, "fine words in a row. " * 20 if i % 2 else "@@## $$$ !! " * 20) for i in range(40)] + [(50, None), (51, ""), (None, "x"), (52, "w " * 100_000), (7, "fine"), (7, "fine")]
    got = quality.classify(frame(docs), labels, features=32).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert all(abs(r.score - 0.5) < 0.01 for r in quality.classify(frame(docs), labels.limit(0), features=8).collect())
    assert quality.classify(frame([]), labels, features=8).collect() == []


def test_isotonic():
    rng = np.random.default_rng(2)
    for _ in range(50):
        values, counts = np.sort(rng.random(12)), rng.integers(1, 5, 12).astype(float)
        means = rng.random(12)
        places, steps = quality.isotonic(values, means * counts, counts)
        assert (np.diff(steps) >= -1e-12).all()
        fitted = np.interp(values, places, steps)
        expected = [max(min((means[i:j + 1] * counts[i:j + 1]).sum() / counts[i:j + 1].sum() for j in range(k, 12)) for i in range(k + 1)) for k in range(12)]
        assert np.allclose(fitted, expected)


def test_quotes(spark):
    rows = [(1, 0, "a", "Hello there.\n\nHow are you?"), (1, 1, "b", "> How are  YOU?\nFine."), (1, 2, "c", "> hello there.\nHi to you too"), (1, 3, "d", "> > How are you?\n> Fine.\nGood."), (1, 4, "e", ">nothing known\nodd"),
            (1, 5, "f", None), (1, 6, "g", "> Good.\n\n> Hi to you too\nmixed"), (2, 0, "a", "x\n> y"), (2, 1, "b", "> x\nz"), (2, 1, "b", "> x\nz"), (2, 3, None, "> z"), (None, 0, "a", "> q\nlone"), (None, 1, "a", "lone"),
            (3, None, "a", "null turn"), (3, 1, "b", "> null turn\n>> deep > mark\nend"), (4, 5000, "a", "far"), (4, 1, "b", "near"), (4, 9000, "c", "> near\nback"), (4, 9001, "c", "> back\nagain")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = quotes.link_quotes(df.selectExpr("*", "1 as rank", "2 as hash", "3 as depth").repartition(3)).toPandas()
    one = got[got.conv_id == 1].set_index("turn")
    assert one.reply_to.tolist()[1:] == [0, 0, 1, 3, 4, 3] and one.depth.tolist() == [0, 1, 1, 2, 3, 4, 3]
    assert one.body.tolist() == ["Hello there.\n\nHow are you?", "Fine.", "Hi to you too", "Good.", "odd", "", "mixed"]
    assert got[got.conv_id == 4].sort_values("turn").reply_to.tolist()[1:] == [0, 0, 2]
    lone = got[got.conv_id.isna()].sort_values("turn")
    assert lone.body.tolist() == ["lone", "lone"] and lone.n_passages.tolist() == [1, 0] and lone.position.tolist() == [0, 0] and lone.reply_to.isna().all()
    got = got[got.conv_id.notna()]
    con = duckdb.connect()
    conversations = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})
    con.register("conversations", conversations[conversations.conv_id.notna()])
    expected = con.sql(quotes.SQL).df()
    key = lambda d: sorted(map(str, d[sorted(d.columns)].astype(object).where(d[sorted(d.columns)].notna(), None).map(lambda x: int(x) if isinstance(x, (float, np.integer)) else x).itertuples(index=False, name=None)))
    assert key(got) == key(expected)
    assert quotes.link_quotes(df.limit(0)).collect() == []
    plan = quotes.link_quotes(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def quoted_sources(texts):
    """For each text the latest earlier one that holds each quoted run, by all runs of its units."""
    clean = lambda t: " ".join(t.lower().split())
    split = lambda t, cut: [c for c in map(clean, re.split(cut, t)) if c]
    blank = r"\n[ \t]*\n\s*"
    bodies, out = [], []
    for text in texts:
        lines = [(x.startswith(">"), x.lstrip("> ")) for x in text.split("\n")]
        found = []
        for mark, group in itertools.groupby(lines, key=lambda x: x[0]):
            run = "\n".join(x for _, x in group)
            if mark and clean(run):
                holds = []
                for k, body in enumerate(bodies):
                    pieces = [clean(body)]
                    for cut in ("\n", blank):
                        parts = split(body, cut)
                        pieces += [" ".join(parts[i:i + n]) for n in {1, len(split(run, cut))} for i in range(len(parts) - n + 1)]
                    holds += [k] * (clean(run) in pieces)
                found.append(max(holds, default=None))
        out.append(found)
        bodies.append("\n".join(x for mark, x in lines if not mark).strip())
    return out


def test_quotes_partial(spark):
    """Some lines of a paragraph and some paragraphs of a body are found."""
    convs = [["one\ntwo\nthree", "between", "> one\n> two\nyes"], ["p1\n\np2\nmore\n\np3", "between", "> p1\n>\n> p2 more\nyes"], ["one\ntwo\nthree", "between", "> one\n> three\nno"]]
    rnd = random.Random(8)
    for _ in range(60):
        texts: list = []
        for _ in range(6):
            body = "".join(rnd.choice("abc") + rnd.choice(["\n", "\n", "\n\n"]) for _ in range(rnd.randrange(1, 6))).strip()
            if texts and rnd.random() < 0.7:
                held = [x for x in rnd.choice(texts).split("\n") if not x.startswith(">")]
                i = rnd.randrange(len(held))
                body = "\n".join("> " + x for x in held[i:i + rnd.randrange(1, 5)]) + "\n" + body
            texts.append(body)
        convs.append(texts)
    df = spark.createDataFrame([(c, t, "a", x) for c, texts in enumerate(convs) for t, x in enumerate(texts)], "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): r for r in quotes.link_quotes(df).collect()}
    assert [got[c, 2].reply_to for c in range(3)] == [0, 0, 1] and [got[c, 2].n_linked for c in range(3)] == [1, 1, 0]
    for c, texts in enumerate(convs):
        for t, found in enumerate(quoted_sources(texts)):
            assert (got[c, t].n_passages, got[c, t].n_linked) == (len(found), sum(x is not None for x in found)), (texts, t)
            if t:
                assert got[c, t].reply_to == max((x for x in found if x is not None), default=t - 1), (texts, t)
    conversations = pd.DataFrame([(c, t, "a", x) for c, texts in enumerate(convs) for t, x in enumerate(texts)], columns=["conv_id", "turn", "role", "text"])
    con = duckdb.connect()
    con.register("conversations", conversations)
    same = lambda *r: tuple(None if x is None else int(x) for x in r)
    expected = con.sql(f"SELECT conv_id, turn, n_passages, n_linked, reply_to, depth FROM ({quotes.SQL})").fetchall()
    assert sorted(same(r.conv_id, r.turn, r.n_passages, r.n_linked, r.reply_to, r.depth) for r in got.values()) == sorted(same(*r) for r in expected)


def test_quotes_long(spark):
    """Half of a body of 4,000 lines is quoted: two rows a line and no string of a run."""
    lines = [f"line {i} of {i % 7}" for i in range(4000)]
    rows = [(1, 0, "a", "\n".join(lines)), (1, 1, "b", "x"), (1, 2, "a", "\n".join("> " + x for x in lines[999:2999]) + "\nyes"), (1, 3, "b", "\n".join("> " + x for x in lines[999:2998]) + "\n> else\nno")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.turn: r for r in quotes.link_quotes(df).collect()}
    assert [(got[t].n_linked, got[t].reply_to) for t in range(4)] == [(0, None), (0, 0), (1, 0), (0, 2)]
    bodies = df.filter("turn = 0").selectExpr("conv_id", "turn as source", "text as body", "array(2000) as lines", "array(1) as paragraphs")
    runs = quotes.run_hashes(bodies, Scratch(spark))
    assert runs.count() == 4000 + 2001 + 1


def test_run_hashes(spark):
    """A run's hash from running sums is the hash of its text, at every place and length."""
    rnd = random.Random(5)
    bodies = [[" ".join(rnd.choice(["a", "b", "\u00e9", "word"]) for _ in range(rnd.randrange(1, 5))) for _ in range(rnd.randrange(1, 9))] for _ in range(20)]
    df = spark.createDataFrame([(1, k, "\n".join(b), list(range(1, 9)), [1]) for k, b in enumerate(bodies)], "conv_id long, source long, body string, lines array<int>, paragraphs array<int>")
    got = {(r.source, r.hash) for r in quotes.run_hashes(df, Scratch(spark)).collect()}
    texts = [(k, " ".join(b[i:j])) for k, b in enumerate(bodies) for i in range(len(b)) for j in range(i + 1, len(b) + 1)]
    direct = spark.createDataFrame(texts, "source long, text string").select("source", "text", quotes.hashed(F.col("text")).alias("hash")).collect()
    assert got == {(r.source, r.hash) for r in direct}
    assert len({r.hash for r in direct}) == len({r.text for r in direct})


def test_quotes_one_conversation(spark):
    """A conversation over several chunks: no join inside it compares all pairs, and all quotes are linked."""
    rnd, n = random.Random(3), 3 * quotes.CHUNK
    source = [None] + [rnd.randrange(t) if rnd.random() < 0.6 else None for t in range(1, n)]
    rows = [(1, t, "a", f"line {t}" if s is None else f"> line {s}\n> common\nline {t}" if t % 2 else f"> line {s}\nline {t}\ncommon") for t, s in enumerate(source)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = quotes.link_quotes(df)
    assert not re.search(r"Join .*\([^)]*(>=|<=|<|>) [^)]*\)", found._jdf.queryExecution().optimizedPlan().toString())
    depth = [0] * n
    for r in sorted(found.collect(), key=lambda r: r.turn):
        t, s = r.turn, source[r.turn]
        holds = s if s is not None and (t % 2 == 0 or (s % 2 == 0 and source[s] is not None)) else None
        assert r.reply_to == (None if t == 0 else t - 1 if holds is None else holds)
        depth[t] = 0 if t == 0 else depth[r.reply_to] + 1
        assert r.depth == depth[t] and r.n_linked == (holds is not None)


def test_oracles(spark):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.sql(f"create view {t} as select * from '{SF_SMALL}/{t}.parquet'")
    for name, sql in queries.ORACLE.items():
        ours, theirs = queries.QUERIES[name](spark, SF_SMALL).toPandas(), con.sql(sql).df()
        cols = sorted(theirs.columns)
        plain = lambda d: sorted(str([None if pd.isna(x) else float(x) if isinstance(x, (int, float, np.number)) and not isinstance(x, (bool, np.bool_)) else x for x in row]) for row in d[cols].itertuples(index=False, name=None))
        assert sorted(ours.columns) == cols and plain(ours) == plain(theirs), name


def test_pipeline(spark, tmp_path):
    """Each stage against its operator's brute force on its own input."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        out.write.parquet(str(tmp_path / name))
        before, docs = docs.toPandas(), spark.read.parquet(str(tmp_path / name))
        after = docs.toPandas()
        if name != "packing":
            assert docs.columns == columns
        if name == "exact_dedup":
            norm = before.text.str.replace("[\x20\x09-\x0d]", "", regex=True)
            best = before.assign(norm=norm, size=-before.text.str.len()).sort_values(["size", "doc_id"]).groupby("norm").doc_id.first()
            assert set(after.doc_id) == set(best)
        elif name == "near_dedup":
            from tests.llm.test_duplicates import brute
            _, expected = brute(list(zip(before.doc_id, before.text)), 5)
            assert set(after.doc_id) == {i for i in before.doc_id if expected[i] == i}
        elif name == "pii":
            assert set(after.doc_id) == set(before.doc_id) and not any(any(brute_spans(t).values()) for t in after.text)
            assert (after.n_chars == after.text.str.len()).all()
        elif name == "quality":
            labels = pd.read_parquet(f"{SF_SMALL}/labels.parquet")
            good = set(labels[labels.quality == 1].doc_id)
            assert len(good & set(after.doc_id)) >= 0.97 * len(good)
        else:
            assert set(after.doc_id) == set(before.doc_id)
            assert after.groupby("sequence_id").length.sum().max() <= 4096
    whole = corpus_pipeline.run(spark, SF_SMALL).toPandas()  # the same stages, one after another
    places = lambda d: sorted(d[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None))
    assert places(whole) == places(after)


def test_pipeline_columns(spark, tmp_path):
    """Stages keep columns of any name, and need none but id and text."""
    spark.createDataFrame([(1, "a b c", 5), (2, "a b c", 6), (3, None, 7)], "doc_id long, text string, _row int").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    for name, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns and sorted(map(tuple, out.collect()), key=str) == sorted([(1, "a b c", 5), (3, None, 7)] + [(2, "a b c", 6)] * (name == "pii"), key=str), name


def test_pipeline_rows(spark, frame):
    """Rows that repeat an id or have none stay or go each by its own text."""
    kept = lambda stage, rows: sorted(((r.doc_id, r.text) for r in stage(spark, frame(rows, extra=False), SF_SMALL).collect()), key=str)
    rows = [(0, "x"), (1, "x"), (1, "a unique text"), (None, "x"), (None, "other"), (None, "other"), (2, "u"), (2, "u")]
    assert kept(corpus_pipeline.exact_stage, rows) == sorted([(0, "x"), (1, "a unique text"), (None, "other"), (2, "u")], key=str)
    long = {k: " ".join(f"{k}{i}" for i in range(60)) for k in "xuo"}
    rows = [(0, long["x"]), (1, long["x"] + " end"), (1, long["u"]), (None, long["x"] + " stop"), (None, long["o"]), (None, long["o"])]
    assert kept(corpus_pipeline.near_stage, rows) == sorted([(0, long["x"]), (1, long["u"]), (None, long["o"])], key=str)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").toPandas()
    after = {i for i, _ in kept(corpus_pipeline.quality_stage, list(docs.itertuples(index=False, name=None)))}
    good, bad = (docs[docs.doc_id.isin(after) == x].iloc[0].text for x in (True, False))
    rows = list(docs.itertuples(index=False, name=None)) + [(-1, good), (-1, bad), (None, good), (None, bad)]
    assert [r for r in kept(corpus_pipeline.quality_stage, rows) if r[0] in (-1, None)] == [(-1, good), (None, good)]


def test_ridge_equals_a_plain_solve(spark):
    """Summed normal equations against one solve over the same rows and features."""
    from lakemart.llm import quality
    rnd = np.random.default_rng(9)
    x = rnd.normal(size=(400, len(quality.STATISTICS))) * rnd.uniform(0.5, 3, len(quality.STATISTICS))
    y = (np.sin(x[:, 0]) + x[:, 1] > 0).astype(float)
    fold = rnd.integers(0, 4, 400)
    train = spark.createDataFrame([(r.tolist(), float(v), int(f)) for r, v, f in zip(x, y, fold)], "x array<double>, y double, fold int").repartition(23)
    model = quality.fit(train, features=40)
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.std, x.std(axis=0))
    z, t = model.map(x[fold != 0]), y[fold != 0]
    weights = np.linalg.solve(z.T @ z / len(z) + 1e-3 * np.eye(z.shape[1]), z.T @ t / len(z))
    assert np.allclose(model.weights, weights, atol=1e-8)
    scores = model.score(x[fold == 0])
    order = np.argsort(model.raw(x[fold == 0]))
    assert (np.diff(scores[order]) >= -1e-12).all()
