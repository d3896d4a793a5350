"""Personal data by weak supervision.

Candidate spans come from strict patterns (the base spans, always kept) and
from loose ones (national phone numbers, spelled-out mail addresses, short
cards, spaced IPs). Labelers vote +1, -1 or 0 on each candidate: the strict
pattern with its check, the loose pattern's own check, gazetteers of top-level
domains, card issuers and dialling rules, cue words before the span, and the
characters that touch it. Expectation-maximisation over the counts of vote
patterns of all documents estimates each labeler's reliability for each kind;
the posteriors are the soft labels of a logistic classifier over span features,
which decides about the loose candidates.

Vote and feature patterns are small tuples of levels, so their counts are
bounded by the code (not by the data): only these counts reach the driver.

Defined results: a null text counts as empty and has no spans; places are code
points, end exclusive; spans of one kind do not overlap; repeated rows are
searched each.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, slices, texts_of

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("strict", "check", "gazetteer", "context", "edges")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[^A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# Loose forms; none of the mail kind stands in a text without its marked "at"
_AT = re.compile(r"[(\[]at[)\]]", re.I)
_LOOSE = {
    "email": re.compile(r"\b[a-z0-9._]{2,40} ?[(\[]at[)\]] ?[a-z0-9-]{2,40} ?[(\[]dot[)\]] ?[a-z]{2,10}\b", re.I),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?: \. ?|\[\.\])[0-9]{1,3}(?: \. ?|\[\.\])[0-9]{1,3}(?: \. ?|\[\.\])[0-9]{1,3}(?![0-9.])"),
    "card": re.compile(r"(?<![0-9.+-])[0-9]{4}[ -]?[0-9]{6}[ -]?[0-9]{5}(?![0-9-])"),
    "phone": re.compile(r"(?<![0-9+().-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])"),
}
# Gazetteers of the labelers.
DOMAINS = frozenset("com org net edu gov mil int info biz io co uk de fr es it nl eu us ca au ch at be se no dk fi pl pt br mx ar in jp cn ru kr za example test".split())
CUES = {
    "email": frozenset("email e-mail mail contact write reply address courriel correo".split()),
    "ip": frozenset("ip host server address addr client from router login ssh ping".split()),
    "card": frozenset("card visa mastercard amex credit debit payment cc karte carte tarjeta".split()),
    "phone": frozenset("phone tel call mobile cell fax telephone telefon contact whatsapp sms".split()),
}
DENIALS = frozenset("version release section chapter isbn order invoice sku part page serial model article".split())
_WORDS = re.compile(r"[^\W\d_][\w-]*")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _parts_fit(text: str) -> bool:
    return all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in re.findall("[0-9]+", text))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Addresses from each @ outwards: the run before it, cut at the last span's
    end, and the longest domain after it. Linear in the text."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and not _LOCAL_END.match(text, start - 1):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The strict spans of each kind, leftmost and without overlap; a match
    that fails its check is dropped and not tried in another way."""
    return {
        "email": list(emails(text)) if "@" in text else [],
        "ip": [m.span() for m in _IP.finditer(text) if _parts_fit(m.group())],
        "card": [m.span() for m in _CARD.finditer(text) if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m.group())) <= 19 and luhn(d)],
        "phone": [m.span() for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15] if "+" in text else [],
    }


def loose_spans(text: str, base: dict[str, list[tuple[int, int]]]) -> dict[str, list[tuple[int, int]]]:
    """Loose candidates that touch no base span of any kind."""
    taken = sorted(s for spans in base.values() for s in spans)
    starts = [a for a, _ in taken]
    reach = list(accumulate((b for _, b in taken), max))  # how far the spans up to each one go

    def free(start: int, end: int) -> bool:
        before = bisect_left(starts, end)
        return not before or reach[before - 1] <= start

    return {kind: [m.span() for m in pattern.finditer(text) if free(*m.span())] if kind != "email" or _AT.search(text) else [] for kind, pattern in _LOOSE.items()}


def votes(text: str, kind: str, start: int, end: int, strict: bool) -> list[int]:
    """One vote of each labeler."""
    span, digits = text[start:end], _digits(text[start:end])
    if kind == "email":
        tail = re.split(r"[^A-Za-z]+", span)[-1].lower()
        check, known = (1 if 2 <= len(tail) <= 10 else -1), (1 if tail in DOMAINS else -1)
    elif kind == "ip":
        check, known = (1 if _parts_fit(span) else -1), (-1 if span.startswith(("0", "255")) else 0)
    elif kind == "card":
        check, known = (1 if luhn(digits) else -1), (1 if digits[:1] in "3456" or digits[:1] == "2" else -1)
    else:
        area = digits[-10:-7]
        check = 1 if 8 <= len(digits) <= 15 else -1
        known = 1 if area[:1] > "1" and digits[-7:-6] > "1" else -1
    before = [w.lower() for w in _WORDS.findall(text, max(0, start - 40), start)][-4:]
    context = 1 if CUES[kind].intersection(before) else -1 if DENIALS.intersection(before) else 0
    around = text[max(0, start - 1):start] + text[end:end + 1]
    edges = -1 if any(c.isalnum() or c in "@_/#" for c in around) else 1
    return [1 if strict else 0, check, known, context, edges]


def features(text: str, kind: str, start: int, end: int) -> list[int]:
    """Levels of the classifier's inputs: length, digits, separators, case, the
    characters on both sides, and a cue or denial before the span."""
    span = text[start:end]
    digits = len(_digits(span))
    before = [w.lower() for w in _WORDS.findall(text, max(0, start - 40), start)][-4:]
    side = lambda c: 0 if not c else 1 if c.isspace() else 2 if c.isalnum() else 3
    return [
        KINDS.index(kind), min(4, (end - start) // 8), min(5, digits // 4), min(3, sum(not c.isalnum() for c in span) // 2),
        int(span[:1] in "+("), side(text[start - 1:start] if start else ""), side(text[end:end + 1]),
        1 if CUES[kind].intersection(before) else 2 if DENIALS.intersection(before) else 0,
    ]


_LEVELS = (len(KINDS), 5, 6, 4, 2, 4, 4, 3)
CANDIDATE = "struct<kind:int,start:int,end:int,base:boolean,votes:array<int>,features:array<int>>"


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): the candidates of each whole text with votes and features."""
    def run(batches):
        kind_type = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("votes", pa.list_(pa.int32())), ("features", pa.list_(pa.int32()))])
        for ids, texts in slices(batches):
            rows = []
            for text in texts:
                base = base_spans(text)
                loose = loose_spans(text, base)
                rows.append([{"kind": k, "start": a, "end": b, "base": strict, "votes": votes(text, kind, a, b, strict), "features": features(text, kind, a, b)}
                             for k, kind in enumerate(KINDS) for strict, group in ((True, base), (False, loose)) for a, b in group[kind]])
            yield pa.RecordBatch.from_arrays([ids, pa.array(rows, pa.list_(kind_type))], ["doc_id", "spans"])

    source = texts_of(docs, id_col, text_col)
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, spans array<{CANDIDATE}>")


def reliabilities(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, float]:
    """Expectation-maximisation over vote patterns (rows of -1, 0, 1) with their
    counts: (posteriors, P(vote | truth) as labelers x 2 x 3, prior). Starts
    from the share of positive votes; counts are smoothed by one of each."""
    p = (0.5 + patterns.sum(axis=1)) / (1 + np.abs(patterns).sum(axis=1))
    p = np.clip(0.5 + p / 2 * 0.9, 0.05, 0.95)
    hits = np.stack([patterns == v for v in (-1, 0, 1)])
    tables, prior = np.zeros((patterns.shape[1], 2, 3)), 0.5
    for _ in range(rounds):
        weight = np.stack([counts * (1 - p), counts * p])
        tables = np.einsum("tr,vrl->ltv", weight, hits.astype(float)) + 1
        tables /= tables.sum(axis=2, keepdims=True)
        prior = (weight[1].sum() + 1) / (weight.sum() + 2)
        chosen = tables[np.arange(patterns.shape[1])[None, :], :, patterns + 1]
        log = np.log(chosen).sum(axis=1) + np.log([1 - prior, prior])
        p = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -50, 50)))
    return p, tables, prior


def one_hot(levels: np.ndarray) -> np.ndarray:
    """Features crossed with nothing: one column for each level, and a constant."""
    starts = np.cumsum([0, *_LEVELS[:-1]])
    out = np.zeros((len(levels), sum(_LEVELS) + 1))
    out[np.arange(len(levels))[:, None], levels + starts] = 1
    out[:, -1] = 1
    return out


def train_spans(levels: np.ndarray, soft: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Logistic regression with soft labels by Newton's method on pattern counts."""
    x, w = one_hot(levels), np.zeros(sum(_LEVELS) + 1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - soft)) + ridge * w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(found: DataFrame) -> np.ndarray:
    """Weights of the span classifier, from the candidates of all documents."""
    spans = found.select(F.explode("spans").alias("s")).select("s.kind", "s.votes", "s.features")
    rows = spans.groupBy("kind", "votes", "features").agg(F.count(F.lit(1)).alias("n")).collect()  # bounded: levels only
    if not rows:
        return np.zeros(sum(_LEVELS) + 1)
    kinds = np.array([r.kind for r in rows])
    ballots, levels, n = np.array([r.votes for r in rows]), np.array([r.features for r in rows]), np.array([r.n for r in rows], float)
    soft = np.zeros(len(rows))
    for kind in range(len(KINDS)):
        own = kinds == kind
        if own.any():
            soft[own] = reliabilities(ballots[own], n[own])[0]
    return train_spans(levels, soft, n)


def accepted(found: DataFrame, weights: np.ndarray, threshold: float = 0.9) -> DataFrame:
    """(doc_id, spans): base spans and the loose ones at ``threshold`` or more,
    by kind and start. The classifier is a sum of a few array look-ups (JVM)."""
    starts = np.cumsum([0, *_LEVELS[:-1]]).tolist()
    table = F.array(*[F.lit(float(w)) for w in weights])
    score = lambda s: sum((F.element_at(table, s["features"][i] + F.lit(start + 1)) for i, start in enumerate(starts)), F.lit(float(weights[-1])))
    edge = float(np.log(threshold / (1 - threshold)))
    kept = F.filter("spans", lambda s: s["base"] | (score(s) >= edge))
    return found.select("doc_id", F.array_sort(F.transform(kept, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base")))).alias("spans"))


def find(docs: DataFrame, threshold: float = 0.9, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) of every document: kind (place in KINDS), start, end, base."""
    found = Scratch(docs.sparkSession).table(candidates(docs, id_col, text_col), "pii-candidates")
    return accepted(found, fit(found), threshold)


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def redact(docs: DataFrame, threshold: float = 0.9, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every accepted span replaced by its kind in brackets; other
    columns are untouched. Texts are read again with the fitted classifier, so
    no text is shuffled."""
    found = Scratch(docs.sparkSession).table(candidates(docs, id_col, text_col), "pii-candidates")
    weights = fit(found)
    edge = float(np.log(threshold / (1 - threshold)))

    @F.pandas_udf("string")
    def clean(texts):
        return texts.map(lambda t: t if t is None else _mask(t, weights, edge))

    return docs.withColumn(text_col, clean(F.col(text_col)))


def _mask(text: str, weights: np.ndarray, edge: float) -> str:
    base = base_spans(text)
    spans = [(a, b, k) for k in KINDS for a, b in base[k]]
    for kind, group in loose_spans(text, base).items():
        if group:
            scores = one_hot(np.array([features(text, kind, a, b) for a, b in group])) @ weights
            spans += [(a, b, kind) for (a, b), s in zip(group, scores) if s >= edge]
    out, last = [], 0
    for a, b, kind in sorted(spans):
        if a >= last:
            out += [text[last:a], f"[{kind.upper()}]"]
        last = max(last, b)
    return "".join(out) + text[last:] if spans else text
