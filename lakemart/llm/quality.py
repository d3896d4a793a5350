"""Quality classifier: random Fourier features, ridge scores, isotonic calibration.

Each whole text gives a vector of document statistics. Random Fourier features
approximate a Gaussian kernel over the standardised statistics; each partition
of training rows sums its part of the normal equations, a tree of sums adds
them, and the ridge solution is a vector of fixed length. Isotonic regression
on rows that the ridge did not see turns its values into probabilities.

What reaches the driver has a fixed size: sums of the moments, one matrix of
(features + 1) squared for each of at most ``SUMS`` partial sums, and a
histogram of ``BINS`` calibration bins. Labels, language, source and id are
never inputs of a score.

Defined results: a null text counts as empty and is scored as such; labelled
ids that are null or unlabelled rows train nothing; an id with several labels
counts with their mean; without any training row every score is 0.5.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, slices, texts_of

SUMS, BINS = 32, 2000
STATISTICS = (
    "log_chars", "log_words", "word_mean", "word_std", "word_longest", "distinct_words", "commonest_word", "repeats_next", "distinct_pairs",
    "upper", "digits", "punctuation", "symbols", "non_ascii", "blank", "entropy", "log_lines", "repeated_lines", "line_mean",
    "symbol_words", "bar_words", "shouted", "short_words", "sentence_ends",
)
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#$%&*+<=>@\\^_`|~{}[]!", np.uint8))
_PUNCTUATION = np.isin(np.arange(256), np.frombuffer(b".,;:!?'\"()-", np.uint8))
_CODES = np.arange(256)
_UPPER, _DIGIT = (_CODES >= 65) & (_CODES <= 90), (_CODES >= 48) & (_CODES <= 57)
_BLANK = np.isin(_CODES, [9, 10, 11, 12, 13, 32])
_LINES = re.compile(r"\n+")


def statistics(text: str) -> list[float]:
    """The statistics of one whole text, in the order of STATISTICS."""
    raw = text.encode()
    words = raw.split()
    n, m = max(1, len(raw)), max(1, len(words))
    bytes_ = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = bytes_[bytes_ > 0] / n
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    seen = Counter(words)
    pairs = max(1, len(words) - 1)
    lines = [x for x in _LINES.split(text) if x.strip()]
    k = max(1, len(lines))
    marked = sum(v for w, v in seen.items() if len(w) > 2 and not (w[-2:].isalnum() or w[-2:-1].isalnum() or w[-1:] in b",." or w[0] > 127 or w[-2] > 127))
    return [
        np.log1p(len(text)), np.log1p(len(words)), sizes.mean(), sizes.std(), np.log1p(sizes.max()),
        len(seen) / m, max(seen.values(), default=0) / m, sum(map(bytes.__eq__, words, words[1:])) / pairs, len(set(zip(words, words[1:]))) / pairs,
        bytes_[_UPPER].sum() / n, bytes_[_DIGIT].sum() / n, bytes_[_PUNCTUATION].sum() / n, bytes_[_SYMBOLS].sum() / n, bytes_[128:].sum() / n,
        bytes_[_BLANK].sum() / n, float(-(share * np.log2(share)).sum()), np.log1p(len(lines)), 1 - len(set(lines)) / k, np.log1p(len(text) / k),
        marked / m, seen.get(b"|", 0) / m, sum(v for w, v in seen.items() if len(w) > 1 and w.isupper()) / m,
        sum(v for w, v in seen.items() if len(w) <= 2) / m, sum(v for w, v in seen.items() if w[-1:] in b".!?") / m,
    ]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x): the statistics of every whole text."""
    def run(batches):
        for ids, texts in slices(batches):
            rows = np.array([statistics(t) for t in texts], np.float64).reshape(len(texts), len(STATISTICS))
            offsets = np.arange(len(texts) + 1, dtype=np.int32) * len(STATISTICS)
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(offsets, rows.ravel())], ["doc_id", "x"])

    source = texts_of(docs, id_col, text_col)
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, x array<double>")


class FourierRidge:
    """Standardisation, random features, ridge weights and calibration steps."""

    def __init__(self, mean: np.ndarray, std: np.ndarray, features: int, gamma: float, seed: int):
        rng = np.random.default_rng(seed)
        self.mean, self.std = mean, std
        self.directions = rng.normal(0, np.sqrt(2 * gamma), (len(mean), features))
        self.phases = rng.uniform(0, 2 * np.pi, features)
        self.weights = np.zeros(features + 1)
        self.steps = (np.array([0.0, 1.0]), np.array([0.5, 0.5]))

    def map(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.std, -8, 8)
        out = np.empty((len(x), len(self.phases) + 1))
        out[:, :-1] = np.sqrt(2 / len(self.phases)) * np.cos(z @ self.directions + self.phases)
        out[:, -1] = 1
        return out

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.map(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability. All but a thousandth comes from the isotonic steps at
        the clipped value's place, the rest from the value itself, which
        orders rows within a step."""
        raw = np.clip(self.raw(x), -0.5, 1.5)
        return np.clip(0.999 * np.interp(raw, *self.steps) + 0.001 * (raw + 0.5) / 2, 0, 1)


def isotonic(values: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins in order of value: (places, means)."""
    blocks: list[list[float]] = []
    for v, s, c in zip(values, sums, counts):
        blocks.append([s, c, v, v])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s2, c2, _, high = blocks.pop()
            blocks[-1][0] += s2
            blocks[-1][1] += c2
            blocks[-1][3] = high
    places = [x for b in blocks for x in (b[2], b[3] + 1e-9)]
    return np.array(places), np.repeat([b[0] / b[1] for b in blocks], 2)


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    return x, batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)


def _sum_matrices(parts: DataFrame, size: int) -> np.ndarray:
    """Adds (part long, m binary) rows as a tree of three levels: SUMS ** 2 groups
    of one in so many parts (98 matrices each for 100,000 tasks), then SUMS groups
    of at most SUMS; SUMS matrices reach the driver."""
    def add(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        total = np.zeros(size)
        for m in group.column("m"):
            total += np.frombuffer(m.as_buffer())
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "m": pa.array([total.tobytes()], pa.binary())})

    for width in (SUMS * SUMS, SUMS):
        parts = parts.withColumn("part", F.col("part") % width).groupBy("part").applyInArrow(add, "part bigint, m binary")
    total = np.zeros(size)
    for row in parts.collect():
        total += np.frombuffer(row.m)
    return total


def fit(train: DataFrame, features: int = 256, gamma: float | None = None, ridge: float = 1e-3, seed: int = 11) -> FourierRidge:
    """``train``: x array<double>, y double (0..1), fold int (0: calibration, else ridge)."""
    width = len(STATISTICS)
    pick = [F.struct(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(width)], *[F.sum(F.col("x")[i] * F.col("x")[i]).alias(f"q{i}") for i in range(width)]).alias("m")]
    m = train.agg(*pick).first().m
    n = m["n"]
    if not n:
        return FourierRidge(np.zeros(width), np.ones(width), features, 1.0, seed)
    mean = np.array([m[f"s{i}"] for i in range(width)]) / n
    std = np.sqrt(np.maximum(np.array([m[f"q{i}"] for i in range(width)]) / n - mean**2, 0))
    # Standardised rows lie about sqrt(2 * width) apart: one over that, squared, is a middling width.
    model = FourierRidge(mean, np.where(std < 1e-9, 1, std), features, gamma or 1 / (2 * width), seed)
    d = features + 1

    def normal(batches):
        total, seen = np.zeros((d + 1, d)), False
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                x, y = _rows(batch.slice(at, 4096))
                z = model.map(x)
                total[:d] += z.T @ z
                total[d] += z.T @ y
                seen = True
        if seen:
            from pyspark import TaskContext
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["part", "m"])

    total = _sum_matrices(train.filter("fold != 0").select("x", "y").mapInArrow(normal, "part bigint, m binary"), (d + 1) * d).reshape(d + 1, d)
    count = max(1.0, total[d - 1, d - 1])
    model.weights = np.linalg.solve(total[:d] / count + ridge * np.eye(d), total[d] / count)

    def binned(batches):
        sums, counts, values = np.zeros(BINS), np.zeros(BINS), np.zeros(BINS)
        for batch in batches:
            if batch.num_rows:
                x, y = _rows(batch)
                raw = np.clip(model.raw(x), -0.5, 1.5)
                at = np.minimum((raw + 0.5) / 2 * BINS, BINS - 1).astype(int)
                sums += np.bincount(at, y, BINS)
                counts += np.bincount(at, minlength=BINS)
                values += np.bincount(at, raw, BINS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), *(pa.array(a[used], pa.float64()) for a in (sums, counts, values))], ["bin", "s", "c", "v"])

    bins = (train.filter("fold = 0").select("x", "y").mapInArrow(binned, "bin bigint, s double, c double, v double")
            .groupBy("bin").agg(F.sum("s").alias("s"), F.sum("c").alias("c"), F.sum("v").alias("v")).orderBy("bin").toPandas())
    if len(bins):
        model.steps = isotonic((bins.v / bins.c).to_numpy(), bins.s.to_numpy(), bins.c.to_numpy())
    elif n:
        model.steps = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    return model


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, features: int = 256, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", label_id: Column | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Learns from all rows of ``labels`` that are not held out; a quarter of them
    (crc32 modulo 4 is 0) calibrates, the others fit the ridge. ``label_id``: what
    of ``doc_id`` the labels name, where that is a key with further parts.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    stats = scratch.table(document_statistics(docs, id_col, text_col), "quality-x")
    named = F.col("doc_id") if label_id is None else label_id
    known = (labels.select(F.col("doc_id" if label_id is not None else id_col).alias("doc_id"), F.col(label_col).cast("double").alias("y")).filter("doc_id is not null and y is not null")
             .groupBy("doc_id").agg(F.avg("y").alias("y")).filter(~held_out(F.col("doc_id"))))
    train = stats.select(named.alias("doc_id"), "x").join(known, "doc_id").select("x", "y", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4).cast("int").alias("fold"))
    train = scratch.table(train, "quality-train")
    model = fit(train, features)
    scratch.drop("quality-train")
    kind = stats.schema["doc_id"].dataType.simpleString()

    def score(batches):
        for batch in batches:
            if batch.num_rows:
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([model.score(x[i:i + 4096]) for i in range(0, len(x), 4096)]))], ["doc_id", "score"])

    scored = stats.select("doc_id", "x").mapInArrow(score, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(named).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
