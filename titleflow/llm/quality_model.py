"""Quality classifier: a factorisation machine over a document's text.

``y = w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j``; the pairwise part is
computed in linear time as ``1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)``.

Inputs x: hashed words (present or not, scaled to length one), structure
statistics as numbers and as one-hot bins, and the text's size as metadata.
Language, source, ids and labels are no inputs.

``train`` fits on at most about ``max_rows`` distinct labelled texts, picked by hash, so
its cost is bounded and repeatable; weights
(``DIM * (1 + FACTORS)`` numbers, fixed by these constants) are broadcast and
every document is scored in one pass without a shuffle.

Cases: a null or empty text has structure inputs only and gets a score; null
labels are not learned from; with one class or none among the labels the score is
that class's share (0.5 without labels); repeated rows are scored each.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titleflow.llm.common import map_texts, materialise, picked

WORD_DIM = 1 << 14
EDGES = np.array([1e-9, 0.01, 0.03, 0.1, 0.2, 0.35, 0.5, 0.8])
BINS = len(EDGES) + 1
STATS = ["symbol", "shout", "pipe", "digit", "upper", "wide", "stop", "word_len", "repeat", "dup_line", "line", "size"]
DIM = WORD_DIM + len(STATS) * (BINS + 1)
FACTORS = 8

_SYMBOLS = np.frombuffer(b"#*$%&<>", np.uint8)


def structure(text: bytes, words: list[bytes], distinct: int) -> list[float]:
    """The statistics ``STATS``, each between 0 and 1."""
    n = max(len(words), 1)
    size = max(len(text), 1)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    lines = [x for x in text.split(b"\n") if x.strip()]
    values = [
        counts[_SYMBOLS].sum() / n,
        counts[33] / n,
        counts[124] / n,
        counts[48:58].sum() / size,
        counts[65:91].sum() / size,
        counts[128:].sum() / size,
        (counts[44] + counts[46]) / n,
        sum(map(len, words)) / n / 20,
        1 - distinct / n if words else 0.0,
        1 - len(set(lines)) / max(len(lines), 1) if lines else 0.0,
        len(lines) / n,
        math.log1p(len(words)) / 15,
    ]
    return [min(1.0, float(v)) for v in values]


def inputs(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of the inputs that are not zero."""
    words = text.split()
    distinct = set(words)
    hashed = np.unique(np.fromiter((crc32(w) % WORD_DIM for w in distinct), np.int64, len(distinct)))
    stats = np.array(structure(text, words, len(distinct)))
    block = WORD_DIM + np.arange(len(STATS)) * (BINS + 1)
    bins = block + 1 + np.searchsorted(EDGES, stats, "right")
    index = np.concatenate([hashed, block, bins])
    value = np.concatenate([np.full(len(hashed), 1 / math.sqrt(max(len(hashed), 1))), stats, np.ones(len(bins))])
    return index, value


@dataclass
class Model:
    bias: float
    weights: np.ndarray  # DIM x (1 + FACTORS): linear weight, then factors

    def score(self, text: bytes) -> float:
        index, value = inputs(text)
        terms = self.weights[index] * value[:, None]
        linear, sums = terms[:, 0].sum(), terms[:, 1:].sum(axis=0)
        y = self.bias + linear + 0.5 * ((sums**2).sum() - (terms[:, 1:] ** 2).sum())
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, y))))


def constant(share: float) -> Model:
    share = min(max(share, 1e-6), 1 - 1e-6)
    return Model(math.log(share / (1 - share)), np.zeros((DIM, 1 + FACTORS), np.float32))


def train(labelled: DataFrame, text: str = "text", label: str = "label", max_rows: int = 5000, rounds: int = 10, seed: int = 7) -> Model:
    """Fit on ``labelled`` (text, label 0/1); of more than ``max_rows`` texts a hash picks about that many.

    Copies of a text with the same label are learned once.  Only the picked
    rows' inputs reach the driver.
    """
    known = labelled.where(F.col(label).isin(0, 1)).select(F.col(text).alias("t"), F.col(label).cast("double").alias("label"))
    total, ones = known.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not total or ones in (0, total):
        return constant(0.5 if not total else ones / total)
    return _fit_rows(picked(known, "t", max_rows), rounds, seed)


def train_by_id(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "label", max_rows: int = 5000, rounds: int = 10, seed: int = 7
) -> Model:
    """``train`` for texts and labels that share a key.

    Keys and text hashes meet the labels and make the sample, so no text is
    shuffled; then the sample's texts alone are read.
    """
    known = labels.where(F.col(label).isin(0, 1)).select(F.col(key).alias("k"), F.col(label).cast("double").alias("label"))
    hashed = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).withColumn("h", F.xxhash64("t"))
    pairs = materialise(hashed.select("k", "h").join(known, "k").groupBy("h", "label").agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("k")), "labelled-texts")
    total, ones, distinct = pairs.agg(F.sum("n"), F.sum(F.col("n") * F.col("label")), F.count_distinct("h")).first()
    if not total or ones in (0, total):
        return constant(0.5 if not total else ones / total)
    if distinct > max_rows:
        pairs = pairs.where(F.pmod("h", F.lit(distinct)) < max_rows)
    # At most about two labels for each of ``max_rows`` texts, three numbers a row.
    sample = hashed.join(F.broadcast(pairs.select("k", "h", "label")), ["k", "h"]).select("t", "label").distinct()
    return _fit_rows(sample, rounds, seed)


def _fit_rows(known: DataFrame, rounds: int, seed: int) -> Model:
    """Fit on all rows (t, label) of a bounded sample."""

    def make():
        def fn(texts):
            pairs = [inputs(t) for t in texts]
            return [[i.astype(np.int32).tobytes() for i, _ in pairs], [v.astype(np.float32).tobytes() for _, v in pairs]]

        return fn

    fields = [("index", "binary", pa.binary()), ("value", "binary", pa.binary())]
    rows = map_texts(known, "t", ["label"], fields, make).collect()
    rows.sort(key=lambda r: (bytes(r["index"]), bytes(r["value"]), r["label"]))  # the fit doesn't depend on the order of arrival
    index = [np.frombuffer(r["index"], np.int32) for r in rows]
    value = [np.frombuffer(r["value"], np.float32) for r in rows]
    return fit(index, value, np.array([r["label"] for r in rows], np.float32), rounds, seed)


def fit(index: list[np.ndarray], value: list[np.ndarray], label: np.ndarray, rounds: int, seed: int, step: float = 0.1, decay: float = 1e-4, batch: int = 50) -> Model:
    """Logistic loss, mini-batches, AdaGrad."""
    draw = np.random.default_rng(seed)
    weights = np.zeros((DIM, 1 + FACTORS), np.float32)
    weights[:, 1:] = draw.normal(0, 0.05, (DIM, FACTORS))
    share = min(max(float(label.mean()), 0.01), 0.99) if len(label) else 0.5
    bias, seen, bias_seen = math.log(share / (1 - share)), np.full_like(weights, 1e-3), 1e-3
    for _ in range(rounds):
        order = draw.permutation(len(label))
        for start in range(0, len(order), batch):
            some = order[start : start + batch]
            sizes = np.array([len(index[r]) for r in some])
            at, x = np.concatenate([index[r] for r in some]), np.concatenate([value[r] for r in some])[:, None]
            row = np.repeat(np.arange(len(some)), sizes)
            terms = weights[at] * x
            starts = np.cumsum(sizes) - sizes
            sums, squares = np.add.reduceat(terms, starts), np.add.reduceat(terms[:, 1:] ** 2, starts)
            y = bias + sums[:, 0] + 0.5 * ((sums[:, 1:] ** 2).sum(axis=1) - squares.sum(axis=1))
            slope = (1 / (1 + np.exp(-np.clip(y, -50, 50))) - label[some]) / len(some)
            grad = x * slope[row][:, None] * np.concatenate([np.ones_like(x), sums[row, 1:] - terms[:, 1:]], axis=1)
            used, place = np.unique(at, return_inverse=True)
            total = np.stack([np.bincount(place, grad[:, k], len(used)) for k in range(1 + FACTORS)], axis=1) + decay * weights[used]
            seen[used] += total**2
            weights[used] -= (step * total / np.sqrt(seen[used])).astype(np.float32)
            bias_seen += float(slope.sum()) ** 2
            bias -= step * float(slope.sum()) / math.sqrt(bias_seen)
    return Model(bias, weights)


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        own = shared.value
        return lambda texts: [[own.score(t) for t in texts]]

    return map_texts(docs, text, keep, [("score", "double", pa.float64())], make)
