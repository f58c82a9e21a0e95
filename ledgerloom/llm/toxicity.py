"""Operator 8: toxicity by FTRL-proximal logistic regression over hashed n-grams and skip-grams.

Words, word pairs and pairs around one word are hashed into 2^20 coordinates.
FTRL-proximal learns with a rate per coordinate and an L1 term that leaves few
weights, which are broadcast to score every whole text.
"""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import prepare, slices, staged, strings, tidy
from ledgerloom.llm.decontamination import words_of
from ledgerloom.operators.layout import broadcast_if_small

BITS = 20
# Labelled documents used for fitting (about; chosen by a hash of the id).
FIT_ROWS = 12_000
EPOCHS = 3
MASK = (1 << BITS) - 1
# words whose hashes a worker keeps (memory only), and characters of one vectorised step
KEPT_WORDS = 100_000
SLICE = 1_000_000
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


class Hasher:
    """Feature numbers of texts; the hashes of words seen are kept between batches."""

    def __init__(self):
        self._clear()

    def _clear(self) -> None:
        self.index: dict[bytes, int] = defaultdict(itertools.count().__next__)
        self.hashes = np.zeros(0, np.uint64)

    def features(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(feature numbers, text of each), repeats included."""
        if len(self.index) > KEPT_WORDS:
            self._clear()
        words = [words_of(t) for t in texts]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        found = np.fromiter(map(self.index.__getitem__, itertools.chain.from_iterable(words)), np.int64, int(counts.sum()))
        new = list(itertools.islice(self.index, len(self.hashes), None))
        self.hashes = np.concatenate([self.hashes, np.fromiter(map(zlib.crc32, new), np.uint64, len(new))])
        h = self.hashes[found]
        owner = np.repeat(np.arange(len(texts)), counts)
        one = h * _MULTIPLIERS[0]
        parts, owners = [one], [owner]
        for gap, multiplier in ((1, _MULTIPLIERS[1]), (2, _MULTIPLIERS[2])):
            same = owner[:-gap] == owner[gap:]
            parts.append(((h[:-gap] * _MULTIPLIERS[3] + h[gap:]) * multiplier)[same])
            owners.append(owner[:-gap][same])
        mixed = np.concatenate(parts)
        return (mixed >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(owners)


def distinct_pairs(features: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Distinct (text, feature) pairs as sorted numbers, the text in the high bits."""
    return np.unique((owner << BITS) | features)


class Ftrl:
    """FTRL-proximal for binary features (presence) and a bias without penalty."""

    def __init__(self, alpha: float = 1.0, beta: float = 1.0, l1: float = 8.0, l2: float = 0.0):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((1 << BITS) + 1)
        self.n = np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        """Weights of coordinates; the last coordinate is the bias."""
        z, rate = self.z[at], (self.beta + np.sqrt(self.n[at])) / self.alpha
        bias = at == 1 << BITS
        small = np.abs(z) - np.where(bias, 0.0, self.l1)
        return np.where(small > 0, -np.sign(z) * small / (rate + np.where(bias, 0.0, self.l2)), 0.0)

    def learn(self, features: np.ndarray, label: float) -> None:
        at = np.append(features, 1 << BITS)
        w = self.weights(at)
        gradient = sigmoid(w.sum()) - label
        step = (np.sqrt(self.n[at] + gradient**2) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += gradient - step * w
        self.n[at] += gradient**2


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30.0, 30.0)))


@dataclass(frozen=True)
class Model:
    features: np.ndarray  # coordinates with a weight
    weights: np.ndarray
    bias: float

    def table(self) -> np.ndarray:
        table = np.zeros(1 << BITS, np.float32)
        table[self.features] = self.weights
        return table


def learn(rows: list[tuple[str, float]], epochs: int = EPOCHS, seed: int = 5, **how: float) -> Model:
    """Model of (text, label) rows, in an order drawn anew each epoch."""
    hasher, ftrl = Hasher(), Ftrl(**how)
    texts, examples = [text for text, _ in rows], []
    for a, b in slices(texts, SLICE):
        pairs = distinct_pairs(*hasher.features(texts[a:b]))
        cuts = np.searchsorted(pairs >> BITS, np.arange(1, b - a))
        examples += np.split((pairs & MASK).astype(np.int32), cuts)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(examples)):
            ftrl.learn(examples[i], rows[i][1])
    weights = ftrl.weights(np.arange((1 << BITS) + 1))
    kept = np.flatnonzero(weights[:-1])
    return Model(kept, weights[kept].astype(np.float32), float(weights[-1]))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    rows: int = FIT_ROWS,
) -> Model:
    """FTRL model of about ``rows`` labelled documents, chosen by a hash of the key.

    FTRL is sequential, so this bounded sample is learned in one task; a document
    that is repeated with the same text is learned once.  Rows of
    ``labels`` without key or label are left out; of several labels of a key the
    highest counts.  Without labelled documents the model scores 0 everywhere
    (its bias is negative), with labels of one kind it scores that kind.
    """
    prepare(docs.sparkSession)
    marked = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(key).cast("long").alias("fit_key"))
        .agg(F.max(label).cast("double").alias("fit_label"))
    )
    total = marked.count()
    share = min(1.0, rows / total) if total else 0.0
    chosen = staged(marked.where(F.pmod(F.xxhash64("fit_key"), F.lit(1_000_003)) < share * 1_000_003), "toxic-sample")
    side, _ = broadcast_if_small(chosen)
    sample = (
        docs.select(F.col(key).cast("long").alias("fit_key"), F.coalesce(F.col(text), F.lit("")).alias("fit_text"))
        .join(side, "fit_key")
        .distinct()
        .repartition(1)
        .sortWithinPartitions(F.xxhash64("fit_key"), "fit_key", "fit_text")
        .select("fit_text", "fit_label")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = [
            (x or "", y) for batch in batches for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        ]
        if not examples:
            return
        model = learn(examples)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(model.features, -1), pa.int64()),
                pa.array(np.append(model.weights, model.bias).astype(np.float64), pa.float64()),
            ],
            ["feature", "weight"],
        )

    learned = sample.mapInArrow(tidy(run), "feature long, weight double").collect()
    weights = {r["feature"]: r["weight"] for r in learned}
    bias = weights.pop(-1, -30.0)
    return Model(np.array(list(weights), np.int64), np.array(list(weights.values()), np.float32), bias)


def score(df: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """Append ``out``, the probability of the label, from the whole text of every row.

    A null or empty text has the score of the bias alone; a column of the name
    ``out`` is replaced, every other one passes through.
    """
    spark = prepare(df.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    kept = df.drop(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, hasher = shared.value, Hasher()
        table = model.table()
        for batch in batches:
            texts = strings(batch.column(batch.schema.names.index(text)))
            sums = [np.zeros(0)]
            for a, b in slices(texts, SLICE):
                sums.append(raw_scores(hasher, table, texts[a:b]) + model.bias)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sigmoid(np.concatenate(sums)), pa.float64())], [*batch.schema.names, out]
            )

    return kept.mapInArrow(tidy(run), T.StructType([*kept.schema.fields, T.StructField(out, T.DoubleType())]))


def raw_scores(hasher: Hasher, table: np.ndarray, texts: list[str]) -> np.ndarray:
    """Sum of the weights of each text's distinct features."""
    features, owner = hasher.features(texts)
    hit = table[features] != 0
    pairs = distinct_pairs(features[hit], owner[hit])
    return np.bincount(pairs >> BITS, table[pairs & MASK], minlength=len(texts))
