"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import texts
from tidepool.llm.common import class_counts, labelled_sample

#: Labelled documents of each class that the weights are fitted on, and features of all of them (256 MB).
PER_CLASS, MOST = 5000, 1 << 26
#: Bytes of features that leave a task together.
TOGETHER = 1 << 24
#: Bits of a feature's number.
HASH_BITS = 20
#: Letters of the word beginnings that count as unigrams beside the whole words.
BEGINNINGS = (4, 5)


def numbers(text: str | None) -> np.ndarray:
    """The numbers of all features of a text, repeats included.

    Words, word beginnings, pairs of neighbours and pairs with one word between, each hashed.
    NULL and texts without a word have none.
    """
    words, more = [], []
    for codes in texts.blocks(text or ""):
        whole, *beginnings = texts.word_hashes(codes, BEGINNINGS)
        words.append(whole)
        more += beginnings
    if not words:
        return np.empty(0, dtype=np.int32)
    row = np.concatenate(words)
    factor = np.uint64(0x9E3779B97F4A7C15)
    pairs = texts.mixed(row[:-1] * factor + row[1:])
    skips = texts.mixed(row[:-2] * factor + row[2:] + np.uint64(1))
    return (np.concatenate([row, *more, pairs, skips]) >> np.uint64(64 - HASH_BITS)).astype(np.int32)


def features(text: str | None) -> np.ndarray:
    """Sorted numbers of the different features of a text."""
    return np.unique(numbers(text))


@dataclass(frozen=True)
class Model:
    """Non-zero weights by feature number, and the bias."""

    numbers: np.ndarray
    weights: np.ndarray
    bias: float

    def table(self) -> np.ndarray:
        out = np.zeros(1 << HASH_BITS, dtype=np.float32)
        out[self.numbers] = self.weights
        return out


def probability(margin: float) -> float:
    return 1 / (1 + math.exp(-min(30.0, max(-30.0, margin))))


class Learner:
    """FTRL-proximal with a learning rate of its own for each coordinate; the last one is the bias."""

    def __init__(self, alpha: float, beta: float, l1: float, l2: float) -> None:
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((2, (1 << HASH_BITS) + 1))

    def weights(self, at: np.ndarray) -> np.ndarray:
        held = self.z[at]
        out = (np.sign(held) * self.l1 - held) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)
        out[np.abs(held) <= self.l1] = 0
        return out

    def _learn(self, at: np.ndarray, w: np.ndarray, slope: float) -> None:
        square = slope * slope
        self.z[at] += slope - (np.sqrt(self.n[at] + square) - np.sqrt(self.n[at])) / self.alpha * w
        self.n[at] += square

    def learn(self, row: np.ndarray, label: int, weight: float) -> None:
        bias = np.array([1 << HASH_BITS])
        w, own = self.weights(row), self.weights(bias)
        slope = (probability(w.sum() + own[0]) - label) * weight
        self._learn(row, w, slope)
        self._learn(bias, own, slope)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS,
          epochs: int = 10, alpha: float = 0.3, beta: float = 1.0, l1: float = 6.0, l2: float = 0.3,
          id_col: str = "doc_id", text_col: str = "text", most: int = MOST) -> Model:
    """Weights from at most ``per_class`` labelled documents of each class.

    All features of a sampled document count. One task fits the sample and holds its features, ``most`` numbers of
    4 bytes at most: documents are taken in an order by hash until these are used up. Both classes weigh alike, whatever
    their shares. L1 leaves few weights, and only these leave the task. With labels of one class
    only, or none, every text has the share of label 1 (one row of each class added) as its
    score.
    """
    low, high = class_counts(labels, label)

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, held = [], 0
            for name, text, own in zip(batch["id"], batch["text"], batch["label"]):
                rows.append((name, own, features(text).tobytes()))
                held += len(rows[-1][2])
                if held >= TOGETHER:
                    yield pd.DataFrame(rows, columns=["id", "label", "features"])
                    rows, held = [], 0
            yield pd.DataFrame(rows, columns=["id", "label", "features"])

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, own, total = [], [], 0
        for batch in batches:
            for kind, one in zip(batch["label"], batch["features"]):
                if total + len(one) // 4 <= most:
                    rows.append(np.frombuffer(one, dtype=np.int32))
                    own.append(kind)
                    total += len(one) // 4
        if own:
            learner, draw = Learner(alpha, beta, l1, l2), np.random.default_rng(7)
            share = np.bincount(own, minlength=2) / len(own)
            weight = 0.5 / np.maximum(share, 1 / (2 * len(own)))
            for _ in range(epochs):
                for k in draw.permutation(len(rows)):
                    learner.learn(rows[k], own[k], weight[own[k]])
            w = learner.weights(np.arange((1 << HASH_BITS) + 1))
            kept = np.flatnonzero(w[:-1])
            yield pd.DataFrame({"numbers": [kept.astype(np.int32).tobytes()],
                                "weights": [w[kept].astype(np.float32).tobytes()], "bias": [w[-1]]})

    sample = labelled_sample(docs, labels, label, per_class, id_col, text_col)
    kind = sample.schema["id"].dataType.simpleString()
    rows = sample.mapInPandas(packed, f"id {kind}, label int, features binary")
    found = (rows.repartition(1).sortWithinPartitions(F.xxhash64("id"), "id", "features").select("label", "features")
             .mapInPandas(fit, "numbers binary, weights binary, bias double").collect()) if low and high else []
    if not found:
        none = np.empty(0, dtype=np.int32)
        return Model(none, none.astype(np.float32), math.log((high + 1) / (low + 1)))
    return Model(np.frombuffer(found[0]["numbers"], dtype=np.int32),
                 np.frombuffer(found[0]["weights"], dtype=np.float32), found[0]["bias"])


def score_column(spark: SparkSession, model: Model, text: Column) -> Column:
    """The probability of label 1 for each whole text; NULL counts as empty."""
    sent = spark.sparkContext.broadcast(model)  # at most 2 ** HASH_BITS weights

    @F.pandas_udf("double")
    def of(texts_: pd.Series) -> pd.Series:
        own, bias = sent.value.table(), sent.value.bias

        def score(text_: str | None) -> float:
            found = numbers(text_)
            return probability(float(own[np.unique(found[own[found] != 0])].sum()) + bias)

        return pd.Series([score(x) for x in texts_], dtype="float64")

    return of(text)
