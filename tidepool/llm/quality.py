"""Quality scores learned from preference pairs (Bradley-Terry) and cut at a score quantile."""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import texts
from tidepool.llm.common import class_counts, fresh, one_label
from tidepool.operators.similarity import over_cores

#: Labelled documents that are fitted together, about.
CHUNK = 8000
#: Words of the spans in which different words are counted.
SPANS = (32, 256)
SHAPES = texts.CLASSES * texts.CLASSES
STATS = 16 + 2 * len(SPANS)
WIDTH = SHAPES + STATS


def features(text: str | None) -> np.ndarray:
    """What a text looks like: shares of neighbouring character classes, and word statistics.

    Runs of one class count once, so the shares don't depend on word lengths. A NULL or empty
    text has zeros only.
    """
    out = np.zeros(WIDTH, dtype=np.float32)
    shapes = np.zeros(SHAPES, dtype=np.int64)
    counts = np.zeros(texts.CLASSES, dtype=np.int64)
    hashes = []
    for codes in texts.blocks(text or ""):
        kinds = texts.classes()[codes]
        counts += np.bincount(kinds, minlength=texts.CLASSES)
        runs = kinds[np.flatnonzero(np.diff(kinds, prepend=255))].astype(np.int64)
        shapes += np.bincount(runs[:-1] * texts.CLASSES + runs[1:], minlength=SHAPES)
        hashes.append(texts.word_hashes(codes)[0])
    total = counts.sum()
    if not total:
        return out
    out[:SHAPES] = np.sqrt(shapes / max(1, shapes.sum()))
    words = np.concatenate(hashes)
    n = len(words)
    stats = [
        math.log1p(total) / 10, math.log1p(n) / 10, counts[texts.UPPER] / total,
        counts[texts.LOWER] / total, counts[texts.DIGIT] / total, counts[texts.SPACE] / total,
        math.sqrt(counts[texts.LINE] / total), counts[texts.SIGN] / total,
        counts[texts.CLASSES - 32:].sum() / total, counts[texts.CLASSES - 32:].max() / total,
        counts[texts.UPPER] / max(1, counts[texts.UPPER] + counts[texts.LOWER]),
        min(20, total / max(1, n)) / 20, 1.0 if not n else 0.0,
    ]
    if n:
        again = (words[1:] == words[:-1]).mean() if n > 1 else 0.0
        twice = (words[2:] == words[:-2]).mean() if n > 2 else 0.0
        stats += [math.sqrt(again), math.sqrt(twice), np.unique(words).size / n ** 0.85]
        for span in SPANS:
            size = min(span, n)
            rows = np.sort(words[:n // size * size].reshape(-1, size), axis=1)
            different = (np.diff(rows, axis=1) != 0).sum(axis=1) + 1
            stats += [different.mean() / size, different.min() / size]
    out[SHAPES:SHAPES + len(stats)] = stats
    return out


@dataclass(frozen=True)
class Model:
    """Weights of scaled features, the score at the cut, and what a text is scored without a fit."""

    weights: np.ndarray
    centre: float
    cut: float
    constant: float | None = None

    def score(self, text: str | None) -> float:
        """0 to 1; ``cut`` at the quantile the model was cut at."""
        if self.constant is not None:
            return self.constant
        strength = float(features(text) @ self.weights) - self.centre
        return 1 / (1 + math.exp(-min(30.0, max(-30.0, strength + math.log(self.cut / (1 - self.cut))))))


def _fit(better: np.ndarray, worse: np.ndarray, steps: int, pairs: int, rate: float, ridge: float) -> np.ndarray:
    """Bradley-Terry strengths: logistic loss on feature differences of drawn pairs, by Adagrad."""
    draw = np.random.default_rng(7)
    weights = np.zeros(better.shape[1], dtype=np.float32)
    squares = np.full_like(weights, 1e-8)
    for _ in range(steps):
        apart = better[draw.integers(len(better), size=pairs)] - worse[draw.integers(len(worse), size=pairs)]
        miss = 1 / (1 + np.exp(np.clip(apart @ weights, -30, 30)))
        slope = ridge * weights - apart.T @ miss.astype(np.float32) / pairs
        squares += slope * slope
        weights -= rate * slope / np.sqrt(squares)
    return weights


def train(docs: DataFrame, labels: DataFrame, cut: float, label: str = "quality",
          chunk: int = CHUNK, steps: int = 400, pairs: int = 512, margin: float = 0.005,
          id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from all labelled documents.

    The documents are dealt by a hash of their id into chunks of about ``chunk``, and each chunk is fitted by a task. Every
    pair of a document of label 1 and one of label 0 in a chunk is a preference; the steps draw among them. The cut is
    a score quantile: the share of label 0 among all rows of ``labels``, taken half way between the scores ``margin`` below
    and above that share. The model is the mean of what the chunks gave, by their numbers of documents, so none is left out
    and no task holds more than a chunk. Chunks with one class only have no pair. With labels of one
    class only, or none, every text has the share of label 1 (one row of each class added) as its score.
    """
    low, high = class_counts(labels, label)

    @F.pandas_udf("binary")
    def packed(texts_: pd.Series) -> pd.Series:
        return texts_.map(lambda x: zlib.compress(features(x).tobytes(), 1))  # mostly zeros

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        plain = rows["features"].map(zlib.decompress)
        rows = rows.assign(features=plain).sort_values(["id", "features"])
        matrix = np.frombuffer(b"".join(rows["features"]), dtype=np.float32).reshape(-1, WIDTH)
        label_ = rows["label"].to_numpy()
        scale = matrix.std(axis=0)
        scale = np.where(scale > 1e-6, 1 / np.maximum(scale, 1e-6), 0).astype(np.float32)
        matrix = np.clip((matrix - matrix.mean(axis=0)) * scale, -8, 8)
        if not 0 < label_.sum() < len(label_):
            return pd.DataFrame({"chunk": [], "n": [], "weights": [], "centre": []})
        weights = _fit(matrix[label_ == 1], matrix[label_ == 0], steps, pairs, 0.05, 1e-3) * scale
        raw = np.frombuffer(b"".join(rows["features"]), dtype=np.float32).reshape(-1, WIDTH) @ weights
        order = np.argsort(raw, kind="stable")
        share = np.where(label_ == 1, high / label_.sum(), low / (label_ == 0).sum())[order]
        along = np.cumsum(share) / share.sum()
        at = low / (low + high)
        below, above = (raw[order][min(len(raw) - 1, np.searchsorted(along, q))]
                        for q in (at - margin, at + margin))
        return pd.DataFrame({"chunk": rows["chunk"].iloc[:1], "n": [len(rows)], "weights": [weights.astype(np.float32).tobytes()],
                             "centre": [float(below + above) / 2]})

    def mean(parts: pd.DataFrame) -> pd.DataFrame:
        parts = parts.sort_values("chunk")
        share = (parts["n"] / parts["n"].sum()).to_numpy()
        weights = np.frombuffer(b"".join(parts["weights"]), dtype=np.float32).reshape(-1, WIDTH)
        return pd.DataFrame({"weights": [(share @ weights.astype("float64")).astype(np.float32).tobytes()],
                             "centre": [float(share @ parts["centre"].to_numpy())]})

    found = []
    if low and high:
        rows = docs.select(F.col(id_col).alias("id"), packed(text_col).alias("features")).join(
            one_label(labels, label, id_col), "id")
        dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(-(-(low + high) // chunk))))
        # one narrow row a chunk
        found = (over_cores(dealt, "chunk").groupBy("chunk").applyInPandas(fit, "chunk long, n long, weights binary, centre double")
                 .withColumn("all", F.lit(1)).groupBy("all").applyInPandas(mean, "weights binary, centre double").collect())
    if not found:
        return Model(np.zeros(WIDTH, dtype=np.float32), 0.0, cut, (high + 1) / (low + high + 2))
    return Model(np.frombuffer(found[0]["weights"], dtype=np.float32), found[0]["centre"], cut)


def score_column(spark: SparkSession, model: Model, text: Column) -> Column:
    """The model's score of each whole text; NULL counts as empty."""
    sent = spark.sparkContext.broadcast(model)  # a few kilobytes, whatever the corpus

    @F.pandas_udf("double")
    def of(texts_: pd.Series) -> pd.Series:
        own = sent.value
        return pd.Series([own.score(x) for x in texts_], dtype="float64")

    return of(text)


def good_documents(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of ``model.cut`` or more, all columns as they are."""
    name = fresh(docs, "score")
    scored = docs.withColumn(name, score_column(docs.sparkSession, model, F.col(text_col)))
    return scored.where(F.col(name) >= model.cut).drop(name)
