"""Languages of a text as a mixture: expectation-maximisation over n-gram likelihoods."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import texts

#: Characters of an n-gram, and bits of its bucket.
GRAM, BUCKET_BITS = 4, 16
BUCKETS = 1 << BUCKET_BITS
#: Added to the count of each bucket of each language.
SMOOTHING = 0.5
#: Rounds of expectation-maximisation at most, and the change at which it ends.
ROUNDS, STILL = 50, 1e-4
#: Log likelihood that a further language must bring, times the logarithm of the n-grams.
PENALTY = 3.0
#: Languages that are learned at most: the world's written ones.
MOST = 256
UNKNOWN = "und"


def _grams(row: np.ndarray) -> np.ndarray:
    """Buckets of all n-grams of normalised letters."""
    grams = row[:max(0, len(row) - GRAM + 1)].astype(np.uint64)
    for k in range(1, GRAM):
        grams = grams * np.uint64(0x100000001B3) + row[k:len(grams) + k]
    return (grams * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of the n-grams of letters in a whole text; a bucket may come repeatedly.

    Letters are in lower case; whatever lies between words, and either end, is one space.
    Nothing for NULL and for texts without a letter.
    """
    rest, total, any_letter = np.zeros(1, dtype=np.uint32), None, False
    long = len(text or "") > texts.BLOCK
    for codes in texts.blocks(text or ""):
        folded = texts.word_codes()[codes] * texts.letters()[codes]
        any_letter = any_letter or bool(folded.any())
        row = np.concatenate((rest, folded))
        row = row[(row != 0) | np.concatenate(([True], row[:-1] != 0))]
        if long:
            counts = np.bincount(_grams(row), minlength=BUCKETS)
            total = counts if total is None else total + counts
            row = row[-(GRAM - 1):]
        rest = row
    if not any_letter:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    if rest[-1]:
        rest = np.append(rest, np.uint32(0))
    rest = np.pad(rest, (0, max(0, GRAM - len(rest))) if not long else 0)
    last = _grams(rest)
    if not long:
        return last, np.ones(len(last), dtype=np.int64)
    total = total + np.bincount(last, minlength=BUCKETS)
    found = np.flatnonzero(total)
    return found, total[found]


@dataclass(frozen=True)
class Model:
    """Languages and the probability of each n-gram bucket under each of them."""

    names: tuple[str, ...]
    chances: np.ndarray  # BUCKETS x languages

    def mixture(self, text: str | None, penalty: float = PENALTY) -> dict[str, float]:
        """The languages of a whole text with their proportions, which add up to 1.

        Begins with the likeliest single language. Adds the language with which
        expectation-maximisation reaches the highest likelihood, as long as that brings
        ``penalty`` times the logarithm of the number of n-grams. Nothing for texts without a
        letter, or if no language was learned.
        """
        buckets, counts = gram_counts(text)
        n = int(counts.sum())
        if not n or not self.names:
            return {}
        chances, counts = self.chances[buckets], counts.astype(np.float32)
        single = counts @ np.log(chances)
        chosen, shares = [int(np.argmax(single))], np.ones(1, dtype=np.float32)
        reached, least = float(single.max()), penalty * math.log(n + 1)
        while len(chosen) < len(self.names):
            slope = (counts / (chances[:, chosen] @ shares)) @ chances - n
            slope[chosen] = -np.inf
            # the likelihood is concave, so a language brings its slope at most
            tried = [(*_proportions(chances[:, [*chosen, k]], counts), int(k)) for k in np.flatnonzero(slope > least)]
            best = max(tried, key=lambda x: x[1], default=None)
            if best is None or best[1] - reached <= least:
                break
            shares, reached = best[0], best[1]
            chosen.append(best[2])
        return {self.names[k]: float(share) for k, share in zip(chosen, shares)}

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language of the largest proportion (the first by name if equal), and that proportion."""
        found = self.mixture(text)
        if not found:
            return UNKNOWN, 0.0
        name = min(found, key=lambda k: (-found[k], k))
        return name, min(1.0, found[name])


def _proportions(chances: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions by expectation-maximisation, and the log likelihood reached."""
    shares = np.full(chances.shape[1], 1 / chances.shape[1], dtype=np.float32)
    n = counts.sum()
    for _ in range(ROUNDS):
        now = shares * ((counts / (chances @ shares)) @ chances) / n
        moved = float(np.abs(now - shares).max())
        shares = now / now.sum()
        if moved < STILL:
            break
    return shares, float(counts @ np.log(chances @ shares))


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", most: int = MOST) -> Model:
    """N-gram probabilities of each language from all rows of ``docs`` with a language.

    Each task counts its rows by language and bucket; the counts are added up by a shuffle,
    and the table of sums (``BUCKETS`` rows a language at most) is the model. A column with
    more than ``most`` values gives the ``most`` frequent ones, so that the model's size is bounded.
    """
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                buckets, counts = gram_counts(text)
                if len(buckets):
                    own = np.bincount(buckets, weights=counts, minlength=BUCKETS)
                    sums[lang] = own if lang not in sums else np.add(sums[lang], own, out=sums[lang])
        for lang, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)),
                                              pa.array(own[at].astype(np.int64))], ["lang", "bucket", "n"])

    named = (docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
             .where("lang is not null and text is not null"))
    ranked = named.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most)
    rows = named.join(F.broadcast(ranked.select("lang")), "lang").mapInArrow(of, "lang string, bucket int, n long")
    sums = rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros(BUCKETS)
        counts[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
        return pd.DataFrame({"lang": rows["lang"].iloc[:1], "counts": [counts.tobytes()]})

    # ``most`` rows of 512 kB at most
    found = sums.groupBy("lang").applyInPandas(packed, "lang string, counts binary").orderBy("lang").collect()
    names = tuple(row["lang"] for row in found)
    table = np.zeros((BUCKETS, len(names)))
    for k, row in enumerate(found):
        table[:, k] = np.frombuffer(row["counts"])
    table += SMOOTHING
    return Model(names, (table / table.sum(axis=0)).astype(np.float32))


def predicted_column(spark: SparkSession, model: Model, text: Column) -> Column:
    """struct(lang, share): the main language of each whole text and its proportion."""
    sent = spark.sparkContext.broadcast(model)  # BUCKETS numbers a language

    @F.pandas_udf("lang string, share double")
    def of(texts_: pd.Series) -> pd.DataFrame:
        own = sent.value
        return pd.DataFrame([own.predict(x) for x in texts_], columns=["lang", "share"])

    return of(text)


def mixture_column(spark: SparkSession, model: Model, text: Column) -> Column:
    """map(language, proportion) of each whole text."""
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("map<string,double>")
    def of(texts_: pd.Series) -> pd.Series:
        own = sent.value
        return pd.Series([own.mixture(x) for x in texts_], dtype="object")

    return of(text)
