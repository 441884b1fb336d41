"""Skip-gram vectors with negative sampling, trained block against block.

The words are dealt into blocks, and so are their vectors, which lie in the shared folder. Every sampled pair of a word
and one near it belongs to a pair of blocks. In a round each block of words meets one block of contexts, all
different ones, so the rounds of an epoch are as many as blocks and no two tasks change the same vector,
but for slices of a very frequent pair of blocks: they begin alike, and each word gets the mean of what they made of it,
by how often they met it. A task holds two blocks of vectors and one packed row of pairs. Nothing as long as the
vocabulary comes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidepool.operators.factorise import first_vectors
from tidepool.operators.joins import salted_join
from tidepool.operators.numbering import number_rows
from tidepool.operators.similarity import over_cores
from tidepool.shared import cut_lineage

# Words of a block, pairs of a packed row and of a slice, slices of a pair of blocks at most.
BLOCK_WORDS = 1 << 17
PACKED, SLICE_PAIRS, SLICES = 1 << 16, 1 << 18, 16
# Words of sentences that are paired at a time.
PAIRED = 1 << 16
# Pairs that are learned from together, and contexts drawn against all of them.
TOGETHER, NEGATIVES = 1024, 64
RATE, NEGATIVE_WEIGHT = 0.1, 5.0

STATE = "kind string, block int, numbers binary, vectors binary, counts binary, met binary"
PAIRS = "first int, second int, n long, words binary, contexts binary"


def vocabulary(sentences: DataFrame, min_count: int) -> DataFrame:
    """``item, n, number``: the items that occur ``min_count`` times, numbered from 0, frequent ones first."""
    counts = sentences.select(F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("n"))
    return cut_lineage(number_rows(counts.filter(F.col("n") >= min_count), [F.desc("n"), F.asc("item")], "number"))


def numbered_sentences(sentences: DataFrame, words: DataFrame) -> DataFrame:
    """``numbers``: each sentence's items by number, without the rare ones, in order."""
    placed = sentences.select(F.monotonically_increasing_id().alias("sentence"), "items")
    rows = cut_lineage(placed).select("sentence", F.posexplode("items").alias("at", "item"))
    found = salted_join(rows, words.select("item", "number"), ["item"], salt_by=["sentence", "at"])
    listed = found.groupBy("sentence").agg(F.sort_array(F.collect_list(F.struct("at", "number"))).alias("own"))
    return listed.select(F.col("own.number").alias("numbers"))


def _drawn(one: np.ndarray, other: np.ndarray, seed: int) -> np.ndarray:
    """Numbers between 0 and 1 by the hash of two arrays."""
    bits = one.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + other.astype(np.uint64) + np.uint64(seed)
    for factor in (0x7FB5D329728EA185, 0x81DADEF4BC2DD44D):
        bits = (bits ^ (bits >> np.uint64(31))) * np.uint64(factor)
    return (bits >> np.uint64(11)).astype("float64") / float(1 << 53)


def sampled_pairs(numbers: DataFrame, blocks: int, window: int, seed: int) -> DataFrame:
    """``first, second, n, words, contexts``: packed pairs of words up to ``window`` apart, by pair of blocks.

    A pair d apart is kept with the chance 1 - (d - 1) / ``window``, by a hash of the sentence's place and words.
    """
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        sizes: dict[tuple[int, int], int] = {}

        def packed(key: tuple[int, int]) -> pa.RecordBatch:
            words, contexts = (np.concatenate(x) for x in zip(*held.pop(key)))
            row = [*key, sizes.pop(key), words.tobytes(), contexts.tobytes()]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], _names(PAIRS))

        seen = 0
        for batch in batches:
            column = batch.column(0)
            flat = column.flatten().to_numpy()
            sentence = np.repeat(np.arange(len(column), dtype="int32"), np.diff(column.offsets.to_numpy()))
            for first in range(0, len(flat), PAIRED):
                parts = []
                for apart in range(1, window + 1):
                    spot = np.arange(first, max(first, min(first + PAIRED, len(flat) - apart)))
                    a, b = flat[spot], flat[spot + apart]
                    kept = (sentence[spot] == sentence[spot + apart]) & (
                        _drawn((spot + seen) * window + apart, a * 31 + b, seed) >= (apart - 1) / window)
                    parts += [(a[kept], b[kept]), (b[kept], a[kept])]
                words, contexts = (np.concatenate(x) for x in zip(*parts))
                key = (words % blocks) * blocks + contexts % blocks
                order = np.argsort(key, kind="stable")
                key, words, contexts = key[order], words[order], contexts[order]
                bounds = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True]))) if len(key) else []
                for start, end in zip(bounds[:-1], bounds[1:]):
                    own = (int(key[start]) // blocks, int(key[start]) % blocks)
                    for at in range(start, end, PACKED):
                        stop = min(at + PACKED, end)
                        held.setdefault(own, []).append((words[at:stop].astype("<i4"), contexts[at:stop].astype("<i4")))
                        sizes[own] = sizes.get(own, 0) + stop - at
                        if sizes[own] >= PACKED:
                            yield packed(own)
                if sum(sizes.values()) > 64 * PACKED:  # many pairs of blocks, few pairs in each
                    for own in list(held):
                        yield packed(own)
            seen += len(flat)
        for own in list(held):
            yield packed(own)

    return numbers.mapInArrow(of, PAIRS)


def _names(schema: str) -> list[str]:
    return [part.split(" ")[0] for part in schema.split(", ")]


def first_state(words: DataFrame, blocks: int, size: int, seed: int) -> DataFrame:
    """The blocks before training: words with vectors by their hash, contexts with zeros."""
    def of(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("number")
        numbers = rows["number"].to_numpy()
        own = np.zeros((2, len(numbers), size + 1), dtype="float32")  # the last column sums squared steps
        own[0, :, :size] = first_vectors(numbers, size, seed) * 0.1
        counts = rows["n"].to_numpy().astype("float64").tobytes()
        return pd.DataFrame([(kind, rows["block"].iloc[0], numbers.astype("<i4").tobytes(), own[k].tobytes(), counts, b"")
                             for k, kind in enumerate(("word", "context"))], columns=_names(STATE))

    block = (F.col("number") % blocks).cast("int").alias("block")
    return cut_lineage(words.select(block, "number", "n").groupBy("block").applyInPandas(of, STATE))


def _step(own: np.ndarray, at: np.ndarray, slope: np.ndarray) -> None:
    """A step against the slopes of the rows ``at``, each row with a rate of its own (Adagrad)."""
    order = np.argsort(at, kind="stable")
    rows = at[order]
    first = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
    total, rows = np.add.reduceat(slope[order], first), rows[first]
    own[rows, -1] += (total * total).mean(axis=1)
    own[rows, :-1] -= RATE * total / np.sqrt(own[rows, -1:] + 1e-8)


def learn(words: np.ndarray, contexts: np.ndarray, first: np.ndarray, second: np.ndarray, chances: np.ndarray,
          draw: np.random.Generator) -> None:
    """One pass over pairs of rows of ``first`` and ``second``, whose vectors change."""
    order = draw.permutation(len(words))
    for start in range(0, len(order), TOGETHER):
        some = order[start:start + TOGETHER]
        a, b = words[some], contexts[some]
        others = np.searchsorted(chances, draw.random(NEGATIVES) * chances[-1], side="right").clip(0, len(chances) - 1)
        x, y, z = first[a, :-1], second[b, :-1], second[others, :-1]
        near = 1 / (1 + np.exp(-np.clip((x * y).sum(axis=1), -30, 30))) - 1
        far = 1 / (1 + np.exp(-np.clip(x @ z.T, -30, 30)))
        far *= (others[None, :] != b[:, None]) * (NEGATIVE_WEIGHT / NEGATIVES)
        up = near[:, None] * y + far @ z
        down = np.concatenate((near[:, None] * x, far.T @ x))
        _step(first, a, up)
        _step(second, np.concatenate((b, others)), down)


def _matrix(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(packed, dtype="float32").reshape(n, -1).copy()


def _rows(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[dict]:
    """Row by row: a batch of packed rows is never unpacked as a whole."""
    for batch in batches:
        columns = [batch.column(name) for name in names]
        for k in range(len(batch)):
            yield {name: column[k].as_py() for name, column in zip(names, columns)}


def _trained(epoch: int, seed: int):
    """Goes through sorted rows: the two blocks of a task, then its pairs."""
    names = ["first", "slice", "turn", *_names(STATE), "words", "contexts"]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, met, draw = None, {}, {}, None

        def done() -> pa.RecordBatch:
            rows = [(kind, *own[:1], own[1], own[2].tobytes(), own[3], met[kind].tobytes()) for kind, own in held.items()]
            kinds = [pa.string(), pa.int32(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], _names(STATE))

        for row in _rows(batches, names):
            now = row["first"], row["slice"]
            if now != key:
                if held:
                    yield done()
                key, held, met = now, {}, {}
                draw = np.random.default_rng((seed, epoch, abs(now[0]), now[1]))
            if row["turn"] < 2:
                ids = np.frombuffer(row["numbers"], dtype="<i4")
                held[row["kind"]] = [row["block"], row["numbers"], _matrix(row["vectors"], len(ids)), row["counts"], ids]
                met[row["kind"]] = np.zeros(len(ids))
                continue
            a, b = (np.searchsorted(held[kind][4], np.frombuffer(row[name], dtype="<i4"))
                    for kind, name in (("word", "words"), ("context", "contexts")))
            chances = np.cumsum(np.frombuffer(held["context"][3]) ** 0.75)
            learn(a, b, held["word"][2], held["context"][2], chances, draw)
            met["word"] += np.bincount(a, minlength=len(met["word"]))
            # every context of the block may have been drawn against
            met["context"] += np.bincount(b, minlength=len(met["context"])) + 1e-3
        if held:
            yield done()

    return of


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block from what its slices made of it: for each word their mean, by how often they met it.

    The rows are sorted by block, the block as it was before first (``old`` is 0); what slices made is added row by row.
    """
    names, kinds = _names(STATE), [pa.string(), pa.int32(), *[pa.binary()] * 4]
    old, total, weight = None, None, None

    def done() -> pa.RecordBatch:
        before = _matrix(old["vectors"], len(weight))
        np.divide(total, weight[:, None], out=total, where=weight[:, None] > 0)
        before[weight > 0] = total[weight > 0]
        row = (old["kind"], old["block"], old["numbers"], before.tobytes(), old["counts"], b"")
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names)

    for row in _rows(batches, names):
        if not row["met"]:
            if old is not None:
                yield done()
            old, weight = row, np.zeros(len(row["numbers"]) // 4)
            total = np.zeros((len(weight), len(row["vectors"]) // 4 // max(1, len(weight))))
            continue
        own = np.frombuffer(row["met"])
        total += _matrix(row["vectors"], len(weight)) * own[:, None]
        weight += own
    if old is not None:
        yield done()


def skipgram(sentences: DataFrame, size: int = 100, window: int = 5, min_count: int = 5, iterations: int = 5,
             seed: int = 0, block_words: int = BLOCK_WORDS, slice_pairs: int = SLICE_PAIRS) -> DataFrame:
    """``item, vector`` (float arrays of ``size``) learned from ``sentences`` with ``items`` (arrays of texts).

    Items that occur fewer than ``min_count`` times are left out, and their neighbours move together. No
    sentence, or none with two items that are left, gives the first vectors.
    """
    sentences = cut_lineage(sentences.select("items"))
    words = vocabulary(sentences, min_count)
    blocks = max(1, -(-words.count() // block_words))
    state = first_state(words, blocks, size, seed)
    pairs = cut_lineage(sampled_pairs(numbered_sentences(sentences, words), blocks, window, seed))
    sizes = pairs.groupBy("first", "second").agg(F.sum("n").alias("total"))
    count: Column = F.least(F.lit(SLICES), F.ceil(F.col("total") / slice_pairs)).cast("int")
    dealt = cut_lineage(pairs.join(sizes.select("first", "second", count.alias("slices")), ["first", "second"]).select(
        "first", "second", F.pmod(F.xxhash64("words", "contexts"), F.col("slices")).cast("int").alias("slice"), "words", "contexts"))
    tasks = cut_lineage(dealt.select("first", "second", "slice").distinct())
    for epoch in range(iterations):
        for turn in range(blocks):
            apart = F.pmod(F.col("second") - F.col("first"), F.lit(blocks)) == turn
            # blocks meet in another order in each epoch, by the same rounds
            own = tasks.filter(apart)
            given = [state.filter(F.col("kind") == kind).join(own.withColumnRenamed(column, "block"), "block").select(
                         (F.col("first") if kind == "context" else F.col("block")).alias("first"), "slice",
                         F.lit(number).alias("turn"), *_names(STATE))
                     for number, (kind, column) in enumerate((("word", "first"), ("context", "second")))]
            rows = given[0].unionByName(given[1]).unionByName(
                dealt.filter(apart).select("first", "slice", F.lit(2).alias("turn"), "words", "contexts"), allowMissingColumns=True)
            sorted_rows = over_cores(rows, "first", "slice").sortWithinPartitions("first", "slice", "turn")
            made = sorted_rows.mapInArrow(_trained(epoch, seed), STATE)
            both = over_cores(state.unionByName(made), "kind", "block")
            state = cut_lineage(both.sortWithinPartitions("kind", "block", F.length("met")).mapInArrow(_joined, STATE))

    def unpacked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for numbers, vectors in zip(rows["numbers"], rows["vectors"]):
                ids = np.frombuffer(numbers, dtype="<i4")
                yield pd.DataFrame({"number": ids, "vector": list(_matrix(vectors, len(ids))[:, :-1])})

    vectors = state.filter(F.col("kind") == "word").mapInPandas(unpacked, "number bigint, vector array<float>")
    return vectors.join(words, "number").select("item", "vector")
