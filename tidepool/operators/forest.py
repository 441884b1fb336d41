"""Approximate neighbours of vectors by a forest of random projection trees, widened over neighbours.

Trees are fitted on a bounded sample: each node splits its members by the plane between two of them, at the median. The
planes are a small table in every task; every vector is put into one leaf of each tree, and vectors of a leaf are
compared exactly. Then each vector meets those with a neighbour in common, until the recall that was asked
for is reached on queries whose true neighbours among all vectors are known.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidepool.operators.joins import salted_join
from tidepool.operators.similarity import (
    BLOCK_ROWS, DIGITS, best_per_row, cosine_topk, keep_top, over_cores, top_neighbours, unit_vectors,
)
from tidepool.shared import cut_lineage

# Vectors that the planes are fitted on, queries that recall is measured with, levels of a tree at most (2 ** MOST_LEVELS planes).
SAMPLE_ROWS, QUERIES, MOST_LEVELS = 20_000, 256, 12
TREES, LEAF_ROWS, ROUNDS = 10, 128, 4
SCORES = 1 << 19  # of small buckets that are made at a time


def fit_forest(sample: np.ndarray, trees: int, levels: int, seed: int = 0) -> list[list[np.ndarray]]:
    """By tree and level the planes of all nodes: a normal and the place along it where the node is split."""
    draw = np.random.default_rng(seed)
    forest = []
    for _ in range(trees):
        node, tree = np.zeros(len(sample), dtype=np.int64), []
        for level in range(levels):
            planes = np.zeros((1 << level, sample.shape[1] + 1))
            order = np.argsort(node, kind="stable")
            bounds = np.searchsorted(node[order], np.arange((1 << level) + 1))
            side = np.zeros(len(sample), dtype=bool)
            for k in range(1 << level):
                own = order[bounds[k]:bounds[k + 1]]
                if len(own) > 1:
                    one, other = sample[draw.choice(own, size=2, replace=False)]
                    normal = one - other
                else:
                    normal = np.zeros(sample.shape[1])
                if not normal.any():  # copies, or nothing to go by
                    normal = draw.normal(size=sample.shape[1])
                along = sample[own] @ normal
                planes[k] = [*normal, np.median(along) if len(own) else 0.0]
                side[own] = along > planes[k, -1]
            tree.append(planes)
            node = 2 * node + side
        forest.append(tree)
    return forest


def leaves(vectors: np.ndarray, forest: list[list[np.ndarray]]) -> np.ndarray:
    """The leaf of each vector in each tree (a column a tree), numbered over all trees."""
    out = []
    for number, tree in enumerate(forest):
        node = np.zeros(len(vectors), dtype=np.int64)
        for planes in tree:
            own = planes[node]
            node = 2 * node + (np.einsum("ij,ij->i", vectors, own[:, :-1]) > own[:, -1])
        out.append((number << len(tree)) + node)
    return np.stack(out, axis=1)


def in_leaves(units: DataFrame, forest: list[list[np.ndarray]]) -> DataFrame:
    """``item, vector, bucket``: every vector once for each tree."""
    sent = units.sparkSession.sparkContext.broadcast(forest)  # trees x 2 ** MOST_LEVELS planes at most
    schema = T.StructType([units.schema["item"], units.schema["vector"], T.StructField("bucket", T.LongType())])
    arrow = to_arrow_schema(schema)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                held = batch.column(1)
                matrix = held.flatten().to_numpy().reshape(len(batch), -1)
                found = leaves(matrix, sent.value)
                for k in range(found.shape[1]):
                    yield pa.RecordBatch.from_arrays([batch.column(0), held, pa.array(found[:, k])], schema=arrow)

    return units.mapInArrow(of, schema)


def true_neighbours(units: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``item, rank, neighbour, score``: the ``k`` best of a bounded number of queries among all vectors, exactly."""
    rows = queries.collect()
    sent = units.sparkSession.sparkContext.broadcast(([r["item"] for r in rows], np.array([r["vector"] for r in rows])))
    kind = units.schema["item"].dataType.simpleString()

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, wanted = sent.value
        for batch in batches:
            if len(batch) and len(names):
                own = batch.sort_values("item", kind="stable")
                items = own["item"].to_numpy()
                scores = np.round(wanted @ np.stack(own["vector"].to_numpy()).T, DIGITS)
                scores[np.array([[n == i for i in items] for n in names]) if items.dtype == object
                       else np.equal.outer(np.array(names), items)] = -np.inf
                at, to = best_per_row(scores, k)
                yield pd.DataFrame({"item": np.array(names, dtype=items.dtype)[at], "neighbour": items[to], "score": scores[at, to]})

    return keep_top(units.mapInPandas(of, f"item {kind}, neighbour {kind}, score double"), k)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Item, vector, least and bucket of rows sorted by bucket, in parts that hold whole buckets."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        buckets = batch.column(3).to_numpy()
        ends = np.flatnonzero(buckets[1:] != buckets[:-1]) + 1
        if held and len(buckets) and held[-1].column(3)[-1].as_py() != buckets[0]:
            ends = np.concatenate(([0], ends))
        last = ends[-1] if len(ends) else 0
        if len(ends):
            yield _arrays([*held, batch.slice(0, last)])
            held = []
        held += [batch.slice(last)] if last < len(batch) else []
    if held:
        yield _arrays(held)


def _arrays(parts: list[pa.RecordBatch]) -> tuple[np.ndarray, ...]:
    table = pa.Table.from_batches(parts)
    items, least, buckets = (table.column(k).to_numpy() for k in (0, 2, 3))
    vectors = np.concatenate([c.flatten().to_numpy() for c in table.column(1).chunks]).reshape(len(items), -1)
    order = np.lexsort((items, buckets)) if items.dtype != object else np.array(
        sorted(range(len(items)), key=lambda n: (buckets[n], items[n])))
    return items[order], vectors[order], least[order], buckets[order]


def met_in_buckets(bucketed: DataFrame, k: int) -> DataFrame:
    """``item, neighbour, score``: within each bucket the best ``k`` of each item that score ``least`` or more.

    For buckets of bounded size, which lie whole in one task; those of equal size are multiplied together.
    """
    schema = T.StructType([T.StructField(name, bucketed.schema["item"].dataType) for name in ("item", "neighbour")]
                          + [T.StructField("score", T.DoubleType())])
    arrow = to_arrow_schema(schema)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for items, vectors, least, buckets in _runs(batches):
            first = np.flatnonzero(np.concatenate(([True], buckets[1:] != buckets[:-1])))
            sizes = np.diff(np.append(first, len(buckets)))
            for size in np.unique(sizes[sizes > 1]):
                starts, together = first[sizes == size], max(1, SCORES // (size * size))
                for at in range(0, len(starts), together):
                    rows = starts[at:at + together, None] + np.arange(size)
                    some = vectors[rows]
                    scores = np.round(some @ some.transpose(0, 2, 1), DIGITS)
                    scores[:, np.arange(size), np.arange(size)] = -np.inf
                    scores[scores < least[rows][:, :, None]] = -np.inf
                    table = scores.reshape(-1, size)
                    own, to = best_per_row(table, k)
                    if len(own):
                        columns = items[rows.ravel()[own]], items[rows[own // size, to]], table[own, to]
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    columns = bucketed.select("item", "vector", F.coalesce("least", F.lit(float("-inf"))).alias("least"), "bucket")
    return over_cores(columns, "bucket").sortWithinPartitions("bucket").mapInArrow(of, schema)


def neighbours_in_buckets(bucketed: DataFrame, k: int, block_rows: int) -> DataFrame:
    """The best ``k`` of each item within each bucket; buckets above ``block_rows`` are cut in blocks."""
    large = cut_lineage(bucketed.groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > block_rows).select("bucket"))
    if large.isEmpty():
        return met_in_buckets(bucketed, k)
    some = salted_join(bucketed, large, ["bucket"], "left_semi", salt_by=["item"]).drop("least")
    others = salted_join(bucketed, large, ["bucket"], "left_anti", salt_by=["item"])
    return met_in_buckets(others, k).unionByName(top_neighbours(some, k, block_rows=block_rows, group="bucket"))


def _pairs(bucketed: DataFrame) -> float:
    """Comparisons within buckets."""
    sizes = bucketed.groupBy("bucket").agg(F.count("*").cast("double").alias("n"))
    return sizes.agg(F.sum(F.col("n") * (F.col("n") - 1))).first()[0] or 0.0


def _merged(old: DataFrame | None, found: DataFrame, wide: int) -> DataFrame:
    """The ``wide`` best of each item; a pair that was met in several buckets counts once."""
    found = found if old is None else found.unionByName(old.select("item", "neighbour", "score"))
    return cut_lineage(keep_top(found.groupBy("item", "neighbour").agg(F.max("score").alias("score")), wide))


def forest_search(vectors: DataFrame, k: int = 10, recall: float = 0.92, trees: int = TREES, leaf_rows: int = LEAF_ROWS,
                  rounds: int = ROUNDS, sample_rows: int = SAMPLE_ROWS, seed: int = 0,
                  block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, dict]:
    """(``item, rank, neighbour, score``, what it took: compared, rounds, recall on the queries).

    After the trees each round puts every vector into a bucket of its own and those of its neighbours, so that vectors with
    a neighbour in common meet. If ``rounds`` don't reach ``recall``, as with vectors without any structure, or a
    round brings so little that those left wouldn't reach it, the exact search is made after all: the result never falls short of it. Buckets of any size are cut in blocks.
    """
    units = cut_lineage(unit_vectors(vectors))
    n = units.count()
    sample = units.orderBy(F.xxhash64("item"), "item").limit(sample_rows).select("item", "vector").collect()
    took = {"compared": 0.0, "rounds": 0, "recall": 1.0}
    if n <= max(leaf_rows, 2 * k):
        took["compared"] = float(n) * max(n - 1, 0)
        return cosine_topk(vectors, k, block_rows=block_rows), took
    points = np.array([row["vector"] for row in sample])
    levels = int(np.clip(np.ceil(np.log2(n / leaf_rows)), 1, MOST_LEVELS))
    queries = units.sparkSession.createDataFrame(sample[:QUERIES], units.select("item", "vector").schema)
    true = cut_lineage(true_neighbours(units, queries, k))
    wanted, wide = true.count(), 2 * k
    took["compared"] += float(min(QUERIES, n)) * n

    def reached(graph: DataFrame) -> float:
        best = graph.filter(F.col("rank") <= k).select("item", "neighbour")
        return true.join(best, ["item", "neighbour"], "left_semi").count() / max(wanted, 1)

    bucketed = cut_lineage(in_leaves(units, fit_forest(points, trees, levels, seed)).withColumn("least", F.lit(None).cast("double")))
    graph = None
    for turn in range(rounds + 1):
        took["compared"] += _pairs(bucketed)
        graph = _merged(graph, neighbours_in_buckets(bucketed, wide, block_rows), wide)
        before, took["recall"] = took["recall"] if turn else 0.0, reached(graph)
        if took["recall"] >= recall:
            return graph.filter(F.col("rank") <= k), took
        gain = took["recall"] - before
        # a round brings less than the one before it; at this pace the rest wouldn't do
        if turn == rounds or gain < 0.02 or (turn > 1 and took["recall"] + (rounds - turn) * gain < recall):
            break
        took["rounds"] += 1
        homes = graph.select("item", F.xxhash64("neighbour").alias("bucket")).unionByName(
            units.select("item", F.xxhash64("item").alias("bucket")))
        # an item with all its neighbours takes only those that are as near as the last of them
        last = graph.filter(F.col("rank") == wide).select("item", F.col("score").alias("least"))
        bounded = units.join(last, "item", "left")
        bucketed = cut_lineage(salted_join(homes, bounded, ["item"]).select("item", "vector", "bucket", "least"))
    took["compared"] += float(n) * (n - 1)
    took["recall"] = 1.0
    return cosine_topk(vectors, k, block_rows=block_rows), took


def forest_topk(vectors: DataFrame, k: int = 10, **settings) -> DataFrame:
    """The ``k`` most similar items by :func:`forest_search`."""
    return forest_search(vectors, k, **settings)[0]
