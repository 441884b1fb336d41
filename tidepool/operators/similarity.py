"""Top-k neighbours of vectors, block against block.

The vectors are dealt into blocks of bounded size, and the blocks into strips. Every pair of
strips is one group of rows for Spark to place; the group multiplies its blocks and hands on
the k best neighbours per vector only. No pair of vectors ever becomes a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidepool.functions.columns import norm
from tidepool.operators.joins import salted_join
from tidepool.operators.stored import FILE_BYTES, read_rows, shared_files, strips_of, write_in_order
from tidepool.shared import cut_lineage

BLOCK_ROWS = 2048
DIGITS = 9  # scores equal to this many digits are ties, which the smaller id wins
SLACK = 10.0 ** (1 - DIGITS)  # more than rounding adds to a score


def best_per_row(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the ``k`` largest entries per row; of equal ones the leftmost."""
    width = scores.shape[1]
    if width > k:
        least = np.partition(scores, width - k, axis=1)[:, width - k]
        rows, cols = np.nonzero((scores >= least[:, None]) & np.isfinite(scores))
    else:
        rows, cols = np.nonzero(np.isfinite(scores))
    order = np.lexsort((cols, -scores[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    rank = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
    return rows[rank < k], cols[rank < k]


def block_of(key: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key), blocks).cast("int")


def blocks_for(rows: int, block_rows: int) -> int:
    return max(1, -(-rows // block_rows))


def over_cores(df: DataFrame, *keys: str) -> DataFrame:
    """Groups dealt over all cores: their work grows faster than their bytes, which is all
    that Spark looks at when it merges small partitions."""
    spark = df.sparkSession
    tasks = max(2 * spark.sparkContext.defaultParallelism,
                int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(tasks, *keys)


def _with_blocks(df: DataFrame, block_rows: int, group: str | None) -> DataFrame:
    """Adds ``_block`` and ``_blocks``, the number of blocks in the row's group."""
    if group is None:
        counted = df.withColumn("_blocks", F.lit(blocks_for(df.count(), block_rows)))
    else:
        n = F.ceil(F.count("*") / F.lit(block_rows)).cast("int")
        sizes = df.groupBy(group).agg(n.alias("_blocks"))
        counted = salted_join(df, sizes, [group], salt_by=["item"])
    return counted.withColumn("_block", block_of("item", F.col("_blocks")))


# Rows of one matrix that are multiplied with how many of the other at a time, and scores of cells that are ranked at a time.
TILE_ROWS, TILE_COLUMNS, CELL_SCORES = 1024, 2048, 1 << 20
STRIP_BYTES = 16 << 20  # of vectors that a task holds, as 8-byte numbers, while it reads all others
COPIES = 4096  # indexed vectors that leave a task together


def block_exchange(
    vectors: DataFrame, block_rows: int = BLOCK_ROWS, group: str | None = None
) -> DataFrame:
    """``[group,] _low, _high, _strip, items, vectors``: what every pair of strips needs.

    The vectors of a block travel as one row. The blocks are dealt in turn into strips, the square root of
    their number, and each block goes to the pairs of its strip with every strip. So a vector is
    copied as often as there are strips, not blocks, and every two blocks meet in just one group.
    """
    keys = [*([group] if group else [])]
    packed = _with_blocks(vectors, block_rows, group).groupBy(*keys, "_blocks", "_block").agg(
        F.collect_list("item").alias("items"), F.flatten(F.collect_list("vector")).alias("vectors"))
    strips = F.ceil(F.sqrt("_blocks")).cast("int")
    placed = packed.select(*keys, (F.col("_block") % strips).alias("_strip"),
                           F.explode(F.sequence(F.lit(0), strips - 1)).alias("_other"), "items", "vectors")
    return placed.select(*keys, F.least("_strip", "_other").alias("_low"),
                         F.greatest("_strip", "_other").alias("_high"), "_strip", "items", "vectors")


def _strip(rows: pa.Table, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Items of a strip in order, and their vectors."""
    own = rows.filter(pc.equal(rows["_strip"], number))
    items = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in own["items"].chunks] or [np.empty(0)])
    vectors = np.concatenate([c.flatten().to_numpy() for c in own["vectors"].chunks] or [np.empty(0)])
    order = np.argsort(items, kind="stable")
    return items[order], vectors.astype("float64", copy=False).reshape(len(items), -1 if len(items) else 1)[order]


class _Nearest:
    """The ``k`` best others so far of each of a few vectors that meet the others in order; of equal ones the earlier stays.

    Scores are worked out roughly, as 4-byte numbers, and exactly only where a vector may be among the best.
    """

    def __init__(self, own: np.ndarray, k: int) -> None:
        self.own, self.narrow, self.k = own, own.astype("float32"), k
        self.length = np.linalg.norm(own, axis=1)
        self.least = np.full(len(own), -np.inf)  # the k-th score of a vector
        self.best = (np.empty(0, dtype="int64"), np.empty(0, dtype="int64"), np.empty(0))
        self.waiting: list = []
        self.size = 0

    def _rough(self, narrow: np.ndarray, longest: float) -> tuple[np.ndarray, np.ndarray] | None:
        """Pairs that may be better than what is kept, if they are few."""
        if np.isneginf(self.least).any():
            return None
        slack = 2.0 ** -22 * (narrow.shape[1] + 4) * self.length * longest + SLACK
        limits = np.nextafter((self.least - slack).astype("float32"), np.float32(-np.inf))
        found = np.flatnonzero(self.narrow @ narrow.T >= limits[:, None])
        return np.divmod(found, len(narrow)) if len(found) <= len(self.own) * len(narrow) // 64 else None

    def meet(self, others: np.ndarray, narrow: np.ndarray, longest: float, start: int, own_start: int | None) -> None:
        """``others`` are numbered from ``start``, and these vectors are those from ``own_start`` on among them."""
        few = self._rough(narrow, longest) if longest < 1e15 and len(self.own) else None
        if few is None:
            table = np.round(self.own @ others.T, DIGITS)
            if own_start is not None:
                same = np.arange(max(own_start, start), min(own_start + len(self.own), start + len(others)))
                table[same - own_start, same - start] = -np.inf
            table[table <= self.least[:, None]] = -np.inf
            rows, columns = best_per_row(table, self.k)
            scores = table[rows, columns]
        else:
            rows, columns = few
            scores = np.round(np.einsum("ij,ij->i", self.own[rows], others[columns]), DIGITS)
            better = scores > self.least[rows]
            if own_start is not None:
                better &= rows + own_start != columns + start
            rows, columns, scores = rows[better], columns[better], scores[better]
        if len(rows):
            self.waiting.append((rows, columns + start, scores))
            self.size += len(rows)
            if self.size >= len(self.own):
                self.settle()

    def settle(self) -> None:
        rows, columns, scores = (np.concatenate(x) for x in zip(self.best, *self.waiting))
        order = np.lexsort((columns, -scores, rows))
        rows, columns, scores = rows[order], columns[order], scores[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
        full = rows[rank == self.k - 1]
        self.least[full] = scores[rank == self.k - 1]
        kept = rank < self.k
        self.best, self.waiting, self.size = (rows[kept], columns[kept], scores[kept]), [], 0


def _tiles(others: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, float]]:
    """Where a tile of vectors starts, its vectors, these as 4-byte numbers and the length of the longest."""
    for start in range(0, len(others), TILE_COLUMNS):
        some = others[start:start + TILE_COLUMNS]
        yield start, some, some.astype("float32"), float(np.linalg.norm(some, axis=1).max())


def _directed(own: np.ndarray, others: np.ndarray, k: int, apart: bool) -> list[tuple]:
    """(rows, columns, scores) of the ``k`` best others of each; the earlier of equal ones.

    If ``apart``, both are the same vectors and none is its own neighbour.
    """
    parts = [(first, _Nearest(own[first:first + TILE_ROWS], k)) for first in range(0, len(own), TILE_ROWS)]
    for start, *tile in _tiles(others):
        for first, some in parts:
            some.meet(*tile, start, first if apart else None)
    for _, some in parts:
        some.settle()
    return [(some.best[0] + first, *some.best[1:]) for first, some in parts]


def top_neighbours(
    unit_vectors: DataFrame,
    k: int,
    include_self: bool = False,
    block_rows: int = BLOCK_ROWS,
    group: str | None = None,
) -> DataFrame:
    """The best ``k`` neighbours within each pair of strips: ``item, neighbour, score``.

    ``unit_vectors`` holds ``item`` and ``vector``; with ``group`` only vectors of the
    same group meet. A group holds two strips and one tile of scores. A later step
    keeps the best of all pairs of strips.
    """
    item_type = unit_vectors.schema["item"].dataType
    keys = [*([group] if group else []), "_low", "_high"]
    schema = T.StructType([
        T.StructField("item", item_type),
        T.StructField("neighbour", item_type),
        T.StructField("score", T.DoubleType()),
    ])
    arrow = to_arrow_schema(schema)

    def best(rows: pa.Table) -> pa.Table:
        low, high = rows["_low"][0].as_py(), rows["_high"][0].as_py()
        first = _strip(rows, low)
        second = first if low == high else _strip(rows, high)
        found = [(first[0], second[0], part) for part in _directed(first[1], second[1], k, low == high and not include_self)]
        if low != high:
            found += [(second[0], first[0], part) for part in _directed(second[1], first[1], k, False)]
        columns = [(own[at], others[to], scores) for own, others, (at, to, scores) in found if len(at)]
        if not columns:
            return arrow.empty_table()
        return pa.Table.from_arrays([pa.array(np.concatenate(c), f.type) for c, f in zip(zip(*columns), arrow)], schema=arrow)

    exchanged = block_exchange(unit_vectors, block_rows, group)
    return over_cores(exchanged, *keys).groupBy(*keys).applyInArrow(best, schema)


def keep_top(pairs: DataFrame, k: int) -> DataFrame:
    """The ``k`` best neighbours per item, with ``rank`` from 1.

    Spark keeps k rows per item in every task before it moves any.
    """
    best_first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("neighbour"))
    ranked = pairs.withColumn("rank", F.row_number().over(best_first))
    return ranked.filter(F.col("rank") <= k).select("item", "rank", "neighbour", "score")


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """``item, vector`` scaled to length 1; vectors of length 0 have no direction and drop out."""
    length = norm(F.col("vector"))
    # The length is bound once per vector here; as a column it would be worked out per number.
    scaled = F.transform(
        F.array(length), lambda n: F.transform("vector", lambda x: x.cast("double") / n)
    )[0]
    return vectors.filter(length > 0).select("item", scaled.alias("vector"))


def _matrix(rows: pa.RecordBatch) -> np.ndarray:
    return rows.column(1).flatten().to_numpy().reshape(len(rows), -1)


def _met_by_strips(k: int, include_self: bool, files: list[tuple[str, int]], strips: list[tuple[int, int, int]], schema: pa.Schema):
    """The ``k`` best of each item of a task's strips, each of which meets all stored vectors in order."""
    starts = np.cumsum([0, *(rows for _, rows in files)])

    def met(file: int, first: int, end: int) -> Iterator[pa.RecordBatch]:
        held = [(rows.column(0).take(pa.array(np.arange(len(rows)))), _matrix(rows).copy())
                for _, rows in read_rows(files[file][0], first, end)]
        items, own = pa.concat_arrays([x for x, _ in held]), np.concatenate([x for _, x in held])
        del held
        parts = [(at, _Nearest(own[at:at + TILE_ROWS], k)) for at in range(0, len(own), TILE_ROWS)]
        for number, (path, _) in enumerate(files):
            for place, rows in read_rows(path):
                for start, *tile in _tiles(_matrix(rows)):
                    for at, some in parts:
                        some.meet(*tile, int(starts[number]) + place + start, None if include_self else int(starts[file]) + first + at)
        for _, some in parts:
            some.settle()
        at, to, scores = (np.concatenate(x) for x in zip(*((some.best[0] + at, *some.best[1:]) for at, some in parts)))
        order = np.argsort(to, kind="stable")
        at, to, scores = at[order], to[order], scores[order]
        for number, (path, count) in enumerate(files):
            for place, rows in read_rows(path):
                low = int(starts[number]) + place
                a, b = np.searchsorted(to, [low, low + len(rows)])
                if a < b:
                    columns = items.take(pa.array(at[a:b])), rows.column(0).take(pa.array(to[a:b] - low)), pa.array(scores[a:b])
                    yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                yield from met(*strips[number])

    return of


def stored_neighbours(unit_vectors: DataFrame, k: int, include_self: bool, n: int, width: int) -> DataFrame:
    """The best ``k`` neighbours of each item, ``item, neighbour, score``, by vectors stored once.

    The vectors are written to the shared folder in order of items. A task holds a strip of them, reads all others file by
    file, and keeps the ``k`` best of each item: no vector is sent for a strip, and nothing but the best leaves a task.
    """
    spark = unit_vectors.sparkSession
    cores = spark.sparkContext.defaultParallelism
    bytes_ = 8 * max(1, width)
    files = write_in_order(unit_vectors, [F.asc("item")], max(-(-n * bytes_ // FILE_BYTES), min(2 * cores, blocks_for(n, BLOCK_ROWS))))
    most = max(1, min(STRIP_BYTES // bytes_, -(-n // (4 * cores))))
    strips = strips_of(files, most)
    item = unit_vectors.schema["item"].dataType
    schema = T.StructType([T.StructField("item", item), T.StructField("neighbour", item), T.StructField("score", T.DoubleType())])
    of = _met_by_strips(k, include_self, files, strips, to_arrow_schema(schema))
    return spark.range(0, len(strips), 1, max(1, len(strips))).mapInArrow(of, schema)


def cosine_topk(
    vectors: DataFrame, k: int = 10, include_self: bool = False, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """The ``k`` most similar items of every item by cosine, exactly."""
    units = unit_vectors(vectors)
    n, width = units.agg(F.count("*"), F.max(F.size("vector"))).first()
    if n > block_rows and shared_files(units.sparkSession):
        return keep_top(stored_neighbours(units, k, include_self, n, width), k)
    return keep_top(top_neighbours(units, k, include_self, block_rows), k)


def fit_cells(sample: np.ndarray, cells: int, rounds: int = 15, seed: int = 0) -> np.ndarray:
    """Centres of ``cells`` groups of unit vectors, by k-means on the sphere."""
    draw = np.random.default_rng(seed)
    centres = sample[draw.choice(len(sample), size=min(cells, len(sample)), replace=False)]
    for _ in range(rounds):
        nearest = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 0, sums / np.maximum(length, 1e-12), centres)
    return centres


def probes_needed(sample: np.ndarray, centres: np.ndarray, k: int, recall: float) -> int:
    """The fewest nearest cells per vector with which the sample's own neighbours mostly share one."""
    queries = sample[:256]
    scores = queries @ sample.T
    scores[np.arange(len(queries)), np.arange(len(queries))] = -np.inf
    best = np.argsort(-scores, axis=1, kind="stable")[:, :min(k, len(sample) - 1)]
    order = np.argsort(-(sample @ centres.T), axis=1, kind="stable")
    member = np.zeros(order.shape, dtype=bool)
    for probes in range(1, len(centres) + 1):
        np.put_along_axis(member, order[:, probes - 1:probes], True, axis=1)
        shared = (member[:len(queries), None, :] & member[best]).any(axis=2)
        if shared.mean() >= recall:
            return probes
    return len(centres)


def _nearest_cells(scores: np.ndarray, population: np.ndarray, probes: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest cells of each row, ``probes`` or more of them, and how many of them it takes to meet ``k`` others.

    Only as many are ranked as the row that takes most of them needs.
    """
    cells, wide = scores.shape[1], probes
    while True:
        wide = min(wide, cells)
        rows, columns = best_per_row(scores, wide) if wide < cells else ((), ())
        if len(rows) == wide * len(scores):
            order = columns.reshape(-1, wide)
        else:
            order = np.argsort(-scores, axis=1, kind="stable")
        met = np.cumsum(population[order], axis=1)
        if order.shape[1] == cells or (met[:, -1] > k).all():
            return order, (met <= k).sum(axis=1) + 1
        wide = 2 * wide


def _in_cells(units: DataFrame, centres: np.ndarray, probes: int, homes: np.ndarray, k: int) -> DataFrame:
    """``item, vector, bucket``: each vector in its ``probes`` nearest cells, and in as many more
    as it takes to meet ``k`` others, by the number of vectors at home in each (``homes``)."""
    sent = units.sparkSession.sparkContext.broadcast((centres, homes))
    schema = T.StructType([units.schema["item"], units.schema["vector"], T.StructField("bucket", T.IntegerType())])
    arrow = to_arrow_schema(schema)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, population = sent.value
        rows = max(1, CELL_SCORES // len(own))  # a batch by all cells, sorted, would be many times the batch
        for batch in batches:
            for start in range(0, len(batch), rows):
                part = batch.slice(start, rows)
                vectors = part.column(1)
                order, short = _nearest_cells(_matrix(part) @ own.T, population, probes, k)
                width = np.minimum(np.maximum(short, probes), order.shape[1])
                chosen = np.arange(order.shape[1]) < width[:, None]
                cells, at = order[chosen].astype("int32"), np.repeat(np.arange(len(part)), width)
                for some in range(0, len(at), COPIES):
                    own_rows = pa.array(at[some:some + COPIES])
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(own_rows), vectors.take(own_rows), pa.array(cells[some:some + COPIES])], schema=arrow)

    return units.mapInArrow(of, schema)


def cell_buckets(
    vectors: DataFrame, k: int, recall: float = 0.95, cells: int | None = None,
    sample_rows: int = 20_000, seed: int = 0,
) -> DataFrame:
    """The search index ``item, vector, bucket`` (see :func:`hashed_topk`)."""
    units = cut_lineage(unit_vectors(vectors))
    n = units.count()
    sample = units.orderBy(F.xxhash64("item")).limit(sample_rows).select("vector").collect()
    if not sample:
        return units.withColumn("bucket", F.lit(0))
    points = np.array([row.vector for row in sample])
    wanted = cells or max(1, min(round(4 * n ** 0.5), len(points) // 4))
    centres = fit_cells(points, wanted, seed=seed)
    probes = probes_needed(points, centres, k, recall)
    homes = np.zeros(len(centres), dtype="int64")
    for row in _in_cells(units, centres, 1, np.full(len(centres), k + 1), k).groupBy("bucket").count().collect():
        homes[row["bucket"]] = row["count"]  # one row a cell
    return _in_cells(units, centres, probes, homes, k)


def hashed_topk(
    vectors: DataFrame,
    k: int = 10,
    recall: float = 0.95,
    cells: int | None = None,
    sample_rows: int = 20_000,
    seed: int = 0,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The ``k`` most similar items among those that share a cell with the item.

    The centres of the cells are fitted on at most ``sample_rows`` vectors (those with the
    smallest hashes); how many nearest cells a vector goes to is the least number with which
    ``recall`` of the neighbours within the sample share one. Every vector is indexed, and in
    so many cells that it meets ``k`` others if there are so many. The number of cells grows
    with the square root of the vectors, so vectors with structure meet a falling share of
    the others; vectors without any need many cells. Within a cell the search is exact, and
    a cell of any size is cut in blocks.
    """
    bucketed = cut_lineage(cell_buckets(vectors, k, recall, cells, sample_rows, seed))
    return _within_cells(bucketed, k, block_rows)


def _within_cells(bucketed: DataFrame, k: int, block_rows: int) -> DataFrame:
    found = top_neighbours(bucketed, k, block_rows=block_rows, group="bucket")
    # A pair may meet in several cells, with scores that differ by rounding.
    once = found.groupBy("item", "neighbour").agg(F.max("score").alias("score"))
    return keep_top(once, k)


def search_quality(vectors: DataFrame, k: int = 10, block_rows: int = BLOCK_ROWS, **settings) -> DataFrame:
    """``items, found, recall, compared``: hashed against exact search, on all items.

    ``compared`` is the number of comparisons as a share of those of the exact search.
    """
    bucketed = cut_lineage(cell_buckets(vectors, k, **settings))
    hashed = cut_lineage(_within_cells(bucketed, k, block_rows))
    exact = cut_lineage(cosine_topk(vectors, k))
    sizes = bucketed.groupBy("bucket").agg(F.count("*").cast("double").alias("n"))
    # single rows of totals
    pairs = sizes.agg(F.sum(F.col("n") * (F.col("n") - 1)).alias("pairs")).first()["pairs"]
    wanted, hits = exact.count(), exact.join(hashed, ["item", "neighbour"], "left_semi").count()
    return unit_vectors(vectors).agg(F.count("*").alias("items")).select(
        "items", F.lit(hashed.count()).alias("found"),
        F.try_divide(F.lit(float(hits)), F.lit(float(wanted))).alias("recall"),
        F.try_divide(F.lit(pairs), (F.col("items") * (F.col("items") - 1)).cast("double")).alias("compared"),
    )


def as_text(topk: DataFrame) -> DataFrame:
    """``item, topk``: the neighbours as ``item=score`` texts, best first (k per item)."""
    entry = F.concat_ws("=", F.col("neighbour").cast("string"), F.col("score").cast("string"))
    return topk.groupBy("item").agg(
        F.sort_array(F.collect_list(F.struct("rank", entry.alias("entry")))).alias("entries")
    ).select("item", F.col("entries.entry").alias("topk"))
