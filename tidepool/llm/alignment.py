"""Links between the tokens of two tokenizers, counted over a corpus by a minimal perfect hash.

The tokens of a byte-level vocabulary and those of a piece vocabulary cover the same bytes of a
document. Two tokens are linked where their bytes overlap. How often each pair of ids is linked
in the whole corpus is counted in dense vectors, one number for each different pair, at the place
that a minimal perfect hash of the pairs gives.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.packing import Encoder, byte_letters
from tidepool.llm.texts import mixed
from tidepool.shared import cut_lineage, scratch_path

#: Pairs that one perfect hash holds about, and pairs that are sent to the tasks at a time. With
#: more pairs the documents are counted and looked up in rounds.
SHARD_PAIRS, SENT_PAIRS = 1 << 18, 1 << 21
#: Places of a level of the hash for each pair that is left, and levels at most.
ROOM, LEVELS = 2, 64
#: Vectors that are added in one group.
FAN = 16
#: Characters of a text that are encoded at a time, where it can be cut.
STEP = 1 << 18
#: Bytes of rows that a task gathers before it hands them on, and ids that it aligns at a time
#: (of whole documents, one at least).
BATCH_BYTES, TOGETHER = 8 << 20, 1 << 19

# -- tokens -----------------------------------------------------------------------------------

_BYTE = re.compile("<0x([0-9A-F]{2})>")


def _narrow(size: int) -> np.dtype:
    return np.dtype("<u2" if size <= 1 << 16 else "<u4")


#: Before spaces that follow a sign which no version of the character tables takes for white
#: space, and that something else follows.
_CUT = re.compile(r"(?<=[\w!-~])(?= +[^ ])")


class Aligner:
    """Both tokenizers, and the bytes of all their tokens."""

    def __init__(self, byte_path: str, piece_path: str) -> None:
        self.encoder = Encoder(byte_path, plain=True)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        letters = byte_letters()
        known = self.encoder.whole.get_vocab(with_added_tokens=True)
        left = [b""] * (max(known.values()) + 1)
        for token, number in known.items():
            left[number] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        names = [self.pieces.id_to_piece(k) for k in range(self.pieces.get_piece_size())]
        right = [bytes([int(m[1], 16)]) if (m := _BYTE.fullmatch(name)) else name.replace("▁", " ").encode() for name in names]
        sides = left, right
        self.sizes = tuple(np.array([len(t) for t in side], dtype=np.int64) for side in sides)
        self.kinds = tuple(_narrow(len(side)) for side in sides)
        #: the bytes of all tokens one behind the other, and where each token's begin
        self.joined = tuple((np.frombuffer(b"".join(side), dtype=np.uint8), np.concatenate(([0], np.cumsum(size)[:-1])))
                            for side, size in zip(sides, self.sizes))
        #: ids as text, with room for one sign
        widths = [len(str(len(side) - 1)) for side in sides]
        self.written = [np.array([str(k) for k in range(len(side))], dtype=f"S{max(widths) + 1}").view(np.uint8).reshape(len(side), -1)
                        for side in sides]
        #: no token of either kind goes on over a space after a word, so a text may be cut there
        self.cuts = self.encoder.ranked is not None and not any("▁" in name.lstrip("▁") for name in names)

    def _parts(self, text: str) -> Iterator[str]:
        """The text cut before spaces, one of which is left out at each cut."""
        start = 0
        while self.cuts and len(text) - start > STEP and (cut := _CUT.search(text, start + STEP)):
            yield text[start:cut.start()]
            start = cut.start() + 1
        yield text[start:]

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids by both tokenizers; none if a side's bytes are not those of a space and the text."""
        none = tuple(np.empty(0, dtype=kind) for kind in self.kinds)
        if not text:
            return none
        both: tuple[list, list] = [], []
        for part in self._parts(text):
            whole = np.frombuffer(f" {part}".encode("utf-8", "surrogatepass"), dtype=np.uint8)
            for side, ids in enumerate((self.encoder.ids(" " + part), self.pieces.encode(part, return_type="numpy"))):
                if not self._spells(side, ids, whole):
                    return none
                both[side].append(ids.astype(self.kinds[side]))
        return np.concatenate(both[0]), np.concatenate(both[1])

    def _spells(self, side: int, ids: np.ndarray, whole: np.ndarray) -> bool:
        """Whether the bytes of the tokens, one after the other, are ``whole``."""
        flat, starts = self.joined[side]
        sizes = self.sizes[side][ids]
        ends = np.cumsum(sizes)
        if int(ends[-1] if len(ends) else 0) != len(whole):
            return False
        at = np.repeat((starts[ids] - (ends - sizes)).astype(np.int32), sizes)
        at += np.arange(len(whole), dtype=np.int32)
        return bool((flat[at] == whole).all())

    def groups(self, left: np.ndarray, right: np.ndarray) -> tuple[int, bytes]:
        """How many groups the common ends cut the tokens into, and the groups as text."""
        if not len(left):
            return 0, b""
        ends = [np.cumsum(size[ids]) for size, ids in zip(self.sizes, (left, right))]
        marked = np.zeros((2, int(ends[0][-1]) + 1), dtype=bool)
        for side, end in zip(marked, ends):
            side[end] = True
        both = marked[0] & marked[1]
        number = np.cumsum(both, dtype=np.int64)
        # twice the number of a token's group (those that end before it, or with it), plus its side
        group = np.concatenate([2 * (number[end] - both[end]) + side for side, end in enumerate(ends)])
        order = np.argsort(group, kind="stable")
        own = group[order]
        text = np.concatenate([table[ids] for table, ids in zip(self.written, (left, right))])[order]
        sign = np.zeros(len(own), dtype=np.uint8)
        sign[:-1] = np.where(own[1:] == own[:-1], ord(","), np.where(own[:-1] % 2 == 0, ord("|"), ord(";")))
        text[:, -1] = sign
        return int(number[-1]), text[text != 0].tobytes()

    def links(self, left: np.ndarray, right: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pairs, bounds) of documents that follow one another in ``left`` and ``right``.

        ``counts`` are the first ids by document. A pair is left id * 2 ** 32 + right id; the
        links of document k are those from bounds[k] to bounds[k + 1]. Each stretch between two
        ends of either kind lies in one token of both kinds, and this is their one link.
        """
        ends = [np.cumsum(size[ids]) for size, ids in zip(self.sizes, (left, right))]
        width = int(ends[0][-1]) + 1 if len(left) else 1
        marked = np.zeros((2, width), dtype=bool)
        for side, end in zip(marked, ends):
            side[end] = True
        both = np.flatnonzero(marked[0] | marked[1])
        one, other = (ids[np.cumsum(m := mark[both], dtype=np.int64) - m].astype(np.int64) for ids, mark in zip((left, right), marked))
        last = np.concatenate(([0], ends[0]))[np.concatenate(([0], np.cumsum(counts)))]
        return (one << 32) | other, np.searchsorted(both, last, side="right")


@functools.cache
def aligner(byte_path: str, piece_path: str) -> Aligner:
    """The aligner of this Python process, made once."""
    return Aligner(byte_path, piece_path)


TOKEN_ROWS = ("id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              "a_ids binary, b_ids binary")
_KINDS = [pa.int64()] * 5 + [pa.string(), pa.binary(), pa.binary(), pa.string()]
_NAMES = [part.split(" ")[0] for part in TOKEN_ROWS.split(", ")] + ["groups"]


def aligned(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id",
            text_col: str = "text", keep_groups: bool = False) -> DataFrame:
    """The tokens of each document and the groups that common ends cut them into.

    A row for each row of ``docs``, whatever its id. NULL and empty texts, and texts that a
    tokenizer changes (its bytes are not those of a space and the text), have no tokens: zeros
    and an empty ``groups_sha256``. With ``keep_groups`` the groups are in ``groups`` as well,
    written as ``a1,a2|b1;a3|b2,b3``. The result is written to the shared folder, packed,
    for the passes that follow.
    """
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(byte_path, piece_path)
        width = len(_NAMES) - (not keep_groups)
        rows, size = [], 0

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], _NAMES[:width])

        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1)):
                left, right = own.tokens(text.as_py())
                groups, written = own.groups(left, right)
                digest = hashlib.sha256(written).hexdigest() if len(left) else ""
                row = (name.as_py(), len(left), len(right), groups, len(left) + len(right) - groups, digest,
                       left.tobytes(), right.tobytes(), written)
                rows.append(row[:width])
                size += len(row[6]) + len(row[7]) + keep_groups * len(written)
                if size > BATCH_BYTES:
                    yield packed()
                    rows, size = [], 0
        if rows:
            yield packed()

    path = scratch_path(docs.sparkSession, "tokens")
    schema = TOKEN_ROWS + (", groups string" if keep_groups else "")
    (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
     .mapInArrow(of, schema).write.option("compression", "zstd").parquet(path))
    return docs.sparkSession.read.parquet(path)


def _linked(own: Aligner, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, pairs, bounds) of some documents at a time, by the columns a_ids and b_ids."""
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(name)) for name in ("a_ids", "b_ids")]
        sizes = [np.diff(np.frombuffer(c.buffers()[1], dtype="<i4")[c.offset:c.offset + len(c) + 1]).astype(np.int64) // kind.itemsize
                 for c, kind in zip(columns, own.kinds)]
        step = np.cumsum(sizes[0]) // TOGETHER
        cuts = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), len(batch)]
        for start, end in zip(cuts, cuts[1:]):
            if end > start:
                left, right = (np.frombuffer(b"".join(c.slice(start, end - start).to_pylist()), dtype=kind)
                               for c, kind in zip(columns, own.kinds))
                yield batch.slice(start, end - start), *own.links(left, right, sizes[0][start:end])


# -- perfect hash -----------------------------------------------------------------------------


def _spot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    step = np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    return (mixed(keys.view(np.uint64) + step) % np.uint64(size)).astype(np.int64)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return _spot(keys, LEVELS, shards)


def build(keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """(levels, keys by place): a minimal perfect hash of different 64-bit keys.

    In each level the keys that are alone on their place stay there, the others go on to the
    next. A key's number is the count of taken places before its own, over all levels.
    """
    levels, placed, left = [], [np.empty(0, dtype=np.int64)], keys
    while len(left):
        if len(levels) == LEVELS:
            raise ValueError("the keys must be different")
        size = ROOM * len(left)
        at = _spot(left, len(levels), size)
        alone = np.bincount(at, minlength=size)[at] == 1
        taken = np.zeros(size, dtype=bool)
        taken[at[alone]] = True
        levels.append(taken)
        placed.append(left[alone][np.argsort(at[alone])])
        left = left[~alone]
    return levels, np.concatenate(placed)


class Perfect:
    """Looks keys up; ``numbers`` is below 0 for a key that the hash wasn't built from."""

    def __init__(self, levels: list[np.ndarray], keys: np.ndarray) -> None:
        self.levels, self.keys = levels, keys
        counts = np.cumsum(np.concatenate([np.zeros(1, dtype=np.int32), *levels]), dtype=np.int32)
        bounds = np.cumsum([0, *map(len, levels)])
        self.ranks = [counts[a:b] for a, b in zip(bounds, bounds[1:])]

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, dtype=np.int64)
        todo = np.arange(len(keys))
        for level, taken in enumerate(self.levels):
            at = _spot(keys[todo], level, len(taken))
            hit = taken[at]
            out[todo[hit]] = self.ranks[level][at[hit]]
            todo = todo[~hit]
            if not len(todo):
                break
        found = np.flatnonzero(out >= 0)
        out[found[self.keys[out[found]] != keys[found]]] = -1
        return out


class Round:
    """The hashes of some shards one behind the other; built once in each task."""

    def __init__(self, shards: int, rows: list[tuple]) -> None:
        self.shards, self.hashes, self.first, self.width = shards, {}, {}, 0
        counts = [np.empty(0, dtype=np.int64)]
        for shard, sizes, bits, keys, *count in rows:
            bounds = np.cumsum([0, *sizes])
            taken = np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=bounds[-1]).astype(bool)
            self.hashes[shard] = Perfect([taken[a:b] for a, b in zip(bounds, bounds[1:])], np.frombuffer(keys, dtype="<i8"))
            self.first[shard] = self.width
            self.width += len(keys) // 8
            counts += [np.frombuffer(c, dtype="<i8") for c in count]
        self.counts = np.concatenate(counts)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The place of each pair in this round's vector; below 0 for pairs of other rounds."""
        out = np.full(len(keys), -1, dtype=np.int64)
        own = shard_of(keys, self.shards) if self.shards > 1 else np.zeros(len(keys), dtype=np.int64)
        for shard, perfect in self.hashes.items():
            at = np.flatnonzero(own == shard)
            numbers = perfect.numbers(keys[at])
            out[at] = np.where(numbers >= 0, numbers + self.first[shard], -1)
        return out


# -- counts -----------------------------------------------------------------------------------


def _different(byte_path: str, piece_path: str) -> Callable:
    """The different pairs of a task's documents."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(byte_path, piece_path)
        seen = np.empty(0, dtype=np.int64)
        for _, keys, _ in _linked(own, batches):
            seen = np.union1d(seen, pd.unique(keys))
            if len(seen) > SHARD_PAIRS:
                yield pa.RecordBatch.from_arrays([pa.array(seen)], ["pair"])
                seen = seen[:0]
        if len(seen):
            yield pa.RecordBatch.from_arrays([pa.array(seen)], ["pair"])

    return of


def _dealt(shards: int) -> Callable:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shard_of(keys, shards), pa.int32())], ["pair", "shard"])

    return of


def _hashed(rows: pd.DataFrame) -> pd.DataFrame:
    levels, keys = build(np.sort(rows["pair"].to_numpy()))
    return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "sizes": [[len(x) for x in levels]],
                         "bits": [np.packbits(np.concatenate(levels)).tobytes()], "pairs": [keys.astype("<i8").tobytes()]})


def _counted(byte_path: str, piece_path: str, shards: int, sent) -> Callable:
    """The dense vectors of a task: how often each pair of a round is linked in its documents."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, now = aligner(byte_path, piece_path), Round(shards, sent.value)
        sums = np.zeros(now.width, dtype=np.int64)
        held, waiting = [], 0
        for _, keys, _ in _linked(own, batches):
            numbers = now.numbers(keys)
            held.append(numbers[numbers >= 0])
            waiting += len(held[-1])
            if waiting >= now.width:
                sums += np.bincount(np.concatenate(held), minlength=now.width)
                held, waiting = [], 0
        if held:
            sums += np.bincount(np.concatenate(held), minlength=now.width)
        if sums.any():
            part = TaskContext.get().partitionId()
            bounds = [(shard, first, first + len(now.hashes[shard].keys)) for shard, first in now.first.items()]
            rows = [(shard, part, sums[a:b].astype("<i8").tobytes()) for shard, a, b in bounds]
            for row in rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], k) for x, k in zip(row, (pa.int32(), pa.int32(), pa.binary()))], ["shard", "part", "counts"])

    return of


COUNT_ROWS = "shard int, part int, counts binary"


def _added(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.frombuffer(rows["counts"].iloc[0], dtype="<i8").copy()
    for one in rows["counts"].iloc[1:]:
        total += np.frombuffer(one, dtype="<i8")
    return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "part": [rows["part"].iloc[0] // FAN], "counts": [total.tobytes()]})


def tree_sum(vectors: DataFrame, parts: int) -> DataFrame:
    """(shard, counts): the vectors of all parts 0 to ``parts`` - 1, added ``FAN`` at a time."""
    while True:
        group = F.floor(F.col("part") / FAN).cast("int").alias("group")
        vectors = vectors.groupBy("shard", group).applyInPandas(_added, COUNT_ROWS)
        parts = -(-parts // FAN)
        if parts <= 1:
            return vectors.drop("part")


@dataclass(frozen=True)
class Model:
    """The pairs of a corpus: ``table`` (shard, sizes, bits, pairs, counts), and the highest count of each right id."""

    byte_path: str
    piece_path: str
    shards: int
    table: DataFrame | None
    best: np.ndarray

    def rounds(self) -> Iterator[DataFrame]:
        each = max(1, SENT_PAIRS // SHARD_PAIRS)
        for first in range(0, self.shards, each):
            yield self.table.where((F.col("shard") >= first) & (F.col("shard") < first + each))


def count_pairs(tokens: DataFrame, byte_path: str, piece_path: str, tasks: int | None = None) -> Model:
    """Counts how often each pair of ids is linked in all documents of ``tokens`` (from ``aligned``).

    The different pairs are dealt into shards of about ``SHARD_PAIRS`` and each shard gets a
    minimal perfect hash with its pairs in the order of their numbers. ``tasks`` tasks (twice
    the cores) add their documents' links to dense vectors of 8 bytes a pair, which
    are then added as a tree. Sent to the tasks at a time are the hashes of ``SENT_PAIRS``
    pairs at most or about that (17 bytes a pair with the counts, 40 MB); with more pairs the
    documents are gone through in rounds, so any number of pairs is counted in bounded
    memory. The highest counts are as many numbers as the right vocabulary has.
    """
    spark: SparkSession = tokens.sparkSession
    sides = tokens.where("n_a > 0").select("a_ids", "b_ids")
    pairs = cut_lineage(sides.mapInArrow(_different(byte_path, piece_path), "pair long").distinct())
    total = pairs.count()
    highest = np.zeros(sentencepiece.SentencePieceProcessor(model_file=piece_path).get_piece_size(), dtype=np.int64)
    if not total:
        return Model(byte_path, piece_path, 0, None, highest)
    shards = -(-total // SHARD_PAIRS)
    hashes = cut_lineage(pairs.mapInArrow(_dealt(shards), "pair long, shard int").groupBy("shard")
                         .applyInPandas(_hashed, "shard int, sizes array<long>, bits binary, pairs binary"))
    model = Model(byte_path, piece_path, shards, hashes, highest)
    tasks = tasks or 2 * spark.sparkContext.defaultParallelism
    few = sides.coalesce(tasks)
    counts = []
    for some in model.rounds():
        sent = spark.sparkContext.broadcast([tuple(row) for row in some.collect()])  # bounded by SENT_PAIRS
        counts.append(cut_lineage(tree_sum(few.mapInArrow(_counted(byte_path, piece_path, shards, sent), COUNT_ROWS), tasks)))
        sent.unpersist()
    table = cut_lineage(hashes.join(functools.reduce(DataFrame.unionAll, counts), "shard"))
    for row in _highest(table).collect():  # one row for an id of the right vocabulary
        highest[row["b"]] = row["count"]
    return Model(byte_path, piece_path, shards, table, highest)


def _unpacked(reduce: bool) -> Callable:
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for pairs, counts in zip(batch["pairs"], batch["counts"]):
                keys, numbers = np.frombuffer(pairs, dtype="<i8"), np.frombuffer(counts, dtype="<i8")
                out = pd.DataFrame({"a": keys >> 32, "b": keys & 0xFFFFFFFF, "count": numbers})
                yield out.groupby("b", as_index=False)["count"].max() if reduce else out

    return of


def _highest(table: DataFrame) -> DataFrame:
    own = table.select("pairs", "counts").mapInPandas(_unpacked(True), "b long, count long")
    return own.groupBy("b").agg(F.max("count").alias("count"))


def pair_counts(spark: SparkSession, model: Model) -> DataFrame:
    """(a, b, count): every pair of ids that is linked anywhere, and how often."""
    if model.table is None:
        return spark.createDataFrame([], "a long, b long, count long")
    return model.table.select("pairs", "counts").mapInPandas(_unpacked(False), "a long, b long, count long")


SCORED = ("id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _looked_up(model: Model, sent, highest, schema: list[str]) -> Callable:
    byte_path, piece_path, shards = model.byte_path, model.piece_path, model.shards

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, now, most = aligner(byte_path, piece_path), Round(shards, sent.value), highest.value
        for batch, keys, bounds in _linked(own, batches):
            numbers = now.numbers(keys)
            found = numbers >= 0
            count = np.where(found, now.counts[np.where(found, numbers, 0)], 0)
            best = found & (count == most[keys & 0xFFFFFFFF])
            sums = {}
            for name, values in (("count_sum", count), ("n_best", best)):
                whole = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
                before = batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)
                sums[name] = pa.array(before + whole[bounds[1:]] - whole[bounds[:-1]])
            yield pa.RecordBatch.from_arrays(
                [sums.get(n, batch.column(batch.schema.get_field_index(n))) for n in schema], schema)

    return of


def scored(tokens: DataFrame, model: Model) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for each row of ``tokens``.

    ``count_sum`` adds up the counts of a document's links, and ``n_best`` is the number of
    links whose count is the highest of their right id. The documents are aligned again from
    their stored ids and their pairs looked up, verified, in the counts of each round.
    """
    spark = tokens.sparkSession
    out = tokens.withColumns({"n_best": F.lit(0).cast("long"), "count_sum": F.lit(0).cast("long")})
    names = [part.split(" ")[0] for part in SCORED.split(", ")]
    if model.table is not None:
        wide = ["a_ids", "b_ids"]
        highest = spark.sparkContext.broadcast(model.best)
        rounds = list(model.rounds())
        out = out.select(*names, *wide)
        for k, some in enumerate(rounds):
            sent = spark.sparkContext.broadcast([tuple(row) for row in some.collect()])
            last = k == len(rounds) - 1
            kept = names if last else names + wide
            schema = SCORED if last else f"{SCORED}, a_ids binary, b_ids binary"
            out = out.mapInArrow(_looked_up(model, sent, highest, kept), schema)
            if not last:
                out = cut_lineage(out)
    return out.select(*names)
