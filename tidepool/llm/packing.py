"""Best-fit packing of token pieces into sequences of one length, by exact complements."""

from __future__ import annotations

import functools
import json
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from tidepool.shared import cut_lineage

#: The id put after each document.
END = 0

# -- tokens -----------------------------------------------------------------------------------

#: The splitting rule of the vocabulary, a fixed value of its format.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Signs that every version of the character tables puts in the same class; texts with others
#: go to the tokenizer itself.
COMMON = re.compile("[^\t-\r -~\xa0-\xac\xae-ɏ‐-‧‰-⁞]")


def byte_letters() -> dict[str, int]:
    """The letters by which a byte-level vocabulary file writes bytes: printable ones as they are,
    the others from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Token ids of whole texts as little-endian 32-bit numbers.

    Ids are those of the ``tokenizers`` library for the vocabulary file. Where the vocabulary
    numbers its merges in the order in which they apply, a rank table gives the same ids, and
    texts without special tokens and rare signs take this shorter way. If ``plain``, the
    strings of special tokens are text like any other.
    """

    def __init__(self, path: str, plain: bool = False) -> None:
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = plain
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        vocabulary, merges = held["model"]["vocab"], held["model"]["merges"]
        self.special = [] if plain else [token["content"] for token in held["added_tokens"]]
        letters = byte_letters()
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.ranked = None
        if len(vocabulary) == 256 + len(pairs) and held["pre_tokenizer"] == {
                "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True,
        } and all(vocabulary.get(a + b) == 256 + k for k, (a, b) in enumerate(pairs)):
            ranks = {bytes(letters[c] for c in token): number for token, number in vocabulary.items()}
            self.ranked = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.ranked is None or any(s in text for s in self.special) or COMMON.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return self.ranked.encode_to_numpy(text).astype("<u4", copy=False)


@functools.cache
def encoder(path: str) -> Encoder:
    """The encoder of this Python process: made once, not once a task."""
    return Encoder(path)


PIECE_ROWS = ("doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long")


def _pieces(path: str, size: int, keep_ids: bool) -> Callable:
    """Pieces of each document, numbered within the task and length by ``part`` and ``place``."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        part = TaskContext.get().partitionId()
        seen = np.zeros(size + 1, dtype=np.int64)
        for batch in batches:
            rows = []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.append(own.ids(text or ""), np.uint32(END)).astype("<u4", copy=False)
                first = len(ids) % size or size
                bounds = [0, *range(first, len(ids) + 1, size)]
                for k, (start, end) in enumerate(zip(bounds, bounds[1:])):
                    packed = ids[start:end].tobytes()
                    row = (name, k, start, end - start, zlib.crc32(packed), part, int(seen[end - start]))
                    rows.append((*row, packed) if keep_ids else row)
                    seen[end - start] += 1
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "place", *["ids"] * keep_ids]
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(zip(*rows), types)], names)

    return of


def pieces(docs: DataFrame, path: str, size: int, keep_ids: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The token pieces of every document: ids of the whole text and one END.

    A document of more than ``size`` ids is cut into pieces of ``size``, of which the first
    holds what is over. A NULL or empty text is one piece of one id. Rows with the same or a
    NULL id are documents of their own. With ``keep_ids`` the ids are in ``ids`` as well.
    """
    schema = PIECE_ROWS + (", ids binary" if keep_ids else "")
    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(_pieces(path, size, keep_ids), schema))


# -- plan -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Plan:
    """Where the pieces of each length go, as ranges of their numbers.

    The ranges are sorted by ``key`` (length, number of the first piece); the piece with number
    n goes to sequence ``sequence`` + n - first, at ``offset``.
    """

    key: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


#: Pieces of one length at most, so that length and number fit one sorted key.
MOST = 1 << 48


def _mixes(left: np.ndarray, size: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """Combinations of lengths with their count, taken from ``left`` (pieces by length)."""

    def take(mix: tuple[int, ...]) -> int:
        times = min(int(left[n]) // mix.count(n) for n in mix)
        if times > 0:
            for n in mix:
                left[n] -= times
        return max(0, times)

    if left[size]:
        yield (size,), take((size,))
    for rest in (1, 2, 3):
        # longest first: what a long piece leaves free is harder to fill
        for long in range(size - 1, 0, -1):
            gap = size - long
            if rest == 1 and left[long] and left[gap]:
                if times := take((long, gap)):
                    yield (long, gap), times
            if rest == 2:
                a = np.arange((gap + 1) // 2, min(gap, long + 1))
                while left[long]:
                    fits = a[(left[a] > 0) & (left[gap - a] > 0)]
                    for n in fits[::-1]:
                        if times := take((long, int(n), gap - int(n))):
                            yield (long, int(n), gap - int(n)), times
                            break
                    else:
                        break
            if rest == 3:
                for n in range(min(gap - 2, long), max(0, (gap - 1) // 3), -1):
                    if not left[long]:
                        break
                    if not left[n]:
                        continue
                    over = gap - n
                    a = np.arange((over + 1) // 2, min(over, n + 1))
                    for m in a[(left[a] > 0) & (left[over - a] > 0)][::-1]:
                        mix = (long, n, int(m), over - int(m))
                        if times := take(mix):
                            yield mix, times


def plan(counts: np.ndarray, size: int) -> Plan:
    """Sequences for ``counts`` pieces of each length 0 to ``size``; works on the counts alone.

    First gaps are filled exactly: with one piece of the complementary length, then with pairs
    and triples of that sum, as many times as all their lengths are there. What is left goes,
    longest first, to the open sequence with the least room that holds it (best fit); equal
    sequences are filled together. The work depends on ``size``, not on the number of pieces.
    """
    left = counts.astype(np.int64).copy()
    if left[0] or (left >= MOST).any():
        raise ValueError("lengths must be 1 to size, with fewer than 2 ** 48 pieces each")
    mixes = [(mix, times) for mix, times in _mixes(left, size) if times]
    rooms: dict[int, list[list]] = {}
    sizes: list[int] = []

    def open_room(free: int, mix: tuple[int, ...], times: int) -> None:
        if free not in rooms:
            rooms[free] = []
            insort(sizes, free)
        rooms[free].append([mix, times])

    for n in range(size, 0, -1):
        todo = int(left[n])
        while todo:
            at = bisect_left(sizes, n)
            if at == len(sizes):
                fit = size // n  # sequences of this length alone
                full, over = divmod(todo, fit)
                if full:
                    open_room(size - fit * n, (n,) * fit, full)
                if over:
                    open_room(size - over * n, (n,) * over, 1)
                break
            free = sizes[at]
            mix, times = rooms[free].pop()
            if not rooms[free]:
                del rooms[free]
                sizes.pop(at)
            each = min(free // n, max(1, todo // times))
            used = min(times, todo // each)
            if used < times:
                open_room(free, mix, times - used)
            open_room(free - each * n, mix + (n,) * each, used)
            todo -= each * used
    mixes += [(mix, times) for held in rooms.values() for mix, times in held]
    given = np.zeros(size + 1, dtype=np.int64)
    rows, sequence = [], 0
    for mix, times in mixes:
        offset = 0
        for n in mix:
            rows.append((n * MOST + given[n], given[n], sequence, offset))
            given[n] += times
            offset += n
        sequence += times
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 4)
    return Plan(*(table[:, k].copy() for k in range(4)), sequence)


def _placed(sent) -> Callable:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Plan = sent.value
        for batch in batches:
            length, number = (batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False)
                              for n in ("length", "number"))
            at = np.searchsorted(own.key, length * MOST + number, side="right") - 1
            rest = [n for n in batch.schema.names if n not in ("number", "part", "place")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(n)) for n in rest),
                 pa.array(own.sequence[at] + number - own.first[at]), pa.array(own.offset[at])],
                [*rest, "sequence_id", "offset"])

    return of


def pack(spark: SparkSession, cut: DataFrame, size: int) -> DataFrame:
    """``cut`` (from ``pieces``) with sequence_id and the offset in the sequence.

    Pieces of a length get consecutive numbers: the number within their task, plus the pieces
    of that length in earlier tasks. No length, however frequent, is gathered or sorted in one
    task. The plan is made from the count of pieces by length (``size`` numbers at most) and
    has a bounded number of ranges, which every task looks its pieces up in.
    """
    stored = cut_lineage(cut)
    by_part = cut_lineage(stored.groupBy("length", "part").agg(F.count("*").alias("n")))
    counts = np.zeros(size + 1, dtype=np.int64)
    for row in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row a length
        counts[row["length"]] = row["n"]
    made = plan(counts, size)
    sent = spark.sparkContext.broadcast(made)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    numbered = (stored.join(offsets, ["length", "part"])
                .withColumn("number", F.col("place") + F.col("before")).drop("before"))
    kept = [f for f in cut.schema.fields if f.name not in ("part", "place")]
    numbered = numbered.select(*(f.name for f in kept), "number")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return numbered.mapInArrow(_placed(sent), f"{schema}, sequence_id long, offset long")
