"""Near duplicates by SimHash: fingerprints, deletion-variant search and groups."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import fresh
from tidepool.llm.components import components
from tidepool.shared import cut_lineage

BITS = 64
SEED = 42
#: Members of an index entry that are compared with one another in a task. Members of longer
#: entries are indexed once more, so that no entry is compared pair by pair beyond this.
ENTRY = 256
#: Bytes of a text whose words are held at a time; a longer word is held whole.
STEP = 1 << 18
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def _shingles(data: bytes, shingle: int) -> Iterator[list[bytes]]:
    """All shingles of a text, block by block; the last words of a block go over to the next."""
    start, words, seen = 0, [], 0
    while start < len(data):
        space = _SPACE.search(data, start + STEP)
        end = space.start() if space else len(data)
        more = data[start:end].lower().split()
        seen += len(more)
        words += more
        if len(words) >= shingle:
            yield [b" ".join(row) for row in zip(*(words[k:] for k in range(shingle)))]
            words = words[len(words) - shingle + 1:]
        start = end
    if 0 < seen < shingle:
        yield [b" ".join(words)]


def fingerprint(text: str | None, shingle: int) -> int:
    """The SimHash of a text as a signed 64-bit number.

    Words are what white space of ASCII separates, A-Z in lower case. A text with fewer words
    than a shingle is one shingle; a text without words (NULL, too) has fingerprint 0.
    """
    ones, total = np.zeros(BITS, dtype=np.int64), 0
    for some in _shingles((text or "").encode("utf-8", "surrogatepass"), shingle):
        hashes = np.array([xxhash.xxh64_intdigest(x, SEED) for x in some], dtype="<u8")
        total += len(hashes)
        for part in np.array_split(hashes.view(np.uint8).reshape(-1, 8), len(hashes) // (1 << 14) + 1):
            ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    packed = np.packbits(ones * 2 > total, bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprint_column(text: Column, shingle: int) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(x, shingle) for x in texts], dtype="int64")

    return of(text)


def segments(max_bits: int) -> list[int]:
    """Bit masks of the fewest segments of which one differs by at most one bit."""
    count = max_bits // 2 + 1
    bounds = [BITS * k // count for k in range(count + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(bounds, bounds[1:])]


def _signed(masks: list[int]) -> np.ndarray:
    return np.array(masks, dtype=np.uint64).view(np.int64)


def _batch(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["entry", "part", "print"])


def _variants(max_bits: int) -> Callable:
    """Index rows of fingerprints: for each bit the segment with this bit left out."""
    masks = _signed([m & ~(1 << i) for i in range(BITS) for m in segments(max_bits) if m >> i & 1])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy(zero_copy_only=False)
            for some in np.array_split(prints, len(prints) // 4096 + 1):
                yield _batch(np.tile(np.arange(BITS, dtype=np.int32), len(some)),
                             (some[:, None] & masks).ravel(), np.repeat(some, BITS))

    return of


def _around(max_bits: int) -> Callable:
    """Index rows of members of long entries: all values within half of ``max_bits``, rounded up.

    Two fingerprints within the distance have such a value in common, half way between them. For two
    bits these are 65 rows, and a value has 65 fingerprints around it at most.
    """
    flips = _signed([sum(1 << k for k in some) for n in range((max_bits + 1) // 2 + 1) for some in combinations(range(BITS), n)])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy(zero_copy_only=False)
            for some in np.array_split(prints, len(prints) * len(flips) // (1 << 17) + 1):
                yield _batch(np.full(len(some) * len(flips), BITS, dtype=np.int32),
                             (some[:, None] ^ flips).ravel(), np.repeat(some, len(flips)))

    return of


def _apart(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Differing bits of signed fingerprints."""
    return np.bitwise_count((one ^ other).view(np.uint64))


def _spanning(prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same members as all links within an entry do: each to its group's first."""
    near = _apart(prints[:, None], prints[None, :]) <= max_bits
    least = np.arange(len(prints))
    while True:
        now = np.where(near, least[None, :], len(prints)).min(axis=1)
        now = now[now]
        if (now == least).all():
            return prints[least], prints
        least = now


def _entry_links(max_bits: int, longest: int) -> Callable:
    """Links within the entries of a sorted partition; members of long entries as they are.

    Links come out as (-1, a, b). One entry is held at a time, and never more of it than
    ``longest`` rows and one batch.
    """

    def linked(entry: np.ndarray, part: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        cuts = np.flatnonzero(np.diff(entry) | np.diff(part)) + 1
        starts = np.concatenate(([0], cuts))
        sizes = np.diff(np.concatenate((starts, [len(prints)])))
        two = starts[sizes == 2]
        a, b = prints[two], prints[two + 1]
        near = _apart(a, b) <= max_bits
        left, right = [a[near]], [b[near]]
        for at, size in zip(starts[sizes > 2], sizes[sizes > 2]):
            one, other = _spanning(prints[at:at + size], max_bits)
            apart = one != other
            left.append(one[apart])
            right.append(other[apart])
        left, right = np.concatenate(left), np.concatenate(right)
        if len(left):
            yield _batch(np.full(len(left), -1, dtype=np.int32), left, right)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_rows = None
        inside = None
        for batch in batches:
            rows = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
            if not len(rows[0]):
                continue
            if inside is not None:
                same = (rows[0] == inside[0]) & (rows[1] == inside[1])
                count = len(same) if same.all() else int(np.argmin(same))
                if count:
                    yield _batch(*(r[:count] for r in rows))
                rows = [r[count:] for r in rows]
                if not len(rows[0]):
                    continue
                inside = None
            if open_rows is not None:
                rows = [np.concatenate(pair) for pair in zip(open_rows, rows)]
            cuts = np.flatnonzero(np.diff(rows[0]) | np.diff(rows[1])) + 1
            bounds = np.concatenate(([0], cuts, [len(rows[0])]))
            last = bounds[-2]
            long = [(s, e) for s, e in zip(bounds[:-2], bounds[1:-1]) if e - s > longest] \
                if np.diff(bounds).max() > longest else []
            keep = np.ones(last, dtype=bool)
            for s, e in long:
                keep[s:e] = False
                yield _batch(*(r[s:e] for r in rows))
            if keep.any():
                yield from linked(*(r[:last][keep] for r in rows))
            open_rows = [r[last:] for r in rows]
            if len(open_rows[0]) > longest:
                yield _batch(*open_rows)
                inside, open_rows = (open_rows[0][0], open_rows[1][0]), None
        if open_rows is not None:
            yield from linked(*open_rows)

    return of


ENTRY_ROWS = "entry int, part long, print long"


def _indexed(prints: DataFrame, variants: Callable, links: Callable) -> DataFrame:
    return (prints.mapInArrow(variants, ENTRY_ROWS).repartition("entry", "part")
            .sortWithinPartitions("entry", "part").mapInArrow(links, ENTRY_ROWS))


def links(prints: DataFrame, max_bits: int, longest: int = ENTRY) -> DataFrame:
    """(u, v): links that connect what all pairs of ``prints`` at ``max_bits`` or fewer connect.

    ``prints`` holds different fingerprints in one long column. A pair within the distance
    agrees in some segment but for one bit, so it meets in the index under the variant
    without that bit, and is then verified on all bits. The members of entries of more than ``longest``
    fingerprints are indexed once more, each once whatever the number of its long entries, under the values
    half way to what they may be linked with: nothing is left out, and no entry is compared in
    full beyond that length. Within an entry each member is linked to the first of its group.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits must be 0 to 3")
    short = cut_lineage(_indexed(prints, _variants(max_bits), _entry_links(max_bits, longest)))
    rest = short.where("entry >= 0").select("print").distinct()
    # as many fingerprints as there are values around one; for 3 bits 2,081
    most = sum(math.comb(BITS, n) for n in range((max_bits + 1) // 2 + 1))
    more = _indexed(rest, _around(max_bits), _entry_links(max_bits, most))
    return (short.where("entry < 0").unionAll(more)
            .select(F.col("part").alias("u"), F.col("print").alias("v")).distinct())


def near_groups(docs: DataFrame, max_bits: int, shingle: int,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component): one row per document, NULL and empty texts included.

    ``component`` is the smallest id that can be reached over links of ``max_bits`` differing
    bits or fewer. Equal fingerprints are one node of the search, so copies cost one row each
    and are never paired. Rows with the same id keep a row each; a NULL id gets the component
    of its fingerprint's group and is never a component itself. No documents give no rows.
    """
    prints = cut_lineage(docs.select(F.col(id_col).alias("id"),
                                     fingerprint_column(F.col(text_col), shingle).alias("print")))
    nodes = prints.groupBy("print").agg(F.min("id").alias("least"))
    found = components(links(nodes.select("print"), max_bits))
    rooted = (nodes.join(found.withColumnRenamed("node", "print"), "print", "left")
              .select("print", "least", F.coalesce("root", "print").alias("root")))
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = rooted.select("print", "root").join(least, "root").select("print", "component")
    return (prints.join(named, "print")
            .select("id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component"))


def one_of_each_group(docs: DataFrame, max_bits: int, shingle: int,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the smallest id of each group, all columns as they are.

    Of rows that repeat an id any one stays. Rows with a NULL id stay only if their group has no
    row with an id, and then all of them do.
    """
    groups = cut_lineage(near_groups(docs, max_bits, shingle, id_col, text_col))
    drop = (groups.where("component is not null and (id is null or id <> component)")
            .select(F.col("id").alias(fresh(docs, "dropped"))).distinct())
    kept = docs.join(drop, F.col(id_col).eqNullSafe(drop[drop.columns[0]]), "left_anti")
    again = (groups.groupBy("id").count().where("count > 1 and id is not null")
             .select(F.col("id").alias(fresh(docs, "again"))))
    if again.isEmpty():
        return kept
    same = F.col(id_col) == again[again.columns[0]]
    return (kept.join(again, same, "left_anti")
            .unionByName(kept.join(again, same, "left_semi").dropDuplicates([id_col])))
