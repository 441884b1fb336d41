"""Benchmark passages in documents: q-gram lemma filter over diagonal bands, then banded alignment."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import texts
from tidepool.llm.common import fresh
from tidepool.shared import cut_lineage

#: Characters of a q-gram.
Q = 8
#: Characters of a passage, and edits that it may have: one or two replaced words. Shorter
#: items count as a whole, with edits in proportion; those of fewer than ``Q`` characters as
#: whole words, without edits.
WINDOW, EDITS = 120, 12
#: Characters of benchmark text that one index holds about; a larger benchmark is searched in blocks.
INDEXED = 4_000_000
#: Characters of a document that are looked up at a time, and bits of the lookup filter.
STEP, FILTER_BITS = 1 << 16, 22
#: Items whose windows are kept ready for alignment.
SWEEPS = 256


def normalised(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Letters and digits in lower case with one 0 for whatever lies between, and their places."""
    codes, places, at, after_word = [], [], 0, True
    for block in texts.blocks(text):
        folded = texts.word_codes()[block]
        kept = np.flatnonzero((folded != 0) | np.concatenate(([after_word], folded[:-1] != 0)))
        codes.append(folded[kept])
        places.append(kept + at)
        at += len(block)
        after_word = bool(folded[-1])
    if not codes:
        return np.empty(0, dtype=np.uint32), np.empty(0, dtype=np.int64)
    return np.concatenate(codes), np.concatenate(places)


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """64-bit hashes of all q-grams of normalised codes, made of whole code points."""
    wide = codes.astype(np.uint64)
    two = (wide[:-1] << np.uint64(21)) | wide[1:]
    four = two[:-2] * np.uint64(0x9E3779B97F4A7C15) + two[2:] * np.uint64(0xD6E8FEB86659FD93)
    four ^= four >> np.uint64(31)
    return four[:-4] * np.uint64(0x7FB5D329728EA185) + (four[4:] ^ (four[4:] >> np.uint64(29))) * np.uint64(0x81DADEF4BC2DD44D)


@dataclass(frozen=True)
class Index:
    """The q-grams of some benchmark items, and what a passage of each item needs."""

    items: list
    codes: np.ndarray
    bounds: np.ndarray  # of each item in ``codes``
    owner: np.ndarray  # the item of each place in ``codes``
    grams: np.ndarray  # the different ones, sorted
    first: np.ndarray  # of each gram's places in ``places``
    places: np.ndarray
    length: np.ndarray  # of a passage, by item
    edits: np.ndarray
    shared: np.ndarray  # q-grams that a passage with this many edits keeps at least
    words: dict[bytes, list]  # names of the items of fewer than ``Q`` characters, by their codes


def build(items: list[tuple], window: int, edits: int) -> Index | None:
    """An index of (id, text) items; NULL ones and those without a letter or digit are left out."""
    names, codes, words = [], [], {}
    for name, text in items:
        own = normalised(text or "")[0]
        own = own[slice(int(len(own) > 0 and own[0] == 0), len(own) - int(len(own) > 1 and own[-1] == 0))]
        if len(own) >= Q:
            names.append(name)
            codes.append(own)
        elif (own != 0).any():
            words.setdefault(own.tobytes(), []).append(name)
    if not names and not words:
        return None
    sizes = np.array([len(c) for c in codes], dtype=np.int64)
    length = np.minimum(sizes, window)
    allowed = np.minimum(length * edits // window, (length + 1) // Q - 1).clip(0)
    while (short := length + 1 - Q * (allowed + 1) < 1).any():
        allowed[short] -= 1
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    places = np.concatenate([np.empty(0, dtype=np.int64), *(np.arange(a, b - Q + 1) for a, b in zip(bounds, bounds[1:]))])
    joined = np.concatenate([np.empty(0, dtype=np.uint32), *codes])
    grams = gram_hashes(joined)[places] if names else np.empty(0, dtype=np.uint64)
    order = np.argsort(grams, kind="stable")
    different, first = np.unique(grams[order], return_index=True)
    return Index(names, joined, bounds, np.repeat(np.arange(len(names)), sizes), different, np.append(first, len(grams)),
                 places[order], length, allowed, length + 1 - Q * (allowed + 1), words)


class Sweep:
    """Least edits between the windows of an item and what ends at each place of a text.

    All windows are aligned at once, a bit for each row of each window's column of
    differences: the windows lie one beside the other in long integers, with room for carries.
    """

    def __init__(self, own: np.ndarray, size: int, edits: int) -> None:
        self.size, self.lanes = size, len(own) - size + 1
        self.width = max(16, -(-(size + 2) // 8) * 8)
        windows = np.lib.stride_tricks.sliding_window_view(own, size)
        self.same = {int(code): self._packed(windows == code) for code in np.unique(own)}
        self.each = sum(1 << self.width * k for k in range(self.lanes)) if self.lanes < 64 else \
            int.from_bytes(np.tile(np.array([1] + [0] * (self.width // 8 - 1), dtype=np.uint8), self.lanes).tobytes(), "little")
        self.inside = self.each * ((1 << size) - 1)
        self.least = self.each * (1024 + edits)

    def _packed(self, bits: np.ndarray) -> int:
        wide = np.zeros((self.lanes, self.width), dtype=bool)
        wide[:, :self.size] = bits
        return int.from_bytes(np.packbits(wide, bitorder="little").tobytes(), "little")

    def ends(self, codes: np.ndarray) -> Iterator[tuple[int, int]]:
        """(end, edits) of each place up to which some window fits with the allowed edits."""
        inside, each, least, same, last = self.inside, self.each, self.least, self.same, self.size - 1
        flags = each << 10
        plus, minus, score = inside, 0, each * self.size
        for end, code in enumerate(codes.tolist(), 1):
            # Myers' column step, in all windows
            hit = same.get(code, 0) | minus
            level = (((plus + (hit & plus)) ^ plus) | hit) & inside
            down = plus & level
            up = minus | (inside ^ (plus | level))
            score += ((up >> last) & each) - ((down >> last) & each)
            up = (up << 1) & inside
            minus = up & level
            plus = ((down << 1) & inside) | (inside ^ (up | level))
            if (flags - score) & flags:
                yield end, 0
            elif (least - score) & flags:
                held = score.to_bytes(self.lanes * self.width // 8, "little")
                both = np.frombuffer(held, dtype=np.uint8).reshape(self.lanes, -1)
                yield end, int((both[:, 0] + 256 * both[:, 1].astype(np.int64)).min())


class Search:
    """Looks the passages of an index up in documents."""

    def __init__(self, index: Index) -> None:
        self.index = index
        self.filter = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.filter[index.grams >> np.uint64(64 - FILTER_BITS)] = True
        self.sweeps: dict[int, Sweep] = {}

    def _words(self, codes: np.ndarray) -> Iterator[tuple[object, int, int]]:
        """(item id, start, end) of the items of fewer than ``Q`` characters, from word bound to word bound."""
        gap = np.concatenate(([True], codes == 0, [True]))
        for size in sorted({len(key) // codes.itemsize for key in self.index.words}):
            starts = np.flatnonzero(gap[:-size - 1] & gap[size + 1:])
            known = np.array([np.frombuffer(key, dtype=codes.dtype) for key in self.index.words if len(key) == size * codes.itemsize])
            starts = starts[np.isin(codes[starts], known[:, 0]) & np.isin(codes[starts + size - 1], known[:, -1])]
            for start in starts.tolist():
                for name in self.index.words.get(codes[start:start + size].tobytes(), ()):
                    yield name, start, start + size

    def _hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the document, place in the index) of all shared q-grams, in order."""
        at = np.flatnonzero(self.filter[grams >> np.uint64(64 - FILTER_BITS)])
        own = grams[at]
        spot = np.searchsorted(self.index.grams, own)
        spot[spot == len(self.index.grams)] = 0
        same = self.index.grams[spot] == own
        at, spot = at[same], spot[same]
        low = self.index.first[spot]
        many = self.index.first[spot + 1] - low
        within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        return np.repeat(at, many), self.index.places[np.repeat(low, many) + within]

    def _sweep(self, item: int) -> Sweep:
        if item not in self.sweeps:
            if len(self.sweeps) >= SWEEPS:
                self.sweeps.clear()
            own = self.index.codes[self.index.bounds[item]:self.index.bounds[item + 1]]
            self.sweeps[item] = Sweep(own, int(self.index.length[item]), int(self.index.edits[item]))
        return self.sweeps[item]

    def _regions(self, grams: np.ndarray, begin: int) -> list[tuple[int, int, int]]:
        """(item, start, end): stretches of the document in which bands hold as many shared q-grams as a passage does.

        Hits are counted in overlapping bands of diagonals, each of two neighbouring stripes. Neighbouring
        bands that hold enough are taken together, and stretches of an item that
        overlap are one, so that every place is verified once for an item.
        """
        index = self.index
        at, places = self._hits(grams)
        if len(at) < index.shared.min():
            return []
        item = index.owner[places]
        enough = (np.bincount(item, minlength=len(index.items)) >= index.shared)[item]
        at, places, item = at[enough], places[enough], item[enough]
        if not len(at):
            return []
        stripe = (at - places + index.bounds[item + 1]) // np.maximum(1, index.edits[item])
        span = int(stripe.max()) + 3
        key = item * span + stripe
        order = np.argsort(key, kind="stable")
        key = key[order]
        cuts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        counts = np.diff(np.append(cuts, len(key)))
        need = index.shared[key[cuts] // span]
        beside = np.flatnonzero(np.diff(key[cuts]) == 1)
        kept = counts >= need
        both = counts[beside] + counts[beside + 1] >= need[beside]
        kept[beside[both]] = True
        kept[beside[both] + 1] = True
        # stripes of one run follow one another and belong to bands that hold enough
        joined = np.zeros(len(cuts), dtype=bool)
        joined[beside[both] + 1] = True
        run = np.cumsum(kept & ~joined)
        rows = np.repeat(kept, counts)
        at, places, run = at[order[rows]], places[order[rows]], np.repeat(run, counts)[rows]
        if not len(at):
            return []
        order = np.lexsort((at, run))
        at, places, run = at[order], places[order], run[order]
        found = []
        bounds = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1], [True])))
        for a, b in zip(bounds, bounds[1:]):
            own = int(index.owner[places[a]])
            need, size, edits = int(index.shared[own]), int(index.length[own]), int(index.edits[own])
            here, there = at[a:b], places[a:b]
            new = np.flatnonzero(np.concatenate(([True], here[1:] != here[:-1])))
            if len(new) < need:
                continue
            once = here[new]
            dense = np.flatnonzero(once[need - 1:] - once[:len(once) - need + 1] <= size + edits - Q)
            if not len(dense):
                continue
            beyond = size + edits - need + 1 - Q
            for part in np.split(dense, np.flatnonzero(np.diff(dense) > need - 1) + 1):
                first, last = part[0], part[-1] + need - 1
                # the q-grams that a passage keeps stand at different places of one window of the item
                inside = np.unique(there[new[first]:new[last + 1] if last + 1 < len(new) else len(there)])
                if len(inside) < need or (inside[need - 1:] - inside[:len(inside) - need + 1]).min() > size - Q:
                    continue
                found.append((own, max(0, begin + int(once[first]) - beyond), begin + int(once[last]) + Q + beyond))
        found.sort()
        out: list[tuple[int, int, int]] = []
        for own, start, end in found:
            if out and out[-1][0] == own and start <= out[-1][2]:
                out[-1] = own, out[-1][1], max(end, out[-1][2])
            else:
                out.append((own, start, end))
        return out

    def _verified(self, codes: np.ndarray, item: int, start: int, end: int) -> Iterator[tuple[int, int, int]]:
        """(start, end, edits) of the passages in one stretch.

        Windows that fit at places that follow one another are one passage; it reaches from the first
        to the last window with the least edits.
        """
        size, last, held = int(self.index.length[item]), -2, []
        for at, edits in self._sweep(item).ends(codes[start:end]):
            if held and at > last + 1:
                yield self._joined(held, start, size)
                held = []
            held.append((edits, at))
            last = at
        if held:
            yield self._joined(held, start, size)

    @staticmethod
    def _joined(held: list[tuple[int, int]], start: int, size: int) -> tuple[int, int, int]:
        least = min(held)[0]
        ends = [at for edits, at in held if edits == least]
        return start + max(0, ends[0] - size), start + ends[-1], least

    def passages(self, text: str | None, first_only: bool = False) -> list[tuple]:
        """(item id, start, end, edits) of the whole text's passages, in code points.

        Passages of one item that overlap are one, with the least edits.
        """
        codes, where = normalised(text or "")
        out = []
        if self.index.words:
            for name, start, end in self._words(codes):
                out.append((name, int(where[start]), int(where[end - 1]) + 1, 0))
                if first_only:
                    return out
        if len(codes) < Q or not self.index.items:
            return out
        found: dict[int, list] = {}
        overlap = 2 * int(self.index.length.max()) + Q
        for begin in range(0, len(codes) - Q + 1, STEP):
            for item, low, high in self._regions(gram_hashes(codes[begin:begin + STEP + overlap]), begin):
                for span in self._verified(codes, item, low, high):
                    if first_only:
                        return [(self.index.items[item], int(where[span[0]]), int(where[span[1] - 1]) + 1, span[2])]
                    found.setdefault(item, []).append(span)
        for item, spans in found.items():
            spans.sort()
            merged = [spans[0]]
            for start, end, edits in spans[1:]:
                last = merged[-1]
                if start < last[1]:
                    merged[-1] = (last[0], max(last[1], end), min(last[2], edits))
                else:
                    merged.append((start, end, edits))
            out += [(self.index.items[item], int(where[s]), int(where[e - 1]) + 1, k) for s, e, k in merged]
        return out


def blocks(benchmark: DataFrame, window: int = WINDOW, edits: int = EDITS, indexed: int = INDEXED,
           text_col: str = "text") -> DataFrame:
    """(block, index): indexes of about ``indexed`` characters of different benchmark texts each.

    Each text is indexed once, however often it is there, under its SHA-256. The indexes are
    built by tasks and stored in the shared folder.
    """
    text = F.col(text_col).cast("string").alias("text")
    texts = cut_lineage(benchmark.select(text).where("text is not null").distinct())
    total = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, -(-total // indexed))

    def built(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("name")
        index = build(list(zip(rows["name"], rows["text"])), window, edits)
        packed = [] if index is None else [pickle.dumps(index)]
        return pd.DataFrame({"block": rows["block"].iloc[:len(packed)], "index": packed})

    block = F.pmod(F.xxhash64("text"), F.lit(count)).cast("int").alias("block")
    return cut_lineage(texts.select(block, F.sha2("text", 256).alias("name"), "text")
                       .groupBy("block").applyInPandas(built, "block int, index binary"))


def _sent(spark: SparkSession, stored: DataFrame) -> Iterator[Broadcast]:
    """One index after the other, sent to the tasks; the driver holds one at a time, packed."""
    for row in stored.select("block").orderBy("block").collect():
        yield spark.sparkContext.broadcast(bytes(stored.where(F.col("block") == row["block"]).first()["index"]))


FOUND = "id long, name string, start long, end long, edits int"


def passages(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
             edits: int = EDITS, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, start, end, edits): every passage of a benchmark item in a whole text.

    A passage is ``window`` normalised characters (the whole item if that is shorter) with
    ``edits`` edits or fewer; one row for each stretch of a document, as code points of the
    text. ``end`` is exact, and ``start`` the passage's length before the first window's end. Every
    document is searched against every item, in one read without a shuffle for
    each ``INDEXED`` characters of benchmark. NULL and empty texts have no passage; repeated
    documents and items, and NULL ids, have rows of their own.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = spark.createDataFrame([], FOUND)
    for sent in _sent(spark, blocks(benchmark, window, edits, INDEXED, item_text)):

        def of(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            search = Search(pickle.loads(sent.value))
            for batch in batches:
                held = [(name, *row) for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                        for row in search.passages(text)]
                if held:
                    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)],
                                                     ["id", "name", "start", "end", "edits"])

        found = found.unionAll(rows.mapInArrow(of, FOUND))
    items = benchmark.select(F.sha2(F.col(item_text).cast("string"), 256).alias("name"), F.col(item_col).cast("long").alias("item_id"))
    return found.join(items, "name").select(F.col("id").alias("doc_id"), "item_id", "start", "end", "edits")


def _leaks(sent: Broadcast, text: Column) -> Column:
    @F.pandas_udf("boolean")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        search = Search(pickle.loads(sent.value))
        for texts_ in batches:
            yield pd.Series([bool(search.passages(x, first_only=True)) for x in texts_], dtype="bool")

    return of(text)


def clean_documents(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                    edits: int = EDITS, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a passage of any item, all columns as they are."""
    name = fresh(docs, "leaks")
    for sent in _sent(spark, blocks(benchmark, window, edits)):
        docs = docs.withColumn(name, _leaks(sent, F.col(text_col))).where(~F.col(name)).drop(name)
    return docs
