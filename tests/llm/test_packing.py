from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.tables import documents, whole
from tidepool.llm import packing as P
from tidepool.llm.queries import SEQUENCE, TOKENS, best_fit_packing


def check_sequences(rows, size: int) -> int:
    """Each sequence is gapless from 0 and no longer than ``size``; the number of sequences."""
    by = defaultdict(list)
    for row in rows:
        by[row["sequence_id"]].append((row["offset"], row["length"]))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def test_pieces_and_sequences_of_the_whole_table(spark, sf_dir):
    own = Tokenizer.from_file(TOKENS)
    expected = set()
    for row in whole(spark, sf_dir):
        ids = [*own.encode(row["text"] or "", add_special_tokens=False).ids, 0]
        first = len(ids) % SEQUENCE or SEQUENCE
        start = 0
        for k, end in enumerate(range(first, len(ids) + 1, SEQUENCE)):
            expected.add((row["doc_id"], k, start, end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes())))
            start = end
        assert start == len(ids)
    rows = best_fit_packing(spark, sf_dir).collect()
    found = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert len(found) == len(expected) and set(found) == expected
    least = -(-sum(r["length"] for r in rows) // SEQUENCE)
    assert check_sequences(rows, SEQUENCE) <= 1.01 * least + 1


@pytest.mark.parametrize("text", ["", "a", "a<|endoftext|>b", "it's I'LL we'd", "  two   spaces \n\n\t x ", "\x1c\x85\xa0 y",
                                  "漢字　かな", "naïve Ünï", "á \U0001F600", "12 345x6", "-" * 3000, "ab" * 5000])
def test_ids_are_those_of_the_tokenizer(text):
    encoder = P.Encoder(TOKENS)
    assert encoder.ranked is not None
    assert encoder.ids(text).tolist() == encoder.whole.encode(text, add_special_tokens=False).ids


def test_ids_of_all_signs_that_take_the_short_way():
    encoder, draw = P.Encoder(TOKENS), random.Random(1)
    signs = [chr(c) for c in range(0x3000) if not P.COMMON.search(chr(c))]
    assert len(signs) > 600
    common = [*"  \n\tetaoin'sdl.,0129", *signs]
    for n in range(4000):
        text = "".join(draw.choice(signs if n % 2 else common) for _ in range(draw.randrange(1, 40)))
        assert encoder.ids(text).tolist() == encoder.whole.encode(text, add_special_tokens=False).ids, repr(text)


def best_fit_decreasing(lengths: list[int], size: int) -> int:
    rooms: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, room in enumerate(rooms) if room >= n]
        if fits:
            rooms[min(fits, key=lambda k: rooms[k])] -= n
        else:
            rooms.append(size - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_plan_against_one_by_one_packing(seed):
    draw, size = np.random.default_rng(seed), 64
    lengths = [draw.integers(1, 65, 300), draw.integers(20, 40, 300), draw.geometric(0.1, 900).clip(1, 64),
               np.full(100, 33), np.full(77, 5), np.array([64, 1])][seed]
    made = P.plan(np.bincount(lengths, minlength=size + 1), size)
    seen, rows = defaultdict(int), []
    for n in lengths.tolist():
        at = np.searchsorted(made.key, n * P.MOST + seen[n], side="right") - 1
        rows.append({"length": n, "offset": int(made.offset[at]),
                     "sequence_id": int(made.sequence[at]) + seen[n] - int(made.first[at])})
        seen[n] += 1
    assert check_sequences(rows, size) == made.sequences
    assert made.sequences <= best_fit_decreasing(lengths.tolist(), size) * 1.02 + 1


def test_exact_complements_leave_no_gap():
    lengths = [60, 4, 50, 10, 4, 30, 20, 8, 6]  # a pair, a pair with one more, three fillers for 30
    assert P.plan(np.bincount(lengths, minlength=65), 64).sequences == 3


def test_awkward_rows(spark, awkward):
    docs = documents(spark, awkward).withColumns({"sequence_id": F.lit(1), "piece": F.lit("x"), "length": F.lit(2)})
    cut = P.pieces(docs, TOKENS, 128, keep_ids=True)
    rows = P.pack(spark, cut, 128).collect()
    assert {r["doc_id"] for r in rows} == {name for name, _ in awkward}
    assert sum(r["doc_id"] == 6 for r in rows) == 2
    assert [r["length"] for r in rows if r["doc_id"] in (1, 2)] == [1, 1]
    check_sequences(rows, 128)
    by = defaultdict(list)
    for r in rows:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        by[r["doc_id"]].append((r["piece"], r["start"], r["length"]))
    for name in (8, 9):
        at = 0
        for k, (piece, start, length) in enumerate(sorted(by[name])):
            assert (piece, start) == (k, at) and (length == 128 or not k)
            at += length
    assert P.pack(spark, P.pieces(documents(spark, []), TOKENS, 128), 128).count() == 0
