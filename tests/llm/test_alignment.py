from __future__ import annotations

import hashlib
import random
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.tables import documents, whole, write_tables
from tidepool.llm import alignment as A
from tidepool.llm.queries import PIECES, TOKENS, cross_tokenizer_alignment

COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def plain_tokens() -> tuple:
    """Both tokenizers as text -> [(id, bytes)], as the libraries give them."""
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    first_names = {k: name for name, k in first.get_vocab().items()}
    signs = {}
    low = 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            signs[chr(b)] = b
        else:
            signs[chr(256 + low)] = b
            low += 1
    second = sentencepiece.SentencePieceProcessor(model_file=PIECES)

    def left(text):
        return [(k, bytes(signs[c] for c in first_names[k])) for k in first.encode(" " + text, add_special_tokens=False).ids]

    def right(text):
        out = []
        for k in second.encode(text):
            name = second.id_to_piece(k)
            out.append((k, bytes([int(name[3:5], 16)]) if second.is_byte(k) else name.replace("▁", " ").encode()))
        return out

    return left, right


def spans(tokens) -> list[tuple[int, int, int]]:
    at, out = 0, []
    for k, own in tokens:
        out.append((k, at, at + len(own)))
        at += len(own)
    return out


def plain_alignment(rows: list[tuple]) -> list[tuple]:
    """What the query returns, link by link."""
    left, right = plain_tokens()
    kept, counts = [], Counter()
    for name, text in rows:
        a, b = (side(text) if text else [] for side in (left, right))
        if any(b"".join(own for _, own in side) != f" {text}".encode() for side in (a, b)):
            a = b = []
        a, b = spans(a), spans(b)
        links, first = [], 0
        for x, start, end in a:
            while first < len(b) and b[first][2] <= start:
                first += 1
            k = first
            while k < len(b) and b[k][1] < end:
                links.append((x, b[k][0]))
                k += 1
        counts.update(links)
        common = sorted({t[2] for t in a} & {t[2] for t in b})
        cut = [[[] for _ in common] for _ in (a, b)]
        for side, tokens in zip(cut, (a, b)):
            for x, _, end in tokens:
                side[bisect_left(common, end)].append(str(x))
        written = [f"{','.join(one)}|{','.join(other)}" for one, other in zip(*cut)]
        kept.append((name, a, b, common, links, ";".join(written)))
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [(name, len(a), len(b), len(common), len(links), sum(counts[p] == most[p[1]] for p in links),
             sum(counts[p] for p in links), hashlib.sha256(written.encode()).hexdigest() if a else "")
            for name, a, b, common, links, written in kept]


def compare(rows, expected) -> None:
    assert sorted(((r["doc_id"], *(r[c] for c in COLUMNS)) for r in rows), key=repr) == sorted(expected, key=repr)


TEXTS = ["it's a <|endoftext|> and </s> <s> text", "▁x", " two  spaces\n\n\tand tabs \r\n", "漢字 かな \U0001F600\U0001F468‍\U0001F469",
         "é ﬁ 　 x", "naïve Ünï", "\x00\x1c\x85\xa0", "12 345x6", "-" * 700, "", None, " ", "a", "퟿﻿‮"]


def test_odd_texts_repeats_and_clashing_columns(spark, tmp_path):
    rows = [*enumerate(TEXTS), (3, TEXTS[3]), (None, "no id"), (None, "no id")]
    docs = documents(spark, rows).withColumns({"n_a": F.lit("x"), "a_ids": F.lit(2), "id": F.lit(7), "counts": F.lit(1)})
    compare(cross_tokenizer_alignment(spark, write_tables(spark, tmp_path, docs)).collect(), plain_alignment(rows))


def test_awkward_rows(spark, tmp_path, awkward):
    found = cross_tokenizer_alignment(spark, write_tables(spark, tmp_path, documents(spark, awkward))).collect()
    compare(found, plain_alignment(awkward))


def test_empty_tables(spark, tmp_path):
    assert cross_tokenizer_alignment(spark, write_tables(spark, tmp_path / "none", documents(spark, []))).collect() == []
    rows = cross_tokenizer_alignment(spark, write_tables(spark, tmp_path / "nulls", documents(spark, [(1, None), (2, "")]))).collect()
    assert [tuple(r)[1:] for r in rows] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_cut_texts_give_what_whole_texts_give(monkeypatch):
    own = A.Aligner(TOKENS, PIECES)
    monkeypatch.setattr(A, "STEP", 3)
    draw = random.Random(4)
    signs = ["a", "Word", "it's", "12", ".", ",", " ", "  ", "\n", "\t", "\xa0", "\u3000", "é", "漢", "\U0001F600", "-", "_", "<s>", "\u200b",
             "\x1c", "\x85", "\u180e", "'ll", "Ω", "я"]
    for _ in range(1500):
        text = "".join(draw.choice(signs) for _ in range(draw.randrange(1, 30)))
        left, right = own.encoder.whole.encode(" " + text, add_special_tokens=False).ids, own.pieces.encode(text)
        found = own.tokens(text)
        if len(found[0]):
            assert found[0].tolist() == left and found[1].tolist() == right, repr(text)
        else:
            assert "▁" in text or b"".join(bytes(own.joined[1][0][own.joined[1][1][k]:][:own.sizes[1][k]]) for k in right) != f" {text}".encode()


@pytest.mark.parametrize("size", [0, 1, 2, 1000, 60_000])
def test_hash_is_perfect_and_minimal(size):
    draw = np.random.default_rng(size)
    keys = np.unique(draw.integers(0, 1 << 62, size))
    levels, placed = A.build(keys)
    made = A.Perfect(levels, placed)
    assert sorted(made.numbers(keys).tolist()) == list(range(len(keys)))
    assert (placed[made.numbers(keys)] == keys).all()
    other = np.setdiff1d(draw.integers(0, 1 << 62, 5000), keys)
    assert (made.numbers(other) == -1).all()
    with pytest.raises(ValueError):
        A.build(np.array([5, 5]))


def test_rounds_shards_and_trees_give_the_same(spark, sf_dir, monkeypatch):
    tokens = A.aligned(spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 200"), TOKENS, PIECES, keep_groups=True)
    assert {hashlib.sha256(r.groups.encode()).hexdigest() if r.n_a else "" for r in tokens.collect()} == {r.groups_sha256 for r in tokens.collect()}
    one = sorted(map(tuple, A.scored(tokens, A.count_pairs(tokens, TOKENS, PIECES)).collect()))
    for name, value in (("SHARD_PAIRS", 500), ("SENT_PAIRS", 1500), ("FAN", 2)):
        monkeypatch.setattr(A, name, value)
    model = A.count_pairs(tokens, TOKENS, PIECES, tasks=7)
    assert model.shards > 4 and len(list(model.rounds())) > 2
    assert sorted(map(tuple, A.scored(tokens, model).collect())) == one
    pairs = A.pair_counts(spark, model).collect()
    assert len({(r.a, r.b) for r in pairs}) == len(pairs) and sum(r["count"] for r in pairs) == sum(row[4] for row in one)
