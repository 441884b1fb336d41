from __future__ import annotations

import random
import re
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.tables import documents, values, whole
from tidepool.llm import components as C, simhash as S
from tidepool.llm.queries import simhash_near_dedup


def plain_fingerprint(text: str | None, shingle: int = 3) -> int:
    low = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    shingles = [" ".join(words[k:k + shingle]) for k in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(prints: dict, max_bits: int) -> dict:
    root = {p: p for p in set(prints.values())}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    known = sorted(root)
    for k, a in enumerate(known):
        for b in known[k + 1:]:
            if (a ^ b).bit_count() <= max_bits:
                root[find(a)] = find(b)
    least = {}
    for name, p in prints.items():
        least[find(p)] = min(name, least.get(find(p), name))
    return {name: least[find(p)] for name, p in prints.items()}


def test_fingerprints_and_components_of_the_whole_table(spark, sf_dir):
    prints = {row["doc_id"]: plain_fingerprint(row["text"]) for row in whole(spark, sf_dir)}
    groups = plain_components(prints, 2)
    rows = simhash_near_dedup(spark, sf_dir).collect()
    assert len(rows) == len(prints)
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == \
        {name: (f"{p:016x}", groups[name]) for name, p in prints.items()}


@pytest.mark.parametrize("longest", [2, 5, S.ENTRY])
def test_links_join_what_all_pairs_join(spark, longest):
    draw = random.Random(5)
    prints = set()
    for _ in range(12):  # clusters of neighbours, some of which share a segment with many others
        centre = draw.getrandbits(64)
        prints.add(centre)
        for _ in range(25):
            prints.add(centre ^ sum(1 << draw.randrange(64) for _ in range(draw.randrange(1, 3))))
    same_half = draw.getrandbits(32) << 32
    prints |= {same_half | draw.getrandbits(32) for _ in range(40)} | {0, 1, 3, (1 << 64) - 1}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = S.links(spark.createDataFrame([(p,) for p in signed], "print long"), 2, longest)
    pairs = [(r.u, r.v) for r in links.collect()]
    assert all(a != b for a, b in pairs)
    found = {r.node: r.root for r in C.components(links).collect()}
    expected = plain_components({p: p & (1 << 64) - 1 for p in signed}, 2)
    mine = {p: found.get(p, p) for p in signed}
    assert {frozenset(q for q in mine if mine[q] == mine[p]) for p in mine} == \
        {frozenset(q for q in expected if expected[q] == expected[p]) for p in expected}


@pytest.mark.parametrize("max_bits", [0, 1, 3])
def test_other_distances(spark, max_bits):
    draw = random.Random(max_bits)
    centre = draw.getrandbits(63)
    prints = {centre ^ sum(1 << b for b in draw.sample(range(63), n)) for n in (0, 1, 2, 3, 4, 5) for _ in range(6)}
    links = S.links(spark.createDataFrame([(p,) for p in prints], "print long"), max_bits, 3)
    found = {r.node: r.root for r in C.components(links).collect()}
    expected = plain_components({p: p for p in prints}, max_bits)
    assert {p: found.get(p, p) for p in prints} == {p: min(q for q in prints if expected[q] == expected[p]) for p in prints}


def test_many_near_fingerprints_make_few_rows(spark):
    draw = np.random.default_rng(3)
    centre, prints = 0x123456789ABCDEF0, set()
    while len(prints) < 20_000:  # different ones within three bits of one
        for bits in draw.integers(0, 64, (20_000, 3)):
            prints.add(centre ^ sum(1 << int(b) for b in set(bits)))
    signed = [p - (1 << 64) if p >> 63 else p for p in sorted(prints)[:20_000]]
    frame = spark.createDataFrame([(p,) for p in signed], "print long").repartition(8)
    rows = frame.mapInArrow(S._around(2), S.ENTRY_ROWS)
    assert rows.count() == 65 * 20_000 and rows.groupBy("part").count().agg(F.max("count")).first()[0] <= 65
    began = time.time()
    links = S.links(frame, 2)
    found = {r.node: r.root for r in C.components(links).collect()}
    assert time.time() - began < 60
    assert len(found) > 19_900 and len(set(found.values())) == 1


@pytest.mark.parametrize("shingle", [1, 2, 3, 5])
def test_long_texts_are_hashed_in_blocks(monkeypatch, shingle):
    texts = ["Some, WORDS\x0bof\u00a0all\tkinds\r\n " * n for n in (0, 1, 2, 40)] + ["\u00c4 B", "  ", "x" * 200, "a b c d e"]
    whole = [S.fingerprint(text, shingle) & (1 << 64) - 1 for text in texts]
    assert whole == [plain_fingerprint(text, shingle) for text in texts]
    for step in (1, 7, 50):
        monkeypatch.setattr(S, "STEP", step)
        assert [S.fingerprint(text, shingle) & (1 << 64) - 1 for text in texts] == whole


def test_components_of_a_path_and_a_star(spark):
    path = [(k, k + 1) for k in range(30)] + [(100, 100 + k) for k in range(1, 200)] + [(7, 7)]
    found = C.components(spark.createDataFrame(path, "u long, v long"))
    assert {r.node: r.root for r in found.collect()} == {k: 0 for k in range(31)} | {100 + k: 100 for k in range(200)}
    assert C.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_awkward_rows(spark, awkward):
    rows = S.near_groups(documents(spark, awkward), 2, 3).collect()
    assert len(rows) == len(awkward)
    by_id = {r["id"]: (r["fingerprint"], r["component"]) for r in rows}
    assert by_id[1] == by_id[2] == by_id[3] == ("0" * 16, 1)
    assert by_id[5] == by_id[6] and by_id[6][1] == 5
    assert by_id[None][1] is None
    assert S.near_groups(documents(spark, []), 2, 3).count() == 0


def test_one_of_each_group_keeps_other_columns(spark, awkward):
    docs = documents(spark, [*awkward, (4, "word")]).withColumns(
        {name: F.lit(1) for name in ("dropped", "again", "print", "component", "id", "root")})
    kept = S.one_of_each_group(docs, 2, 3)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.select("doc_id").collect()), key=repr)
    groups = {r["id"]: r["component"] for r in S.near_groups(documents(spark, awkward), 2, 3).collect()}
    assert ids == sorted({g for g in groups.values() if g is not None} | {None}, key=repr)
    assert values(S.one_of_each_group(documents(spark, []), 2, 3)) == []
