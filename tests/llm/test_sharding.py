from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.tables import documents, values, whole, write_tables
from tidepool.llm import sharding as S
from tidepool.llm.queries import sharding


def plain_shard(key, shards: dict) -> int:
    # the hash of nothing leaves the seed as it is
    own = 42 if key is None else xxhash.xxh64_intdigest(str(key).encode(), 42)
    best = None
    for shard, weight in sorted(shards.items()):
        seeded = xxhash.xxh64_intdigest(own.to_bytes(8, "little"), 42)
        bits = xxhash.xxh64_intdigest(str(shard).encode(), seeded) >> 11
        score = weight / -math.log((bits + 0.5) / 2**53)
        if best is None or score > best[0]:
            best = score, shard
    return best[1]


def check(rows, table: list[tuple]) -> None:
    """Every row is there, in the shard that the plain way gives, and slots have no gap."""
    found = Counter((r["doc_id"], r["size"], r["text_crc32"], r["law"], r["shard"], r["grown_shard"]) for r in rows)
    expected = Counter()
    for name, text in table:
        data = (text or "").encode()
        expected[name, len(data) + 8, zlib.crc32(data), "key", plain_shard(name, S.equal_shards(24)), plain_shard(name, S.equal_shards(25))] += 1
    assert found == expected
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 24)
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))


def test_the_whole_table_against_the_plain_way(spark, sf_dir):
    rows = sharding(spark, sf_dir).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in whole(spark, sf_dir)])
    moved = sum(r["grown_shard"] == 24 for r in rows)
    assert 0 < moved < 2 * len(rows) / 25


def test_awkward_rows(spark, tmp_path, awkward):
    table = [*awkward, (None, None), *[(77, "one key")] * 3000, *[(k, "") for k in range(1000, 1500)]]
    docs = documents(spark, table).repartition(13).withColumns({name: F.lit("x") for name in ("shard", "slot", "part", "place", "size", "id")})
    check(sharding(spark, write_tables(spark, tmp_path / "a", docs)).collect(), table)
    assert sharding(spark, write_tables(spark, tmp_path / "b", documents(spark, []))).collect() == []


def test_weights_get_their_share_and_only_moved_keys_move(spark):
    keys = spark.range(40_000).withColumnRenamed("id", "doc_id").withColumn("from_shard", F.lit("kept"))
    weights = {0: 1.0, 3: 2.0, 7: 5.0}
    counts = {r["shard"]: r["rows"] for r in S.balance(keys.withColumn("text", F.lit("abc")), weights).collect()}
    for shard, weight in weights.items():
        assert abs(counts[shard] / 40_000 - weight / 8) < 0.015
    heavier = {r["to_shard"] for r in S.moves(keys, weights, {**weights, 3: 3.0}).collect()}
    assert heavier == {3}
    gone = S.moves(keys, weights, {0: 1.0, 7: 5.0})
    assert gone.columns == ["doc_id", "from_shard", "from_shard_", "to_shard"]
    assert {r["from_shard_"] for r in gone.collect()} == {3} and gone.count() == counts[3]
    assert S.moves(keys, weights, dict(reversed(weights.items()))).count() == 0
    as_text = keys.select(F.col("doc_id").cast("string").alias("doc_id"))
    column = S.shard_column(F.col("doc_id"), weights)
    assert values(keys.select("doc_id", column).where("doc_id < 300")) == \
        [(int(k), s) for k, s in sorted(values(as_text.select("doc_id", column).where("int(doc_id) < 300")), key=lambda x: repr((int(x[0]), x[1])))]


@pytest.mark.parametrize("weights", [{}, {0: 0.0}, {0: 1.0, 1: -1.0}])
def test_weights_must_be_above_nothing(weights):
    with pytest.raises(ValueError):
        S.shard_column(F.lit(1), weights)
    with pytest.raises(ValueError):
        S.equal_shards(0)


def test_written_shards_hold_every_row(spark, tmp_path):
    docs = documents(spark, [(k % 50, f"text {k}") for k in range(400)]).withColumn("shard", F.lit("old"))
    S.write_shards(docs, str(tmp_path / "out"), S.equal_shards(5))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert values(back.select(*docs.drop("shard").columns)) == values(docs.drop("shard"))
    assert all(r["shard"] == plain_shard(r["doc_id"], S.equal_shards(5)) for r in back.collect())


def test_numbering_moves_no_row(spark, sf_dir):
    plan = sharding(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "SinglePartition" not in plan
