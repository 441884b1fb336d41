from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.operators import forest as W


def _bucketed(spark, text):
    rng = np.random.default_rng(4)
    units = rng.integers(-2, 3, size=(40, 4)) + 0.5  # ties, as few values occur
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    rows, least = [], {i: (0.2 if i % 3 == 0 else None) for i in range(40)}
    for bucket, size in enumerate([1, 2, 2, 5, 5, 17, 30]):
        for i in rng.choice(40, size=size, replace=False):
            rows.append((f"i{i:02}" if text else int(i), units[i].tolist(), least[int(i)], bucket * 7 - 9))
    kind = "string" if text else "bigint"
    return rows, spark.createDataFrame(rows, f"item {kind}, vector array<double>, least double, bucket bigint").repartition(3)


@pytest.mark.parametrize("text", [False, True])
@pytest.mark.parametrize("block_rows", [100, 8])
def test_buckets_meet_as_by_brute_force(spark, monkeypatch, text, block_rows):
    monkeypatch.setattr(W, "SCORES", 40)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")  # buckets go over many batches
    try:
        rows, df = _bucketed(spark, text)
        found = sorted(map(tuple, W.neighbours_in_buckets(df, 3, block_rows).filter("score is not null").collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    wanted, bound = [], {i: x for i, _, x, _ in rows}
    for bucket in {r[3] for r in rows}:
        own = [r for r in rows if r[3] == bucket]
        for i, v, least, _ in own:
            scores = sorted((-round(float(np.dot(v, w)), 9), j) for j, w, _, _ in own if j != i)
            wanted += [(i, j, -x) for x, j in scores[:3]]
    if block_rows == 100:
        wanted = [(i, j, x) for i, j, x in wanted if bound[i] is None or x >= bound[i]]
        assert [r[:2] for r in found] == [r[:2] for r in sorted(wanted)]
        np.testing.assert_allclose([r[2] for r in found], [r[2] for r in sorted(wanted)], atol=1e-9)
    else:  # in large buckets what is below the bound may come along, and the best of each pair of strips
        assert {r[:2] for r in wanted if bound[r[0]] is None or r[2] >= bound[r[0]]} <= {r[:2] for r in found}


def test_small_buckets_are_not_a_group_each(spark):
    # every bucket was packed, exchanged in blocks and handed to Python as a group of its own
    rows, df = _bucketed(spark, False)
    plan = W.neighbours_in_buckets(df, 3, 100)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroupsInArrow" not in plan


def test_rounds_that_cannot_do_are_left_for_the_exact_search(spark):
    rng = np.random.default_rng(1)
    points = rng.normal(size=(1500, 48))
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(points)], "item bigint, vector array<double>")
    found, took = W.forest_search(df, k=3, trees=1, leaf_rows=8, rounds=9, recall=0.999)
    assert took["recall"] == 1.0 or took["recall"] >= 0.999
    assert took["rounds"] < 9
    units = points / np.linalg.norm(points, axis=1, keepdims=True)
    scores = np.round(units @ units.T, 9)
    np.fill_diagonal(scores, -np.inf)
    best = {(i, int(j)) for i in range(1500) for j in np.argsort(-scores[i], kind="stable")[:3]}
    assert {(r["item"], r["neighbour"]) for r in found.collect()} == best if took["recall"] == 1.0 else True
