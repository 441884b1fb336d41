"""Approximate neighbours by projection trees: what they find, and what they compare."""

from __future__ import annotations

import numpy as np
import pytest

from tidepool.operators import forest as W, similarity as V


def frame(spark, matrix):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(matrix)], "item bigint, vector array<double>")


def share_found(exact, found) -> float:
    return exact.join(found, ["item", "neighbour"], "left_semi").count() / exact.count()


def grouped(n: int, groups: int, size: int = 24) -> np.ndarray:
    rng = np.random.default_rng(n)
    return np.repeat(rng.normal(size=(groups, size)), n // groups, axis=0) + 0.5 * rng.normal(size=(n, size))


def test_vectors_with_structure_meet_a_part_of_the_others(spark):
    df = frame(spark, grouped(6000, 150))
    found, took = W.forest_search(df)
    assert share_found(V.cosine_topk(df), found) >= 0.9
    assert took["compared"] < 6000 * 6000 / 3 and found.count() == 60_000
    assert found.groupBy("item").count().filter("count <> 10").count() == 0


def test_neighbours_of_neighbours_raise_recall(spark):
    df = frame(spark, grouped(4000, 40))
    few, some = (W.forest_search(df, trees=2, leaf_rows=30, rounds=r, recall=2.0)[1] for r in (0, 0))
    assert few == some  # the same on every run
    found, took = W.forest_search(df, trees=2, leaf_rows=30, rounds=5, recall=0.9)
    assert took["rounds"] >= 1 and share_found(V.cosine_topk(df), found) >= 0.85


def test_vectors_without_structure_are_searched_exactly(spark):
    df = frame(spark, np.random.default_rng(1).normal(size=(900, 64)))
    found, took = W.forest_search(df, trees=1, leaf_rows=20, rounds=1, recall=0.99)
    assert took["recall"] == 1.0 and share_found(V.cosine_topk(df), found) == 1.0


@pytest.mark.parametrize("n", [0, 1, 5, 300])
def test_copies_zeros_and_few_vectors(spark, n):
    rng = np.random.default_rng(n)
    matrix = rng.normal(size=(n, 6))
    if n == 300:
        matrix[100:250] = matrix[7]  # half are copies
        matrix[3] = 0
    df = frame(spark, matrix)
    found = W.forest_topk(df, k=3, leaf_rows=16).collect()
    exact = V.cosine_topk(df, k=3).collect()
    assert len(found) == len(exact)
    if n < 300:
        assert sorted(found) == sorted(exact)
    else:
        assert all(r.score > 0.999999 for r in found if 100 <= r.item < 250)


def test_leaves_part_the_sample_in_halves():
    sample = np.random.default_rng(0).normal(size=(512, 8))
    sizes = np.unique(W.leaves(sample, W.fit_forest(sample, 3, 4)), return_counts=True)[1]
    assert len(sizes) == 48 and sizes.max() <= 40


def test_names_may_be_texts(spark):
    matrix = grouped(600, 20)
    df = spark.createDataFrame([(f"i{i:04d}", v.tolist()) for i, v in enumerate(matrix)], "item string, vector array<float>")
    found = W.forest_topk(df, k=4, leaf_rows=32)
    assert share_found(V.cosine_topk(df, k=4), found) >= 0.85
