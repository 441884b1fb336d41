"""Fitted models find what is in the data: groups of items, topics of sessions, kinds of users."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from tidepool.operators import factorise as Z, models as M, similarity as V, skipgram as K

GROUPS = 4


def share_of_own_group(topk) -> float:
    rows = topk.select((F.col("item") % GROUPS == F.col("neighbour") % GROUPS).cast("double").alias("own"))
    return rows.agg(F.avg("own")).first()[0]


def test_factors_bring_items_of_a_group_together(spark):
    draw = random.Random(1)
    pairs = {(user, draw.randrange(15) * GROUPS + user % GROUPS) for user in range(120) for _ in range(8)}
    scores = spark.createDataFrame([(u, i, 1.0) for u, i in sorted(pairs)], "user bigint, item bigint, score double")
    items, users = M.als_factors(scores, rank=8, iterations=8)
    assert users.count() == 120
    # by chance it would be a quarter
    assert share_of_own_group(V.cosine_topk(items, k=5)) > 0.9


def _loss(ratings, users, items, reg, alpha) -> float:
    """Weighted squared error over all pairs, and the penalty by positive ratings."""
    x = np.zeros((len(users), len(items)))
    for u, i, s in ratings:
        x[u, i] = s
    guess = users @ items.T
    out = ((1 + alpha * np.abs(x)) * ((x > 0) - guess) ** 2).sum()
    positive = x > 0
    return out + reg * ((positive.sum(1) * (users ** 2).sum(1)).sum() + (positive.sum(0) * (items ** 2).sum(1)).sum())


def _matrix(df) -> np.ndarray:
    return np.array([r.vector for r in df.orderBy("id").collect()], dtype="float64")


def test_factors_reach_the_loss_of_the_library(spark, tmp_path):
    draw = random.Random(4)
    pairs = {(u, draw.randrange(10) * GROUPS + u % GROUPS) for u in range(1, 60) for _ in range(9)} | {(0, i) for i in range(40)}
    pairs |= {(u, 7) for u in range(60)}  # one user has all items, one item all users
    ratings = [(u, i, float(draw.randrange(1, 9))) for u, i in sorted(pairs)]
    frame = spark.createDataFrame(ratings, "user_index int, item_index int, score float")
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    model = ALS(rank=6, maxIter=12, regParam=0.05, alpha=3.0, implicitPrefs=True, seed=1,
                userCol="user_index", itemCol="item_index", ratingCol="score").fit(frame)
    theirs = _loss(ratings, *(_matrix(f.withColumnRenamed("features", "vector")) for f in (model.userFactors, model.itemFactors)), 0.05, 3.0)
    found = {}
    for per_row, sent in ((10_000, 1 << 20), (11, 1 << 20), (11, 0), (1, 1 << 20)):
        users, items = (_matrix(f) for f in Z.implicit_factors(frame, 60, 40, 6, 0.05, 12, 3.0, 0, per_row, sent))
        assert users.shape == (60, 6) and items.shape == (40, 6)
        assert _loss(ratings, users, items, 0.05, 3.0) < 1.01 * theirs
        found[per_row, sent] = users @ items.T
    for other in found.values():  # how keys are split and vectors travel changes nothing but rounding
        np.testing.assert_allclose(other, found[10_000, 1 << 20], atol=2e-3)


def test_a_key_with_a_third_of_all_ratings_is_split(spark):
    data = [(0, i, 1.0) for i in range(3000)] + [(u, u % 3000, 1.0) for u in range(1, 6001)]
    frame = spark.createDataFrame(data, "user_index int, item_index int, score float")
    rows = Z.packed_ratings(frame, "user_index", "item_index", per_row=100)
    sizes = rows.select("block", "slices", F.size("owns").alias("n")).collect()
    assert sum(r.n for r in sizes) == 9000 and max(r.n for r in sizes) < 200
    assert sum(r.slices > 1 for r in sizes) == 30
    none = frame.where("false")
    assert [f.count() for f in Z.implicit_factors(none, 0, 0)] == [0, 0]


def test_skipgram_brings_items_of_a_topic_together(spark):
    draw = random.Random(2)
    rows = [(" ".join(str(draw.randrange(10) * GROUPS + n % GROUPS) for _ in range(12)),) for n in range(800)]
    corpus = spark.createDataFrame(rows, "events string")
    vectors = M.skipgram_vectors(corpus, size=16, iterations=5).withColumn("item", F.col("item").cast("bigint"))
    assert vectors.count() == 10 * GROUPS
    assert share_of_own_group(V.cosine_topk(vectors, k=3)) > 0.9


@pytest.mark.parametrize("block_words, slice_pairs", [(9, 1 << 18), (1 << 17, 3000), (14, 2000)])
def test_skipgram_in_blocks_and_slices(spark, block_words, slice_pairs):
    draw = random.Random(2)
    rows = [([str(draw.randrange(10) * GROUPS + n % GROUPS) for _ in range(12)] + ["hot"] * 6,) for n in range(800)]
    rows += [(["rare", "rarer"],), ([],), (None,)]
    sentences = spark.createDataFrame(rows, "items array<string>").repartition(5)
    vectors = K.skipgram(sentences, size=16, iterations=6, block_words=block_words, slice_pairs=slice_pairs)
    found = vectors.collect()
    assert len(found) == 10 * GROUPS + 1 and all(len(r.vector) == 16 and np.isfinite(r.vector).all() for r in found)
    items = vectors.filter("item <> 'hot'").withColumn("item", F.col("item").cast("bigint"))
    assert share_of_own_group(V.cosine_topk(items, k=3)) > 0.9


def test_skipgram_pairs_are_those_of_the_window(spark):
    numbers = spark.createDataFrame([([1, 2, 3, 4, 5],), ([6, 7],), ([8],), ([],)], "numbers array<bigint>").coalesce(1)
    found = set()
    for r in K.sampled_pairs(numbers, 3, 2, 0).collect():
        words, contexts = (np.frombuffer(x, dtype="<i4") for x in (r.words, r.contexts))
        assert r.n == len(words) and (words % 3 == r["first"]).all() and (contexts % 3 == r.second).all()
        found |= set(zip(words.tolist(), contexts.tolist()))
    beside = {(a, a + 1) for a in (1, 2, 3, 4, 6)}
    assert beside | {(b, a) for a, b in beside} <= found  # neighbours are always kept
    far = {(1, 3), (2, 4), (3, 5)}
    assert found <= beside | {(b, a) for a, b in beside} | far | {(b, a) for a, b in far}
    assert K.skipgram(spark.createDataFrame([], "items array<string>")).collect() == []


def test_clusters_part_users_of_different_categories(spark):
    events = [(f"u{u}", f"{'ab' if u % 2 else 'cd'}"[n % 2] + f":{n}") for u in range(30) for n in range(12)]
    events += [("few", "a:1")] * 3 + [("odd", "z:1")] * 12
    df = spark.createDataFrame(events, "ad_id string, item_id string")
    counts = df.groupBy(F.split_part("item_id", F.lit(":"), F.lit(1)).alias("category")).agg(F.count("*").alias("counts"))
    clusters = {r.ad_id: r.cluster for r in M.user_clusters(df, counts, k=3, min_count=20).collect()}
    assert len(clusters) == 31 and "few" not in clusters
    kinds = [{clusters[f"u{u}"] for u in range(30) if u % 2 == kind} for kind in (0, 1)]
    assert all(len(kind) == 1 for kind in kinds) and kinds[0] != kinds[1]
    sizes = {r.cluster: r.users for r in M.cluster_sizes(spark.createDataFrame(list(clusters.items()), "ad_id string, cluster int")).collect()}
    assert sum(sizes.values()) == 31
    assert {r.cluster for r in M.user_clusters(df, counts, min_count=10**6).collect()} == {0}


def test_exchanged_vectors_do_not_pass_the_driver(spark, monkeypatch):
    rows = [(u, (u * k) % 40, 1.0) for u in range(60) for k in range(1, 5)]
    frame = spark.createDataFrame(sorted(set(rows)), "user_index int, item_index int, score float")
    plans, plain = [], Z._exchanged_step

    def kept(*args):
        step = plain(*args)
        plans.append(step._jdf.queryExecution().executedPlan().toString())
        return step

    monkeypatch.setattr(Z, "_exchanged_step", kept)
    Z.implicit_factors(frame, 60, 40, 6, 0.05, 2, 3.0, 0, sent_bytes=0)
    assert len(plans) == 4 and not any("BroadcastExchange" in plan for plan in plans)
