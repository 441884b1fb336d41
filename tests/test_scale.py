"""The ways taken by very frequent keys, very long groups and many blocks give the plain results."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.functions.dates import shift_day
from tidepool.operators import (
    evaluate as E, interactions as N, joins as J, numbering as U, samples as S, similarity as V,
)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_join(spark, how):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("x"))
    right = spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("y"))
    assert len(J.hot_hashes(left, ["k"], 500)) == 2
    salted = J.salted_join(left, right, ["k"], how, hot_rows=500, salts=7)
    assert rows(salted) == rows(left.join(right, ["k"], how))


def test_short_lists_are_sent_and_long_ones_shuffled(spark):
    left, right = spark.range(100), spark.range(50, 90)
    for max_rows, sent in ((40, True), (39, False)):
        joined = J.join_short(left, right, ["id"], max_rows)
        hint = "strategy=broadcast" in joined._jdf.queryExecution().analyzed().toString()
        assert hint == sent and rows(joined) == rows(right)


def test_salted_join_refuses_mixed_key_types(spark):
    with pytest.raises(TypeError):
        J.salted_join(spark.range(1), spark.range(1).select(F.col("id").cast("int")), ["id"])


def test_next_day_and_latest(spark):
    labels = spark.createDataFrame([("u", "2024-03-01"), ("u", "2024-03-02")], "ad_id string, dt string")
    features = spark.createDataFrame([("u", "2024-02-29", 7)], "ad_id string, dt string, f int")
    assert [tuple(r) for r in J.join_next_day(labels, features).collect()] == [
        ("u", shift_day("2024-02-29", 1), 7)]
    seen = spark.createDataFrame([("d", 1, "a"), ("d", 3, "b"), ("d", 3, "c")], "k string, t int, v string")
    assert [tuple(r) for r in J.latest_per_key(seen, "k", "t", "v").collect()] == [("d", "c", 3)]


def test_conditional_left_join(spark):
    left = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1)], "k string, c int")
    right = spark.createDataFrame([("a", "x")], "k string, v string")
    joined = J.left_join_where(left, right, "k", F.col("c") > 0)
    assert rows(joined) == rows(spark.createDataFrame(
        [("a", 1, "x"), ("a", 0, None), ("b", 1, None)], "k string, c int, v string"))


def test_numbers_and_totals_over_many_partitions(spark):
    values = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("v")).repartition(16)
    numbered = U.number_rows(values, [F.asc("v")], "n", start=1).collect()
    assert all(r.n == r.v + 1 for r in numbered) and len(numbered) == 5000
    totals = U.running_total(values, [F.asc("v")], "v", "before").collect()
    assert all(r.before == r.v * (r.v - 1) // 2 for r in totals)


def vectors(spark, matrix):
    return spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(matrix)], "item bigint, vector array<double>")


def brute_topk(matrix, k):
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    scores = np.round(unit @ unit.T, V.DIGITS)
    np.fill_diagonal(scores, -np.inf)
    return {i: [(int(j), scores[i, j]) for j in np.lexsort((np.arange(len(s)), -s))[:k]]
            for i, s in enumerate(scores)}


def collected(topk):
    found = {}
    for r in sorted(topk.collect(), key=lambda r: (r.item, r.rank)):
        found.setdefault(r.item, []).append((r.neighbour, r.score))
    return found


@pytest.mark.parametrize("block_rows", [7, 1000])
def test_cosine_topk_with_many_copies(spark, block_rows):
    rng = np.random.default_rng(0)
    matrix = np.round(rng.normal(size=(120, 8)), 1)
    matrix[40:80] = matrix[3]  # a third of all vectors are copies
    found = collected(V.cosine_topk(vectors(spark, matrix), k=5, block_rows=block_rows))
    expected = brute_topk(matrix, 5)
    for item, best in expected.items():
        assert [n for n, _ in found[item]] == [n for n, _ in best]
        np.testing.assert_allclose([s for _, s in found[item]], [s for _, s in best], atol=1e-8)


def test_a_vector_is_copied_once_per_strip(spark):
    n, block_rows = 5000, 50  # a hundred blocks, ten strips
    df = vectors(spark, np.random.default_rng(1).normal(size=(n, 4)))
    sent = V.block_exchange(V.unit_vectors(df), block_rows)
    assert sent.agg(F.sum(F.size("items"))).first()[0] == 10 * n
    assert sent.groupBy("_low", "_high").count().count() == 55
    met = sent.select("_low", "_high", "_strip", F.explode("items").alias("item"))
    assert met.groupBy("item", "_low", "_high").count().agg(F.max("count")).first()[0] == 1


def test_include_self_and_zero_vectors(spark):
    df = vectors(spark, np.array([[1.0, 0], [0, 1], [0, 0]]))
    found = collected(V.cosine_topk(df, k=1, include_self=True))
    assert found == {0: [(0, 1.0)], 1: [(1, 1.0)]}
    assert V.as_text(V.cosine_topk(df, k=1)).count() == 2


@pytest.mark.parametrize("block_rows", [16, 1000])
def test_hashed_search_finds_most_true_neighbours(spark, block_rows):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 16))
    matrix = np.repeat(centres, 12, axis=0) + 0.2 * rng.normal(size=(240, 16))
    matrix[:80] = matrix[0] + 1e-3 * rng.normal(size=(80, 16))  # one very full bucket
    exact = collected(V.cosine_topk(vectors(spark, matrix), k=5))
    found = collected(V.hashed_topk(vectors(spark, matrix), k=5, block_rows=block_rows))
    hits = sum(len({n for n, _ in exact[i]} & {n for n, _ in found.get(i, [])}) for i in exact)
    assert hits / (5 * len(exact)) > 0.9
    assert all(len({n for n, _ in best}) == 5 for best in found.values()) and len(found) == 240


def test_hashed_search_compares_few_pairs_of_vectors_with_structure(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(60, 16))
    matrix = np.repeat(centres, 25, axis=0) + 0.25 * rng.normal(size=(1500, 16))
    quality = V.search_quality(vectors(spark, matrix), k=5).first()
    assert quality.recall >= 0.9 and quality.compared <= 1 / 3 and quality.found == 5 * 1500


def test_hashed_search_gives_k_neighbours_of_few_vectors(spark):
    matrix = np.random.default_rng(0).normal(size=(4, 8))
    assert collected(V.hashed_topk(vectors(spark, matrix), k=3)) == collected(V.cosine_topk(vectors(spark, matrix), k=3))
    assert V.hashed_topk(vectors(spark, matrix).where("false"), k=3).count() == 0


def brute_knn(scores, weight, k, b=0.2, k1=100.0):
    users, items = (sorted({s[i] for s in scores}) for i in (0, 1))
    x, has = np.zeros((2, len(items), len(users)))
    for u, i, s in scores:
        x[items.index(i), users.index(u)] = s
        has[items.index(i), users.index(u)] = 1
    idf = np.log(len(items)) - np.log1p(has.sum(axis=0))
    if weight == "bm25":
        length = x.sum(axis=1, keepdims=True)
        w = np.where(has > 0, x * (k1 + 1) / (k1 * (1 - b + b * length / length.mean()) + x) * idf, 0)
    else:
        w = np.sqrt(x) * idf if weight == "tfidf" else x
        n = np.linalg.norm(w, axis=1, keepdims=True)
        w = np.divide(w, n, out=np.zeros_like(w), where=n > 0)
    both = has @ has.T
    sims = np.round(w @ w.T, N.DIGITS)
    best = {}
    for i, item in enumerate(items):
        met = [(-sims[i, j], items[j]) for j in range(len(items)) if j != i and both[i, j]]
        best[item] = [(n, -s) for s, n in sorted(met)[:k]]
    return best


@pytest.mark.parametrize("weight", ["tfidf", "cosine", "bm25"])
@pytest.mark.parametrize("basket, load", [(1000, 4_000_000), (7, 300), (1000, 1), (1, 20)])
def test_item_knn_with_a_user_of_a_third_of_all_rows(spark, monkeypatch, weight, basket, load):
    # the last ones make every item one of several slabs, in ranges of a few neighbours
    for name, value in (("STEP", 11), ("WAITING", 17), ("RANGE", 8)):
        monkeypatch.setattr(N, name, value)
    rng = np.random.default_rng(2)
    scores = {("hot", i): float(rng.integers(1, 9)) for i in range(60)}
    for u in range(40):
        for i in rng.choice(60, size=3, replace=False):
            scores[(f"u{u}", int(i))] = float(rng.integers(1, 9))
    data = [(u, i, s) for (u, i), s in scores.items()]
    df = spark.createDataFrame(data, "user string, item bigint, score double")
    found = collected(N.item_knn(df, weight, k=4, basket=basket, load=load))
    expected = brute_knn(data, weight, 4)
    for item, best in expected.items():
        np.testing.assert_allclose([s for _, s in found[item]], [s for _, s in best], atol=2e-9)


@pytest.mark.parametrize("weight", ["tfidf", "cosine", "bm25"])
@pytest.mark.parametrize("basket, load", [(1000, 1000), (2, 3)])
def test_item_knn_keeps_pairs_of_weight_zero(spark, weight, basket, load):
    # user a has all items but one, so its idf is 0; user c has a score of 0
    data = [("a", 1, 2.0), ("a", 2, 3.0), ("a", 3, 1.0), ("b", 4, 1.0), ("c", 4, 0.0), ("c", 1, 2.0)]
    df = spark.createDataFrame(data, "user string, item bigint, score double")
    found = collected(N.item_knn(df, weight, k=4, basket=basket, load=load))
    expected = brute_knn(data, weight, 4)
    assert sum(map(len, found.values())) == 8
    for item, best in expected.items():
        assert [n for n, _ in found[item]] == [n for n, _ in best]
        np.testing.assert_allclose([s for _, s in found[item]], [s for _, s in best], atol=2e-9)


def test_item_knn_makes_no_row_for_a_pair_of_items(spark):
    data = [(u, (u * 7 + 3 * n) % 500, float(n + 1)) for u in range(300) for n in range(40)]
    data += [(u, 999, 1.0) for u in range(300)]  # an item of every user
    df = spark.createDataFrame(data, "user bigint, item bigint, score double")
    pairs = sum(41 * 40 // 2 for _ in range(300))
    weights = N.item_weights(df, "cosine").withColumn("number", F.col("item"))
    homes = N.item_loads(weights, 40_000)
    met = N.meetings(weights, homes, 1024)
    assert met.count() * 3 < pairs
    assert met.agg(F.sum(F.size("numbers") * F.size("others"))).first()[0] == 300 * 41 * 41
    # blocks and slabs have about as many products as they may
    sizes = met.groupBy("block", "slab").agg(F.sum(F.size("numbers") * F.size("others")).alias("n"))
    assert homes.filter("number = 999").first()["slabs"] == 1 and sizes.agg(F.max("n")).first()[0] < 100_000
    assert N.item_loads(weights, 5_000).filter("number = 999").first()["slabs"] == 3
    plan = N.item_knn(df, "cosine")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_negatives_avoid_positives_and_end(spark):
    data = spark.createDataFrame([(u, f"{u}{n}") for u in "abc" for n in range(30)],
                                 "ad_id string, row_id string")
    own = {"a": list(range(1, 21)), "b": list(range(1, 20)), "c": [5]}
    positives = spark.createDataFrame(list(own.items()), "ad_id string, items array<bigint>")
    found = S.sample_negatives(data, positives, n_items=20, attempts=2).collect()
    assert not [r for r in found if r.negative in own[r.ad_id] or not 1 <= r.negative <= 20]
    per_user = {u: [r.negative for r in found if r.ad_id == u] for u in own}
    assert per_user["a"] == [] and set(per_user["b"]) == {20} and len(per_user["b"]) == 300
    assert len(set(per_user["c"])) == 19
    again = S.sample_negatives(data.repartition(5), positives, n_items=20, attempts=2).collect()
    assert sorted(found) == sorted(again)
    assert S.pair_triples(S.sample_negatives(
        data.withColumn("t", F.lit(1)), positives, 20), "t").columns == ["ad_id", "positive", "negative"]


def test_downsampling_keeps_positives_and_the_rate(spark):
    df = spark.range(20000).select(
        "id", F.when(F.col("id") % 10 == 0, 1.0).when(F.col("id") % 10 == 1, F.lit(None))
        .otherwise(0.0).alias("y"))
    kept = S.downsample_negatives(df, "y", 0.2, ["id"])
    assert kept.filter("y > 0").count() == 2000
    assert abs(kept.filter("y is null or y = 0").count() / 18000 - 0.2) < 0.02
    assert rows(kept) == rows(S.downsample_negatives(df.repartition(3), "y", 0.2, ["id"]))


def test_ranks_and_hit_rate(spark):
    rng = np.random.default_rng(3)
    users, items = rng.normal(size=(50, 6)), rng.normal(size=(90, 6))
    items[10:40] = items[10]
    targets = rng.integers(0, 95, size=50)
    targets_df = spark.createDataFrame([(f"r{i}", int(t)) for i, t in enumerate(targets)],
                                       "profile string, target bigint")
    user_df = spark.createDataFrame([(f"r{i}", v.tolist()) for i, v in enumerate(users)],
                                    "profile string, vector array<double>")
    scores = np.round(users @ items.T, E.DIGITS)
    expected = {}
    for i, t in enumerate(targets):
        own = scores[i, t] if t < 90 else None
        expected[f"r{i}"] = None if own is None else 1 + sum(
            (s > own) or (s == own and j < t) for j, s in enumerate(scores[i]) if j != t)
    for block_rows, sent_rows in ((11, 0), (1000, 0), (11, 89), (1000, 90)):
        ranks = E.target_ranks(targets_df, user_df, vectors(spark, items), block_rows, sent_rows)
        assert {r.profile: r.rank for r in ranks.collect()} == expected
    long = spark.createDataFrame(
        [(f"r{i}", j, float(scores[i, j])) for i in range(50) for j in range(90)],
        "row_id string, item bigint, score double")
    given = E.ranks_from_scores(long, targets_df.withColumnRenamed("profile", "row_id"))
    assert {r.row_id: r.rank for r in given.collect()} == expected
    result = E.hit_rate(ranks, ks=(1, 10, 500)).first()
    assert result.records == 50 and result.hr_1 <= result.hr_10 <= result.hr_500
    assert result.hr_500 == pytest.approx(np.mean([e is not None for e in expected.values()]))
    assert E.hit_rate(given, limit=7).first().records == 7
    twice = E.hit_rate(ranks.withColumn("n", F.lit(2)), ks=(1, 10, 500), weight="n").first()
    assert twice.records == 100 and twice.hr_10 == result.hr_10


def test_ranking_skips_blocks_that_cannot_win(spark):
    rng = np.random.default_rng(8)
    users, items = rng.normal(size=(60, 8)), rng.normal(size=(400, 8)) * rng.pareto(1.5, size=(400, 1))
    items[-1] = users[0] = 0  # without a direction
    best = np.argsort(-(users @ items.T), axis=1)
    targets = [(f"r{u}", int(best[u, place])) for u in range(60) for place in (0, 3, 50)] + [("r5", 9999), ("r0", 399)]
    targets_df = spark.createDataFrame(sorted(set(targets)), "profile string, target bigint")
    user_df = spark.createDataFrame([(f"r{i}", v.tolist()) for i, v in enumerate(users)], "profile string, vector array<double>")
    candidates = vectors(spark, items)
    scored = E.reached_scores(targets_df, user_df, candidates)
    counts = E.rank_counts(scored, candidates, 400, block_rows=10).collect()
    plain = {(r.profile, r.target): r.rank for r in E.target_ranks(targets_df, user_df, candidates).collect()}
    assert {(r.profile, r.target): None if r.reached is None else r.better + 1 for r in counts} == plain
    assert plain["r5", 9999] is None and len(counts) == len(plain)
    # scores are worked out for a part of the pairs only
    assert sum(r.computed for r in counts) < 0.5 * 400 * len(counts)


def test_small_blocks_send_no_vector_more_often(spark, monkeypatch):
    rng = np.random.default_rng(4)
    items, users = rng.normal(size=(300, 4)), rng.normal(size=(40, 4))
    targets_df = spark.createDataFrame([(f"r{u}", int(n)) for u in range(40) for n in rng.choice(300, 10, replace=False)],
                                       "profile string, target bigint")
    user_df = spark.createDataFrame([(f"r{i}", v.tolist()) for i, v in enumerate(users)], "profile string, vector array<double>")
    candidates, sent = vectors(spark, items), []
    plain = E.over_cores

    def kept(df, *keys):
        sent.append(df)
        return plain(df, *keys)

    monkeypatch.setattr(E, "over_cores", kept)
    scored = E.reached_scores(targets_df, user_df, candidates)
    counts = E.rank_counts(scored, candidates, 300, block_rows=2)
    asking, offered = [df.agg(F.sum(F.size([c for c in df.columns if c.startswith("vector")][0]))).first()[0] // 4 for df in sent]
    # all candidates fit one strip, so every target goes there once
    assert asking <= 400 and offered <= 300 * 4 * spark.sparkContext.defaultParallelism
    ranks = {(r.profile, r.target): r.rank for r in E.target_ranks(targets_df, user_df, candidates).collect()}
    assert {(r.profile, r.target): r.better + 1 for r in counts.collect()} == ranks
    # many strips on both sides count the same
    assert {(r.profile, r.target): r.better + 1 for r in E.rank_counts(scored, candidates, 300, 2, strip_bytes=2048).collect()} == ranks


def test_user_vectors_and_scores(spark):
    rng = np.random.default_rng(5)
    items = rng.normal(size=(9, 4))
    profiles = spark.createDataFrame(
        [("p", [1, 2, 2], [], [3]), ("p", [4], [], []), ("q", [], [8, 99], [])],
        "profile string, item_seq array<bigint>, item_car array<bigint>, item_purchase array<bigint>")
    vecs = vectors(spark, items)
    users = E.user_vectors(profiles, vecs, 4)
    found = {r.profile: np.array(r.vector) for r in users.collect()}
    zero = np.zeros(4)
    expected = {"p": items[[1, 2, 2, 4]].mean(axis=0) + items[3], "q": items[8] + zero}
    for key, vector in expected.items():
        np.testing.assert_allclose(found[key], vector, atol=1e-12)
    pairs = spark.createDataFrame([("p", 0), ("p", 0), ("q", 5)], "profile string, item bigint")
    scored = E.score_pairs(pairs, users, vecs).collect()
    assert len(scored) == 3
    for r in scored:
        logit = expected[r.profile] @ items[r.item]
        assert r.logit == pytest.approx(logit) and r.score == pytest.approx(1 / (1 + np.exp(-logit)))


def test_auc_with_ties(spark):
    rng = np.random.default_rng(4)
    score = np.round(rng.random(400), 2)
    score[:130] = 0.5  # a third of all rows share one score
    label = (rng.random(400) < 0.3).astype(int)
    p, n = score[label == 1], score[label == 0]
    exact = np.mean([(a > b) + 0.5 * (a == b) for a in p for b in n])
    df = spark.createDataFrame(list(zip(label.tolist(), score.tolist())), "label int, score double")
    assert E.auc(df).first().auc == pytest.approx(exact)
    assert E.auc(df, bins=200).first().auc == pytest.approx(exact, abs=0.02)
    assert E.auc(df.filter("label = 1")).first().auc is None


def test_score_tables_are_bounded():
    import tracemalloc
    from types import SimpleNamespace

    import pyarrow as pa
    from pyspark.sql import types as T

    rng = np.random.default_rng(6)
    own, others = rng.normal(size=(3000, 4)), rng.normal(size=(20_000, 4))
    centres, homes = rng.normal(size=(1500, 4)), np.full(1500, 5)
    tracemalloc.start()
    found = V._directed(own, others, 3, False)
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    best = np.argsort(-np.round(own[:50] @ others.T, V.DIGITS), axis=1, kind="stable")[:, :3]
    assert (found[0][1][:150].reshape(50, 3) == best).all()

    # the task's function, without Spark around it
    held = SimpleNamespace(broadcast=lambda x: SimpleNamespace(value=x))
    units = SimpleNamespace(sparkSession=SimpleNamespace(sparkContext=held), mapInArrow=lambda of, schema: of,
                            schema=T.StructType().add("item", "long").add("vector", T.ArrayType(T.DoubleType())))
    vectors_ = pa.ListArray.from_arrays(np.arange(0, 4 * 10_000 + 1, 4, dtype="int32"), pa.array(others[:10_000].ravel()))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(10_000)), vectors_], ["item", "vector"])
    tracemalloc.reset_peak()
    out = [b.select([0, 2]).to_pandas() for b in V._in_cells(units, centres, 2, homes, 10)(iter([batch]))]
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()
    # 5 at home in each cell: three cells hold more than 10
    cells = {n: list(rows["bucket"]) for n, rows in __import__("pandas").concat(out).groupby("item")}
    near = np.argsort(-(others[:10_000] @ centres.T), axis=1, kind="stable")[:, :3]
    assert [cells[n] for n in range(10_000)] == near.tolist()
