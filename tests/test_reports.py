from __future__ import annotations

import pytest

from tidepool import schemas
from tidepool.operators import models as M
from tidepool.plans import reports as R

AS_OF = "2024-01-16"
EVENTS = "ad_id string, item_id string, behavior_name string, ts bigint, dt string"


def impressions(spark, *rows):
    """Rows of ots, user, click, postback, day."""
    return spark.createDataFrame(
        [(o, u, 1, f"d-{u}", 2_000_000, p, c, d) for o, u, c, p, d in rows], schemas.IMPRESSIONS)


def extension(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.IMPRESSION_EXTENSION)


def creatives(spark, catalog=5):
    return spark.createDataFrame([(1, catalog)], schemas.CREATIVES)


def test_performance_without_clicks_and_with_missing_welfare(spark):
    shown = impressions(spark, ("a", "u", 0, 0, "2024-01-15"), ("b", "u", 0, 0, "2024-01-15"))
    more = extension(spark, ("a", None, "2024-01-15"), ("b", 3e5, "2024-01-15"))
    row = R.performance(shown, more, creatives(spark), [5], AS_OF).first()
    assert (row.uu, row.vimp, row.sales, row.sw) == (1, 2, 4.0, 1e5)
    assert row.cvr is None and row.cpa is None and row.vctr == 0 and row.vrpm == 2000
    none = R.performance(shown, more.filter("ots = 'a'"), creatives(spark), [5], AS_OF).first()
    assert none.sw is None


def test_cold_start_limits(spark):
    days = ["2024-01-10"]
    shown, more = [], []

    def show(user, times, day):
        for n in range(times):
            shown.append((f"{user}{day}{n}", user, 1, 0, day))
            more.append((f"{user}{day}{n}", 1.0, day))

    for user, times in {"u99": 99, "u100": 100, "nine": 100, "ten": 100, "none": 100}.items():
        show(user, times, days[0])
        show(user, 1, "2024-01-15")
    events = [(u, "a", "ViewContent", 1, days[0]) for u, n in {"nine": 9, "ten": 10}.items()
              for _ in range(n)]
    found = R.cold_start(
        impressions(spark, *shown), extension(spark, *more), creatives(spark),
        spark.createDataFrame(events, EVENTS), [5], AS_OF).collect()
    assert {r.label: r.cold_start_user_count for r in found} == {
        "ad_cold_start": 1, "behavior_cold_start": 1, "without_cold_start": 3}


def test_item_response_counts_an_impression_per_kind_of_behaviour(spark):
    shown = impressions(spark, ("a", "u", 1, 0, "2024-01-15"), ("b", "v", 0, 0, "2024-01-15"))
    more = extension(spark, ("a", 1.0, "2024-01-15"), ("b", 1.0, "2024-01-14"))
    items = spark.createDataFrame([("a", 1, "x", "2024-01-12"), ("b", 1, "y", "2024-01-13")],
                                  schemas.IMPRESSION_ITEMS)
    events = spark.createDataFrame(
        [("u", "x", "ViewContent", 1, "2024-01-15"), ("u", "x", "ViewContent", 2, "2024-01-15"),
         ("u", "x", "revenue", 3, "2024-01-15"), ("u", "x", "AddToCart", 3, "2024-01-14")], EVENTS)
    row = R.item_response(shown, items, more, creatives(spark), events, [5], AS_OF).first()
    assert (row.vimp, row.click, row.sales) == (3, 2, 6.0)
    assert (row.active_ui_view_count, row.active_ui_add_to_car_count,
            row.active_ui_revenue_count) == (1, 0, 1)
    assert (row.unique_active_item_count, row.unique_behavior_item_count) == (2, 1)


def test_reach_split_of_creatives_without_catalogue(spark):
    shown = impressions(spark, ("a", "u", 1, 0, "2024-01-15"), ("b", "u", 0, 0, "2024-01-15"))
    more = extension(spark, ("a", 1.0, "2024-01-15"), ("b", None, "2024-01-15"))
    row = R.reach_split(shown, more, creatives(spark, None), [5], AS_OF).first()
    assert (row.active_user_count, row.vimp, row.sw) == (1, 2, 1.0)
    assert (row.active_catalogue_user_count, row.vimp_catalogue, row.sw_catalogue) == (0, 0, 0.0)


def test_event_totals_of_no_one(spark):
    events = spark.createDataFrame([("u", "x", "ViewContent", 1, "2024-01-15")], EVENTS)
    row = R.event_totals(events, impressions(spark, ("a", "v", 1, 0, "2024-01-15")), AS_OF).first()
    assert (row.total_events, row.users_count, row.view_count) == (0, 0, None)


@pytest.fixture(scope="module")
def purchases(spark):
    """Two groups of users that buy disjoint items."""
    rows = [(u, 2 * i + u % 2, 1.0) for u in range(40) for i in range(10) if (u * i) % 3 != 1]
    return spark.createDataFrame(rows, "user int, item bigint, score double")


def test_als_separates_the_groups(spark, purchases):
    from tidepool.operators.similarity import cosine_topk

    items, users = M.als_factors(purchases, rank=8, iterations=8)
    assert items.count() == 20 and users.count() == 40
    top = cosine_topk(items, k=3).collect()
    assert len(top) == 60 and all(r.item % 2 == r.neighbour % 2 for r in top)


def test_skipgram_and_clusters(spark):
    rows = [(f"u{u}", f"s{u % 2}{i % 6}:{i}", i) for u in range(30) for i in range(24)]
    events = spark.createDataFrame(rows, "ad_id string, item_id string, ts bigint").selectExpr(
        "*", "'ViewContent' AS behavior_name", "'2024-01-15' AS dt")
    from pyspark.sql import functions as F

    from tidepool.functions.columns import category_of
    from tidepool.operators.sequences import session_corpus

    vectors = M.skipgram_vectors(session_corpus(events, AS_OF), size=8, iterations=1)
    assert vectors.count() == 48 and all(len(r.vector) == 8 for r in vectors.collect())
    counts = events.groupBy(category_of(F.col("item_id")).alias("category")).agg(
        F.count("*").alias("counts"))
    clusters = M.user_clusters(events, counts, k=2, min_count=10)
    groups = {}
    for r in clusters.collect():
        groups.setdefault(r.cluster, set()).add(int(r.ad_id[1:]) % 2)
    assert sorted(map(tuple, groups.values())) == [(0,), (1,)]
    assert {r.users for r in M.cluster_sizes(clusters).collect()} == {15}
    assert M.user_clusters(events, counts, min_count=10**9).count() == 30
