"""Every job by name, run on the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidepool import schemas
from tidepool.functions import columns as C
from tidepool.functions.dates import shift_day, window_dates
from tidepool.operators import (
    behaviours as B, evaluate as E, features as X, forest as W, interactions as N, items as I, joins as J,
    models as M, reach, runs, samples as S, sequences as Q, similarity as V, skipgram as K,
)
from tidepool.plans import daily, reports as R, views
from tidepool.plans.views import ACTIVE_CAP, AS_OF, CATALOGS, DENIED, STORES
from tidepool.shared import cut_lineage, scratch_path
from tidepool.sources import bucketed, published, scripts, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Thresholds in proportion to the given tables.
MIN_IMPRESSIONS = 3
MIN_BEHAVIOURS = 10
BUCKETS = 8
DAY = shift_day(AS_OF, -1)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of digits, as sums of doubles depend on their order."""
    return df.select(*[
        F.round(name, digits).alias(name) if kind == "double" else F.col(name)
        for name, kind in df.dtypes
    ])


def _texts(df: DataFrame) -> DataFrame:
    """Arrays as joined text."""
    return df.select(*[
        F.array_join(name, ",").alias(name) if kind.startswith("array") else F.col(name)
        for name, kind in df.dtypes
    ])


def _features(spark, sf_dir):
    return Q.user_features(*views.daily(spark, sf_dir), AS_OF)


# Tables and files

@query
def scan_dt_range(spark, sf_dir):
    path = scratch_path(spark, "behaviours")
    tables.create_as(views.behaviours(spark, sf_dir), path, ["dt"])
    return tables.scan_range(spark, path, schemas.BEHAVIOURS, *window_dates(AS_OF, -3, -1))


@query
def scan_dimension(spark, sf_dir):
    return tables.scan_dimension(
        views.creatives(spark, sf_dir), "merchandise_catalog_id", CATALOGS
    )


@query
def delimited_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "features")
    rows = _features(spark, sf_dir)
    tables.write_delimited(rows, path)
    return tables.read_delimited(spark, path, rows.schema)


@query
def partition_replace(spark, sf_dir):
    path = scratch_path(spark, "impressions")
    rows = views.impressions(spark, sf_dir)
    tables.create_as(rows.withColumn("click", F.lit(0)), path, ["dt"])
    days = rows.filter(F.col("dt").between(*window_dates(AS_OF, -7, -2)))
    tables.replace_partitions(days, path)
    # a day written again changes nothing, and one that has no rows any more is emptied
    tables.replace_partitions(days, path, days=[shift_day(AS_OF, -n) for n in range(1, 8)])
    return spark.read.schema(schemas.IMPRESSIONS).parquet(path).groupBy("dt").agg(
        F.count("*").alias("n"), F.sum("click").alias("clicks")
    )


@query
def published_days(spark, sf_dir):
    path = scratch_path(spark, "published")
    rows = views.impressions(spark, sf_dir)
    published.publish(rows.withColumn("click", F.lit(0)), path)
    days = rows.filter(F.col("dt").between(*window_dates(AS_OF, -7, -2)))
    for _ in range(2):  # a day published again changes nothing, and one that has no rows any more is emptied
        published.publish(days, path, [shift_day(AS_OF, -n) for n in range(1, 8)])
    return published.read(spark, path, schemas.IMPRESSIONS).groupBy("dt").agg(
        F.count("*").alias("n"), F.sum("click").alias("clicks"))


@query
def ctas_partitioned(spark, sf_dir):
    path = scratch_path(spark, "shown")
    rows = views.catalogue_impressions(spark, sf_dir)
    tables.create_as(rows, path, ["core_label", "dt"])
    return spark.read.schema(rows.schema).parquet(path)


@query
def export_by_day(spark, sf_dir):
    path = scratch_path(spark, "export")
    rows = views.impressions(spark, sf_dir)
    tables.export_by_day(rows, path, *window_dates(AS_OF, -9, -5))
    tables.export_by_day(rows, path, *window_dates(AS_OF, -7, -1))
    return tables.read_delimited(spark, path, schemas.IMPRESSIONS, by=["dt"])


@query
def shards(spark, sf_dir):
    shown = views.shown_items(spark, sf_dir)
    dealt = tables.redistribute(shown, 6, ["ots"]).withColumn("shard", F.spark_partition_id())
    by_key = dealt.groupBy("ots").agg(F.count("*").alias("n"), F.count_distinct("shard").alias("in_shards"),
                                      F.max("shard").alias("shard"))
    return by_key.agg(F.sum("n").alias("n"), F.max("in_shards").alias("in_shards"),
                      F.count_distinct("shard").alias("shards"))


@query
def missing_table(spark, sf_dir):
    path = scratch_path(spark, "index")
    tables.ensure_dataset(spark, path, schemas.ITEM_INDEX, ["dt"])
    held = spark.read.schema(schemas.ITEM_INDEX).parquet(path)
    found = views.behaviours(spark, sf_dir).select("item_id").distinct()
    return found.join(held, "item_id", "left")


@query
def parameterised_sql(spark, sf_dir):
    views.impressions(spark, sf_dir).createOrReplaceTempView("impressions")
    text = """
        SELECT count(*) AS n FROM impressions WHERE dt = '${dt}'
        ;
-- next --
        SELECT dt, count(*) AS n, sum(click) * ${factor} AS clicks
        FROM impressions
        WHERE dt >= date_format(date_add(date('${dt}'), -10), 'yyyy-MM-dd')
          AND dt <= date_format(date_add(date('${dt}'), -1), 'yyyy-MM-dd')
        GROUP BY dt
        ;
    """
    return scripts.run_statements(spark, text, {"dt": AS_OF, "factor": 100})[-1]


# Behaviours, items and sequences

@query
def behaviour_extract(spark, sf_dir):
    return B.extract_behaviours(views.raw_event_log(spark, sf_dir), STORES, DENIED)


@query
def behaviour_extract_json(spark, sf_dir):
    return B.extract_behaviours_json(views.raw_tracker_log(spark, sf_dir), STORES, DENIED)


@query
def category_counts(spark, sf_dir):
    return B.category_counts(views.events(spark, sf_dir), DAY)


@query
def active_items(spark, sf_dir):
    return views.active(spark, sf_dir)


@query
def stable_item_index(spark, sf_dir):
    rows = cut_lineage(views.behaviours(spark, sf_dir))
    none = spark.createDataFrame([], schemas.ITEM_INDEX)
    earlier = rows.filter(F.col("dt") == shift_day(AS_OF, -10))
    previous = I.stable_item_index(none, earlier, shift_day(AS_OF, -1))
    today = rows.filter(F.col("dt").between(*window_dates(AS_OF, -9, -1)))
    return I.stable_item_index(previous, today, AS_OF)


@query
def appended_item_index(spark, sf_dir):
    rows = cut_lineage(views.behaviours(spark, sf_dir).select("item_id", "dt"))
    none = spark.createDataFrame([], "item_id string, item_no bigint")
    first = I.new_item_numbers(none, rows.filter(F.col("dt") == shift_day(AS_OF, -10)))
    stored = bucketed.write_bucketed(first, scratch_path(spark, "index"), ["item_id"], BUCKETS).all_rows()
    more = I.new_item_numbers(stored, rows.filter(F.col("dt").between(*window_dates(AS_OF, -9, -1))))
    return stored.unionByName(more).withColumn("dt", F.lit(DAY))


@query
def dense_index(spark, sf_dir):
    return I.dense_index(views.table(spark, sf_dir, "lineitem"), "l_partkey", "item_index")


@query
def user_features(spark, sf_dir):
    return _features(spark, sf_dir)


@query
def incremental_user_features(spark, sf_dir):
    path = scratch_path(spark, "runs")
    rows, items = views.daily(spark, sf_dir)
    published.publish(runs.day_runs(rows.filter(F.col("dt") < DAY)), path)
    runs.store_day(rows, path, DAY)
    return runs.window_features(spark, path, items, AS_OF)


@query
def backfill_user_features(spark, sf_dir):
    days = [shift_day(AS_OF, -n) for n in range(7)]
    return Q.backfill_user_features(*views.daily(spark, sf_dir), days)


@query
def user_sessions(spark, sf_dir):
    return _texts(Q.user_sessions(*views.daily(spark, sf_dir), DAY))


@query
def user_behaviour_arrays(spark, sf_dir):
    return _texts(Q.user_behaviour_arrays(views.events(spark, sf_dir), AS_OF))


@query
def session_corpus(spark, sf_dir):
    return Q.session_corpus(views.events(spark, sf_dir), AS_OF)


@query
def user_category_sequences(spark, sf_dir):
    return Q.user_category_sequences(views.events(spark, sf_dir), DAY)


@query
def user_positives(spark, sf_dir):
    return Q.user_positives(*views.daily(spark, sf_dir)).drop("items")


# Samples

@query
def min_length_filter(spark, sf_dir):
    items = F.split("item_seq", ",")
    return _features(spark, sf_dir).select(
        "ad_id",
        C.min_length(items, 5).cast("int").alias("five"),
        C.min_length(items, 6, distinct=True).cast("int").alias("six_different"),
    )


def _train_sample(spark, sf_dir):
    rows, items = views.daily(spark, sf_dir)
    features = Q.user_features(rows, items, DAY)
    return S.train_sample(rows, items, features, DAY), features


@query
def train_sample(spark, sf_dir):
    return S.with_slices(*_train_sample(spark, sf_dir))


@query
def train_sample_conversions(spark, sf_dir):
    rows, items = views.daily(spark, sf_dir)
    sessions = Q.user_sessions(rows, items, shift_day(DAY, -1))
    sample = S.train_sample_conversions(rows, items, sessions, DAY)
    return _texts(S.with_slices(sample, sessions))


@query
def train_examples(spark, sf_dir):
    path = scratch_path(spark, "examples")
    tables.write_examples(S.to_examples(*_train_sample(spark, sf_dir)), path)
    return _texts(tables.read_examples(spark, path, schemas.TRAIN_EXAMPLE))


@query
def negative_downsample(spark, sf_dir):
    return S.downsample_negatives(
        views.feature_material(spark, sf_dir), "click", 0.2, ["ots"]
    ).select("ots", "click")


@query
def negative_sampling(spark, sf_dir):
    rows, items = views.daily(spark, sf_dir)
    negatives = S.sample_negatives(
        views.labelled_rows(rows, items), Q.user_positives(rows, items), ACTIVE_CAP
    )
    return negatives.select("ad_id", "row_id", "item_no", "draw", "negative")


# Joins

@query
def left_join_condition(spark, sf_dir):
    shown = views.impressions(spark, sf_dir).select("ots", "ad_id", "click")
    documents = views.behaviour_documents(spark, sf_dir).filter(F.col("part") == 0).select(
        "ad_id", "user_behavior_f"
    )
    joined = J.left_join_where(shown, documents, "ad_id", F.col("click") > 0)
    has_view = F.get_json_object("user_behavior_f", "$.has_view").cast("int")
    return joined.select("ots", "ad_id", "click", has_view.alias("has_view"))


@query
def latest_per_key(spark, sf_dir):
    rows = views.table(spark, sf_dir, "events").select(
        "user_id", views.micros("ts").alias("ts"), "event_id"
    )
    return J.latest_per_key(rows, "user_id", "ts", "event_id")


@query
def latest_per_key_stored(spark, sf_dir):
    rows = views.table(spark, sf_dir, "events").select("user_id", views.micros("ts").alias("ts"), "event_id")
    stored = bucketed.write_bucketed(rows, scratch_path(spark, "events"), ["user_id"], BUCKETS)
    return bucketed.latest_stored(stored, "ts", "event_id")


@query
def next_day_stored(spark, sf_dir):
    rows = cut_lineage(views.behaviours(spark, sf_dir).select("ad_id", "item_id", "dt"))
    daily = rows.groupBy("ad_id", F.col("dt").alias("day")).agg(F.count("*").alias("events"))
    labels = bucketed.write_bucketed(rows, scratch_path(spark, "labels"), ["ad_id"], BUCKETS)
    features = bucketed.write_bucketed(daily, scratch_path(spark, "daily"), ["ad_id"], BUCKETS)
    joined = bucketed.join_stored(labels, features, F.datediff(F.col("dt").cast("date"), F.col("day").cast("date")) == 1)
    return joined.groupBy("dt").agg(F.count("*").alias("n"), F.sum("events").alias("events"))


# Click samples and features

@query
def user_behaviour_json(spark, sf_dir):
    return views.behaviour_documents(spark, sf_dir)


@query
def impression_items(spark, sf_dir):
    return views.catalogue_impressions(spark, sf_dir)


def _ctr_sample(spark, sf_dir, rate):
    day = views.feature_material(spark, sf_dir).filter(F.col("dt") == DAY)
    documents = views.behaviour_documents(spark, sf_dir)
    shown = views.catalogue_impressions(spark, sf_dir)
    return X.ctr_sample(shown, day, documents, DAY, rate), documents


@query
def ctr_sample(spark, sf_dir):
    return X.with_documents(*_ctr_sample(spark, sf_dir, 0.2), "itemf")


@query
def ctr_feature_merge(spark, sf_dir):
    sample, documents = _ctr_sample(spark, sf_dir, 1.0)
    merged = X.with_documents(X.merge_features(sample), documents, "features")

    def field(name):
        return F.get_json_object("features", f"$.{name}")

    return merged.select(
        "ots", "ad_id_plus", "campaign_id", "item_id", "core_label", "ctr_label", "cvr_label", "dt", "part",
        field("source").alias("source"),
        field("priority").alias("priority"),
        field("customer").cast("bigint").alias("customer"),
        field("price").cast("double").alias("price"),
        field("has_view").cast("int").alias("has_view"),
        F.size(F.from_json(field("content_ids_list"), "array<string>")).alias("n_items"),
    )


def _typed(spark, sf_dir):
    return X.typed_features(
        views.feature_documents(spark, sf_dir), views.catalogue(spark), ["event_id"]
    )


@query
def ctr_feature_merge_limited(spark, sf_dir):
    merged = X.merge_features(_ctr_sample(spark, sf_dir, 1.0)[0], limit=10)
    return merged.select("ots", "ad_id_plus", "item_id", "core_label", "ctr_label", "cvr_label", "dt")


@query
def typed_features(spark, sf_dir):
    weights = F.map_values("weights")
    return _rounded(_typed(spark, sf_dir).select(
        "event_id", "name", "kind", "label", "text_value", "number_value",
        F.array_join("text_values", ",").alias("text_values"),
        F.size("counted_values").alias("n_values"),
        F.array_join(F.array_sort(F.map_keys("weights")), ",").alias("weight_keys"),
        F.aggregate(weights, F.lit(0.0), lambda total, x: total + x).alias("weight_sum"),
    ))


@query
def feature_stats_dense(spark, sf_dir):
    return _rounded(X.dense_stats(_typed(spark, sf_dir)), 4)


@query
def feature_stats_categorical(spark, sf_dir):
    return X.category_stats(_typed(spark, sf_dir))


@query
def feature_stats_weighted(spark, sf_dir):
    return _rounded(X.weighted_stats(_typed(spark, sf_dir)), 4)


@query
def feature_stats_report(spark, sf_dir):
    report = X.stats_report(AS_OF, _typed(spark, sf_dir))
    n = F.coalesce(F.get_json_object("stats", "$.count"), F.get_json_object("stats", "$.n"))
    return report.select("dt", "name", "kind", "key", "rank", n.cast("bigint").alias("n"))


@query
def scalar_functions(spark, sf_dir):
    rows = views.spread(views.table(spark, sf_dir, "orders"))
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    price = F.col("o_totalprice")
    pairs = C.text_to_map(F.concat(F.lit("s:"), status, F.lit(",p:"), priority))
    whole = C.plain_numbers(rows.select(
        "o_orderkey", price.cast("decimal(12,0)").alias("whole"),
        price.cast("decimal(12,2)").alias("cents"),
    ))
    texts = F.concat_ws(",", F.col("o_custkey").cast("string"), F.lit("3"), F.lit("3"))
    merged = C.merge_json(F.to_json(F.struct(F.lit(1).alias("a"), status.alias("b"))),
                          F.to_json(F.struct(F.lit(2).alias("a"))))
    more = rows.select(
        "o_orderkey",
        C.normalise_item_id(F.concat(F.lit(" 1:s:"), F.col("o_custkey").cast("string")))
        .alias("item_id"),
        C.category_of(priority).alias("category"),
        F.col("o_custkey").cast("string").try_cast("bigint").alias("as_number"),
        status.try_cast("bigint").alias("not_a_number"),
        C.least_strict(F.when(F.col("o_orderkey") % 17 != 0, price), 1e5).alias("capped"),
        C.safe_ratio(price, F.col("o_orderkey") % 5, 5).alias("ratio"),
        F.array_join(C.unique_sorted(C.parse_int_list(texts)), ",").alias("ids"),
        F.element_at(C.add_prefix(pairs, "x_"), F.lit("x_p")).alias("prefixed"),
        F.get_json_object(merged, "$.a").cast("int").alias("merged"),
        F.round(C.sigmoid(price / 1e5), 6).alias("sigmoid"),
        F.round(F.tanh(price / 1e6), 6).alias("tanh"),
        C.hash_draw(1000, F.col("o_orderkey"), 7).alias("draw"),
    )
    return more.join(whole, "o_orderkey")


# Reports

@query
def report_event_totals(spark, sf_dir):
    return R.event_totals(views.events(spark, sf_dir), views.impressions(spark, sf_dir), AS_OF)


@query
def report_event_totals_catalog(spark, sf_dir):
    return R.event_totals_catalog(
        views.events(spark, sf_dir), views.impressions(spark, sf_dir),
        views.creatives(spark, sf_dir), CATALOGS, AS_OF,
    )


@query
def report_user_overlap(spark, sf_dir):
    return R.user_overlap(views.events(spark, sf_dir), views.impressions(spark, sf_dir), AS_OF)


def _ad_tables(spark, sf_dir):
    return (views.impressions(spark, sf_dir), views.extension(spark, sf_dir),
            views.creatives(spark, sf_dir))


@query
def report_item_response(spark, sf_dir):
    impressions, extension, creatives = _ad_tables(spark, sf_dir)
    return _rounded(R.item_response(
        impressions, views.shown_items(spark, sf_dir), extension, creatives,
        views.events(spark, sf_dir), CATALOGS, AS_OF, DENIED,
    ))


@query
def report_performance(spark, sf_dir):
    return _rounded(R.performance(*_ad_tables(spark, sf_dir), CATALOGS, AS_OF))


@query
def report_cold_start(spark, sf_dir):
    return _rounded(R.cold_start(
        *_ad_tables(spark, sf_dir), views.events(spark, sf_dir), CATALOGS, AS_OF,
        MIN_IMPRESSIONS, MIN_BEHAVIOURS,
    ))


@query
def report_reach_split(spark, sf_dir):
    return _rounded(R.reach_split(*_ad_tables(spark, sf_dir), CATALOGS, AS_OF))


def _numbered_users(spark, *logs):
    """User numbers as daily runs make them: those of a day after those of the days before."""
    users = logs[0].select("ad_id", "dt")
    for log in logs[1:]:
        users = users.unionByName(log.select("ad_id", "dt"))
    users = cut_lineage(users.distinct())
    earlier = reach.append_users(spark.createDataFrame([], "ad_id string, number bigint"), users.filter(F.col("dt") < DAY))
    earlier = cut_lineage(earlier)
    return cut_lineage(earlier.unionByName(reach.append_users(earlier, users.filter(F.col("dt") >= DAY))))


def _stored_users(spark, rows, numbers, first, last):
    path = scratch_path(spark, "users")
    daily.store_users(rows.filter(F.col("dt") < DAY), numbers, path)
    daily.store_users(rows.filter(F.col("dt") >= DAY), numbers, path, [DAY])
    return daily.stored_users(spark, path, *window_dates(AS_OF, first, last))


@query
def report_event_totals_daily(spark, sf_dir):
    events, shown = cut_lineage(views.events(spark, sf_dir)), views.impressions(spark, sf_dir)
    numbers = _numbered_users(spark, events, shown)
    return daily.event_totals(events, _stored_users(spark, shown, numbers, -29, 0), numbers, AS_OF)


@query
def report_event_totals_catalog_daily(spark, sf_dir):
    events = cut_lineage(views.events(spark, sf_dir))
    chosen = R.selected_creatives(views.creatives(spark, sf_dir), CATALOGS)
    shown = views.impressions(spark, sf_dir).join(chosen, "creative_id")
    numbers = _numbered_users(spark, events, shown)
    seen = _stored_users(spark, shown, numbers, -29, 0)
    return daily.event_totals(events, seen, numbers, AS_OF, -7, R.CATALOG_AD)


@query
def report_user_overlap_daily(spark, sf_dir):
    events, shown = cut_lineage(views.events(spark, sf_dir)), views.impressions(spark, sf_dir)
    numbers = _numbered_users(spark, events, shown)
    return daily.user_overlap(_stored_users(spark, events, numbers, -1, -1), _stored_users(spark, shown, numbers, -29, 0))


@query
def report_reach_split_daily(spark, sf_dir):
    impressions, extension, creatives = _ad_tables(spark, sf_dir)
    numbers = _numbered_users(spark, impressions)
    path = scratch_path(spark, "reach")
    for days in (F.col("dt") < DAY, F.col("dt") == DAY):
        published.publish(daily.day_reach(impressions.filter(days), extension.filter(days), creatives, CATALOGS, numbers), path)
    stored = published.read(spark, path, daily.REACHED, *window_dates(AS_OF, -2, -1))
    return _rounded(daily.reach_split(stored))


# Recall models

@query
def interaction_scores(spark, sf_dir):
    return _rounded(N.interaction_scores(views.purchase_lines(spark, sf_dir)))


@query
def vocabulary_lookup(spark, sf_dir):
    scores, users, items = N.indexed_scores(cut_lineage(views.purchases(spark, sf_dir)))
    contiguous = int(I.is_contiguous(users, "user_index") and I.is_contiguous(items, "item_index"))
    return _rounded(scores.withColumns({
        "score": F.col("score").cast("double"), "contiguous": F.lit(contiguous)}))


def _knn(spark, sf_dir, weight):
    scores = N.interaction_scores(views.purchases(spark, sf_dir))
    return _rounded(N.item_knn(scores, weight))


@query
def item_knn_tfidf(spark, sf_dir):
    return _knn(spark, sf_dir, "tfidf")


@query
def item_knn_cosine(spark, sf_dir):
    return _knn(spark, sf_dir, "cosine")


@query
def item_knn_bm25(spark, sf_dir):
    return _knn(spark, sf_dir, "bm25")


@query
def als_similar_items(spark, sf_dir):
    items, _ = M.als_factors(cut_lineage(views.purchases(spark, sf_dir)))
    return V.cosine_topk(items)


@query
def embedding_topk(spark, sf_dir):
    return _rounded(V.cosine_topk(views.item_vectors(spark, sf_dir)))


@query
def embedding_topk_text(spark, sf_dir):
    topk = V.cosine_topk(views.item_vectors(spark, sf_dir))
    return _texts(V.as_text(_rounded(topk)))


@query
def approx_topk(spark, sf_dir):
    return V.hashed_topk(views.item_vectors(spark, sf_dir))


@query
def approx_topk_quality(spark, sf_dir):
    return V.search_quality(views.item_vectors(spark, sf_dir)).select(
        "items", "found", (F.col("recall") >= 0.9).cast("int").alias("finds_most"),
        (F.col("compared") < 1).cast("int").alias("compares_less"),
    )


@query
def forest_topk(spark, sf_dir):
    return W.forest_topk(views.item_vectors(spark, sf_dir))


@query
def forest_quality(spark, sf_dir):
    vectors = cut_lineage(views.item_vectors(spark, sf_dir))
    found = cut_lineage(W.forest_topk(vectors))
    exact = V.cosine_topk(vectors)
    hits = exact.join(found, ["item", "neighbour"], "left_semi").count()
    return found.agg(F.count_distinct("item").alias("items"), F.count("*").alias("found"),
                     (F.lit(hits) >= 0.9 * F.count("*")).cast("int").alias("finds_most"))


@query
def skipgram_topk(spark, sf_dir):
    corpus = Q.session_corpus(views.events(spark, sf_dir), views.LAST_DAY, days=30)
    return V.cosine_topk(M.skipgram_vectors(corpus))


def _category_inputs(spark, sf_dir):
    rows = cut_lineage(views.events(spark, sf_dir))
    category = C.category_of(F.col("item_id")).alias("category")
    return rows, rows.groupBy(category).agg(F.count("*").alias("counts"))


@query
def user_category_vectors(spark, sf_dir):
    rows, counts = _category_inputs(spark, sf_dir)
    return _texts(M.user_categories(rows, M.frequent_categories(counts)))


@query
def user_category_clusters(spark, sf_dir):
    return M.user_clusters(*_category_inputs(spark, sf_dir))


@query
def cluster_sizes(spark, sf_dir):
    sizes = M.cluster_sizes(M.user_clusters(*_category_inputs(spark, sf_dir)))
    largest_first = F.sort_array(F.collect_list("users"), asc=False)  # one number a cluster
    return sizes.agg(largest_first.alias("sizes")).select(F.posexplode("sizes").alias("place", "users"))


# How well the models fit, as flags that SQL can state; each from the whole of its model.

@query
def cluster_quality(spark, sf_dir):
    rows, counts = _category_inputs(spark, sf_dir)
    users = cut_lineage(M.user_categories(rows, M.frequent_categories(counts)))
    found = M.cluster_quality(cut_lineage(M.user_clusters(rows, counts)), users)
    return found.select("users", (F.col("nearest") >= 0.99).cast("int").alias("nearest"),
                        (F.col("within") <= 0.8 * F.col("whole")).cast("int").alias("beats_one_cluster"))


@query
def skipgram_quality(spark, sf_dir):
    corpus = Q.session_corpus(views.events(spark, sf_dir), views.LAST_DAY, days=30)
    sentences = cut_lineage(corpus.select(F.split("events", " ").alias("items")))
    vectors = cut_lineage(K.skipgram(sentences))
    found = E.similarity_quality(sentences, vectors)
    frequent = F.lit(vectors.count()).cast("bigint").alias("items")
    return found.select(frequent, (F.col("auc") >= 0.6).cast("int").alias("beats_chance"),
                        (F.col("auc") > F.col("beside") + 0.1).cast("int").alias("beats_cooccurrence"))


@query
def als_quality(spark, sf_dir):
    scores = cut_lineage(views.purchases(spark, sf_dir))
    items, users = M.als_factors(scores)
    return E.separation(scores, users, items).select(
        "pairs", (F.col("auc") >= 0.9).cast("int").alias("beats_chance"),
        (F.col("auc") > F.col("popular") + 0.1).cast("int").alias("beats_popularity"))


# Evaluation

VECTOR_SIZE = 64


def _scored_inputs(spark, sf_dir, rows, items):
    """Samples, user vectors and item vectors; each is used several times, so kept once computed."""
    profiles = cut_lineage(views.month_profiles(rows, items))
    samples = cut_lineage(views.month_samples(rows, items, profiles))
    vectors = views.item_vectors(spark, sf_dir)
    users = cut_lineage(E.user_vectors(profiles, vectors, VECTOR_SIZE))
    return samples, users, vectors


@query
def user_item_scores(spark, sf_dir):
    samples, users, candidates = _scored_inputs(spark, sf_dir, *views.daily(spark, sf_dir))
    pairs = samples.select("row_id", "profile", F.col("item_no").alias("item"))
    return _rounded(E.score_pairs(pairs, users, candidates)).drop("profile")


@query
def hit_rate(spark, sf_dir):
    samples, users, candidates = _scored_inputs(spark, sf_dir, *views.daily(spark, sf_dir))
    pairs = samples.groupBy("profile", F.col("item_no").alias("target")).agg(
        F.count("*").alias("n")
    )
    numbered = candidates.filter(F.col("item").between(1, ACTIVE_CAP))
    ranks = E.target_ranks(pairs.select("profile", "target"), users, numbered)
    return _rounded(E.hit_rate(ranks.join(pairs, ["profile", "target"]), weight="n"))


@query
def ranking_by_bounds(spark, sf_dir):
    samples, users, candidates = _scored_inputs(spark, sf_dir, *views.daily(spark, sf_dir))
    pairs = cut_lineage(samples.groupBy("profile", F.col("item_no").alias("target")).agg(F.count("*").alias("n")))
    targets = pairs.select("profile", "target")
    scored = cut_lineage(E.reached_scores(targets, users, candidates))
    # as many blocks as a list of millions would have
    counts = E.rank_counts(scored, candidates, candidates.count(), block_rows=8)
    plain = E.target_ranks(targets, users, candidates).withColumnRenamed("rank", "plain")
    rank = F.when(F.col("reached").isNotNull(), F.col("better") + 1)
    both = counts.join(plain, ["profile", "target"]).join(pairs, ["profile", "target"])
    return both.agg(F.sum("n").alias("records"), F.min(rank.eqNullSafe(F.col("plain")).cast("int")).alias("equal"))


def _labelled_scores(spark, sf_dir):
    behaviours, items = views.daily(spark, sf_dir)
    samples, users, candidates = _scored_inputs(spark, sf_dir, behaviours, items)
    rows = samples.select("ad_id", "row_id", "profile", "item_no")
    negatives = S.sample_negatives(rows, Q.user_positives(behaviours, items), ACTIVE_CAP, per_row=1)
    pairs = cut_lineage(S.labelled_pairs(rows, negatives, ["row_id", "profile"], "item_no").select(
        "profile", F.col("item_no").alias("item"), "label"
    ))
    return E.score_pairs(pairs, users, candidates)


@query
def auc(spark, sf_dir):
    scores = _labelled_scores(spark, sf_dir)
    rounded = scores.withColumn("score", F.round("score", 9))
    return _rounded(E.auc(rounded))


@query
def auc_binned(spark, sf_dir):
    scores = _labelled_scores(spark, sf_dir)
    rounded = scores.withColumn("score", F.round("score", 9))
    return _rounded(E.auc(rounded, bins=200))


@query
def evaluation_summary(spark, sf_dir):
    return _rounded(E.evaluation_summary(_labelled_scores(spark, sf_dir)))
