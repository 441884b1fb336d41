from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidepool import schemas
from tidepool.functions import columns as C
from tidepool.operators import features as X, samples as S

CONFIG = {
    "dense": ["label", "d"], "sparse": ["s"], "embedding": ["e"], "weighted_embedding": ["w"],
    "labels": ["ctr_label", "cvr_label", "d"],
}


def typed(spark, *documents):
    df = spark.createDataFrame(
        [(n, json.dumps(d) if d is not None else None, 1.0, 0.0) for n, d in enumerate(documents)],
        "id int, features string, label double, cvr_label double")
    return X.typed_features(df, X.feature_config(spark, CONFIG), ["id"])


def values(spark, name, *documents):
    rows = typed(spark, *documents).filter(F.col("name") == name).orderBy("id").collect()
    return {r.id: r for r in rows}


def test_dense_takes_numbers_and_number_text(spark):
    found = values(spark, "d", {"d": True}, {"d": "1.5"}, {"d": [1]}, {"d": 2}, {"d": 0.25},
                   {"d": None}, {"d": "x"}, {}, None)
    assert {k: r.number_value for k, r in found.items()} == {1: 1.5, 3: 2.0, 4: 0.25}
    assert {r.kind for r in found.values()} == {"dense"}


def test_sparse_takes_text_and_whole_numbers(spark):
    found = values(spark, "s", {"s": 3}, {"s": "a"}, {"s": 1.5}, {"s": True}, {"s": ["a"]})
    assert {k: r.text_value for k, r in found.items()} == {0: "3", 1: "a"}


def test_embedding_writes_texts_and_counts_all(spark):
    found = values(spark, "e", {"e": [1, 2]}, {"e": ["a"]}, {"e": []}, {"e": [0.5]}, {"e": 7})
    assert {k: (r.text_values, r.counted_values) for k, r in found.items()} == {
        0: (["1", "2"], ["1", "2"]), 1: (["a"], ["a"]), 3: (None, ["0.5"])}


def test_weighted_needs_entries(spark):
    found = values(spark, "w", {"w": {}}, {"w": {"a": 0.5, "b": "2"}}, {"w": [1]})
    assert {k: r.weights for k, r in found.items()} == {1: {"a": 0.5, "b": 2.0}}


def test_labels_are_features_too_and_win(spark):
    rows = typed(spark, {"label": 9, "cvr_label": 5, "unknown": 1}).collect()
    assert {r.name: (r.kind, r.number_value) for r in rows} == {
        "label": ("dense", 1.0), "ctr_label": ("labels", 1.0), "cvr_label": ("labels", 0.0)}


def test_statistics(spark):
    stats = {r.name: r for r in X.dense_stats(typed(spark, {"d": 3.0})).collect()}
    one = stats["d"]
    assert (one["count"], one.positive, one.min, one.max, one.mean, one.variance) == (1, 1, 3, 3, 3, 0)
    documents = [{"d": 1, "s": "a", "e": ["x", "x"], "w": {"k": 1}},
                 {"d": 3, "s": "a", "e": ["y"], "w": {"k": 3, "l": 2}}]
    many = typed(spark, *documents)
    two = {r.name: r for r in X.dense_stats(many).collect()}["d"]
    assert two.variance == pytest.approx(two.square_mean - two.mean ** 2) == 1
    assert {(r.name, r.value): r.n for r in X.category_stats(many).collect()} == {
        ("s", "a"): 2, ("e", "x"): 2, ("e", "y"): 1}
    assert {r.key: (r["count"], r.mean) for r in X.weighted_stats(many).collect()} == {
        "k": (2, 2.0), "l": (1, 2.0)}
    report = X.stats_report("2024-01-15", many).collect()
    assert [r.name for r in report] == sorted(r.name for r in report)
    assert json.loads(next(r.stats for r in report if r.key == "l"))["max"] == 2.0


def test_merged_documents(spark):
    texts = ['{"a": 1, "b": {"x": [1]}}', None, '{"a": "2"}']
    df = spark.createDataFrame([tuple(texts)], "x string, y string, z string")
    merged = df.select(C.merge_json(F.col("x"), F.col("y"), F.col("z"))).first()[0]
    assert json.loads(merged) == {"a": "2", "b": {"x": [1]}}


def test_limited_merge_needs_both_documents(spark):
    rows = [("1", "u", "c", "i", "l", '{"a":1}', '{"c":1}', "{}", '{"b":2}', 1.0, 0.0, "d"),
            ("0", "u", "c", "i", "l", None, "{}", "{}", "{}", 1.0, 0.0, "d"),
            ("2", "u", "c", "i", "l", "{}", "{}", "{}", "{}", 1.0, 0.0, "d")]
    merged = X.merge_features(spark.createDataFrame(rows, schemas.CTR_SAMPLE), limit=1).collect()
    assert [(r.ots, json.loads(r.features)) for r in merged] == [("1", {"a": 1, "b": 2, "c": 1})]


def test_behaviour_document(spark):
    arrays = spark.createDataFrame([("u", 0, ["a", "b"], ["AddToCart", None], 0, 1, "d")],
                                   schemas.USER_BEHAVIOUR_ARRAYS)
    document = json.loads(X.user_behaviour_json(arrays).first().user_behavior_f)
    assert document == {"content_ids_list": ["a", "b"], "behavior_types_list": ["AddToCart", None],
                        "has_view": 0, "has_add_to_car": 1}


def test_config_file(spark, tmp_path):
    path = tmp_path / "config.json"
    path.write_text(json.dumps({**CONFIG, "shared_embedding": [["s", "e"]]}))
    assert X.load_feature_config(spark, str(path)) == CONFIG


def samples(spark, *sequences):
    rows = [("u", s, "1", None, "\\N", "", n, 2, "d") for n, s in enumerate(sequences)]
    return spark.createDataFrame(rows, schemas.TRAIN_SAMPLE)


def test_examples_need_six_different_items(spark):
    df = samples(spark, "1,2,3,4,5,5", "6,5,4,3,2,1,1", "\\N")
    rows = S.to_examples(df).collect()
    assert [(r.item_target, r.item_seq, r.item_car, r.item_purchase) for r in rows] == [
        (1, [1, 2, 3, 4, 5, 6], [], [])]
    kept = S.to_examples(df, unique=False).orderBy("item_target").collect()
    assert [r.item_seq for r in kept] == [[1, 2, 3, 4, 5, 5], [6, 5, 4, 3, 2, 1, 1], []]


def test_samples_need_five_items(spark):
    behaviours = spark.createDataFrame([("u", "a", 1, 1, "2024-01-15"), ("v", "a", 3, 1, "2024-01-15")],
                                       schemas.BEHAVIOURS)
    items = spark.createDataFrame([("a", 1, 4, "d")], schemas.ACTIVE_ITEMS)
    features = spark.createDataFrame(
        [("u", 0, "1,2,3,4", "", None, None, None, 4, "2024-01-14"),
         ("v", 0, "1,2,3,4", "", None, None, None, 6, "2024-01-14"),
         ("v", 1, "5,6", "", None, None, None, 6, "2024-01-14"),
         ("v", 0, "1,2,3,4,5", "", None, None, None, 5, "2024-01-13")], schemas.USER_FEATURES)
    samples = S.train_sample(behaviours, items, features, "2024-01-15")
    assert [(r.ad_id, r.item_seq, r.item_target, r.label) for r in samples.collect()] == [
        ("v", "1,2,3,4", 4, 3)]
    assert S.to_examples(samples, features).first().item_seq == [1, 2, 3, 4, 5, 6]


def test_decimals_become_plain_numbers(spark):
    df = spark.sql("SELECT cast(3 AS decimal(9,0)) a, cast(1.5 AS decimal(9,2)) b, 'x' c")
    assert dict(C.plain_numbers(df).dtypes) == {"a": "bigint", "b": "double", "c": "string"}
