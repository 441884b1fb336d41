from __future__ import annotations

import json
import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tidepool import schemas
from tidepool.functions import columns as C, dates
from tidepool.operators import (
    behaviours as B, features as X, items as I, joins as J, samples as S, sequences as Q,
)
from tidepool.plans import views

NAMES = B.EVENT_PREFIX + "ViewContent"


def raw_row(content="1:a:2", adid="u", event=NAMES, store="s", log_type=NAMES, ts="5"):
    data = {"adid": [adid], "event": [event], "createdat": [ts], "storeid": [store]}
    if content is not None:
        data["partnerparameters"] = [json.dumps({"content_id": content})]
    return (data, log_type, "2024-01-15")


def extract(spark, *rows):
    raw = spark.createDataFrame(list(rows), schemas.RAW_EVENT_LOG)
    return sorted(B.extract_behaviours(raw, ["s"], ("", "bad")).collect(), key=str)


def test_item_ids_and_categories(spark):
    df = spark.createDataFrame([("123:shop-a_1:99",), (" x:1 ",), ("plain",)], "i string")
    item = C.normalise_item_id(F.col("i"))
    rows = df.select(item, C.category_of(item)).collect()
    assert [tuple(r) for r in rows] == [
        ("shop-a_1:99", "shop-a_1"), ("x:1", "x"), ("plain", "plain")
    ]


def test_empty_pieces_make_no_rows(spark):
    rows = extract(spark, raw_row("1:a:2,,"))
    assert [r.item_id for r in rows] == ["a:2"]


def test_missing_fields_make_no_rows_and_no_error(spark):
    empty = ({}, NAMES, "2024-01-15")
    assert extract(spark, raw_row(None), empty, raw_row(adid=None)) == []


def test_denied_ids_stores_and_log_types(spark):
    assert extract(spark, raw_row(adid=""), raw_row(adid="bad"), raw_row(store="other"),
                   raw_row(log_type="error")) == []


def test_unknown_event_has_no_code(spark):
    rows = extract(spark, raw_row(event="adjust:callback:Other"), raw_row(event="revenue"))
    assert sorted((r.behavior_type for r in rows), key=str) == [3, None]


def test_dirty_time_is_null(spark):
    assert extract(spark, raw_row(ts="soon"))[0].ts is None


def test_json_log_gives_the_same_rows(spark):
    row = {"_d": {"PartnerParameters": json.dumps({"content_id": "1:a:2, 1:b:3"}), "StoreId": "s"},
           "_u": "u", "_m": NAMES, "timestamp": 5}
    raw = spark.createDataFrame([(json.dumps(row), "2024-01-15")], schemas.RAW_TRACKER_LOG)
    assert sorted(B.extract_behaviours_json(raw, ["s"]).collect(), key=str) == extract(
        spark, raw_row("1:a:2, 1:b:3"))


def test_windows():
    assert dates.window_dates("2024-03-01", -3, -1) == ("2024-02-27", "2024-02-29")
    assert dates.shift_day("2024-01-01", -1) == "2023-12-31"


BEHAVIOURS = [
    ("u", "a", 1, 2, "2024-01-15"), ("u", "b", 2, 1, "2024-01-15"), ("u", "c", 1, 1, "2024-01-14"),
    ("v", "a", None, 7, "2024-01-13"), ("v", "zz", 1, 8, "2024-01-15"),
]
ITEMS = [("a", 9, 1, "d"), ("b", 8, 2, "d"), ("c", 7, 3, "d")]


def test_features_order_ties_and_missing_parts(spark):
    rows = spark.createDataFrame(BEHAVIOURS, schemas.BEHAVIOURS)
    items = spark.createDataFrame(ITEMS, schemas.ACTIVE_ITEMS)
    u, v = sorted(Q.user_features(rows, items, "2024-01-16").collect(), key=str)
    assert (u.item_seq, u.behavior_seq, u.item_car, u.item_purchase) == ("2,3,1", "2,1,1", "2", None)
    assert (v.item_seq, v.behavior_seq, v.item_car, v.dt) == ("1", "", None, "2024-01-15")


def test_backfill_equals_single_days(spark):
    rows = spark.createDataFrame(BEHAVIOURS, schemas.BEHAVIOURS)
    items = spark.createDataFrame(ITEMS, schemas.ACTIVE_ITEMS)
    days = ["2024-01-14", "2024-01-15", "2024-01-16", "2024-01-17", "2024-01-30"]
    single = [r for day in days for r in Q.user_features(rows, items, day).collect()]
    together = Q.backfill_user_features(rows, items, days).collect()
    assert sorted(map(str, single)) == sorted(map(str, together))


@pytest.mark.parametrize("newest_first", [False, True])
def test_long_sequences_continue_in_parts(spark, newest_first):
    events = [("hot", f"i{n:03d}", n // 3) for n in range(90)] + [("cold", "x", 4)]
    events += [("minute", f"i{n % 7}", 5) for n in range(60)] + [("none", "same", None)] * 55
    rows = spark.createDataFrame(events, "ad_id string, item_id string, ts bigint")
    whole = Q.user_sequences(rows, ["ad_id"], ["item_id"], newest_first)
    parts = Q.user_sequences(rows, ["ad_id"], ["item_id"], newest_first, part_events=10)
    assert whole.filter("part > 0").count() == 0
    gathered = {}
    for r in sorted(parts.collect(), key=lambda r: (r.ad_id, r.part)):
        assert len(r.seq) <= 10
        gathered.setdefault((r.ad_id, r.n_items), []).extend(r.seq)
    assert gathered == {(r.ad_id, r.n_items): r.seq for r in whole.collect()}


def joined_text(rows, key, names):
    """Slices of each user put together again."""
    out = {}
    for r in sorted(rows, key=lambda r: (r[key], r["dt"], r["part"])):
        own = out.setdefault((r[key], r["dt"]), {name: [] for name in names})
        for name in names:
            value = r[name]
            own[name] += value if isinstance(value, list) else re.split("[, ]", value) if value else []
    return out


def test_what_comes_out_does_not_depend_on_the_slices(spark, monkeypatch):
    sf_dir = "/root/testdata/sf0.001"
    rows, items = views.daily(spark, sf_dir)
    events = views.events(spark, sf_dir)
    day = views.AS_OF

    def made():
        features = Q.user_features(rows, items, "2024-01-15", part_events=P)
        sessions = Q.user_sessions(rows, items, "2024-01-14", part_events=P)
        arrays = Q.user_behaviour_arrays(events, day, part_events=P)
        samples = S.train_sample(rows, items, features, "2024-01-15")
        shown = views.impressions(spark, sf_dir).select("ots", "ad_id", "click")
        documents = X.user_behaviour_json(arrays)
        flags = documents.select("ad_id", F.get_json_object("user_behavior_f", "$.has_view").alias("v"),
                                 F.get_json_object("user_behavior_f", "$.has_add_to_car").alias("c"))
        clicks = X.ctr_sample(views.catalogue_impressions(spark, sf_dir),
                              views.feature_material(spark, sf_dir), documents, "2024-01-15", 1.0)
        joined = J.left_join_where(shown, documents.filter("part = 0"), "ad_id", F.col("click") > 0)
        return {
            "features": joined_text(features.collect(), "ad_id", ["item_seq", "behavior_seq", "item_car"]),
            "sessions": joined_text(sessions.collect(), "ad_id", ["item_nos", "behavior_types"]),
            "arrays": joined_text(arrays.collect(), "ad_id", ["content_ids", "behavior_types"]),
            "corpus": joined_text(Q.session_corpus(events, day, part_events=P).collect(), "ad_id", ["events"]),
            "categories": joined_text(Q.user_category_sequences(events, "2024-01-15", part_events=P).collect(),
                                      "ad_id", ["item_seq", "category_seq"]),
            "samples": sorted(map(str, samples.select("ad_id", "item_target", "label", "dt").collect())),
            "conversions": sorted(map(str, S.train_sample_conversions(
                rows, items, sessions, "2024-01-15", min_items=2).select("ad_id", "item_target", "label").collect())),
            "examples": sorted(map(str, S.to_examples(samples, features, min_items=2).collect())),
            "flags": sorted(set(map(str, flags.collect()))),
            "clicks": sorted(map(str, clicks.drop("itemf").collect())),
            "joined": sorted(map(str, joined.select("ots", "ad_id", "click").collect())),
        }

    P = Q.PART_EVENTS
    whole = made()
    P = 3
    assert made() == whole and whole["samples"] and whole["examples"]


def test_samples_of_any_slices_hold_whole_sequences(spark, monkeypatch):
    sf_dir = "/root/testdata/sf0.01"
    names = {"train_sample": ["item_seq", "behavior_seq", "item_car", "item_purchase"],
             "train_sample_conversions": ["item_nos", "behavior_types"]}

    def made():
        out = {}
        for query, lists in names.items():
            rows = queries()[query](spark, sf_dir).collect()
            own = {}
            assert all((r.part == 0) == (r.label is not None) == (r.item_target is not None) for r in rows)
            for r in rows:  # a target's lists first, then those of the further parts
                own.setdefault((r.ad_id, r.dt), {})[r.part] = [
                    r[name].split(",") if r[name] else [] for name in lists]
            out[query] = {key: [sum((parts[k][n] for k in sorted(parts)), []) for n in range(len(lists))]
                          for key, parts in own.items()}
            out[f"targets of {query}"] = sorted(
                (r.ad_id, r.item_target, r.label, r.dt) for r in rows if r.label is not None)
        rows = queries()["ctr_sample"](spark, sf_dir).collect()
        documents = {}
        for r in rows:
            if r.itemf is not None:
                documents.setdefault((r.ad_id_plus, r.dt), {})[r.part] = json.loads(r.itemf)
        out["itemf"] = {key: [sum((parts[k][name] for k in sorted(parts)), [])
                              for name in ("content_ids_list", "behavior_types_list")]
                        for key, parts in documents.items()}
        out["clicks"] = sorted(str(r.asDict() | {"itemf": None}) for r in rows if r.part == 0)
        merged = queries()["ctr_feature_merge"](spark, sf_dir).collect()
        first = {r.ad_id_plus: r.n_items for r in merged if r.part == 0}
        out["n_items"] = {user: n + sum(r.n_items for r in merged if r.part > 0 and r.ad_id_plus == user)
                          for user, n in first.items()}
        return out

    whole = made()
    for make in (Q.user_features, Q.user_sessions, Q.user_behaviour_arrays):
        monkeypatch.setattr(make, "__defaults__", (*make.__defaults__[:-1], 3))
    assert made() == whole and all(whole.values())


def test_active_items_break_ties_by_id(spark):
    rows = spark.createDataFrame(
        [("u", item, 1, 1, "2024-01-10") for item in "bbaaccd"] + [("u", "old", 1, 1, "2024-01-05")],
        schemas.BEHAVIOURS)
    found = I.active_items(rows, "2024-01-16", cap=3).orderBy("item_no").collect()
    assert [(r.item_id, r.item_num, r.item_no) for r in found] == [
        ("a", 2, 1), ("b", 2, 2), ("c", 2, 3)]


def index_of(spark, previous, today):
    old = spark.createDataFrame(previous, "item_id string, item_no bigint")
    new = spark.createDataFrame([(t,) for t in today], "item_id string")
    index = I.stable_item_index(old, new, "2024-01-16")
    assert I.is_contiguous(index, "item_no", start=1)
    return {r.item_id: r.item_no for r in index.collect()}


def test_stable_index(spark):
    assert index_of(spark, [], ["b", "a", "b"]) == {"a": 1, "b": 2}
    old = [("z", 1), ("gone", 2)]
    assert index_of(spark, old, ["b", "z", "a"]) == {"z": 1, "gone": 2, "a": 3, "b": 4}
    gaps = [("z", 5), ("gone", 9)]
    assert index_of(spark, gaps, ["b", "z"]) == {"z": 1, "gone": 2, "b": 3}


def test_zero_based(spark):
    index = I.zero_based(spark.createDataFrame([(1, 2), (2, 1)], "a int, b int"), "a", "b")
    assert I.is_contiguous(index, "a") and I.is_contiguous(index, "b")
    assert not I.is_contiguous(index.withColumn("a", F.col("a") * 2), "a")
