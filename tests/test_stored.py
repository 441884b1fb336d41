"""Days published at once, tables stored by key, and windows made of stored days."""

from __future__ import annotations

import random
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from tidepool.functions.dates import shift_day
from tidepool.operators import items as I, joins as J, numbering as U, reach, runs, sequences as Q
from tidepool.plans import daily, reports as R
from tidepool.shared import scratch_path
from tidepool.sources import bucketed, published


def rows(df):
    return sorted(map(str, df.collect()))


def plan(df) -> str:
    """The plan that ran, after what Spark changed on the way."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def days(spark, *named):
    return spark.createDataFrame([(n, d) for n, d in named], "n int, dt string")


SCHEMA = "n int, dt string"


def test_a_run_is_visible_as_a_whole(spark):
    path = scratch_path(spark, "p")
    assert published.read(spark, path, SCHEMA).collect() == []
    published.publish(days(spark, (1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03")), path)
    published.publish(days(spark, (4, "2024-01-02")), path, ["2024-01-01", "2024-01-02", "2024-01-09"])
    assert rows(published.read(spark, path, SCHEMA)) == rows(days(spark, (4, "2024-01-02"), (3, "2024-01-03")))
    assert rows(published.read(spark, path, SCHEMA, "2024-01-03", "2024-01-09")) == rows(days(spark, (3, "2024-01-03")))
    # a run without any row empties its days
    published.publish(spark.createDataFrame([], SCHEMA), path, ["2024-01-03"])
    assert rows(published.read(spark, path, SCHEMA)) == rows(days(spark, (4, "2024-01-02")))


@pytest.mark.parametrize("step", ["write", "commit"])
def test_a_run_that_fails_leaves_the_old_days_whole(spark, monkeypatch, step):
    path = scratch_path(spark, "p")
    before = days(spark, (1, "2024-01-01"), (2, "2024-01-02"))
    published.publish(before, path)
    if step == "commit":
        def fail(*_):
            raise OSError("lost")

        monkeypatch.setattr(published, "_commit", fail)
        bad = days(spark, (9, "2024-01-01"))
    else:  # some tasks write their rows, one fails
        bad = days(spark, *[(n, "2024-01-01") for n in range(50)]).repartition(10).withColumn(
            "n", F.when(F.col("n") == 33, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("n")))
    with pytest.raises(Exception, match="lost"):
        published.publish(bad, path, ["2024-01-01", "2024-01-02"])
    assert rows(published.read(spark, path, SCHEMA)) == rows(before)
    monkeypatch.undo()
    published.publish(days(spark, (5, "2024-01-02")), path)
    assert rows(published.read(spark, path, SCHEMA)) == rows(days(spark, (1, "2024-01-01"), (5, "2024-01-02")))


def test_two_runs_at_once_do_not_lose_days(spark, monkeypatch):
    path = scratch_path(spark, "p")
    published.publish(days(spark, (1, "2024-01-01")), path)
    state = published.manifest(spark, path)
    published.publish(days(spark, (2, "2024-01-02")), path)
    monkeypatch.setattr(published, "manifest", lambda *_: state)  # the other run began before
    with pytest.raises(RuntimeError, match="another run"):
        published.publish(days(spark, (3, "2024-01-03")), path)
    monkeypatch.undo()
    assert rows(published.read(spark, path, SCHEMA)) == rows(days(spark, (1, "2024-01-01"), (2, "2024-01-02")))


def test_old_versions_can_be_removed(spark):
    path = scratch_path(spark, "p")
    for n in range(3):
        published.publish(days(spark, (n, "2024-01-01"), *([(9, "2024-01-02")] if not n else [])), path)
    assert len(published.prune(spark, path)) == 1 and published.prune(spark, path) == []
    assert rows(published.read(spark, path, SCHEMA)) == rows(days(spark, (2, "2024-01-01"), (9, "2024-01-02")))


def keyed(spark, n: int, hot: int = 0):
    draw = random.Random(n)
    data = [(f"u{draw.randrange(n // 5)}", k, draw.randrange(100)) for k in range(n)]
    data += [("hot", k, draw.randrange(100)) for k in range(hot)] + [(None, 1, 1)]
    return spark.createDataFrame(data, "ad_id string, ts bigint, v int")


@pytest.mark.parametrize("hot", [0, 600])
def test_stored_by_key_nothing_is_moved(spark, hot):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = keyed(spark, 900, hot)
        right = keyed(spark, 400, hot // 100).select("ad_id", F.col("ts").alias("day"), F.col("v").alias("w"))
        a = bucketed.write_bucketed(left, scratch_path(spark, "a"), ["ad_id"], 6, hot_rows=100, salts=8)
        b = bucketed.write_bucketed(right, scratch_path(spark, "b"), ["ad_id"], 6, hot_rows=100, salts=8)
        assert len(a.hot_hashes) == (1 if hot else 0) and a.hot.count() == hot
        assert rows(a.all_rows()) == rows(left)
        joined = bucketed.join_stored(a, b, F.col("ts") > F.col("day"))
        assert rows(joined) == rows(left.join(right, "ad_id").filter("ts > day"))
        latest = bucketed.latest_stored(a, "ts", "v")
        assert rows(latest) == rows(J.latest_per_key(left, "ad_id", "ts", "v"))
        if not hot:
            assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
            again = bucketed.read_bucketed(spark, scratch_path(spark, "x").rsplit("/", 1)[0] + "/" + a.rows.inputFiles()[0].split("/")[-3],
                                           left.schema.toDDL(), ["ad_id"], 6)
            assert rows(again.rows) == rows(left)
            own = a.rows.groupBy("ad_id").agg(F.max(F.struct("ts", "v")))
            assert "Exchange" not in plan(own)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("few", [True, False])
def test_new_numbers_do_not_move_the_old_ones(spark, monkeypatch, few):
    if not few:
        monkeypatch.setattr(U, "SENT_VALUES", 0)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        first = spark.createDataFrame([(f"i{k:04d}",) for k in range(0, 500, 3)], "item_id string")
        none = spark.createDataFrame([], "item_id string, item_no bigint")
        known = I.new_item_numbers(none, first)
        stored = bucketed.write_bucketed(known, scratch_path(spark, "i"), ["item_id"], 4).rows
        today = spark.createDataFrame([(f"i{k:04d}",) for k in range(0, 500, 2)] * 3 + [(None,)], "item_id string")
        new = I.new_item_numbers(stored, today)
        expected = I.stable_item_index(known, today.filter("item_id is not null"), "2024-01-16").select("item_id", "item_no")
        assert rows(stored.unionByName(new)) == rows(expected)
        # the values asked for are dealt into the buckets, what is stored stays
        met = plan(U.cut_lineage(today.distinct()).join(stored, "item_id", "left_semi"))
        if not few:
            # with adaptive execution the text holds the final and the first plan
            final = met.split("== Initial Plan ==")[0]
            assert final.count("Exchange hashpartitioning(item_id") == 1 and "Bucketed: true" in final
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def logged(spark, n_days: int = 12, users: int = 9):
    draw = random.Random(7)
    data = []
    for d in range(n_days):
        for u in range(users):
            for _ in range(draw.randrange(0, 5)):
                ts = d * 86_400_000_000 + draw.randrange(20)
                data.append((f"u{u}", f"c{draw.randrange(3)}:{draw.randrange(9)}", draw.randrange(1, 4), ts, f"2024-01-{d + 1:02d}"))
    data += [("u0", "c0:1", 1, 5 * 86_400_000_000 + k % 7, "2024-01-06") for k in range(60)]  # a long day
    return spark.createDataFrame(data, "ad_id string, item_id string, behavior_type int, ts bigint, dt string")


@pytest.mark.parametrize("part_events", [Q.PART_EVENTS, 7])
def test_windows_of_stored_runs_equal_those_of_the_log(spark, monkeypatch, part_events):
    log, path = logged(spark), scratch_path(spark, "runs")
    items = I.active_items(log, "2024-01-13", days=12, cap=15)
    for day in sorted({r.dt for r in log.select("dt").distinct().collect()}):
        runs.store_day(log, path, day, part_events)
    runs.store_day(log, path, "2024-01-04", part_events)  # a day that is run again
    run_days = [shift_day("2024-01-13", -n) for n in range(8)]
    found = [runs.window_features(spark, path, items, day, part_events=part_events) for day in run_days]
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    expected = Q.backfill_user_features(log, items, run_days, part_events=part_events)
    assert rows(whole) == rows(expected.select(whole.columns))
    monkeypatch.setattr(runs, "PART_EVENTS", part_events)
    merged = runs.merged_runs(spark, path, "2024-01-08", 4)
    alike = Q.user_sequences(log.filter("dt between '2024-01-04' and '2024-01-07'"), ["ad_id"], ["item_id", "behavior_type"])
    joined = {}
    for r in merged.orderBy("ad_id", "part").collect():
        joined.setdefault(r.ad_id, []).extend(r.seq)
    assert joined == {r.ad_id: r.seq for r in alike.collect()}


def test_a_run_reads_its_own_day_of_the_log(spark):
    log, path = scratch_path(spark, "log"), scratch_path(spark, "runs")
    logged(spark).write.partitionBy("dt").parquet(log)
    table = spark.read.schema("ad_id string, item_id string, behavior_type int, ts bigint, dt string").parquet(log)
    expected = rows(table.filter(F.col("dt").between("2024-01-05", "2024-01-06")))
    for file in table.inputFiles():  # a run that read any other day would fail
        if "dt=2024-01-05" not in file and "dt=2024-01-06" not in file:
            Path(urlparse(file).path).write_bytes(b"no parquet")
    for day in ("2024-01-05", "2024-01-06"):
        runs.store_day(table, path, day)
    window = runs.stored_behaviours(spark, path, "2024-01-04", "2024-01-06")
    assert all("/versions/" in f and log not in f for f in window.inputFiles())
    assert rows(window.select(table.columns)) == expected


def brute_users(data, first, last):
    return {u for u, d in data if first <= d <= last}


def test_users_of_windows_from_daily_bitmaps(spark):
    draw = random.Random(3)
    data = [(f"u{draw.randrange(60)}", f"2024-01-{draw.randrange(1, 15):02d}") for _ in range(300)]
    data += [("hot", f"2024-01-{d:02d}") for d in range(1, 15) for _ in range(40)]
    log = spark.createDataFrame(data, "ad_id string, dt string")
    known, path = spark.createDataFrame([], "ad_id string, number bigint"), scratch_path(spark, "users")
    for day in range(1, 15):  # each run adds its day's users, far apart so that there are many bitmaps
        own = log.filter(F.col("dt") == f"2024-01-{day:02d}")
        new = reach.append_users(known, own)
        known = spark.createDataFrame(known.unionByName(new).collect(), known.schema)
        daily.store_users(own, known.withColumn("number", F.col("number") * 20_000), path, [f"2024-01-{day:02d}"])
    numbers = known.withColumn("number", F.col("number") * 20_000)
    assert I.is_contiguous(known, "number", 1) and known.count() == len({u for u, _ in data})
    for first, last in ((1, 14), (3, 3), (5, 11), (14, 14)):
        span = f"2024-01-{first:02d}", f"2024-01-{last:02d}"
        stored = daily.stored_users(spark, path, *span)
        wanted = brute_users(data, *span)
        assert reach.count_users(reach.union_users(stored)).first()["n"] == len(wanted)
        other = daily.stored_users(spark, path, "2024-01-06", "2024-01-08")
        both = reach.count_common(reach.union_users(stored), reach.union_users(other)).first()["n"]
        assert both == len(wanted & brute_users(data, "2024-01-06", "2024-01-08"))
        kept = reach.rows_of_users(log, reach.union_users(stored), numbers)
        assert {r.ad_id for r in kept.collect()} == wanted and kept.count() == sum(u in wanted for u, _ in data)
    empty = log.filter("false")
    assert reach.count_users(reach.union_users(reach.day_users(empty, numbers))).first()["n"] == 0
    # a user of a third of all rows is one bit before anything is moved
    assert reach.day_users(log, numbers).agg(F.sum(F.bitmap_count("users"))).first()[0] == len(set(data))


def test_daily_reports_equal_those_of_the_logs(spark):
    draw = random.Random(5)
    events = spark.createDataFrame(
        [(f"u{draw.randrange(30)}", f"c:{draw.randrange(9)}", draw.choice([R.VIEW, R.CART, R.PURCHASE]), f"2024-01-{draw.randrange(1, 17):02d}")
         for _ in range(500)], "ad_id string, item_id string, behavior_name string, dt string")
    seen = spark.createDataFrame([(f"u{draw.randrange(10, 45)}", f"2024-01-{draw.randrange(1, 17):02d}") for _ in range(60)], "ad_id string, dt string")
    numbers = reach.append_users(spark.createDataFrame([], "ad_id string, number bigint"), events.select("ad_id").unionAll(seen.select("ad_id")))
    path = scratch_path(spark, "users")
    daily.store_users(seen, numbers, path)
    for as_of in ("2024-01-16", "2024-01-09", "2023-12-01"):
        stored = daily.stored_users(spark, path, shift_day(as_of, -29), as_of)
        assert rows(daily.event_totals(events, stored, numbers, as_of)) == rows(R.event_totals(events, seen, as_of))
        active = reach.day_users(events.filter(F.col("dt") == shift_day(as_of, -1)), numbers)
        assert rows(daily.user_overlap(active, stored)) == rows(R.user_overlap(events, seen, as_of))
