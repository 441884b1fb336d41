"""Behaviours of each user and day as sorted runs, stored once and merged by day.

A daily run reads its own day of the log, sorts it by user and publishes the runs. Windows of several days
are made of stored runs: days follow one another, so a user's sequence is its runs one after the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidepool.functions.dates import shift_day
from tidepool.operators.sequences import PART_EVENTS, user_features, user_sequences
from tidepool.sources import published

RUNS = ("ad_id string, part int, seq array<struct<ts:bigint,item_id:string,behavior_type:int>>, "
        "n_items bigint, dt string")


def day_runs(behaviours: DataFrame, part_events: int = PART_EVENTS) -> DataFrame:
    """``ad_id, part, seq, n_items, dt``: the behaviours of each user and day in time order.

    Long runs are in slices like all sequences.
    """
    runs = user_sequences(behaviours, ["ad_id", "dt"], ["item_id", "behavior_type"], part_events=part_events)
    return runs.select("ad_id", F.col("part").cast("int").alias("part"), "seq", "n_items", "dt")


def store_day(behaviours: DataFrame, path: str, day: str, part_events: int = PART_EVENTS) -> int:
    """Publishes the runs of one day, in place of those it has; reads that day of ``behaviours`` only."""
    return published.publish(day_runs(behaviours.filter(F.col("dt") == day), part_events), path, [day])


def stored_behaviours(spark: SparkSession, path: str, first: str, last: str) -> DataFrame:
    """The behaviours of the days ``first .. last``, from their runs."""
    runs = published.read(spark, path, RUNS, first, last)
    return runs.select("ad_id", "dt", F.inline("seq")).select("ad_id", "item_id", "behavior_type", "ts", "dt")


def merged_runs(spark: SparkSession, path: str, as_of: str, days: int) -> DataFrame:
    """``ad_id, part, seq``: each user's behaviours in the ``days`` before ``as_of``, in time order.

    The runs of a user are put one after the other by day and slice; no event is sorted again, and
    one row a user, day and slice is moved. Runs that together are long stay slices, numbered anew.
    """
    runs = published.read(spark, path, RUNS, shift_day(as_of, -days), shift_day(as_of, -1))
    sizes = runs.groupBy("ad_id").agg(F.sum(F.size("seq")).alias("n"))
    if (sizes.agg(F.max("n")).first()[0] or 0) <= PART_EVENTS:
        joined = F.flatten(F.col("runs.seq"))
        return runs.groupBy("ad_id").agg(F.sort_array(F.collect_list(F.struct("dt", "part", "seq"))).alias("runs")).select(
            "ad_id", F.lit(0).alias("part"), joined.alias("seq"))
    # the slices of a user are few: a million events each
    places = runs.select("ad_id", "dt", "part").groupBy("ad_id").agg(F.sort_array(F.collect_list(F.struct("dt", "part"))).alias("at"))
    numbered = places.select("ad_id", F.posexplode("at").alias("number", "own")).select(
        "ad_id", F.col("own.dt").alias("dt"), F.col("own.part").alias("part"), "number")
    return runs.join(numbered, ["ad_id", "dt", "part"]).select("ad_id", F.col("number").alias("part"), "seq")


def window_features(spark: SparkSession, path: str, items: DataFrame, as_of: str, days: int = 3,
                    part_events: int = PART_EVENTS) -> DataFrame:
    """:func:`~tidepool.operators.sequences.user_features` from stored runs; no log is read."""
    rows = stored_behaviours(spark, path, shift_day(as_of, -days), shift_day(as_of, -1))
    return user_features(rows, items, as_of, days, part_events)
