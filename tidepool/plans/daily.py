"""The reach reports from what daily runs have stored, in place of the logs of their windows.

A run adds its day's new users to the user numbers and publishes the day's users as bitmaps. The reports then read
bitmaps, and of the logs the days whose events they count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidepool.functions.dates import in_window
from tidepool.operators import reach
from tidepool.plans import reports as R
from tidepool.sources import published

SEEN = "dt string, bucket bigint, users binary"
MEASURES = ("sales", "vimp", "pb", "click", "sw")
REACHED = ("dt string, grp string, bucket bigint, users binary, "
           "sales double, vimp bigint, pb bigint, click bigint, sw double")
GROUPS = ("", "_catalogue", "_selected")


def store_users(rows: DataFrame, numbers: DataFrame, path: str, days: Sequence[str] = ()) -> int:
    """Publishes the users of the days of ``rows`` (``ad_id, dt``)."""
    return published.publish(reach.day_users(rows.select("ad_id", "dt"), numbers), path, days)


def stored_users(spark: SparkSession, path: str, first: str, last: str) -> DataFrame:
    return published.read(spark, path, SEEN, first, last)


def event_totals(events: DataFrame, seen: DataFrame, numbers: DataFrame, as_of: str, first: int = -1,
                 names: Sequence[str] = R.ANY_AD) -> DataFrame:
    """Events of the days ``first .. -1`` of the users in the stored bitmaps ``seen``."""
    days = events.filter(in_window(F.col("dt"), as_of, first, -1))
    users = reach.union_users(seen)
    return R.totals(reach.rows_of_users(R.per_item_counts(days), users, numbers), names)


def user_overlap(active: DataFrame, seen: DataFrame) -> DataFrame:
    """How many users of the stored bitmaps ``active`` are also in ``seen``."""
    return reach.count_common(reach.union_users(active), reach.union_users(seen), "users_count")


def day_reach(impressions: DataFrame, extension: DataFrame, creatives: DataFrame, catalogs: Sequence[int],
              numbers: DataFrame) -> DataFrame:
    """``dt, grp, bucket, users`` and sums: users and results of all ads, ads with a catalogue, and ads of the given ones.

    An impression and its extension are of the same day.
    """
    catalog = F.col("merchandise_catalog_id")
    member = F.array(F.lit(""), F.when(catalog.isNotNull(), "_catalogue"), F.when(catalog.isin(*catalogs), "_selected"))
    rows = (
        impressions.select("dt", "ots", "ad_id", "creative_id", (F.col("sales_e6") / F.lit(R.MICROS)).alias("sales"),
                           F.lit(1).alias("vimp"), F.col("postback").alias("pb"), "click")
        .join(R.welfare(extension), "ots")
        .join(creatives.select("creative_id", "merchandise_catalog_id"), "creative_id", "left")
        .withColumn("grp", F.explode(F.array_compact(member)))
    )
    sums = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in MEASURES]
    return reach.day_users(rows, numbers, ("dt", "grp"), sums=sums)


def reach_split(stored: DataFrame) -> DataFrame:
    """The reach report of the stored days (from :func:`day_reach`)."""
    columns = []
    for group in GROUPS:
        own = F.col("grp") == group
        columns.append(F.coalesce(F.sum(F.when(own, F.bitmap_count("users"))), F.lit(0)).alias(f"active{group}_user_count"))
        columns += [F.coalesce(F.sum(F.when(own, F.col(name))), F.lit(0)).alias(f"{name}{group}") for name in MEASURES]
    return stored.groupBy("dt").agg(*columns).orderBy("dt")
