"""Distinct users over sliding windows, from bitmaps stored by day.

Users get dense numbers once and keep them. A day's users are bitmaps of these numbers, one of 4 kB for each
32,768 numbers that have one. The users of any window are the union of its days' bitmaps, exactly, so
a daily run reads its own day of the log and the stored bitmaps, not the log of the window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidepool.functions.dates import in_window
from tidepool.operators.joins import salted_join
from tidepool.operators.numbering import append_numbers

USERS = "bucket bigint, users binary"


def append_users(known: DataFrame, rows: DataFrame, key: str = "ad_id") -> DataFrame:
    """``key, number``: the users of ``rows`` that ``known`` doesn't have, numbered after its last."""
    return append_numbers(known, rows.select(key), key, "number")


def _placed(rows: DataFrame, numbers: DataFrame, key: str) -> DataFrame:
    placed = salted_join(rows, numbers.select(key, "number"), [key])
    return placed.withColumns({"bucket": F.bitmap_bucket_number("number"), "bit": F.bitmap_bit_position("number")})


def day_users(rows: DataFrame, numbers: DataFrame, by: Sequence[str] = ("dt",), key: str = "ad_id",
              sums: Sequence[Column] = ()) -> DataFrame:
    """``by, bucket, users`` and ``sums``: the users of each day (and group), as bitmaps.

    ``sums`` are named aggregates of the rows that add up over buckets. All rows of a user are one bit by the
    time anything is moved, so a user with very many rows costs no more than another.
    """
    return _placed(rows, numbers, key).groupBy(*by, "bucket").agg(
        F.bitmap_construct_agg("bit").alias("users"), *sums)


def union_users(bitmaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by, bucket, users``: the users that are in any of the bitmaps."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("users").alias("users"))


def users_within(bitmaps: DataFrame, as_of: str, first: int, last: int) -> DataFrame:
    """The users of the days ``first .. last`` about ``as_of``; other days are not read."""
    return union_users(bitmaps.filter(in_window(F.col("dt"), as_of, first, last)))


def count_users(users: DataFrame, name: str = "n") -> DataFrame:
    return users.agg(F.coalesce(F.sum(F.bitmap_count("users")), F.lit(0)).alias(name))


def count_common(one: DataFrame, other: DataFrame, name: str = "n") -> DataFrame:
    """How many users are in both: those of each, less those of the union."""
    counted = [df.select(F.bitmap_count("users").alias("n")) for df in (one, other)]
    both = union_users(one.unionByName(other)).select((-F.bitmap_count("users")).alias("n"))
    return counted[0].unionAll(counted[1]).unionAll(both).agg(F.coalesce(F.sum("n"), F.lit(0)).alias(name))


def rows_of_users(rows: DataFrame, users: DataFrame, numbers: DataFrame, key: str = "ad_id") -> DataFrame:
    """The rows whose user is in the bitmaps, by the user's bit."""
    met = _placed(rows, numbers, key).join(users.select("bucket", "users"), "bucket")
    byte = F.conv(F.hex(F.substring("users", (F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = byte.bitwiseAND(F.pow(F.lit(2), F.col("bit") % 8).cast("int")) != 0
    return met.filter(held).select(rows.columns)
