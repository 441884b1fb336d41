"""Item lists and their numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidepool.functions.dates import in_window, shift_day
from tidepool.operators.numbering import append_numbers, number_rows

ACTIVE_ITEM_CAP = 20_000


def active_items(
    behaviours: DataFrame, as_of: str, days: int = 10, cap: int = ACTIVE_ITEM_CAP
) -> DataFrame:
    """The ``cap`` items with most behaviours in the ``days`` before ``as_of``, numbered from 1."""
    counts = (
        behaviours.filter(in_window(F.col("dt"), as_of, -days, -1))
        .groupBy("item_id")
        .agg(F.count("item_id").alias("item_num"))
    )
    order = [F.desc("item_num"), F.asc("item_id")]
    kept = counts.orderBy(*order).limit(cap)
    # The window sees the kept rows only: ``cap`` at most.
    return kept.select(
        "item_id",
        "item_num",
        F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("item_no"),
        F.lit(shift_day(as_of, -1)).alias("dt"),
    )


def stable_item_index(previous: DataFrame, today: DataFrame, as_of: str) -> DataFrame:
    """Yesterday's item numbers, with the items new today appended in the order of their ids.

    ``previous`` holds ``item_id, item_no`` and may be empty; ``today`` holds ``item_id``.
    Only the new items are sorted. If yesterday's numbers have gaps, all items are
    numbered anew in the old order, as the numbers must be consecutive.
    """
    old = previous.select("item_id", "item_no")
    state = old.agg(F.count("*").alias("n"), F.coalesce(F.max("item_no"), F.lit(0)).alias("last"))
    n, last = state.first()
    items = today.select("item_id").distinct()
    if n == last:
        fresh = items.join(old, "item_id", "left_anti")
        index = old.unionByName(number_rows(fresh, [F.asc("item_id")], "item_no", start=last + 1))
    else:
        merged = old.withColumnRenamed("item_no", "old_no").join(items, "item_id", "full_outer")
        order = [F.asc_nulls_last("old_no"), F.asc("item_id")]
        index = number_rows(merged, order, "item_no", start=1)
    return index.select("item_id", "item_no", F.lit(shift_day(as_of, -1)).alias("dt"))


def new_item_numbers(known: DataFrame, today: DataFrame) -> DataFrame:
    """``item_id, item_no``: only the items that ``known`` doesn't have, to be appended to it.

    Gives the numbers of :func:`stable_item_index` while those of ``known`` have no gap; what is known is
    neither moved nor written again.
    """
    return append_numbers(known, today, "item_id", "item_no")


def dense_index(df: DataFrame, column: str, name: str, start: int = 0) -> DataFrame:
    """The distinct values of ``column`` with consecutive numbers in sorted order."""
    values = df.select(column).distinct()
    return number_rows(values, [F.asc(column)], name, start)


def zero_based(df: DataFrame, *columns: str) -> DataFrame:
    """Numbers that count from 1 as numbers that count from 0."""
    return df.withColumns({name: F.col(name) - 1 for name in columns})


def is_contiguous(index: DataFrame, name: str, start: int = 0) -> bool:
    """Whether the numbers are ``start, start+1, ...`` without gap or repeat."""
    low, high, n, distinct = index.agg(
        F.min(name), F.max(name), F.count("*"), F.count_distinct(name)
    ).first()
    return n == 0 or (low == start and high == start + n - 1 and distinct == n)
