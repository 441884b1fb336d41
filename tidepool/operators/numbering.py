"""Consecutive numbers and running totals over a whole table, without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidepool.shared import cut_lineage

# Narrow values that are sent to where the known ones lie: a few megabytes.
SENT_VALUES = 100_000
_ROW_BITS = 33  # monotonically_increasing_id keeps the row's place in its partition in these bits


def _ranged(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` in order over stored partitions, with partition ``_slice`` and place ``_place``."""
    stored = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order))
    position = F.monotonically_increasing_id()
    return stored.withColumns({
        "_slice": F.shiftright(position, _ROW_BITS),
        "_place": position.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
    })


def _with_offsets(placed: DataFrame, size: Column) -> DataFrame:
    """Adds ``_before``: the total of ``size`` over the partitions before the row's own."""
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_slice").agg(size.alias("_size")).select(
        "_slice", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before")
    )
    # One row per partition of the table, whatever the table's size.
    return placed.join(F.broadcast(offsets), "_slice")


def number_rows(df: DataFrame, order: Sequence[Column], name: str, start: int = 0) -> DataFrame:
    """Adds ``name``: ``start, start+1, ...`` in the given order, which should be unique."""
    placed = _with_offsets(_ranged(df, order), F.count("*"))
    number = F.col("_before") + F.col("_place") + F.lit(start)
    return placed.withColumn(name, number.cast("bigint")).select(*df.columns, name)


def running_total(df: DataFrame, order: Sequence[Column], value: str, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over all rows before this one in the given order."""
    placed = _with_offsets(_ranged(df, order), F.sum(value))
    before = (
        Window.partitionBy("_slice").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    )
    total = F.col("_before") + F.coalesce(F.sum(value).over(before), F.lit(0))
    return placed.withColumn(name, total).select(*df.columns, name)


def append_numbers(known: DataFrame, values: DataFrame, key: str, name: str, start: int = 1) -> DataFrame:
    """``key, name``: numbers for the values that ``known`` doesn't have, after its last, in sorted order.

    What is known is neither sorted nor moved: the new run's values are looked for in it where it lies. Stored by
    ``key`` (see :mod:`tidepool.sources.bucketed`) it meets the values bucket by bucket; otherwise the values are
    sent to it if they are few, and only beyond that both sides are shuffled. NULL gets no number.
    """
    last = known.agg(F.max(name)).first()[0]
    asked = cut_lineage(values.select(key).filter(F.col(key).isNotNull()).distinct())
    if asked.limit(SENT_VALUES + 1).count() <= SENT_VALUES:
        met = known.select(key).join(F.broadcast(asked), key, "left_semi")
    else:
        met = asked.join(known.select(key), key, "left_semi")
    return number_rows(asked.join(cut_lineage(met), key, "left_anti"), [F.asc(key)], name, start if last is None else last + 1)
