"""Joins whose left side may hold a few very frequent keys, and lookups by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidepool.functions.dates import next_day

# A key below this many rows fits one task and needs no salt.
HOT_ROWS = 1_000_000
# Tasks that the rows of one frequent key are spread over. A key with a smaller share of all
# rows than one of so many tasks has is no longer than they are.
SALTS = 256
# A list of this many narrow rows is a few megabytes.
SHORT_ROWS = 100_000


def hot_hashes(
    df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, salts: int = SALTS
) -> list[int]:
    """Hashes of the keys with more than ``hot_rows`` rows and more than 1/``salts`` of all rows.

    There are fewer than ``salts`` of them by arithmetic, so the limit cuts nothing off.
    """
    frequent = (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") > hot_rows)
        .select("n", F.xxhash64(*keys).alias("h"))
        .orderBy(F.desc("n"), "h")
        .limit(salts)
    ).collect()
    if not frequent:
        return []
    total = df.select(*keys).count()
    return sorted({row.h for row in frequent if row.n * salts > total})


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
    salt_by: Sequence[str] | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Equi-join that spreads the left rows of frequent keys over ``salts`` tasks.

    The right rows of those keys are repeated once per salt, so every left row
    still meets all its partners once. Without frequent keys it is a plain join.
    ``salt_by`` names the left columns that choose the salt (default: all of them). ``counted`` are
    rows whose keys are as frequent as the left ones, if those cost more to count.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"no salted join of kind {how}")
    keys = list(keys)
    for key in keys:
        if left.schema[key].dataType != right.schema[key].dataType:
            raise TypeError(f"key {key} has different types on the two sides")
    hot = hot_hashes(left if counted is None else counted, keys, hot_rows, salts)
    if not hot:
        return left.join(right, keys, how)

    spread = F.pmod(F.xxhash64(*(salt_by or left.columns)), F.lit(salts)).cast("int")
    is_hot = F.xxhash64(*keys).isin(hot)
    salted_left = left.withColumn("_salt", F.when(is_hot, spread).otherwise(F.lit(0)))
    repeats = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_right = right.withColumn("_salt", F.explode(repeats))
    return salted_left.join(salted_right, keys + ["_salt"], how).drop("_salt")


def join_short(
    df: DataFrame, short: DataFrame, keys: Sequence[str], max_rows: int = SHORT_ROWS
) -> DataFrame:
    """Inner join with a list of narrow rows that is sent to every task if it is short.

    Its length is counted first, no further than ``max_rows``; a longer one is joined
    through a salted shuffle.
    """
    if short.limit(max_rows + 1).count() <= max_rows:
        return df.join(F.broadcast(short), list(keys))
    return salted_join(df, short, keys)


def keep_known(df: DataFrame, ids: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The rows of ``df`` whose key occurs in ``ids``."""
    known = ids.select(key).distinct()
    return salted_join(df, known, [key], "left_semi", hot_rows)


def left_join_where(left: DataFrame, right: DataFrame, key: str, condition: Column) -> DataFrame:
    """Left join in which only left rows meeting ``condition`` may find a partner.

    ``condition`` reads left columns only. Rows that fail it lose their join key,
    and come out with NULLs from the right side.
    """
    probe = left.withColumn("_probe", F.when(condition, F.col(key)))
    partners = right.withColumnRenamed(key, "_probe")
    return salted_join(probe, partners, ["_probe"], "left", salt_by=left.columns).drop("_probe")


def join_next_day(labels: DataFrame, features: DataFrame, key: str = "ad_id") -> DataFrame:
    """Each label row of a day with the features its key had the day before."""
    following = features.withColumn("dt", next_day(F.col("dt")))
    return salted_join(labels, following, [key, "dt"])


def latest_per_key(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """The value seen last for every key; of equally late ones the largest."""
    return df.groupBy(key).agg(F.max(F.struct(order, value)).alias("last")).select(
        key, F.col(f"last.{value}").alias(value), F.col(f"last.{order}").alias(order)
    )
