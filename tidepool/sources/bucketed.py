"""Tables stored by a hash of their key, so that joins and groups on the key move no row."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidepool.operators.joins import HOT_ROWS, SALTS, hot_hashes, salted_join


def _table(spark: SparkSession, path: str, ddl: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """The bucketed files at ``path`` as a frame that knows its buckets."""
    name, by = f"bucketed_{uuid.uuid4().hex}", ", ".join(f"`{k}`" for k in keys)
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
              f"INTO {buckets} BUCKETS LOCATION '{place}'")
    found = spark.table(name)
    found.schema  # read before the name goes; the files stay
    spark.sql(f"DROP TABLE {name}")
    return found


@dataclass(frozen=True)
class Bucketed:
    """A stored table: rows in buckets by key, and apart from them the rows of very frequent keys."""

    rows: DataFrame
    hot: DataFrame
    keys: tuple[str, ...]
    #: hashes of the frequent keys, fewer than the salts of a join
    hot_hashes: tuple[int, ...]

    def all_rows(self) -> DataFrame:
        return self.rows.unionByName(self.hot)


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int,
                   hot_rows: int = HOT_ROWS, salts: int = SALTS) -> Bucketed:
    """Stores ``df`` in ``buckets`` buckets by ``keys``, sorted within each; one file a bucket.

    Keys with more than ``hot_rows`` rows and more than 1/``salts`` of all would make one bucket much longer
    than the others. Their rows are stored apart, in files of any task.
    """
    spark = df.sparkSession
    hashes = hot_hashes(df, keys, hot_rows, salts)
    is_hot = F.xxhash64(*keys).isin(hashes) if hashes else F.lit(False)
    name = f"bucketed_{uuid.uuid4().hex}"
    ordinary = df.filter(~is_hot).repartition(buckets, *keys)
    ordinary.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", f"{path}/rows").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")
    df.filter(is_hot).write.parquet(f"{path}/hot")
    return read_bucketed(spark, path, df.schema.toDDL(), keys, buckets, hashes)


def read_bucketed(spark: SparkSession, path: str, ddl: str, keys: Sequence[str], buckets: int,
                  hashes: Sequence[int] = ()) -> Bucketed:
    return Bucketed(_table(spark, f"{path}/rows", ddl, keys, buckets), spark.read.schema(ddl).parquet(f"{path}/hot"),
                    tuple(keys), tuple(hashes))


def join_stored(left: Bucketed, right: Bucketed, condition: Column | None = None) -> DataFrame:
    """Inner join of two tables stored by the same keys and number of buckets.

    Bucket meets bucket without a shuffle. Only the rows of keys that are frequent on a side are moved, spread
    by salts. ``condition`` may ask for more, by the names of the columns: the right
    side's others than the keys must differ from the left side's.
    """
    keys = list(left.keys)

    def met(a: DataFrame, b: DataFrame) -> DataFrame:
        return a.join(b, keys)

    hashes = sorted({*left.hot_hashes, *right.hot_hashes})
    if hashes:
        hot = F.xxhash64(*keys).isin(hashes)
        found = met(left.rows.filter(~hot), right.rows.filter(~hot)).unionByName(
            salted_join(left.all_rows().filter(hot), right.all_rows().filter(hot), keys))
    else:
        found = met(left.rows, right.rows)
    return found if condition is None else found.filter(condition)


def latest_stored(table: Bucketed, order: str, value: str) -> DataFrame:
    """:func:`~tidepool.operators.joins.latest_per_key` of a stored table; only frequent keys are moved."""
    last = F.max(F.struct(order, value)).alias("last")
    keys = list(table.keys)
    parts = [rows.groupBy(*keys).agg(last) for rows in (table.rows, table.hot)]
    return parts[0].unionByName(parts[1]).select(
        *keys, F.col(f"last.{value}").alias(value), F.col(f"last.{order}").alias(order))
