"""Day-partitioned tables and delimited files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

FIELD_SEP = "\u0001"  # fixed value: the separator of the delimited files
NULL_MARK = "\\N"  # fixed value: the text that stands for NULL in them


def scan_range(
    spark: SparkSession, path: str, schema: T.StructType | str, dt_from: str, dt_to: str
) -> DataFrame:
    """The days ``dt_from .. dt_to`` of a table partitioned by ``dt``; other days are not read.

    The schema keeps ``dt`` a string, where Spark would guess a date.
    """
    table = spark.read.schema(schema).parquet(path)
    return table.filter(F.col("dt").between(dt_from, dt_to))


def scan_dimension(df: DataFrame, column: str, ids: Sequence) -> DataFrame:
    return df.filter(F.col(column).isin(*ids))


def by_partition(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of one output partition together, large ones split over several tasks and files."""
    return df.hint("rebalance", *[F.col(c) for c in by]) if by else df


def create_as(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """Writes a new table; an existing one is an error."""
    by_partition(df, by).write.mode("errorifexists").partitionBy(*by).parquet(path)


def _drop_days(spark: SparkSession, path: str, days: Sequence[str], by: str) -> None:
    """Removes the folders of these days, whichever store the table is in."""
    jvm = spark.sparkContext._jvm
    for day in days:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{by}={day}")
        store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if store.exists(folder):
            store.delete(folder, True)


def replace_partitions(
    df: DataFrame, path: str, by: Sequence[str] = ("dt",), days: Sequence[str] = ()
) -> None:
    """Replaces the partitions that occur in ``df`` in one commit, and leaves the others.

    ``days`` names the days (values of the first partition column) that are run: those
    without a row in ``df`` are emptied, after the others are written. They are few, so what is asked of ``df`` is
    which of them it has. Where both must be seen at once, publish the days (:mod:`tidepool.sources.published`).
    """
    held = {row[0] for row in df.filter(F.col(by[0]).isin(*days)).select(by[0]).distinct().collect()} if days else set()
    (
        by_partition(df, by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )
    _drop_days(df.sparkSession, path, sorted(set(days) - held), by[0])


def ensure_dataset(
    spark: SparkSession, path: str, schema: T.StructType | str, by: Sequence[str] = ()
) -> None:
    """An empty table with this schema if there is none at ``path``."""
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy(*by).parquet(path)


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    sep: str = FIELD_SEP,
    null: str = NULL_MARK,
    by: Sequence[str] = (),
) -> DataFrame:
    """Delimited text without header or quoting; columns by position, ``by`` from the folders.

    Lines are split here, as the CSV reader cannot tell empty text from NULL without quotes.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    folders = [T.StructField(name, T.StringType()) for name in by]
    lines = spark.read.schema(T.StructType([T.StructField("value", T.StringType()), *folders])).text(
        path
    )
    pieces = F.split("value", f"\\Q{sep}\\E", -1)
    fields = [field for field in schema if field.name not in by]

    def column(place: int, field: T.StructField) -> Column:
        text = F.get(pieces, place)
        # text that is no value of the type becomes NULL, as in the tables it comes from
        return F.when(text != null, text).try_cast(field.dataType).alias(field.name)

    columns = {field.name: column(place, field) for place, field in enumerate(fields)}
    return lines.select(*[columns.get(name, F.col(name)) for name in schema.names])


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str = FIELD_SEP,
    mode: str = "append",
    null: str = NULL_MARK,
    by: Sequence[str] = (),
    days_only: bool = False,
) -> None:
    """``days_only``: mode ``overwrite`` replaces the folders that ``df`` has rows for, no others."""
    writer = df.write.mode(mode)
    if days_only:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if by:
        writer = writer.partitionBy(*by)
    writer.csv(path, sep=sep, header=False, nullValue=null, emptyValue="", quote="",
               escape="\u0000", escapeQuotes=False,
               ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def export_by_day(
    df: DataFrame, path: str, dt_from: str, dt_to: str, sep: str = FIELD_SEP
) -> None:
    """The days of the range as delimited text, a folder per day that has rows.

    Days exported before stay, unless they are exported again. A day of ordinary size is one file; a large one is split, as no single task
    should write a whole large day.
    """
    days = df.filter(F.col("dt").between(dt_from, dt_to))
    write_delimited(by_partition(days, ["dt"]), path, sep, mode="overwrite", by=["dt"], days_only=True)


def redistribute(df: DataFrame, n: int, key: Sequence[str]) -> DataFrame:
    """Rows dealt into ``n`` shards by a hash of the key: the same shards on every run."""
    return df.repartition(n, F.xxhash64(*key))


def write_examples(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """Typed examples with their lists as array columns.

    With ``by`` the partitions that occur in ``df`` are replaced and the others stay.
    """
    if by:
        replace_partitions(df, path, by)
    else:
        df.write.mode("overwrite").parquet(path)


def read_examples(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    partition_column: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A query against an outside database, read in ranges of ``partition_column``."""
    return spark.read.jdbc(
        url, f"({query}) q", column=partition_column, lowerBound=lower, upperBound=upper,
        numPartitions=partitions, properties=properties,
    )
