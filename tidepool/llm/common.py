"""Table access, names and samples that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name beginning with ``name`` that ``df`` doesn't have in any case."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_bucket(id_col: str, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``; NULL for a NULL id."""
    return F.crc32(F.col(id_col).cast("string")) % buckets


def in_bucket(id_col: str, buckets: int, bucket: int) -> Column:
    return F.coalesce(id_bucket(id_col, buckets) == bucket, F.lit(False))


def one_label(labels: DataFrame, label: str, id_col: str = "doc_id") -> DataFrame:
    """(id, label) of each id with label 0 or 1; ids that are NULL or have both are left out."""
    return (labels.select(F.col(id_col).alias("id"), F.col(label).alias("label"))
            .where("id is not null and label in (0, 1)").groupBy("id")
            .agg(F.min("label").cast("int").alias("label"), F.max("label").alias("other"))
            .where("label = other").drop("other"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, label) of at most ``per_class`` labelled documents of each class 0 and 1.

    The documents are those with the smallest hash of their id, so the sample is the same on
    every run. Ids with a NULL label or with both labels are left out, and so are NULL ids.
    The chosen ids are few by construction and go to every task; no text is shuffled.
    """
    one = one_label(labels, label, id_col)
    chosen = [one.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(per_class)
              for k in (0, 1)]
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(chosen[0].unionAll(chosen[1])), "id").select("id", "text", "label")


def class_counts(labels: DataFrame, label: str) -> tuple[int, int]:
    """How many rows have label 0 and label 1."""
    row = labels.agg(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)).first()
    return row[0], row[1]
