"""Small tables with awkward rows, and plain ways to compute what the operators return."""

from __future__ import annotations

from pathlib import Path

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


def documents(spark, rows: list[tuple]):
    """Rows of (doc_id, text) as documents."""
    return spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows], DOCUMENTS)


def write_tables(spark, path: Path, docs, labels=None, benchmark=None, conversations=None) -> str:
    """The tables of a query's folder; those not given are empty."""
    docs.write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame(labels or [], LABELS).write.parquet(str(path / "labels.parquet"))
    spark.createDataFrame(benchmark or [], "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    spark.createDataFrame(conversations or [], "conv_id long, turn long, role string, text string") \
        .write.parquet(str(path / "conversations.parquet"))
    return str(path)


def values(df) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)


def whole(spark, sf_dir: str, name: str = "documents") -> list:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()
