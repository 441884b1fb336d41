"""Tables by day whose changes become visible at once.

The rows of a run are written to a folder of their own first. Then one small file, the next
manifest, says which folder holds each day. A reader takes the last manifest, so it sees all days of a run or
none: a job that fails in between leaves the table as it was. Days without rows are in no manifest.

Layout: ``versions/version=<id>/<by>=<day>/`` and ``manifests/<number>.json``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from tidepool.sources.tables import by_partition


def _store(spark: SparkSession, path: str) -> tuple:
    """The folder and the file system it is in, whichever store that is."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    folder, store = _store(spark, path)
    return [entry.getPath().getName() for entry in store.listStatus(folder)] if store.exists(folder) else []


def manifest(spark: SparkSession, path: str) -> tuple[int, dict[str, str]]:
    """The number of the last manifest (0 if there is none) and the version of each day."""
    numbers = [int(name.removesuffix(".json")) for name in _names(spark, f"{path}/manifests") if name.endswith(".json")]
    if not numbers:
        return 0, {}
    last = max(numbers)
    text = spark.read.text(f"{path}/manifests/{last:09d}.json", wholetext=True).first()["value"]
    return last, json.loads(text)


def _commit(spark: SparkSession, path: str, number: int, days: dict[str, str]) -> None:
    """Makes a manifest visible by a rename."""
    aside, store = _store(spark, f"{path}/manifests/.{uuid.uuid4().hex}")
    out = store.create(aside)
    out.write(bytearray(json.dumps(days, sort_keys=True).encode()))
    out.close()
    final, _ = _store(spark, f"{path}/manifests/{number:09d}.json")
    if store.exists(final) or not store.rename(aside, final):
        store.delete(aside, False)
        raise RuntimeError(f"another run has published manifest {number} of {path}")


def publish(df: DataFrame, path: str, days: Sequence[str] = (), by: str = "dt") -> int:
    """Replaces the days that occur in ``df``, and empties those of ``days`` that don't; all at once.

    Other days stay. Returns the manifest's number. One run at a time may publish to a table: a second one that
    began before the first was done fails, and changes nothing.
    """
    spark = df.sparkSession
    number, held = manifest(spark, path)
    version = uuid.uuid4().hex
    by_partition(df, [by]).write.partitionBy(by).parquet(f"{path}/versions/version={version}")
    made = [name.removeprefix(f"{by}=") for name in _names(spark, f"{path}/versions/version={version}") if name.startswith(f"{by}=")]
    now = {day: old for day, old in held.items() if day not in days} | dict.fromkeys(made, version)
    _commit(spark, path, number + 1, now)
    return number + 1


def read(spark: SparkSession, path: str, schema: T.StructType | str, first: str | None = None,
         last: str | None = None, by: str = "dt") -> DataFrame:
    """The days ``first .. last`` of a published table; the folders of other days are not listed."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    days = {day: version for day, version in manifest(spark, path)[1].items()
            if (first is None or day >= first) and (last is None or day <= last)}
    if not days:
        return spark.createDataFrame([], schema)
    base = f"{path}/versions"
    folders = [f"{base}/version={version}/{by}={day}" for day, version in sorted(days.items())]
    return spark.read.schema(schema).option("basePath", base).parquet(*folders).select(schema.names)


def prune(spark: SparkSession, path: str) -> list[str]:
    """Removes versions that the last manifest has no day of; readers of older ones must be done."""
    kept = {f"version={version}" for version in manifest(spark, path)[1].values()}
    gone = [name for name in _names(spark, f"{path}/versions") if name not in kept]
    for name in gone:
        folder, store = _store(spark, f"{path}/versions/{name}")
        store.delete(folder, True)
    return sorted(gone)
