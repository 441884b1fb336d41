"""The folder all executors share, and the lineage cuts written to it."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Applications whose folder was seen from the executors.
_seen: set[str] = set()


def _check_seen(spark: SparkSession, folder: str) -> None:
    """Fails if a folder of the driver's own file system isn't there for tasks on a cluster; looked at once."""
    sc = spark.sparkContext
    if sc.applicationId in _seen or sc.master.startswith("local[") or sc.master == "local" or not folder.startswith("file:"):
        return
    path, tasks = "/" + folder.removeprefix("file:").lstrip("/"), max(2, sc.defaultParallelism)
    # a file made now: an old folder of the same name on another machine doesn't have it
    name = f"{path}/seen-{uuid.uuid4().hex}"
    with open(name, "w"):
        pass
    seen = spark.range(0, tasks, 1, tasks).rdd.map(lambda _: os.path.exists(name)).collect()
    os.remove(name)
    if not all(seen):
        raise ValueError(f"spark.checkpoint.dir ({folder}) isn't shared by all executors")
    _seen.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, as every executor sees it.

    Only a local session may go without the setting; it then gets a folder of its own. Spark
    makes a folder for the session in it, which goes when the session's JVM ends. On a cluster a folder
    of a file system that executors would see another of is refused.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
            configured = tempfile.mkdtemp(prefix="tidepool-")
        sc.setCheckpointDir(configured)
    folder = sc._jvm.org.apache.hadoop.fs.Path(sc.getCheckpointDir())
    folder.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(folder)
    _check_seen(spark, sc.getCheckpointDir())
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and read it back from the shared folder, partition by partition.

    What follows reads stored rows, so a lost executor neither repeats the work
    before the cut nor moves a row to another partition.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
