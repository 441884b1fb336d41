"""Runs jobs next to their SQL on the same tables and compares the rows.

``python -m tests.compare <dir> [name ...]`` prints one line per job.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of(columns: list[str], rows: list[tuple]) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(row[i] for i in order) for row in rows)


def difference(spark, con, sf_dir: str, job, sql: str) -> str | None:
    """What differs, or None."""
    df = job(spark, sf_dir)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    theirs = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} / {theirs[0]}"
    if mine[1] == theirs[1]:
        return None
    only, other = mine[1] - theirs[1], theirs[1] - mine[1]
    return (f"rows {sum(mine[1].values())} / {sum(theirs[1].values())}; "
            f"only here {sum(only.values())} {list(only)[:2]}; "
            f"only there {sum(other.values())} {list(other)[:2]}")


def main(sf_dir: str, names: list[str]) -> None:
    from __spark_entry__ import oracle_sql, queries

    spark, con = session(), database(sf_dir)
    jobs, sql = queries(), oracle_sql()
    for name in names or jobs:
        began = time.time()
        try:
            if name in sql:
                found = difference(spark, con, sf_dir, jobs[name], sql[name])
                n = len(con.execute(sql[name]).fetchall())
                status = f"ok {n} rows" if found is None else f"DIFFERS {found}"
            else:
                status = f"no sql, {len(jobs[name](spark, sf_dir).collect())} rows"
        except Exception as error:  # a broken job must not hide the others
            status = f"FAILED {type(error).__name__} {str(error)[:600]}"
        print(f"{name:28s} {time.time() - began:6.1f}s  {status}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
