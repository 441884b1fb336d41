from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidepool import schemas
from tidepool.shared import scratch_path
from tidepool.sources import scripts, tables


def rows(df):
    return sorted(map(str, df.collect()))


def days(spark, *named):
    return spark.createDataFrame([(n, d) for n, d in named], "n int, dt string")


def test_replacing_a_day_leaves_the_others(spark):
    path = scratch_path(spark, "t")
    tables.create_as(days(spark, (1, "2024-01-01"), (2, "2024-01-02")), path, ["dt"])
    for _ in range(2):
        tables.replace_partitions(days(spark, (3, "2024-01-02"), (4, "2024-01-03")), path)
    table = spark.read.schema("n int, dt string").parquet(path)
    assert rows(table) == rows(days(spark, (1, "2024-01-01"), (3, "2024-01-02"), (4, "2024-01-03")))
    with pytest.raises(Exception):
        tables.create_as(days(spark, (1, "2024-01-01")), path, ["dt"])


def test_a_day_run_without_rows_is_emptied(spark):
    path = scratch_path(spark, "t")
    tables.create_as(days(spark, (1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03")), path, ["dt"])
    tables.replace_partitions(days(spark, (4, "2024-01-02")), path, days=["2024-01-01", "2024-01-02", "2024-01-09"])
    table = spark.read.schema("n int, dt string").parquet(path)
    assert rows(table) == rows(days(spark, (4, "2024-01-02"), (3, "2024-01-03")))


def test_a_failed_run_empties_no_day(spark):
    path = scratch_path(spark, "t")
    before = days(spark, (1, "2024-01-01"), (2, "2024-01-02"))
    tables.create_as(before, path, ["dt"])
    bad = days(spark, (3, "2024-01-02")).withColumn("n", F.when(F.col("n") > 0, F.raise_error(F.lit("lost")).cast("int")))
    with pytest.raises(Exception, match="lost"):
        tables.replace_partitions(bad, path, days=["2024-01-01", "2024-01-02"])
    assert rows(spark.read.schema("n int, dt string").parquet(path)) == rows(before)


def test_exports_and_examples_leave_other_days(spark):
    path, examples = scratch_path(spark, "e"), scratch_path(spark, "x")
    first = days(spark, (1, "2024-01-01"), (2, "2024-01-02"))
    again = days(spark, (5, "2024-01-02"), (6, "2024-01-03"))
    for part, last in ((first, "2024-01-02"), (again, "2024-01-03")):
        tables.export_by_day(part, path, "2024-01-01", last)
        tables.write_examples(part, examples, ["dt"])
    expected = rows(days(spark, (1, "2024-01-01"), (5, "2024-01-02"), (6, "2024-01-03")))
    assert rows(tables.read_delimited(spark, path, "n int, dt string", by=["dt"])) == expected
    assert rows(tables.read_examples(spark, examples, "n int, dt string")) == expected


def test_dirty_text_becomes_null(spark):
    path = scratch_path(spark, "d")
    tables.write_delimited(spark.createDataFrame([("x", "1"), ("2", "y")], "a string, b string"), path)
    assert rows(tables.read_delimited(spark, path, "a int, b int")) == rows(
        spark.createDataFrame([(None, 1), (2, None)], "a int, b int"))


def test_scan_reads_only_the_days_asked_for(spark):
    path = scratch_path(spark, "t")
    tables.create_as(days(spark, *[(n, f"2024-01-{n:02d}") for n in range(1, 10)]), path, ["dt"])
    scan = tables.scan_range(spark, path, "n int, dt string", "2024-01-03", "2024-01-05")
    assert sorted(r.n for r in scan.collect()) == [3, 4, 5]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_missing_table_is_made_empty_and_kept(spark):
    path = scratch_path(spark, "t")
    tables.ensure_dataset(spark, path, schemas.ACTIVE_ITEMS, ["dt"])
    assert spark.read.schema(schemas.ACTIVE_ITEMS).parquet(path).count() == 0
    one = spark.createDataFrame([("a", 1, 1, "2024-01-01")], schemas.ACTIVE_ITEMS)
    tables.replace_partitions(one, path)
    tables.ensure_dataset(spark, path, schemas.ACTIVE_ITEMS, ["dt"])
    assert rows(spark.read.schema(schemas.ACTIVE_ITEMS).parquet(path)) == rows(one)


@pytest.mark.parametrize("sep", ["\u0001", "\t"])
def test_delimited_text_keeps_nulls_quotes_and_spaces(spark, sep):
    data = spark.createDataFrame(
        [("a", 1, '{"k": "v, w"}'), (" b ", None, None), ("", 2, "back\\slash"), ('q"', 3, '"x"')],
        "s string, n int, j string")
    path = scratch_path(spark, "d")
    tables.write_delimited(data, path, sep)
    assert rows(tables.read_delimited(spark, path, data.schema, sep)) == rows(data)
    tables.write_delimited(data, path, sep)
    assert tables.read_delimited(spark, path, data.schema, sep).count() == 8


def test_export_skips_days_without_rows(spark):
    path = scratch_path(spark, "e")
    table = days(spark, (1, "2024-01-01"), (2, "2024-01-03"), (3, "2024-01-09"))
    tables.export_by_day(table, path, "2024-01-01", "2024-01-05")
    exported = tables.read_delimited(spark, path, "n int, dt string", by=["dt"])
    assert sorted(r.n for r in exported.collect()) == [1, 2]
    files = exported.inputFiles()
    assert len(files) == 2 and not any("2024-01-02" in f for f in files)


def test_shards_do_not_depend_on_the_run(spark):
    def shards(df):
        return {r.id: r.p for r in tables.redistribute(df, 6, ["id"]).select(
            "id", F.spark_partition_id().alias("p")).collect()}

    assert shards(spark.range(300)) == shards(spark.range(300).repartition(9))
    assert len(set(shards(spark.range(300)).values())) == 6


def test_script_statements_and_values(spark):
    text = "SELECT '${a}' AS a;\n-- next --\nSELECT ${n} + 1 AS n, '${a}' AS a\n;\n"
    first, second = scripts.run_statements(spark, text, {"a": "x' OR '1'='1", "n": 4})
    assert first.first().a == "x' OR '1'='1"
    assert tuple(second.first()) == (5, "x' OR '1'='1")
    with pytest.raises(KeyError):
        scripts.run_statements(spark, "SELECT ${missing}", {})
    with pytest.raises(ValueError):
        scripts.run_statements(spark, " ;\n-- next --\n", {})
