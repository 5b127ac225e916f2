import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from barlake.functions import to_bars
from barlake.operators import (
    append_bars,
    create_bar_table,
    loaded_months,
    merge_into,
    month_exists,
    month_range,
    month_status,
    sorted_by_month,
    with_month,
)
from barlake.schema import BAR_COLUMNS
from conftest import at, bars, ms, raw_frame


def some_bars(spark, *rows):
    return to_bars(raw_frame(spark, [("A", "2023", "01", t, c) for t, c in rows]))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_append_is_by_name_and_by_month_of_the_row(spark, make_table):
    table = make_table()
    rows = some_bars(spark, ("2023-01-31 23:59", 1.0), ("2023-02-01 00:00", 2.0))
    append_bars(spark, table, rows.select(*reversed(rows.columns)))
    append_bars(spark, table, some_bars(spark, ("2023-01-01 00:00", 3.0)))
    assert spark.table(table).columns == [*BAR_COLUMNS, "event_month"]
    assert bars(spark.table(table)) == [
        (at("2023-01-01"), 3.0), (at("2023-01-31 23:59"), 1.0), (at("2023-02-01"), 2.0)
    ]
    assert {str(r[0]) for r in loaded_months(spark, table).collect()} == {"2023-01-01", "2023-02-01"}


def test_month_bounds_of_a_range(spark, make_table):
    table = make_table()
    edges = ["2022-11-30 23:59:59.999", "2022-12-01 00:00", "2022-12-31 23:59:59.999", "2023-01-01 00:00"]
    append_bars(spark, table, some_bars(spark, *((t, float(i)) for i, t in enumerate(edges))))
    assert [c for _, c in bars(month_range(spark.table(table), 2022, "12"))] == [1.0, 2.0]


def test_month_range_prunes_partitions_and_pushes_the_time(spark, make_table):
    table = make_table()
    append_bars(spark, table, some_bars(spark, ("2023-01-01 00:00", 1.0), ("2023-02-01 00:00", 2.0)))
    january = month_range(spark.table(table), 2023, 1).select("close")
    plan = plan_of(january)
    assert "PartitionFilters: [isnotnull(event_month" in plan
    assert "GreaterThanOrEqual(event_time" in plan and "LessThan(event_time" in plan
    assert "ReadSchema: struct<close:double,event_time:timestamp>" in plan
    assert len(january.inputFiles()) <= 2


def test_exists_and_status(spark, make_table):
    table = make_table(with_symbol=True)
    assert not month_exists(spark, table, 2023, 1)
    append_bars(spark, table, some_bars(spark, ("2024-02-29 00:00", 1.0)))
    assert month_exists(spark, table, "2024", "02")
    assert month_exists(spark, table, "2024", "02", "A")
    assert not month_exists(spark, table, "2024", "02", "B")
    asked = spark.createDataFrame([(dt.date(2024, m, 1),) for m in (1, 2, 3)], "event_month date")
    assert {(r[0].month, r[1]) for r in month_status(spark, table, asked).collect()} == {
        (1, "MISSING"), (2, "EXISTS"), (3, "MISSING")
    }


def test_existence_starts_one_task_when_the_first_has_a_row(spark, make_table):
    table = make_table()
    for day in range(1, 7):
        append_bars(spark, table, some_bars(spark, (f"2023-01-0{day} 00:00", 1.0)))
    assert spark.table(table).rdd.getNumPartitions() > 2
    spark.sparkContext.setJobGroup("existence", "")
    try:
        assert month_exists(spark, table, 2023, 1)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup("existence") for s in tracker.getJobInfo(job).stageIds]
    assert sum(tracker.getStageInfo(s).numTasks for s in stages) == 1


def test_missing_table_is_an_error(spark):
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        month_exists(spark, "bars_test.none", 2023, 1)


def test_overwrite_keeps_other_months_in_any_session(spark, make_table):
    table = make_table()
    append_bars(spark, table, some_bars(spark, ("2023-01-01 00:00", 1.0), ("2023-02-01 00:00", 2.0)))
    again = with_month(some_bars(spark, ("2023-02-01 00:00", 9.0))).select(*spark.table(table).columns)
    again.write.mode("overwrite").insertInto(table)
    assert [c for _, c in bars(spark.table(table))] == [1.0, 9.0]


def test_a_known_location_can_be_registered_again(spark, make_table, tmp_path):
    table = make_table()
    append_bars(spark, table, some_bars(spark, ("2023-01-01 00:00", 1.0)))
    create_bar_table(spark, f"{table}_again", str(tmp_path / table))
    assert bars(spark.table(f"{table}_again")) == bars(spark.table(table))


def many_bars(spark, n):
    """Two thirds of the bars in one month."""
    skewed = F.when(F.col("id") % 3 < 2, F.col("id") % 44_640).otherwise(44_640 + F.col("id"))
    rows = spark.range(n).select((F.lit(ms("2023-01-01")) + skewed * 60_000).alias("open_time_ms"))
    values = {c: F.col("open_time_ms").cast("double") for c in BAR_COLUMNS[:-1]}
    return to_bars(rows.withColumns(values))


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_a_hot_month_is_split_and_every_file_is_sorted(spark, make_table, adaptive):
    table = make_table()
    small = {
        "spark.sql.adaptive.enabled": adaptive,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        append_bars(spark, table, many_bars(spark, 60_000).repartition(8))
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    files = spark.table(table).filter("event_month = date'2023-01-01'").inputFiles()
    assert len(files) > 1
    for file in files:
        times = [r[0] for r in spark.read.parquet(file).select("event_time").collect()]
        assert times == sorted(times)
    assert spark.table(table).count() == 60_000


def test_writing_does_not_pass_through_one_task(spark, make_table):
    rows = with_month(some_bars(spark, ("2023-01-01 00:00", 1.0)))
    plan = plan_of(sorted_by_month(rows))
    assert "SinglePartition" not in plan and "hashpartitioning(event_month" in plan
    assert plan.count("Exchange") == 1


def test_namespace_is_created_with_the_table(spark, make_table):
    make_table()
    assert "bars_test" in {r[0] for r in spark.sql("SHOW NAMESPACES").collect()}


@pytest.mark.parametrize("write", [append_bars, merge_into])
def test_files_carry_the_range_of_their_times(spark, make_table, write):
    table, key = make_table(), "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(key)
    write(spark, table, some_bars(spark, ("2023-01-01 00:00", 1.0), ("2023-01-02 00:00", 2.0)))
    assert spark.conf.get(key) == before
    (file,) = spark.table(table).inputFiles()
    stored = pq.ParquetFile(file.removeprefix("file://"))
    group = stored.metadata.row_group(0)
    (times,) = [group.column(i) for i in range(group.num_columns) if group.column(i).path_in_schema == "event_time"]
    assert times.physical_type == "INT64"
    assert (times.statistics.min.day, times.statistics.max.day) == (1, 2)
