"""Loads that are published whole or not at all, and what an ingest counts."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tripflow.operators.cleaning import clean_trips
from tripflow.plans.ingest import ingest_report
from tripflow.plans.weather import load_weather
from tripflow.sinks.publish import publish_partitions, publish_table, published, remove_unpublished
from tripflow.sinks.writers import publish_if_rows
from tripflow.sources.trip_files import file_report, read_trip_files

FAILS = "IF(n = 3, raise_error('broken'), n) AS n"


def _loads(root):
    return sorted(os.listdir(root)) if os.path.exists(root) else []


def test_a_table_is_replaced_in_one_step(spark, tmp_dir):
    df = spark.range(5).withColumnRenamed("id", "n")
    assert publish_table(df, "pub_a", tmp_dir) == 5
    before = spark.table("pub_a")
    assert publish_table(df.where("n < 2"), "pub_a", tmp_dir) == 2
    assert spark.table("pub_a").count() == 2 and before.count() == 5  # a reader keeps the rows it began with
    # a load that fails, and one without rows, leave the table and no folder
    with pytest.raises(Exception, match="broken"):
        publish_table(df.selectExpr(FAILS), "pub_a", tmp_dir)
    assert publish_table(df.where("n > 100"), "pub_a", tmp_dir) == 0
    with pytest.raises(ValueError, match="columns"):
        publish_table(df.withColumn("more", F.lit(1)), "pub_a", tmp_dir)
    assert spark.table("pub_a").count() == 2 and len(_loads(tmp_dir)) == 2
    assert remove_unpublished(spark, "pub_a", tmp_dir) == []  # too young
    assert len(remove_unpublished(spark, "pub_a", tmp_dir, older_than=-1)) == 1
    assert spark.table("pub_a").count() == 2 and published(spark, "pub_a")[0].endswith(_loads(tmp_dir)[0])


def test_partitions_are_replaced_one_by_one(spark, tmp_dir):
    rows = [(1, "2015_01"), (2, "2015_01"), (3, "2015_02"), (4, None), (5, "a'b/c=d %")]
    df = spark.createDataFrame(rows, "n int, year_month string")
    assert publish_partitions(df, "pub_b", tmp_dir) == 5
    read = lambda: sorted((r.n, r.year_month) for r in spark.table("pub_b").collect())
    assert read() == rows
    before = spark.table("pub_b").where("year_month = '2015_01'")
    before._jdf.queryExecution().executedPlan()  # a reader that has begun
    again = spark.createDataFrame([(7, "2015_01"), (8, "2015_03"), (9, "a'b/c=d %"), (10, None)], df.schema)
    assert publish_partitions(again, "pub_b", tmp_dir) == 4
    assert read() == [(3, "2015_02"), (7, "2015_01"), (8, "2015_03"), (9, "a'b/c=d %"), (10, None)]
    assert sorted(r.n for r in before.collect()) == [1, 2]
    assert publish_partitions(df.where("n > 100"), "pub_b", tmp_dir) == 0
    with pytest.raises(Exception, match="broken"):
        publish_partitions(df.selectExpr(FAILS, "year_month"), "pub_b", tmp_dir)
    assert len(read()) == 5 and len(_loads(tmp_dir)) == 2
    assert remove_unpublished(spark, "pub_b", tmp_dir, older_than=-1) == []  # February is still in the first load
    publish_partitions(spark.createDataFrame([(3, "2015_02")], df.schema), "pub_b", tmp_dir)
    assert len(remove_unpublished(spark, "pub_b", tmp_dir, older_than=-1)) == 1 and len(read()) == 5


@pytest.mark.parametrize("least,rows", [(0, 100), (1000, 0)])
def test_a_staged_write_reads_its_input_once(spark, tmp_dir, least, rows):
    seen, done = spark.sparkContext.accumulator(0), []

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(100).mapInArrow(count, "id long").where(F.col("id") >= least)
    assert publish_if_rows(df, tmp_dir, done.append) == rows
    assert seen.value == 100 and len(done) == len(_loads(tmp_dir)) == (1 if rows else 0)


def _readings(spark, n):
    rows = [("725030", "2015", "01", f"{d:02d}", 50.0, 9.0, "3.5", 10.0, 0.0, 0.0) for d in range(1, n + 1)]
    return spark.createDataFrame(rows, "stn string, year string, mo string, da string, temp double, visib double, wdsp string, gust double, prcp double, sndp double")


def test_finished_weather_is_not_loaded_again(spark, tmp_dir):
    spark.sql("DROP TABLE IF EXISTS pub_weather")
    with pytest.raises(ValueError, match="no weather"):
        load_weather(spark, _readings(spark, 0), "pub_weather", store=tmp_dir)
    assert not _loads(tmp_dir)
    assert load_weather(spark, lambda: _readings(spark, 3), "pub_weather", store=tmp_dir).count() == 3

    def unread():
        raise AssertionError("a finished load reads nothing")

    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("second-load", "second load")
    broken = _readings(spark, 9).withColumn("temp", F.raise_error(F.lit("read")))
    assert load_weather(spark, unread, "pub_weather", store=tmp_dir).schema == load_weather(spark, broken, "pub_weather", store=tmp_dir).schema
    assert len(tracker.getJobIdsForGroup("second-load")) <= 2  # whether the table has a row, twice
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    with pytest.raises(Exception, match="read"):
        load_weather(spark, broken, "pub_weather", store=tmp_dir, reload=True)
    assert spark.table("pub_weather").count() == 3
    assert load_weather(spark, _readings(spark, 4), "pub_weather", store=tmp_dir, reload=True).count() == 4


HEADER = "Trip Duration,Start Time,Bike ID,Colour"


def _land(root):
    os.makedirs(f"{root}/a {{b}}")
    cells = {
        "201501 [1].csv": [HEADER, "300,2015-01-02 00:00:01,11,red", "bad,2015-01-02 00:00:01,12,", ",2015-01-02 00:00:01,13,", "", "4,n/a,14.0,blue"],
        "a {b}/201502*%.CSV": ["bikeid,starttime,tripduration", "21,2/3/2015 4:05,60", "bikeid,starttime,tripduration", "22,2/3/2015 4:05"],
        "201503-new.csv": ["ride_length,started_at", "1,2"],
        "201503-twice.csv": ["bikeid,bike_id", "1,2"],
        "notes.csv": [HEADER, "300,2015-01-02 00:00:01,99,red"],
    }
    for name, lines in cells.items():
        with open(f"{root}/{name}", "w") as f:
            f.write("\n".join(lines) + "\n")


def test_an_ingest_counts_what_it_leaves_out(spark, tmp_dir):
    landing, store = f"{tmp_dir}/land", f"{tmp_dir}/store"
    _land(landing)
    with pytest.raises(ValueError, match="2 files have unknown or ambiguous headers"):
        ingest_report(spark, landing, store)
    need = ("tripduration", "starttime")
    report = ingest_report(spark, landing, store, need, publish="pub_trips", on_unknown="skip")
    assert report.files == {"read": 2, "unknown header": 1, "ambiguous header": 1, "no month": 1}
    assert report.rows == spark.table("pub_trips").count() == 2
    assert {k: n for k, n in report.counts.items() if n} == {
        "rows_read": 6, "rows_rejected": 4, "missing_tripduration": 2, "unreadable_tripduration": 1, "unreadable_starttime": 1, "extra_cells": 2
    }
    rows = {r.bikeid: r for r in spark.table("pub_trips").collect()}
    assert rows[21].starttime == dt.datetime(2015, 2, 3, 4, 5) and rows[11].year_month == "2015_01"
    months = ingest_report(spark, landing, f"{tmp_dir}/feb", need, months=["2015_02"])
    assert months.rows == 1 and months.files == {"read": 1} and months.counts["rows_read"] == 2
    # a later load without rows leaves the table
    assert ingest_report(spark, landing, store, ("gender",), publish="pub_trips", on_unknown="skip").rows == 0
    assert spark.table("pub_trips").count() == 2


def test_null_rows_and_bad_cells_are_typed(spark):
    raw = spark.createDataFrame([(None, None, None), ("1990.0", "x", " 7 "), ("12", "1/2/2015 3:04", "?")], "tripduration string, starttime string, bikeid string")
    assert [tuple(r) for r in clean_trips(raw, ("tripduration",)).select("tripduration", "starttime", "bikeid").orderBy("tripduration").collect()] == [
        (12, dt.datetime(2015, 1, 2, 3, 4), None),
        (1990, None, 7),
    ]


def test_large_files_are_not_read_for_their_header(spark, tmp_dir):
    lines = 400_000  # more than the batches a task passes over
    with open(f"{tmp_dir}/201501.csv", "w") as f:
        f.write("bikeid,starttime\n" + "1,2015-01-01 00:00:00\n" * lines)
    with open(f"{tmp_dir}/201502.csv", "w") as f:
        f.write("starttime,bikeid\n2015-02-01 00:00:00,2\n")
    report = {r.path[-10:]: r for r in file_report(spark, tmp_dir).collect()}
    assert report["201501.csv"].header == "bikeid,starttime" and report["201502.csv"].header == "starttime,bikeid"
    assert read_trip_files(spark, tmp_dir).groupBy("bikeid").count().orderBy("bikeid").collect()[0][1] == lines
