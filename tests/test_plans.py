"""Plan shape checks: no Python in the plans, no quadratic joins, pushdown reaches the scan."""

import contextlib
import datetime as dt
import io
import os

import pytest

from tripflow import registry
from tripflow.plans.trip_mart import trip_mart

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin")
# queries whose callables write files first; their plans are checked by the others' pieces
SKIP = set(registry.WRITERS)
WITH_WEATHER = {"daily_weather", "trip_mart", "sliced_station_flows", "weather_usage", "weather_correlation"}


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - SKIP))
def test_plan_has_no_python_and_no_nested_loop(spark, name):
    text = plan_of(registry.QUERIES[name](spark, SF))
    bad = [f for f in FORBIDDEN if f in text]
    assert not bad, (name, bad)
    assert name in WITH_WEATHER or "l_discount" not in text, "weather is read and not used"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - SKIP))
def test_making_a_plan_starts_no_job(spark, name):
    sc = spark.sparkContext
    sc.setJobGroup(f"plan-{name}", name)
    registry.QUERIES[name](spark, SF).schema
    assert not sc.statusTracker().getJobIdsForGroup(f"plan-{name}")
    sc.setLocalProperty("spark.jobGroup.id", None)


def test_year_filter_reaches_parquet_scan(spark, tmp_dir):
    t = dt.datetime(2015, 6, 1, 8)
    trips = spark.createDataFrame(
        [("Subscriber", "A", "B", t, 600, 40.712, -74.001, 40.722, -74.011)],
        "usertype string, start_station_name string, end_station_name string, starttime timestamp_ntz, "
        "tripduration int, start_station_latitude double, start_station_longitude double, "
        "end_station_latitude double, end_station_longitude double",
    )
    trips.write.parquet(f"{tmp_dir}/trips")
    stations = spark.createDataFrame(
        [("A", "Q", "N1", 40.712, -74.001), ("B", "Q", "N2", 40.722, -74.011)],
        "name string, borough string, neighborhood string, latitude double, longitude double",
    )
    df = trip_mart(spark.read.parquet(f"{tmp_dir}/trips"), stations, None, years=(2014, 2015, 2016))
    text = plan_of(df)
    assert "PushedFilters: [IsNotNull(starttime), GreaterThanOrEqual(starttime" in text, text
    assert "ReadSchema: struct<usertype:string" in text
    assert "tripduration" in text and "bikeid" not in text
    assert df.count() == 1


def test_station_day_range_reaches_parquet_scan(spark, tmp_dir):
    from tripflow.plans.station_day import station_day

    t = dt.datetime(2015, 6, 1, 8)
    spark.createDataFrame(
        [("A", "B", t, t + dt.timedelta(minutes=5), 7)],
        "start_station_name string, end_station_name string, starttime timestamp_ntz, stoptime timestamp_ntz, bikeid int",
    ).write.parquet(f"{tmp_dir}/t")
    stations = spark.createDataFrame(
        [("A", "Q", "N", 1.0, 1.0, 3), ("B", "Q", "N", 1.0, 1.0, 3)],
        "name string, borough string, neighborhood string, latitude double, longitude double, capacity long",
    )
    df = station_day(spark.read.parquet(f"{tmp_dir}/t"), stations, date_range=("2015-01-01", "2015-12-31"))
    text = plan_of(df)
    assert "Or(And(GreaterThanOrEqual(starttime" in text, text
    assert "bikeid" not in text
    assert sorted((r.station_name, r.trips_started, r.trips_ended) for r in df.collect()) == [("A", 1, 0), ("B", 0, 1)]


def test_flow_is_one_shuffle_with_map_side_combine(spark, tmp_dir):
    from tripflow.operators.flow import station_day_flow

    t = dt.datetime(2015, 6, 1, 8)
    spark.createDataFrame(
        [("A", "B", t, t)] * 3, "start_station_name string, end_station_name string, starttime timestamp_ntz, stoptime timestamp_ntz"
    ).write.parquet(f"{tmp_dir}/f")
    text = plan_of(station_day_flow(spark.read.parquet(f"{tmp_dir}/f")))
    tree = text.split("\n\n")[0]
    assert tree.count("Exchange") == 1 and tree.count("Scan parquet") == 1
    assert "partial_sum" in text
