"""Stores that later queries read in part: tiles, sketches, buckets, sibling tables, a connector, area covers."""

import contextlib
import datetime as dt
import io
import math
import random

import pytest
from pyspark.sql import functions as F

from tripflow.functions.sketches import distinct_sketches, merged_distinct, relative_error
from tripflow.operators.joins import one_row_each
from tripflow.operators.spatial import area_cells, points_in_areas
from tripflow.operators.weather import daily_weather
from tripflow.plans.reports import bike_usage
from tripflow.plans.station_day import station_day
from tripflow.plans.stations import station_dimension
from tripflow.plans.tiles import Slice, tile_store, tiles
from tripflow.sinks.writers import save_bucketed
from tripflow.sources.folder_source import condition, register
from tripflow.sources.warehouse import read_source, read_wildcard


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


# --- quadtree cover


def _ring(cx, cy, r, n, turn=0.0):
    points = [[cx + r * math.cos(turn + 2 * math.pi * k / n), cy + r * math.sin(turn + 2 * math.pi * k / n)] for k in range(n)]
    return [*points, points[0]]


def _inside(geometry, x, y):
    odd = False
    for ring in (ring for poly in geometry for ring in poly):
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                odd = not odd
    return odd


AREAS = {
    "huge": [[_ring(0, 0, 500, 9), _ring(10, 10, 40, 5)]],  # far larger than the top level's cells
    "tiny": [[_ring(3, 3, 0.2, 4)]],
    "island": [[_ring(-30, 5, 9, 30)], [_ring(30, 5, 3, 7), _ring(30, 5, 1, 4)]],
    "thin": [[[[-20.0, -20.0], [60.0, 61.0], [60.0, 61.3], [-20.0, -19.9], [-20.0, -20.0]]]],
}


@pytest.fixture(scope="module")
def areas(spark):
    return spark.createDataFrame(list(AREAS.items()), "area_id string, geometry array<array<array<array<double>>>>")


def test_points_in_areas_of_mixed_sizes(spark, areas):
    rng = random.Random(6)
    points = [(n, rng.uniform(-520, 520), rng.uniform(-60, 89)) for n in range(300)] + [(300 + n, rng.uniform(-40, 61), rng.uniform(-20, 61)) for n in range(700)]
    points = [(n, x if abs(x) <= 180 else x / 3, y) for n, x, y in points]
    df = spark.createDataFrame(points, "n int, longitude double, latitude double")
    got = {(r.n, r.area_id) for r in points_in_areas(df, areas, 1.0, []).collect() if r.area_id}
    assert got == {(n, a) for n, x, y in points for a, g in AREAS.items() if _inside(g, x, y)}


def test_cover_follows_the_outline(spark, areas):
    count = lambda size, of: area_cells(areas.where(F.col("area_id") == of), size).count()
    # half the cell, twice the cells: their number grows with the outline, not with the area
    assert count(0.125, "island") < 2.4 * count(0.25, "island")
    cells = area_cells(areas, 1.0).where("area_id = 'huge'")
    outline = 2 * math.pi * 500
    assert cells.where("NOT inside").count() < 4 * outline and cells.where("inside AND level = 6").count() > 50
    twice = area_cells(areas, 1.0).groupBy("area_id", "level", "cx", "cy").count().where("count > 1")
    assert twice.isEmpty()


# --- tiles


def test_tiles_equal_station_days(spark):
    rng = random.Random(3)
    at = lambda: dt.datetime(2015, 1, rng.randint(1, 4), rng.randint(0, 23))
    rows = [(rng.choice(["A", "B", "C", None]), rng.choice("ABC"), at(), at(), rng.choice(["x", "y"])) for _ in range(400)]
    trips = spark.createDataFrame(rows, "start_station_name string, end_station_name string, starttime timestamp_ntz, stoptime timestamp_ntz, usertype string")
    stations = spark.createDataFrame(
        [("A", "Q", "N", 1.0, 1.0, 3), ("B", "Q", "M", 1.0, 1.0, 0), ("C", "R", "N", 1.0, 1.0, 7), (None, "R", "N", 1.0, 1.0, 7), (None, "R", "N", 1.0, 1.0, 7)],
        "name string, borough string, neighborhood string, latitude double, longitude double, capacity long",
    )
    got = {r["slice"]: r for r in tiles(tile_store(trips), stations, {"all": Slice(), "q": Slice(boroughs=["Q"]), "none": Slice(usertypes=["z"])}).collect()}
    assert sorted(got) == ["all", "q"]
    for name, where in (("all", "true"), ("q", "borough = 'Q'")):
        days = station_day(trips, stations, date_range=None).where(where)
        own = days.agg(F.sum("trips_started"), F.count_distinct("station_name"), F.round(F.avg("trips_per_dock"), 6), F.avg("net_flow")).first()
        assert tuple(got[name])[1:] == tuple(own)


def test_stations_without_a_name_match_nothing(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    assert [tuple(r) for r in one_row_each(df, "k").collect()] == [("a", 3)]
    with pytest.raises(Exception, match="k repeats: a"):
        one_row_each(df.unionByName(df), "k").collect()


# --- sketches


def test_merged_sketches_lie_within_their_error(spark):
    df = spark.range(60_000).select((F.col("id") % 12).alias("month"), (F.col("id") % 7).alias("station"), (F.col("id") * 7919 % 20_011).alias("bike"))
    kept = distinct_sketches(df, ["month", "station"], "bike")
    for keys in ([], ["station"], ["month"]):
        exact = {tuple(r)[:-1]: r.n for r in df.groupBy(*keys).agg(F.count_distinct("bike").alias("n")).collect()}
        about = {tuple(r)[:-1]: r.about for r in merged_distinct(kept, keys).collect()}
        assert exact.keys() == about.keys() and all(abs(about[k] - n) <= n * relative_error() for k, n in exact.items())
    assert merged_distinct(kept.limit(0)).first().about in (0, None)


# --- buckets


def test_bucketed_table_needs_no_exchange(spark, tmp_dir):
    trips = spark.range(5000).select((F.col("id") % 50).cast("int").alias("bikeid"), F.col("id").cast("int").alias("tripduration"), F.current_date().alias("start_day"))
    save_bucketed(trips, "by_bike", "bikeid", 8, f"{tmp_dir}/by_bike")
    table = spark.table("by_bike")
    assert "Exchange" not in _plan(bike_usage(table)) and bike_usage(table).count() == 50
    joined = table.hint("merge").join(table.groupBy("bikeid").agg(F.max("tripduration").alias("most")), "bikeid")
    assert "Exchange" not in _plan(joined) and joined.count() == 5000
    one = table.where("bikeid = 7")
    assert "SelectedBucketsCount: 1 out of 8" in _plan(bike_usage(one)) and one.count() == 100
    assert len(table.inputFiles()) == 8  # a file a bucket


# --- sibling tables


def test_sibling_tables_are_left_out_before_they_are_listed(spark, tmp_dir):
    for year in range(2012, 2018):
        df = spark.range(year - 2010).withColumn("v", F.lit(1.0)) if year != 2016 else spark.range(6)
        df.write.parquet(f"{tmp_dir}/y{year}")
        spark.catalog.createTable(f"sib_{year}", f"{tmp_dir}/y{year}", "parquet")
    got = read_wildcard(spark, "sib_*", "2014", "2016")
    assert {(r.table_suffix, r.n) for r in got.groupBy("table_suffix").agg(F.count(F.lit(1)).alias("n")).collect()} == {("2014", 4), ("2015", 5), ("2016", 6)}
    assert all("y2012" not in f and "y2017" not in f for f in got.inputFiles()) and "sib_2013" not in _plan(got)
    only = got.where("table_suffix = '2015'")
    assert only.count() == 5 and "y2016" not in _plan(only)
    assert got.where("v IS NULL").count() == 6  # a table without the column
    with pytest.raises(ValueError, match="no table"):
        read_wildcard(spark, "sib_*", "1900", "1901")
    with pytest.raises(ValueError, match="needs one"):
        read_wildcard(spark, "sib_2014")


# --- connector


def test_connector_takes_the_query_and_filters(spark, tmp_dir):
    spark.range(100).selectExpr("id", "id % 10 AS k", "cast(id AS string) AS t").repartition(4).write.parquet(f"{tmp_dir}/w")
    df = read_source(spark, query="SELECT id, k, t || '!' AS shout FROM source WHERE id < 50", fmt=register(spark), options={"path": f"{tmp_dir}/w"})
    assert df.rdd.getNumPartitions() == 4 and df.count() == 50
    some = df.where("k = 3 AND id >= 20 AND shout IN ('23!', '33!') AND length(shout) = 3")
    assert sorted(r.shout for r in some.collect()) == ["23!", "33!"]
    tree = _plan(some).split("\n\n")
    conditions = [part.partition("Condition : ")[2] for part in tree if "Condition : " in part]
    assert len(conditions) == 1 and conditions[0].startswith("(length(shout")  # the others are the source's work


def test_filters_as_sql():
    from pyspark.sql.datasource import EqualTo, In, IsNotNull, LessThan, StringContains

    assert condition(EqualTo(("a",), "x'y")) == "\"a\" = 'x''y'"
    assert condition(In(("a",), (1, 2))) == '"a" IN (1, 2)'
    assert condition(IsNotNull(("a",))) == '"a" IS NOT NULL'
    assert condition(LessThan(("a",), dt.date(2015, 1, 2))) == "\"a\" < '2015-01-02'"
    assert condition(EqualTo(("a", "b"), 1)) is None and condition(EqualTo(("a",), None)) is None and condition(StringContains(("a",), "x")) is None


# --- weather years, status rows


def test_weather_years_reach_the_scan(spark, tmp_dir):
    rows = [("725030", y, "01", "02", 50.0, 9.0, "3.5", 10.0, 0.0, 0.0) for y in ("2013", "2014", "2019", "bad", None)]
    schema = "stn string, year string, mo string, da string, temp double, visib double, wdsp string, gust double, prcp double, sndp double"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_dir}/r")
    df = daily_weather(spark.read.parquet(f"{tmp_dir}/r"))
    assert "In(year, [2014" in _plan(df) and df.count() == 2
    numbers = spark.read.parquet(f"{tmp_dir}/r").withColumn("year", F.col("year").try_cast("int"))
    assert daily_weather(numbers).count() == 2


def test_status_rows_repeat_or_only_filter(spark):
    info = spark.createDataFrame([("1", "A", "a", 0.5, 0.5, "7", "1"), ("2", "B", "b", 0.6, 0.6, "7", "1")], "station_id string, name string, short_name string, lat double, lon double, region_id string, capacity string")
    status = spark.createDataFrame([("1",), ("1",), ("1",), ("9",), (None,)], "station_id string")
    areas = spark.createDataFrame([("x", "Q", "N", [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0], [0.0, 0.0]]]])], "area_id string, borough string, neighborhood string, geometry array<array<array<array<double>>>>")
    assert station_dimension(info, status, areas).count() == 1
    assert station_dimension(info, status, areas, status_join="inner").count() == 3
    with pytest.raises(ValueError, match="semi or inner"):
        station_dimension(info, status, areas, status_join="left")
