import datetime as dt
import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tripflow.operators.cleaning import clean_trips
from tripflow.plans import ingest
from tripflow.plans.ingest import ingest_trip_files
from tripflow.plans.stations import station_dimension
from tripflow.sinks.writers import register_table, save_with_schema, write_by_day, write_if_rows, write_partitioned
from tripflow.sources import driver_tables, trip_files
from tripflow.sources.feeds import read_area_features, read_station_feed
from tripflow.sources.trip_files import canonical_names, file_report, read_trip_files
from tripflow.sources.warehouse import table_has_rows
from tripflow.streaming.ingest import run_trip_stream_once

LOWER = "tripduration,starttime,stoptime,start_station_id,start_station_name,start_station_latitude,start_station_longitude,end_station_id,end_station_name,end_station_latitude,end_station_longitude,bikeid,usertype,birth_year,gender"
TITLE = "Trip Duration,Start Time,Stop Time,Start Station ID,Start Station Name,Start Station Latitude,Start Station Longitude,End Station ID,End Station Name,End Station Latitude,End Station Longitude,Bike ID,User Type,Birth Year,Gender"
# same columns, another order
REORDERED = "Bike ID,Gender,Birth Year,User Type,Trip Duration,Start Time,Stop Time,Start Station ID,Start Station Name,Start Station Latitude,Start Station Longitude,End Station ID,End Station Name,End Station Latitude,End Station Longitude"


def _write(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(header + "\n")
        for r in rows:
            f.write(",".join(r) + "\n")


def _land(root):
    a = [
        ["300", "2015-01-02 00:00:01.123", "2015-01-02 00:05:01.456", "1", "A St", "40.71", "-74.0", "2", "B St", "40.72", "-74.01", "11", "Subscriber", "1980", "1"],
        ["0", "2015-01-02 05:00:00", "2015-01-02 05:00:00", "1", "A St", "40.71", "-74.0", "2", "B St", "40.72", "-74.01", "12", "Customer", "\\N", "0"],
    ]
    _write(f"{root}/2015/201501-a.csv", LOWER, a)
    b = [
        ["600", "6/1/2015 0:00", "6/1/2015 0:10", "2", "B St", "40.72", "-74.01", "1", "A St", "40.71", "-74.0", "13", "Subscriber", "1975", "2"],
        ["700", "6/10/2015 10:30", "6/10/2015 10:41", "2", "B St", "40.72", "-74.01", "1", "A St", "40.71", "-74.0", "14", "Subscriber", "", "2"],
        ["800", "12/31/2015 23:59", "1/1/2016 0:12", "2", "B St", "40.72", "-74.01", "1", "A St", "40.71", "-74.0", "15", "Customer", "1990", "1"],
        ["900", "bad", "6/1/2015 0:10", "2", "B St", "40.72", "-74.01", "1", "A St", "40.71", "-74.0", "16", "Customer", "1990", "1"],
    ]
    _write(f"{root}/2015/201506-b.CSV", TITLE, b)
    c = [["17", "1", "1985", "Subscriber", "420", "6/2/2015 8:00:05", "6/2/2015 8:07:05", "1", "A St", "40.71", "-74.0", "2", "B St", "40.72", "-74.01"]]
    _write(f"{root}/2015/201506-c.csv", REORDERED, c)
    _write(f"{root}/2015/notes.csv", LOWER, a)  # no year-month in the name: skipped
    _write(f"{root}/2015/__x/201501-a.csv", LOWER, a)  # hidden folder: skipped


def test_read_trip_files_layouts(spark, tmp_dir):
    _land(tmp_dir)
    raw = read_trip_files(spark, tmp_dir)
    assert raw.count() == 7
    report = {r.path.rsplit("/", 1)[1]: r for r in file_report(spark, tmp_dir).collect()}
    assert {k: r.status for k, r in report.items()} == {"201501-a.csv": "read", "201506-b.CSV": "read", "201506-c.csv": "read", "notes.csv": "no month"}
    trips = clean_trips(raw)
    rows = {r.bikeid: r for r in trips.collect()}
    assert sorted(rows) == [11, 12, 13, 14, 15, 17]  # 16 has an unparsable start time
    assert rows[11].starttime == dt.datetime(2015, 1, 2, 0, 0, 1) and rows[11].year_month == "2015_01"
    assert rows[14].starttime == dt.datetime(2015, 6, 10, 10, 30) and rows[14].birth_year is None
    assert rows[15].stoptime == dt.datetime(2016, 1, 1, 0, 12)
    assert rows[17].tripduration == 420 and rows[17].start_station_name == "A St" and rows[17].gender == "1"
    assert rows[12].birth_year is None and rows[12].tripduration == 0
    # the strict rule: any null drops the trip
    assert sorted(r.bikeid for r in clean_trips(raw, required="all").collect()) == [11, 13, 15, 17]


def test_files_are_never_lost_silently(spark, tmp_dir):
    row = ["300", "2015-01-02 00:00:01"]
    _write(f"{tmp_dir}/1 January/201501 trips.csv", "tripduration,starttime", [row])  # spaces in both names
    _write(f"{tmp_dir}/201501-backup/notes.csv", "tripduration,starttime", [row])  # a month in the folder only
    _write(f"{tmp_dir}/201502-extra.csv", "tripduration,starttime,color", [[*row, "red"]])
    assert read_trip_files(spark, tmp_dir).count() == 2
    assert read_trip_files(spark, tmp_dir, month_from_folder=True).count() == 3
    assert read_trip_files(spark, tmp_dir, months=["2015_02"]).count() == 1
    _write(f"{tmp_dir}/201503-new.csv", "ride_length,started_at,ended_at", [row + [row[1]]])
    with pytest.raises(ValueError, match="201503-new"):
        read_trip_files(spark, tmp_dir)
    assert read_trip_files(spark, tmp_dir, on_unknown="skip").count() == 2
    report = {r.path.rsplit("/", 1)[1]: (r.status, r.extras) for r in file_report(spark, tmp_dir).collect()}
    assert report["201503-new.csv"] == ("unknown header", ["ride_length", "started_at", "ended_at"])
    assert report["201502-extra.csv"] == ("read", ["color"]) and report["notes.csv"][0] == "no month"


def test_equal_geometries_are_two_areas(spark, tmp_dir):
    square = {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]}
    doc = {"features": [{"properties": {"boroname": b, "ntaname": b}, "geometry": square} for b in "PQ"]}
    with open(f"{tmp_dir}/a.geojson", "w") as f:
        json.dump(doc, f)
    points = spark.createDataFrame([(0.5, 0.5)], "latitude double, longitude double")
    areas = read_area_features(spark, f"{tmp_dir}/a.geojson")
    from tripflow.operators.spatial import points_in_areas

    assert sorted(r.borough for r in points_in_areas(points, areas, 1.0, ["borough"]).collect()) == ["P", "Q"]
    with pytest.raises(Exception, match="area_id repeats"):
        points_in_areas(points, areas.withColumn("area_id", F.lit("same")), 1.0, ["borough"]).collect()


def test_duplicate_header_mapping_raises():
    with pytest.raises(ValueError):
        canonical_names("bikeid,bike_id,starttime")
    names, extras = canonical_names("Bike ID,Start Time,Color")
    assert names[:2] == ["bikeid", "starttime"] and extras == ["color"]


def test_ingest_is_idempotent_per_month(spark, tmp_dir):
    landing, store = f"{tmp_dir}/landing", f"{tmp_dir}/store"
    _land(landing)
    assert ingest_trip_files(spark, landing, store, table="trips_store") == 6
    assert ingest_trip_files(spark, landing, store) == 6  # reload: months replaced, not doubled
    assert spark.read.parquet(store).count() == 6
    assert spark.table("trips_store").count() == 6
    assert table_has_rows(spark, "trips_store") and not table_has_rows(spark, "no_such_table")
    months = sorted(r[0] for r in spark.read.parquet(store).select("year_month").distinct().collect())
    assert months == ["2015_01", "2015_06"]


def test_sinks(spark, tmp_dir):
    df = spark.createDataFrame(
        [(dt.date(2015, 6, 1), b, "2015_06") for b in range(20)] + [(dt.date(2015, 6, 2), 1, "2015_06")],
        "start_day date, bikeid int, year_month string",
    )
    write_by_day(df, f"{tmp_dir}/by_day")
    folders = sorted(d for d in os.listdir(f"{tmp_dir}/by_day") if d.startswith("start_day="))
    assert folders == ["start_day=2015-06-01", "start_day=2015-06-02"]
    register_table(spark, "by_day", f"{tmp_dir}/by_day")
    assert spark.table("by_day").count() == 21
    assert write_if_rows(df.limit(0), lambda d: write_partitioned(d, f"{tmp_dir}/never")) == 0
    assert not os.path.exists(f"{tmp_dir}/never")
    assert write_if_rows(df, lambda d: write_partitioned(d, f"{tmp_dir}/p")) == 21
    from tripflow.plans.stations import STATION_SCHEMA

    save_with_schema(spark.createDataFrame([("1", "x", 40.0)], "station_id string, name string, latitude double"), "st", STATION_SCHEMA)
    assert spark.table("st").schema == STATION_SCHEMA


def test_station_feeds_and_areas(spark, tmp_dir):
    info = {"data": {"stations": [
        {"station_id": "1", "name": "A St", "short_name": "1.1", "lat": 0.5, "lon": 0.5, "region_id": "71", "capacity": 10},
        {"station_id": "2", "name": "B St", "short_name": "2.2", "lat": 1.5, "lon": 1.5, "region_id": "71.0", "capacity": 5},
        {"station_id": "3", "name": "C St", "short_name": "3.3", "lat": 0.7, "lon": 0.2, "region_id": "x", "capacity": 5},
        {"station_id": "4", "name": "D St", "short_name": None, "lat": 0.6, "lon": 0.6, "region_id": "1", "capacity": 5},
        {"station_id": "5", "name": "E St", "short_name": "5.5", "lat": 9.0, "lon": 9.0, "region_id": "1", "capacity": 5},
        {"station_id": "6", "name": "F St", "short_name": "6.6", "lat": 0.8, "lon": 0.8, "region_id": "1", "capacity": 5},
    ]}}
    status = {"data": {"stations": [{"station_id": s, "num_bikes_available": 1} for s in ["1", "2", "3", "4", "5", "2", "7"]]}}
    geo = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"boroname": "Queens", "ntaname": "Sunnyside"},
         "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]}},
        {"type": "Feature", "properties": {"boroname": "Queens", "ntaname": "Hunters Point"},
         "geometry": {"type": "MultiPolygon", "coordinates": [[[[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]]]]}},
        {"type": "Feature", "properties": {"boroname": "X", "ntaname": "Line"},
         "geometry": {"type": "LineString", "coordinates": [[0, 0], [1, 1]]}},
    ]}
    for name, doc in (("info.json", info), ("status.json", status), ("nta.geojson", geo)):
        with open(f"{tmp_dir}/{name}", "w") as f:
            json.dump(doc, f)
    areas = read_area_features(spark, f"{tmp_dir}/nta.geojson")
    assert areas.count() == 2
    dim = station_dimension(
        read_station_feed(spark, f"{tmp_dir}/info.json"), read_station_feed(spark, f"{tmp_dir}/status.json"), areas, cell_size=0.5
    )
    rows = {r.station_id: r for r in dim.collect()}
    # 3: bad region id; 4: no short name; 5: in no area; 6: not in status
    assert sorted(rows) == ["1", "2"]
    assert rows["1"].neighborhood == "Sunnyside" and rows["2"].neighborhood == "Hunters Point"
    assert rows["2"].region_id == 71 and rows["1"].capacity == 10


def test_streaming_ingest_picks_up_new_files(spark, tmp_dir):
    landing, store, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/store", f"{tmp_dir}/ckpt"
    _write(f"{landing}/201501-a.csv", LOWER, [
        ["300", "2015-01-02 00:00:01", "2015-01-02 00:05:01", "1", "A St", "40.71", "-74.0", "2", "B St", "40.72", "-74.01", "11", "Subscriber", "1980", "1"],
    ])
    run_trip_stream_once(spark, landing, store, ckpt)
    assert spark.read.parquet(store).count() == 1
    _write(f"{landing}/201506-b.csv", TITLE, [
        ["600", "6/1/2015 0:00", "6/1/2015 0:10", "2", "B St", "40.72", "-74.01", "1", "A St", "40.71", "-74.0", "13", "Subscriber", "1975", "2"],
    ])
    run_trip_stream_once(spark, landing, store, ckpt)
    out = spark.read.parquet(store)
    assert out.count() == 2
    assert sorted(r[0] for r in out.select("year_month").collect()) == ["2015_01", "2015_06"]
    assert out.where(F.col("bikeid") == 13).first().starttime == dt.datetime(2015, 6, 1)
    # the batch job over the same landing folder leaves the same store
    assert ingest_trip_files(spark, landing, store) == 2 and spark.read.parquet(store).count() == 2


def test_generic_sources(spark, tmp_dir):
    from tripflow.sources.warehouse import read_source, read_years

    df = spark.createDataFrame([(y, float(y)) for y in range(2012, 2021)], "year int, v double")
    df.write.partitionBy("year").parquet(f"{tmp_dir}/gsod")
    got = read_years(spark, f"{tmp_dir}/gsod", 2014, 2019)
    assert sorted(r.year for r in got.collect()) == list(range(2014, 2020))
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        got.explain(mode="formatted")
    assert "PartitionFilters: [isnotnull(year" in buf.getvalue()
    df.createOrReplaceTempView("gsod_view")
    assert read_source(spark, query="SELECT count(*) AS n FROM gsod_view").first().n == 9
    assert read_source(spark, table="gsod_view").count() == 9
    assert read_source(spark, path=f"{tmp_dir}/gsod").count() == 9


def test_rows_of_files_that_hold_a_month_are_not_moved(spark, tmp_dir, monkeypatch):
    """A store's files come from the landed ones, part by part; only months in many small files are gathered. The rows are the same."""
    cells = "2015-03-01 10:00:00.250,2015-03-01 10:10:00.250,{},60"
    for n in range(6):
        for folder, month in (("few", n + 1), ("many", 3)):
            os.makedirs(f"{tmp_dir}/{folder}", exist_ok=True)
            with open(f"{tmp_dir}/{folder}/2015{month:02d}-{n}.csv", "w") as f:
                f.write("\n".join(["starttime,stoptime,bikeid,tripduration", *(cells.format(10 * n + k) for k in range(3))]) + "\n")
    moved = []
    write = ingest.write_partitioned

    def seen(df, path, **how):
        moved.append(how["gather"])
        return write(df, path, **how)

    monkeypatch.setattr(ingest, "write_partitioned", seen)
    for folder in ("few", "many"):
        store = f"{tmp_dir}/{folder}-store"
        assert ingest_trip_files(spark, f"{tmp_dir}/{folder}", store, ["starttime"]) == 18
        rows = spark.read.parquet(store)
        assert sorted(r[0] for r in rows.select("bikeid").collect()) == sorted(10 * n + k for n in range(6) for k in range(3))
        assert rows.select("year_month").distinct().count() == (6 if folder == "few" else 1)
    assert moved == [False, True]
    monkeypatch.setattr(trip_files, "LARGE_FILE", 8)  # files of over 8 bytes are large
    ingest_trip_files(spark, f"{tmp_dir}/many", f"{tmp_dir}/large-store", ["starttime"])
    assert moved[2:] == [False] and spark.read.parquet(f"{tmp_dir}/large-store").count() == 18
    publish = [ingest.ingest_report(spark, f"{tmp_dir}/few", f"{tmp_dir}/loads", ["starttime"], publish="few_trips").rows, spark.table("few_trips").count()]
    assert publish == [18, 18]
    spark.sql("DROP TABLE few_trips")


def test_trips_by_month_move_as_keys(spark, tmp_dir):
    """The trips that are landed as text: the same rows, dealt by month before names, places and texts are added."""
    home = f"{tmp_dir}/tables"
    day = dt.datetime(1996, 1, 31)
    tables = {
        "nation": [(0, "A", 0), (1, "B", 0)],
        "customer": [(k, "c", k % 2, 0.0, "BUILDING" if k else None) for k in range(3)],
        "supplier": [(k, "s", k % 2, 0.0) for k in range(2)],
        "orders": [(k, k % 3, "O", 1.0, day, "1-URGENT") for k in range(8)],
        "lineitem": [(k, 7 * k, k % 2, 1, 1.0, 1.0, 0.0, 0.0, "A", "F", None if k == 5 else day + dt.timedelta(days=20 * k)) for k in range(8)] * 2,
    }
    for name, rows in tables.items():
        spark.createDataFrame(rows, driver_tables.SCHEMAS[name]).write.parquet(f"{home}/{name}.parquet")
    plain, by_month = driver_tables.trips_view(spark, home), driver_tables.trips_view(spark, home, by_month=True)
    count = lambda df: Counter(df.collect())
    assert count(by_month.drop("month")) == count(plain) and plain.count() == 16
    plan = by_month._jdf.queryExecution().optimizedPlan().toString()
    assert "n_name" not in plan[plan.index("RebalancePartitions") :].split("Relation")[0]
    for name, trips in (("plain", plain), ("dealt", by_month)):
        ingest.land_as_text(trips, f"{tmp_dir}/{name}")
    texts = [sorted(spark.read.text(f"{tmp_dir}/{n}", recursiveFileLookup=True).distinct().collect()) for n in ("plain", "dealt")]
    assert texts[0] == texts[1]
    assert sorted(os.listdir(f"{tmp_dir}/plain/title")) == sorted(os.listdir(f"{tmp_dir}/dealt/title"))
