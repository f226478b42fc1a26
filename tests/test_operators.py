import datetime as dt
import random

from pyspark.sql import functions as F

from tripflow.operators.flow import station_day_flow
from tripflow.operators.joins import match_stations
from tripflow.operators.spatial import points_in_areas
from tripflow.operators.weather import daily_weather
from tripflow.plans.station_day import station_day

T = "start_station_name string, end_station_name string, starttime timestamp_ntz, stoptime timestamp_ntz"


def _trips(spark):
    d = dt.datetime
    rows = [
        ("A", "B", d(2015, 6, 1, 8), d(2015, 6, 1, 8, 20)),
        ("A", "B", d(2015, 6, 1, 9), d(2015, 6, 1, 9, 20)),
        ("B", "A", d(2015, 6, 1, 23, 50), d(2015, 6, 2, 0, 10)),  # ends the next day
        ("C", "A", d(2015, 6, 2, 7), d(2015, 6, 2, 7, 5)),
        (None, "A", d(2015, 6, 2, 7), d(2015, 6, 2, 7, 5)),  # unknown start station
        ("A", "C", None, d(2015, 6, 3, 7, 5)),  # unknown start time
    ]
    return spark.createDataFrame(rows, T)


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_flow_methods_agree_and_balance(spark):
    trips = _trips(spark)
    a = station_day_flow(trips, method="single_pass")
    b = station_day_flow(trips, method="full_outer")
    assert _sorted(a) == _sorted(b)
    tot = a.agg(F.sum("net_flow"), F.sum("trips_started"), F.sum("trips_ended")).first()
    # 4 starts and 6 ends are known; net flow sums to ends - starts over all stations
    assert (tot[1], tot[2]) == (4, 6) and tot[0] == 2
    rows = {(r.station_name, str(r.trip_date)): r for r in a.collect()}
    assert rows[("A", "2015-06-01")].trips_started == 2 and rows[("A", "2015-06-01")].trips_ended == 0
    assert rows[("A", "2015-06-02")].trips_ended == 3


def test_flow_balanced_when_complete(spark):
    rnd = random.Random(3)
    names = ["S%d" % i for i in range(7)]
    base = dt.datetime(2015, 1, 1)
    rows = []
    for _ in range(500):
        s = base + dt.timedelta(minutes=rnd.randrange(60 * 24 * 20))
        rows.append((rnd.choice(names), rnd.choice(names), s, s + dt.timedelta(minutes=rnd.randrange(90))))
    f = station_day_flow(spark.createDataFrame(rows, T))
    tot = f.agg(F.sum("net_flow"), F.sum(F.col("trips_started") + F.col("trips_ended"))).first()
    assert tot[0] == 0 and tot[1] == 1000


def test_station_day_mart(spark):
    trips = _trips(spark)
    stations = spark.createDataFrame(
        [("A", "Q", "Sunnyside", 40.0, -73.0, 4), ("B", "Q", "Dutch Kills", 40.1, -73.1, 0), ("C", None, None, 40.2, -73.2, 5)],
        "name string, borough string, neighborhood string, latitude double, longitude double, capacity long",
    )
    sd = station_day(trips, stations, date_range=("2015-06-01", "2015-06-02"), sort=True)
    rows = sd.collect()
    # C has no borough -> gone; 2015-06-03 outside the range -> gone
    assert {r.station_name for r in rows} == {"A", "B"}
    assert max(str(r.trip_date) for r in rows) == "2015-06-02"
    b = [r for r in rows if r.station_name == "B"][0]
    assert b.trips_per_dock is None and b.flow_stress_score is None and b.utilization_status == "Efficient"


def test_match_stations_cell_and_nearest(spark):
    stations = spark.createDataFrame(
        [("X", 40.7121, -74.0011), ("Y", 40.7139, -74.0011)], "name string, latitude double, longitude double"
    )
    trips = spark.createDataFrame([(1, 40.71214, -74.00112), (2, 40.71349, -74.00112), (3, 41.0, -74.0)], "id int, lat double, lon double")
    cell = match_stations(trips, stations, "lat", "lon", "s_", ["name"], how="cell")
    assert sorted((r.id, r.s_name) for r in cell.collect()) == [(1, "X")]
    near = match_stations(trips, stations, "lat", "lon", "s_", ["name"], how="nearest", max_distance_m=120.0, join_type="left")
    assert sorted((r.id, r.s_name) for r in near.collect()) == [(1, "X"), (2, "Y"), (3, None)]


def test_nearest_station_is_the_nearest(spark):
    from tripflow.functions.geo import haversine_m

    rnd = random.Random(3)
    places = [(f"s{i}", rnd.uniform(40, 41), rnd.uniform(-74, -73)) for i in range(60)]
    places += [("near", 40.7109, -74.0), ("far", 40.7138, -74.0), ("pole", 89.9, 10.0), ("line", 10.0, 179.999)]
    points = [(i, rnd.uniform(40, 41), rnd.uniform(-74, -73)) for i in range(300)]
    points += [(900, 40.7121, -74.0), (901, 89.9, -170.0), (902, 10.0, -179.999), (903, None, 1.0), (904, 95.0, 1.0)]
    stations = spark.createDataFrame(places, "name string, latitude double, longitude double")
    trips = spark.createDataFrame(points, "id int, lat double, lon double")
    for reach in (250.0, 9_000.0, 60_000.0):
        got = {r.id: r.n_name for r in match_stations(trips, stations, "lat", "lon", "n_", ["name"], how="nearest", max_distance_m=reach, join_type="left").collect()}
        every = trips.crossJoin(stations).withColumn("d", haversine_m("lat", "lon", "latitude", "longitude")).where(f"d <= {reach} AND lat <= 90").collect()
        want = {i: min(((r.d, r.name) for r in every if r.id == i), default=(0, None))[1] for i, _, _ in points}
        assert got == want
    import pytest

    with pytest.raises(ValueError):
        match_stations(trips, stations, "lat", "lon", "n_", ["name"], how="nearest")


def _ring(x0, y0, x1, y1):
    return [[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]


def test_points_in_areas_cases(spark):
    areas = spark.createDataFrame(
        [
            ("holed", "B1", "N1", [[_ring(0.0, 0.0, 4.0, 4.0), _ring(1.0, 1.0, 2.0, 2.0)]]),
            ("multi", "B2", "N2", [[_ring(10.0, 0.0, 11.0, 1.0)], [_ring(12.0, 0.0, 13.0, 1.0)]]),
            ("left", "B3", "N3", [[_ring(20.0, 0.0, 21.0, 1.0)]]),
            ("right", "B3", "N4", [[_ring(21.0, 0.0, 22.0, 1.0)]]),
            ("over", "B4", "N5", [[_ring(3.0, 3.0, 5.0, 5.0)]]),
        ],
        "area_id string, borough string, neighborhood string, geometry array<array<array<array<double>>>>",
    )
    pts = [
        ("inside", 3.0, 0.5), ("hole", 1.5, 1.5), ("edge", 0.0, 2.0), ("vertex", 4.0, 4.0), ("corner", 0.0, 0.0), ("hole_edge", 1.0, 1.5),
        ("part1", 10.5, 0.5), ("part2", 12.5, 0.5), ("gap", 11.5, 0.5),
        ("l", 20.5, 0.5), ("r", 21.5, 0.5), ("shared", 21.0, 0.5),
        ("both", 3.5, 3.5), ("none", 50.0, 50.0), ("bad", 500.0, 0.0),
    ]
    points = spark.createDataFrame([(n, y, x) for n, x, y in pts], "name string, latitude double, longitude double")
    got = sorted((r.name, r.area_id) for r in points_in_areas(points, areas, 1.5, ["neighborhood"]).collect())
    want = sorted(
        [("inside", "holed"), ("hole", None), ("edge", None), ("vertex", "over"), ("hole_edge", None),
         ("part1", "multi"), ("part2", "multi"), ("gap", None), ("l", "left"), ("r", "right"), ("shared", None),
         ("both", "holed"), ("both", "over"), ("corner", None), ("none", None), ("bad", None)]
    )
    assert got == want


def _ray_inside(x, y, rings):
    inside = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            cross = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
            if cross == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return False
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                inside = not inside
    return inside


def test_points_in_areas_brute_force(spark):
    rnd = random.Random(7)
    polys = []
    for i in range(40):
        cx, cy = rnd.uniform(0, 20), rnd.uniform(0, 20)
        ring = [[cx + rnd.randint(-3, 3), cy + rnd.randint(-3, 3)] for _ in range(3)]
        ring.append(ring[0])
        polys.append(("t%d" % i, [[ring]]))
    pts = [(j, rnd.choice([rnd.uniform(-2, 22), float(rnd.randint(-2, 22))]), rnd.uniform(-2, 22)) for j in range(1500)]
    # include every vertex as a point (boundary cases)
    for _, g in polys:
        for vx, vy in g[0][0][:3]:
            pts.append((len(pts), vy, vx))
    areas = spark.createDataFrame(polys, "area_id string, geometry array<array<array<array<double>>>>")
    points = spark.createDataFrame(pts, "id int, latitude double, longitude double")
    got = sorted((r.id, r.area_id) for r in points_in_areas(points, areas, 2.5, []).where("area_id is not null").collect())
    want = sorted((pid, aid) for pid, y, x in pts for aid, g in polys if _ray_inside(x, y, g[0]))
    assert got == want


def test_area_summary_counts_unlisted_types(spark):
    from tripflow.plans.reports import start_area_summary

    tm = spark.createDataFrame([("B", "N", "x", 1.0), ("B", "N", "x", 2.0), ("B", "N", "other", 9.0)], "start_borough string, start_neighborhood string, usertype string, trip_minute double")
    r = start_area_summary(tm, ["x"]).first()
    assert (r.trips, r.trips_x, r.avg_minute_x) == (3, 2, 1.5)


def test_daily_weather_sentinels(spark):
    rows = [
        ("725030", "2015", "06", "01", 70.0, 10.0, "5.0", 999.9, 0.5, 999.9),
        ("744860", "2015", "06", "01", 9999.9, 8.0, "999.9", 20.0, 99.99, 999.9),
        ("725030", "2015", "06", "02", 9999.9, 999.9, "999.9", 999.9, 99.99, 999.9),
        ("999999", "2015", "06", "01", 10.0, 1.0, "1.0", 1.0, 1.0, 1.0),  # other station
        ("725030", "2013", "06", "01", 10.0, 1.0, "1.0", 1.0, 1.0, 1.0),  # outside the years
    ]
    schema = "stn string, year string, mo string, da string, temp double, visib double, wdsp string, gust double, prcp double, sndp double"
    out = daily_weather(spark.createDataFrame(rows, schema), sort=True).collect()
    assert len(out) == 2
    a, b = out
    assert a.timestamp == dt.datetime(2015, 6, 1) and a.temperature == 70.0 and a.visibility == 9.0
    assert a.wind_speed == 5.0 and a.wind_gust == 20.0 and a.precipitation == 0.5 and a.snow_depth is None
    assert b.temperature is None and b.visibility is None


def test_unique_names_check_and_point_part(spark):
    import pytest

    from tripflow.functions.geo import point_part, point_text
    from tripflow.operators.joins import one_row_each

    st = spark.createDataFrame([("A", "Q"), ("A", "Q"), ("B", "Q")], "name string, borough string")
    with pytest.raises(Exception, match="name repeats: A"):
        one_row_each(st, "name").collect()
    assert one_row_each(st.where("name = 'B'"), "name").collect() == [("B", "Q")]
    df = spark.createDataFrame([(40.71234, -74.00112), (None, 1.0)], "lat double, lon double")
    rows = df.select(point_text("lat", "lon").alias("p")).select(point_part("p", 0), point_part("p", 1)).collect()
    assert tuple(rows[0]) == (40.71234, -74.00112) and tuple(rows[1]) == (None, None)
