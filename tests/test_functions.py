import datetime as dt

from pyspark.sql import functions as F

from tripflow.functions import calendar as C
from tripflow.functions import cleaning as K
from tripflow.functions import geo as G
from tripflow.functions import metrics as M


def test_time_of_day_bands(spark):
    hours = [0, 4, 5, 11, 12, 16, 17, 20, 21, 23]
    df = spark.createDataFrame([(dt.datetime(2015, 6, 1, h, 30),) for h in hours], "ts timestamp_ntz")
    got = [r[0] for r in df.select(C.time_of_day("ts")).collect()]
    assert got == ["Night", "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening", "Night", "Night"]


def test_season_and_weekday(spark):
    days = [dt.date(2015, m, 7) for m in range(1, 13)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.select(C.season("d")).collect()]
    assert got == ["Winter", "Winter", "Spring", "Spring", "Spring", "Summer", "Summer", "Summer", "Fall", "Fall", "Fall", "Winter"]
    # 2015-06-07 was a Sunday
    assert spark.createDataFrame([(dt.date(2015, 6, 7),)], "d date").select(C.day_of_week("d")).first()[0] == 1


def test_parse_time_ignores_the_sessions_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2015-03-08 02:30:00",), ("11/1/2015 1:30",)], "t string")
        got = [str(r[0]) for r in df.select(K.parse_time("t").cast("string")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == ["2015-03-08 02:30:00", "2015-11-01 01:30:00"]


def test_parse_time_layouts(spark):
    cases = [
        ("6/1/2015 0:00", dt.datetime(2015, 6, 1, 0, 0)),
        ("6/10/2015 0:30", dt.datetime(2015, 6, 10, 0, 30)),
        ("6/10/2015 10:30", dt.datetime(2015, 6, 10, 10, 30)),  # 15 characters
        ("12/31/2015 23:59", dt.datetime(2015, 12, 31, 23, 59)),  # 16 characters
        ("6/1/2015 0:00:05", dt.datetime(2015, 6, 1, 0, 0, 5)),
        ("12/31/2015 23:59:59", dt.datetime(2015, 12, 31, 23, 59, 59)),
        ("2015-06-01 00:00:01", dt.datetime(2015, 6, 1, 0, 0, 1)),
        ("2015-01-02 00:00:01.123", dt.datetime(2015, 1, 2, 0, 0, 1)),
        ("bad", None),
        (None, None),
    ]
    df = spark.createDataFrame([(t,) for t, _ in cases], "t string")
    got = [r[0] for r in df.select(K.parse_time("t")).collect()]
    assert got == [e for _, e in cases]


def test_coercions_and_nulls(spark):
    df = spark.createDataFrame([("71.0",), ("x",), (None,), ("12",), ("nan",), ("  ",)], "v string")
    got = [r[0] for r in df.select(K.to_whole_number("v")).collect()]
    assert got == [71, None, None, 12, None, None]
    got = [r[0] for r in df.select(K.textual_null("v")).collect()]
    assert got == ["71.0", "x", None, "12", None, None]
    df = spark.createDataFrame([(9999.9,), (50.0,)], "v double")
    assert [r[0] for r in df.select(K.without_sentinel("v", 9999.9)).collect()] == [None, 50.0]


def test_haversine(spark):
    df = spark.createDataFrame([(40.7, -74.0, 40.7, -74.0), (0.0, 0.0, 0.0, 1.0), (40.0, -74.0, 41.0, -73.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(G.haversine_m("a", "b", "c", "d")).collect()]
    assert got[0] == 0.0
    assert abs(got[1] - 6371010.0 * 3.141592653589793 / 180) < 1e-6
    back = df.select(G.haversine_m("c", "d", "a", "b")).collect()
    assert [r[0] for r in back] == got


def test_snap_widens_float(spark):
    vals = [40.71234, -73.98765, 40.7441, 40.6001]
    df = spark.createDataFrame([(v,) for v in vals], "v double").withColumn("f", F.col("v").cast("float"))
    # a float reading snaps to the same (double) cell as the double reading
    rows = df.select(G.snap("f", 3).alias("a"), G.snap("v", 3).alias("b")).collect()
    assert all(r.a == r.b for r in rows)
    assert [r.b for r in rows] == [40.712, -73.988, 40.744, 40.6]


def test_metrics(spark):
    df = spark.createDataFrame([(10, 5, 0), (10, 5, 3), (None, 4, 2)], "e int, s int, cap int")
    rows = df.select(
        M.net_flow("e", "s").alias("nf"),
        M.trips_per_dock("s", "e", "cap").alias("tpd"),
        M.utilization_status(M.trips_per_dock("s", "e", "cap")).alias("st"),
        M.utilization_status(M.trips_per_dock("s", "e", "cap"), unknown_label="Unknown").alias("st2"),
    ).collect()
    assert [r.nf for r in rows] == [5, 5, -4]
    assert rows[0].tpd is None and rows[0].st == "Efficient" and rows[0].st2 == "Unknown"
    assert rows[1].tpd == 5.0 and rows[1].st == "Underused"
    sp = spark.createDataFrame([(1.0, 0.0), (1.0, 30.0)], "km double, m double")
    assert [r[0] for r in sp.select(M.avg_speed_kmh("km", "m")).collect()] == [None, 2.0]


def test_fixed_point_mean_is_exact(spark):
    vals = [0.1, 0.2, 0.3, 1234.57, 0.01] * 7
    df = spark.createDataFrame([(v,) for v in vals], "v double").repartition(5)
    got = df.agg(M.fixed_point_mean("v", 2)).first()[0]
    assert got == (sum(round(v * 100) for v in vals) / len(vals)) / 100
