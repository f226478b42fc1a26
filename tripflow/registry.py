"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads the driver's tables in full through the views in
``tripflow.sources.driver_tables``. Only ``station_congestion_range`` and
``sliced_*`` keep part of the days, where that is the feature. Making a query's
plan starts no job, except for those whose work is to write (``WRITERS``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.functions.calendar import year_range
from tripflow.functions.cleaning import parse_time, to_whole_number
from tripflow.functions.geo import haversine_m, point_part, point_text
from tripflow.functions.sketches import distinct_sketches, merged_distinct, relative_error
from tripflow.operators.cleaning import drop_textual_nulls
from tripflow.operators.flow import station_day_flow
from tripflow.operators.joins import match_stations
from tripflow.operators.slicing import slice_station_days, slice_trips
from tripflow.operators.spatial import points_in_areas
from tripflow.operators.weather import daily_weather
from tripflow.plans import reports as R
from tripflow.plans.ingest import flawed_examples, header_examples, ingest_report, ingest_trip_files, land_as_text
from tripflow.plans.station_day import station_day
from tripflow.plans.stations import load_stations, station_dimension
from tripflow.plans.tiles import Slice, tile_store, tiles
from tripflow.plans.trip_mart import trip_mart
from tripflow.plans.weather import load_weather
from tripflow.session import scratch_path
from tripflow.sinks.publish import publish_partitions
from tripflow.sinks.writers import save_bucketed, write_by_day, write_partitioned
from tripflow.sources import driver_tables as dt
from tripflow.sources.trip_files import read_trip_files
from tripflow.sources.folder_source import register as register_folder_source
from tripflow.sources.warehouse import read_source, read_wildcard, read_years

# Market segments of the driver data play the user types.
USERTYPES = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
RANGE = ("1996-03-01", "1998-10-31")
AREA_CELL = 2.0  # plane units; an area square is 8 x 8
BIKE_BUCKETS = 16
NEAREST_M = 60.0  # trip coordinates lie up to 50 m off their station

Query = Callable[[SparkSession, str], DataFrame]


def weather_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_weather(dt.weather_raw_view(spark, sf_dir), years=None)


def trip_mart_of(spark: SparkSession, sf_dir: str, weather: bool = False) -> DataFrame:
    days = weather_of(spark, sf_dir) if weather else None
    return trip_mart(dt.trips_view(spark, sf_dir), dt.stations_view(spark, sf_dir), days, years=None)


def station_day_of(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    return station_day(dt.trips_view(spark, sf_dir), dt.stations_view(spark, sf_dir), **{"date_range": None, **how})


def on_mart(report: Callable[..., DataFrame], **how) -> Query:
    return lambda s, d: report(trip_mart_of(s, d), **how)


def on_station_days(report: Callable[..., DataFrame]) -> Query:
    return lambda s, d: report(station_day_of(s, d))


def q_sliced_station_flows(spark, sf_dir):
    wet = slice_trips(
        trip_mart_of(spark, sf_dir, weather=True), seasons=("Summer", "Fall"), times_of_day=("Morning", "Evening"), rain=("Rain",)
    )
    return R.station_flows(wet)


def q_sliced_station_metrics(spark, sf_dir):
    days = slice_station_days(station_day_of(spark, sf_dir), date_range=RANGE, boroughs=("ASIA", "EUROPE"))
    return R.station_metrics(days)


def q_station_rush_hours(spark, sf_dir):
    """Station metrics of mornings and evenings, from rows by time of day."""
    hours = station_day_of(spark, sf_dir, by_time_of_day=True)
    return R.station_metrics(slice_station_days(hours, times_of_day=("Morning", "Evening")))


def q_route_distances(spark, sf_dir):
    """G2 over every route that occurs: great-circle km between the route's stations."""
    routes = dt.trips_view(spark, sf_dir).select("start_station_name", "end_station_name").distinct()
    st = dt.stations_view(spark, sf_dir).select("name", "latitude", "longitude")
    s = st.toDF("start_station_name", "s_lat", "s_lon")
    e = st.toDF("end_station_name", "e_lat", "e_lon")
    return routes.join(s, "start_station_name").join(e, "end_station_name").select(
        "start_station_name",
        "end_station_name",
        (haversine_m("s_lat", "s_lon", "e_lat", "e_lon") / F.lit(1000.0)).alias("distance_km"),
    )


def q_nearest_station(spark, sf_dir):
    """Trips by the station nearest to where they start, within reach or none."""
    trips = dt.trips_view(spark, sf_dir).select("start_station_latitude", "start_station_longitude")
    near = match_stations(
        trips, dt.stations_view(spark, sf_dir), "start_station_latitude", "start_station_longitude", "near_", ["name"],
        how="nearest", max_distance_m=NEAREST_M, join_type="left",
    )
    return near.groupBy("start_station_latitude", "start_station_longitude", "near_name").agg(F.count(F.lit(1)).alias("trips"))


def q_points_in_areas(spark, sf_dir):
    pts = dt.customer_points(spark, sf_dir)
    areas = dt.areas_view(spark, sf_dir, with_regions=True)
    return points_in_areas(pts, areas, AREA_CELL, ["borough", "neighborhood"])


def q_station_dimension(spark, sf_dir):
    info, status = dt.supplier_sites(spark, sf_dir)
    return station_dimension(info, status, dt.areas_view(spark, sf_dir), cell_size=AREA_CELL)


def q_parse_trip_times(spark, sf_dir):
    """Event times rendered in the layouts trip files use, parsed back."""
    ev = dt.load(spark, sf_dir, "events")
    k = F.col("event_id") % 4
    text = (
        F.when(F.col("event_type") == "error", F.lit("n/a"))
        .when(k == 0, F.date_format("ts", "M/d/yyyy H:mm"))
        .when(k == 1, F.date_format("ts", "M/d/yyyy H:mm:ss"))
        .when(k == 2, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    )
    return ev.select("event_id", text.alias("time_text")).withColumn("parsed", parse_time("time_text"))


def q_textual_nulls(spark, sf_dir):
    """Events whose type survives the null policy; some are rendered as null, 'nan' or blank."""
    k = F.col("event_id") % 7
    text = F.when(k == 0, F.lit("nan")).when(k == 1, F.lit("  ")).when(k == 2, F.lit(" NaN ")).when(k != 3, F.col("event_type"))
    return drop_textual_nulls(dt.load(spark, sf_dir, "events").select("event_id", text.alias("event_type")), ["event_type"])


def q_numeric_coerce(spark, sf_dir):
    """Event values rendered as a feed's text, coerced back to whole numbers."""
    k, whole = F.col("event_id") % 5, F.col("user_id").cast("string")
    text = (
        F.when(k == 0, whole).when(k == 1, F.concat(whole, F.lit(".0"))).when(k == 2, F.concat(whole, F.lit(".75"))).when(k == 3, F.lit("x"))
    )
    return dt.load(spark, sf_dir, "events").select("event_id", text.alias("value_text")).withColumn("whole", to_whole_number("value_text"))


# --- queries that write and read back


def q_trip_file_ingest(spark, sf_dir):
    """Trips rendered to monthly text files in two layouts and ingested back: every stored column."""
    landing, store = scratch_path(spark, "landing"), scratch_path(spark, "trip-store")
    land_as_text(dt.trips_view(spark, sf_dir, by_month=True), landing)
    ingest_trip_files(spark, landing, store, month_from_folder=True)
    return spark.read.parquet(store)


def q_header_layout_union(spark, sf_dir):
    """Order rows as files of three layouts, one with a new column and one in a folder with a space."""
    landing = scratch_path(spark, "layouts")
    header_examples(dt.load(spark, sf_dir, "orders"), landing)
    return read_trip_files(spark, landing, month_from_folder=True)


def q_month_reload(spark, sf_dir):
    """Trip months published through a catalog table, of which one year is loaded again with other rows: its months are
    replaced, each in one step, other months stay."""
    store, table = scratch_path(spark, "months"), "tripflow_month_reload"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    trips = dt.trips_view(spark, sf_dir).select("tripduration", "starttime", "usertype", "bikeid")
    trips = trips.withColumn("year_month", F.date_format("starttime", "yyyy_MM"))
    publish_partitions(trips, table, store)
    again = trips.where(year_range("starttime", 1997, 1997) & (F.col("tripduration") >= 1800))
    publish_partitions(again.withColumn("usertype", F.lit("reloaded")), table, store)
    return spark.table(table).groupBy("year_month", "usertype").agg(F.count(F.lit(1)).alias("trips"), F.sum("tripduration").alias("seconds"))


def q_trips_by_day_store(spark, sf_dir):
    """The day-partitioned, bike-clustered store."""
    store = scratch_path(spark, "days")
    trips = dt.trips_view(spark, sf_dir).select("bikeid", "tripduration", "usertype", "start_day")
    write_by_day(trips, store)
    return spark.read.parquet(store)


def q_station_table_load(spark, sf_dir):
    """Station and area feeds as JSON files, through the station job, from its saved table."""
    folder = scratch_path(spark, "feeds")
    info, status = dt.supplier_sites(spark, sf_dir)
    dt.render_feeds(info, status, dt.areas_view(spark, sf_dir), folder)
    return load_stations(spark, folder, "tripflow_stations", cell_size=AREA_CELL)


def q_weather_table_load(spark, sf_dir):
    """Readings stored by year, the weather job over some of them, and its saved table."""
    readings = scratch_path(spark, "readings")
    write_partitioned(dt.weather_raw_view(spark, sf_dir), readings, ("year",))
    return load_weather(
        spark, read_years(spark, readings, 1996, 1999), "tripflow_weather", store=scratch_path(spark, "weather"), reload=True
    )


def q_weather_guarded_load(spark, sf_dir):
    """A weather table that is loaded once: a second load of other readings is skipped, and a reload of
    readings without rows leaves the table as it is."""
    table, store = "tripflow_weather_once", scratch_path(spark, "weather")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    readings = dt.weather_raw_view(spark, sf_dir)
    load_weather(spark, readings, table, store=store)
    load_weather(spark, lambda: readings.where("mo = '01'"), table, store=store)
    return load_weather(spark, readings.where("stn = 'none'"), table, store=store, reload=True)


NEEDED = ("tripduration", "starttime", "bikeid")


def _flawed_ingest(spark, sf_dir):
    landing, store, table = scratch_path(spark, "flawed"), scratch_path(spark, "trips"), "tripflow_flawed_trips"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    flawed_examples(dt.load(spark, sf_dir, "orders"), landing)
    return ingest_report(spark, landing, store, NEEDED, publish=table, on_unknown="skip"), spark.table(table)


def q_flawed_trip_files(spark, sf_dir):
    """Order rows as trip files with bad and missing cells, the month in the files' names: the typed rows that were kept."""
    _, stored = _flawed_ingest(spark, sf_dir)
    return stored.select("tripduration", "starttime", "bikeid", "usertype", "birth_year", "start_day", "year_month")


def q_ingest_counts(spark, sf_dir):
    """What the ingest of those files counted while it wrote: rows and cells by what was wrong, files not read by why."""
    report, _ = _flawed_ingest(spark, sf_dir)
    return report.frame(spark).where("measure <> 'files: read'")  # how many files months have is the writer's choice


def q_weather_sibling_tables(spark, sf_dir):
    """Readings as one table a year, read by a pattern of names within bounds: other years' tables are not opened."""
    root = scratch_path(spark, "siblings")
    write_partitioned(dt.weather_raw_view(spark, sf_dir), root, ("year",))
    first = dt.load(spark, sf_dir, "lineitem").agg(F.year(F.min("l_shipdate")), F.year(F.max("l_shipdate"))).first()
    for year in range(first[0] or 0, (first[1] or -1) + 1):
        spark.sql(f"DROP TABLE IF EXISTS tripflow_gsod{year}")
        spark.catalog.createTable(f"tripflow_gsod{year}", f"{root}/year={year}", "parquet")
    return daily_weather(read_wildcard(spark, "tripflow_gsod*", "1996", "1999", suffix_column="year"), years=None)


def q_weather_by_connector(spark, sf_dir):
    """Readings through a connector that runs a query on its side and takes the year filter too."""
    root = scratch_path(spark, "warehouse")
    dt.weather_raw_view(spark, sf_dir).write.parquet(root)
    query = "SELECT stn, year, mo, da, temp, visib, wdsp, gust, prcp, sndp FROM source WHERE stn <> '725053'"
    return daily_weather(read_source(spark, query=query, fmt=register_folder_source(spark), options={"path": root}), years=(1996, 1999))


SLICES = {
    "all": Slice(),
    "autumn mornings and evenings": Slice(date_range=("1996-09-01", "1996-11-30"), times_of_day=("Morning", "Evening")),
    "two segments in asia": Slice(usertypes=("BUILDING", "MACHINERY"), boroughs=("ASIA",)),
    "northern nights": Slice(times_of_day=("Night",), neighborhoods=("EUROPE North", "AMERICA North"), usertypes=("FURNITURE",)),
}


def q_sliced_tiles(spark, sf_dir):
    """The tiles R1-R4 of several slices, all from a store of station-day counts that is made once."""
    store = scratch_path(spark, "tiles")
    write_partitioned(tile_store(dt.trips_view(spark, sf_dir)).withColumn("year", F.year("trip_date")), store, ("year",))
    return tiles(spark.read.parquet(store), dt.stations_view(spark, sf_dir), SLICES)


def q_distinct_bikes_sketched(spark, sf_dir):
    """Bikes seen at each start station: exact, and whether the estimate from monthly sketches lies within its stated error."""
    store = scratch_path(spark, "sketches")
    trips = dt.trips_view(spark, sf_dir).select("start_station_name", F.date_format("starttime", "yyyy_MM").alias("year_month"), "bikeid")
    write_partitioned(distinct_sketches(trips, ["start_station_name", "year_month"], "bikeid"), store)
    about = merged_distinct(spark.read.parquet(store), ["start_station_name"])
    exact = trips.groupBy("start_station_name").agg(F.count_distinct("bikeid").alias("bikes"))
    off = F.abs(F.col("about") - F.col("bikes"))
    return exact.join(about, "start_station_name").select("start_station_name", "bikes", (off <= F.col("bikes") * relative_error()).alias("within_error"))


def q_bike_usage(spark, sf_dir):
    """Trips, seconds and days of each bike, from a table dealt into buckets by bike: no exchange."""
    table = "tripflow_trips_by_bike"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    trips = dt.trips_view(spark, sf_dir).select("bikeid", "tripduration", "start_day")
    save_bucketed(trips, table, "bikeid", BIKE_BUCKETS, scratch_path(spark, "bikes"))
    return R.bike_usage(spark.table(table))


def q_station_status_rows(spark, sf_dir):
    """Stations of the dimension job with how many rows each has when it appears once for each of its status rows."""
    info, status = dt.supplier_sites(spark, sf_dir)
    rows = station_dimension(info, status, dt.areas_view(spark, sf_dir), cell_size=AREA_CELL, status_join="inner")
    return rows.groupBy("station_id", "name", "neighborhood").agg(F.count(F.lit(1)).alias("rows"))


def q_point_parts(spark, sf_dir):
    """Trip starts as point text and taken apart again; text without two numbers gives nulls."""
    trips = dt.trips_view(spark, sf_dir).select("start_station_latitude", "start_station_longitude", "bikeid")
    text = F.when(F.col("bikeid") % 5 == 0, "none").when(F.col("bikeid") % 7 == 0, F.col("start_station_latitude").cast("string"))
    text = text.otherwise(point_text("start_station_latitude", "start_station_longitude"))
    points = trips.select(text.alias("point"), "start_station_latitude", "start_station_longitude")
    lat, lon = point_part("point", 0), point_part("point", 1)
    same = (lat == F.col("start_station_latitude")) & (lon == F.col("start_station_longitude"))
    return points.agg(
        F.count(F.lit(1)).alias("points"), F.count(lat).alias("latitudes"), F.count(lon).alias("longitudes"), F.count_if(same).alias("same")
    )


WRITERS: dict[str, Query] = {
    "weather_sibling_tables": q_weather_sibling_tables,
    "weather_by_connector": q_weather_by_connector,
    "sliced_tiles": q_sliced_tiles,
    "distinct_bikes_sketched": q_distinct_bikes_sketched,
    "bike_usage": q_bike_usage,
    "trip_file_ingest": q_trip_file_ingest,
    "header_layout_union": q_header_layout_union,
    "month_reload": q_month_reload,
    "trips_by_day_store": q_trips_by_day_store,
    "station_table_load": q_station_table_load,
    "weather_table_load": q_weather_table_load,
    "weather_guarded_load": q_weather_guarded_load,
    "flawed_trip_files": q_flawed_trip_files,
    "ingest_counts": q_ingest_counts,
}

QUERIES: dict[str, Query] = {
    "station_day_flow": lambda s, d: station_day_flow(dt.trips_view(s, d)),
    "station_congestion": lambda s, d: station_day_of(s, d, sort=True),
    "station_congestion_range": lambda s, d: station_day_of(s, d, date_range=RANGE),
    "daily_weather": lambda s, d: daily_weather(dt.weather_raw_view(s, d), years=None, sort=True),
    "trip_mart": lambda s, d: trip_mart_of(s, d, weather=True),
    "kpi_tiles": lambda s, d: R.kpi_tiles(trip_mart_of(s, d), station_day_of(s, d)),
    "active_stations": lambda s, d: R.active_stations(dt.trips_view(s, d)),
    "unmatched_trips": lambda s, d: R.unmatched_trips(dt.trips_view(s, d), dt.stations_view(s, d)),
    "route_busiest_month": on_mart(R.route_busiest_month),
    "latest_month_top_routes": on_mart(R.latest_month_top_routes, k=10),
    "monthly_by_usertype": on_mart(R.monthly_by_usertype),
    "time_of_day_hist": on_mart(R.trips_by_time_of_day),
    "season_hist": on_mart(R.trips_by_season),
    "start_station_map": lambda s, d: R.start_station_map(trip_mart_of(s, d), dt.stations_view(s, d)),
    "start_area_summary": on_mart(R.start_area_summary, usertypes=USERTYPES[:4]),
    "top_destinations": on_mart(R.top_destinations, k=10),
    "station_flows": on_mart(R.station_flows),
    "sliced_station_flows": q_sliced_station_flows,
    "utilization_by_month": on_station_days(R.utilization_by_month),
    "net_flow_map": on_station_days(R.net_flow_map),
    "station_metrics": on_station_days(R.station_metrics),
    "sliced_station_metrics": q_sliced_station_metrics,
    "station_rush_hours": q_station_rush_hours,
    "weather_usage": lambda s, d: R.weather_usage(station_day_of(s, d), weather_of(s, d)),
    "weather_correlation": lambda s, d: R.weather_correlation(station_day_of(s, d), weather_of(s, d)),
    "route_distances": q_route_distances,
    "nearest_station": q_nearest_station,
    "points_in_areas": q_points_in_areas,
    "station_dimension": q_station_dimension,
    "station_status_rows": q_station_status_rows,
    "point_parts": q_point_parts,
    "parse_trip_times": q_parse_trip_times,
    "textual_nulls": q_textual_nulls,
    "numeric_coerce": q_numeric_coerce,
    **WRITERS,
}


q_station_congestion = QUERIES["station_congestion"]
