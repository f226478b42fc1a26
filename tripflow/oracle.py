"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written from the definitions of the results, not from any plan: the flow of a
station is the sum over the sides of its trips, labels of hours, months and rates
come from tables of values written out here, so that a wrong constant of the library shows, distances are computed once for each pair
of positions. Views over the driver tables repeat ``sources.driver_tables``.
"""

from __future__ import annotations

STATIONS_V = """
stations_v AS (
  SELECT CAST(n.n_nationkey AS VARCHAR) AS station_id,
         n.n_name AS name,
         'S' || lpad(CAST(n.n_nationkey AS VARCHAR), 3, '0') AS short_name,
         CAST(40600000 + CAST(n.n_nationkey AS BIGINT) * 12340 + 310 AS DOUBLE) / 1000000 AS latitude,
         -(CAST(73900000 + CAST(n.n_nationkey AS BIGINT) * 8760 + 470 AS DOUBLE) / 1000000) AS longitude,
         CAST(n.n_regionkey AS BIGINT) AS region_id,
         CAST(n.n_nationkey % 8 AS BIGINT) AS capacity,
         r.r_name AS borough,
         r.r_name || CASE WHEN n.n_nationkey % 2 = 0 THEN ' North' ELSE ' South' END AS neighborhood
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

TRIPS_V = """
trips_base AS (
  SELECT CAST((l.l_partkey * 31 + l.l_suppkey * 17 + l.l_linenumber) % 3600 AS INTEGER) AS tripduration,
         l.l_shipdate + to_seconds(((l.l_orderkey * 7 + l.l_linenumber * 13) % 1440) * 60 + l.l_partkey % 60) AS starttime,
         s.s_nationkey, s.s_suppkey, c.c_nationkey, c.c_custkey, c.c_mktsegment, l.l_partkey
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
trips_v AS (
  SELECT b.tripduration,
         b.starttime,
         b.starttime + to_seconds(b.tripduration) AS stoptime,
         CAST(b.s_nationkey AS INTEGER) AS start_station_id,
         ns.n_name AS start_station_name,
         CAST(40600000 + CAST(b.s_nationkey AS BIGINT) * 12340 + 310 + (b.s_suppkey % 5 - 2) * 200 AS DOUBLE) / 1000000 AS start_station_latitude,
         -(CAST(73900000 + CAST(b.s_nationkey AS BIGINT) * 8760 + 470 + (b.s_suppkey % 5 - 2) * 200 AS DOUBLE) / 1000000) AS start_station_longitude,
         CAST(b.c_nationkey AS INTEGER) AS end_station_id,
         ne.n_name AS end_station_name,
         CAST(40600000 + CAST(b.c_nationkey AS BIGINT) * 12340 + 310 + (b.c_custkey % 5 - 2) * 200 AS DOUBLE) / 1000000 AS end_station_latitude,
         -(CAST(73900000 + CAST(b.c_nationkey AS BIGINT) * 8760 + 470 + (b.c_custkey % 5 - 2) * 200 AS DOUBLE) / 1000000) AS end_station_longitude,
         CAST(b.l_partkey % 2000000000 AS INTEGER) AS bikeid,
         b.c_mktsegment AS usertype,
         CAST(1940 + b.c_custkey % 60 AS INTEGER) AS birth_year,
         CAST(b.c_custkey % 3 AS VARCHAR) AS gender,
         b.starttime AS start_date,
         CAST(b.starttime AS DATE) AS start_day
  FROM trips_base b
  JOIN nation ns ON b.s_nationkey = ns.n_nationkey
  JOIN nation ne ON b.c_nationkey = ne.n_nationkey
)"""

WEATHER_RAW_V = """
weather_raw AS (
  SELECT CASE l_returnflag WHEN 'A' THEN '725030' WHEN 'N' THEN '744860' ELSE '725053' END AS stn,
         CAST(year(l_shipdate) AS VARCHAR) AS year,
         lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0') AS mo,
         lpad(CAST(day(l_shipdate) AS VARCHAR), 2, '0') AS da,
         CASE WHEN l_quantity = 50 THEN 9999.9 ELSE l_quantity + 20 END AS temp,
         CASE WHEN l_linenumber = 7 THEN 999.9 ELSE l_linenumber * 1.5 END AS visib,
         CASE WHEN l_tax = 0.08 THEN '999.9' ELSE CAST(CAST(l_linenumber * 2 + 0.5 AS DOUBLE) AS VARCHAR) END AS wdsp,
         CASE WHEN l_discount = 0 THEN 999.9 ELSE round(l_discount * 100) END AS gust,
         CASE WHEN l_quantity = 49 THEN 99.99 WHEN l_tax <= 0.02 THEN 0.0 ELSE l_linenumber / 4.0 END AS prcp,
         CASE WHEN l_linestatus = 'O' THEN 999.9 ELSE CAST(floor(l_quantity / 8) AS DOUBLE) END AS sndp
  FROM lineitem
)"""

# what a missing-value code stands for is no reading
_MEANS = """
  avg(nullif(temp::DOUBLE, 9999.9)) AS temperature, avg(nullif(visib::DOUBLE, 999.9)) AS visibility, avg(nullif(wdsp::DOUBLE, 999.9)) AS wind_speed,
  avg(nullif(gust::DOUBLE, 999.9)) AS wind_gust, avg(nullif(prcp::DOUBLE, 99.99)) AS precipitation, avg(nullif(sndp::DOUBLE, 999.9)) AS snow_depth"""
_PLACES = "'725030', '744860'"

WEATHER_V = f"""
weather_v AS (
  SELECT strptime(year || mo || da, '%Y%m%d') AS timestamp, {_MEANS}
  FROM weather_raw WHERE stn IN ({_PLACES}) GROUP BY ALL
)"""


def with_views(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def _label_table(name: str, labels: dict[int, str]) -> str:
    return f"{name}(n, label) AS (VALUES " + ", ".join(f"({n}, '{v}')" for n, v in labels.items()) + ")"


_HOURS = {h: "Morning" if 5 <= h <= 11 else "Afternoon" if 12 <= h <= 16 else "Evening" if 17 <= h <= 20 else "Night" for h in range(24)}
_MONTHS = {m: "Spring" if m in (3, 4, 5) else "Summer" if m in (6, 7, 8) else "Fall" if m in (9, 10, 11) else "Winter" for m in range(1, 13)}

# every trip has two sides: it leaves a station on one day and reaches one on another or the same
FLOW_V = """
sides AS (
  SELECT start_station_name AS place, starttime::DATE AS day, TRUE AS leaves FROM trips_v
  UNION ALL
  SELECT end_station_name, stoptime::DATE, FALSE FROM trips_v
),
flow AS (
  SELECT place, day, count_if(leaves) AS left_here, count_if(NOT leaves) AS came_here
  FROM sides WHERE place IS NOT NULL AND day IS NOT NULL GROUP BY ALL
)"""

RATES_V = """
rates AS (
  SELECT f.*, s.*, (left_here + came_here) / nullif(s.capacity, 0) AS rate, abs(came_here - left_here) / nullif(s.capacity, 0) AS stress
  FROM flow f JOIN stations_v s ON s.name = f.place
  WHERE s.borough IS NOT NULL
),
station_day AS (
  SELECT day AS trip_date, place AS station_name, borough, neighborhood, latitude, longitude, capacity,
         left_here::BIGINT AS trips_started, came_here::BIGINT AS trips_ended, (came_here - left_here)::BIGINT AS net_flow,
         rate AS trips_per_dock, stress AS flow_stress_score,
         if(rate > 15, 'Overused', if(rate < 6, 'Underused', 'Efficient')) AS utilization_status
  FROM rates
)"""


def _great_circle_km(a: str, b: str) -> str:
    """Kilometres between the (lat, lon) columns of aliases ``a`` and ``b``."""
    half = "pow(sin((radians({1}) - radians({0})) / 2), 2)"
    haversine = (
        half.format(f"{a}lat", f"{b}lat") + f" + cos(radians({a}lat)) * cos(radians({b}lat)) * " + half.format(f"{a}lon", f"{b}lon")
    )
    return f"{2 * 6371010.0}::DOUBLE * asin(sqrt(least({haversine}, 1.0))) / 1000"


# a position belongs to the stations that it agrees with at three decimals
MART_V = f"""
{_label_table("hours", _HOURS)},
{_label_table("months", _MONTHS)},
spots AS (SELECT round(latitude, 3) AS y, round(longitude, 3) AS x, borough, neighborhood FROM stations_v),
legs AS (
  SELECT DISTINCT start_station_latitude AS a_lat, start_station_longitude AS a_lon,
                  end_station_latitude AS b_lat, end_station_longitude AS b_lon
  FROM trips_v
),
placed AS (
  SELECT legs.*, {_great_circle_km("a_", "b_")} AS km,
         p.borough AS start_borough, p.neighborhood AS start_neighborhood, q.borough AS end_borough, q.neighborhood AS end_neighborhood
  FROM legs
  JOIN spots p ON p.y = round(a_lat, 3) AND p.x = round(a_lon, 3)
  JOIN spots q ON q.y = round(b_lat, 3) AND q.x = round(b_lon, 3)
),
days AS (
  SELECT day AS start_date, isodow(day)::INT % 7 + 1 AS day_of_week, month(day)::INT AS month, year(day)::INT AS year, months.label AS season
  FROM (SELECT DISTINCT starttime::DATE AS day FROM trips_v) JOIN months ON months.n = month(day)
),
dry_mart AS (
  SELECT t.usertype, t.start_station_name, t.end_station_name, days.*, hours.label AS time_of_day,
         round(t.tripduration / 60, 2) AS trip_minute,
         a_lat || ',' || a_lon AS start_point, b_lat || ',' || b_lon AS end_point,
         placed.* EXCLUDE (a_lat, a_lon, b_lat, b_lon, km),
         a_lat AS start_lat, a_lon AS start_lon, b_lat AS end_lat, b_lon AS end_lon, km AS trip_distance_km,
         round(km / nullif(round(t.tripduration / 60, 2) / 60, 0), 2) AS trip_avg_speed_kmh
  FROM trips_v t
  JOIN placed ON (t.start_station_latitude, t.start_station_longitude, t.end_station_latitude, t.end_station_longitude) = (a_lat, a_lon, b_lat, b_lon)
  JOIN days ON days.start_date = t.starttime::DATE
  JOIN hours ON hours.n = hour(t.starttime)
)"""

WET_MART_V = """
trip_mart AS (
  SELECT m.*, w.temperature, w.visibility, w.wind_speed, w.precipitation
  FROM dry_mart m LEFT JOIN weather_v w ON w.timestamp::DATE = m.start_date
)"""

FLOW = with_views(TRIPS_V, FLOW_V)
STATION_DAYS = with_views(STATIONS_V, TRIPS_V, FLOW_V, RATES_V)
DRY_MART = with_views(STATIONS_V, TRIPS_V, MART_V)
WET_MART = with_views(STATIONS_V, TRIPS_V, WEATHER_RAW_V, WEATHER_V, MART_V, WET_MART_V)

USERTYPES = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD")
RANGE = ("1996-03-01", "1998-10-31")
IN_RANGE = f"trip_date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'"


def _fixed_mean(x: str, where: str = "TRUE", decimals: int = 2) -> str:
    scale = 10**decimals
    units = f"round({x} * {scale})::BIGINT"
    return f"sum({units}) FILTER ({where})::DOUBLE / nullif(count({x}) FILTER ({where}), 0) / {scale}::DOUBLE"


def _area_summary() -> str:
    columns = ["count(*) AS trips"]
    for u in USERTYPES:
        columns.append(f"count_if(usertype = '{u}') AS trips_{u.lower()}")
        columns.append(_fixed_mean("trip_minute", f"usertype = '{u}'") + f" AS avg_minute_{u.lower()}")
    return f"{DRY_MART} SELECT start_borough, start_neighborhood, {', '.join(columns)} FROM dry_mart GROUP BY ALL"


def _station_flows(mart: str, where: str = "TRUE") -> str:
    return f"""
SELECT start_station_name, end_station_name, start_neighborhood, end_neighborhood,
       count(*) AS trips, {_fixed_mean("trip_avg_speed_kmh")} AS avg_speed_kmh
FROM {mart} WHERE {where} GROUP BY ALL
"""


ROUTE = "start_station_name || ' -> ' || end_station_name AS route"
ROUTE_MONTHS = """,
route_months AS (
  SELECT start_station_name, end_station_name, date_trunc('month', start_date)::DATE AS trip_month, count(*) AS trips
  FROM dry_mart GROUP BY ALL
)"""
DAILY = """,
daily AS (
  SELECT d.*, w.temperature, w.precipitation, w.wind_speed
  FROM (SELECT trip_date, sum(trips_started)::BIGINT AS daily_trips FROM station_day GROUP BY ALL) d
  LEFT JOIN weather_v w ON w.timestamp::DATE = d.trip_date
)"""
DAYS_AND_WEATHER = with_views(STATIONS_V, TRIPS_V, FLOW_V, RATES_V, WEATHER_RAW_V, WEATHER_V) + DAILY
STATION_METRICS = """
SELECT borough, neighborhood, station_name, round(avg(trips_per_dock), 6) AS utilization_rate,
       avg(net_flow) AS avg_net_flow, round(avg(flow_stress_score), 6) AS flow_stress_score
FROM station_day WHERE {} GROUP BY ALL
"""

ORACLE_SQL: dict[str, str] = {
    "station_day_flow": FLOW + """
SELECT place AS station_name, day AS trip_date, left_here::BIGINT AS trips_started, came_here::BIGINT AS trips_ended,
       (came_here - left_here)::BIGINT AS net_flow
FROM flow
""",
    "station_congestion": STATION_DAYS + "SELECT * FROM station_day",
    "station_congestion_range": f"{STATION_DAYS} SELECT * FROM station_day WHERE {IN_RANGE}",
    "daily_weather": with_views(WEATHER_RAW_V, WEATHER_V) + "SELECT * FROM weather_v",
    "trip_mart": WET_MART + "SELECT * FROM trip_mart",
    "kpi_tiles": with_views(STATIONS_V, TRIPS_V, FLOW_V, RATES_V, MART_V) + """,
tiles AS (
  SELECT (SELECT count(*) FROM dry_mart)::DOUBLE AS total_trips, count(DISTINCT station_name)::DOUBLE AS active_stations,
         round(avg(trips_per_dock), 6) AS utilization_rate, avg(net_flow) AS avg_net_flow
  FROM station_day
)
UNPIVOT tiles ON COLUMNS(*) INTO NAME metric VALUE value
""",
    "active_stations": FLOW + "SELECT count(DISTINCT place) AS active_stations FROM sides",
    "unmatched_trips": with_views(STATIONS_V, TRIPS_V) + """,
known AS (SELECT DISTINCT round(latitude, 3) AS y, round(longitude, 3) AS x FROM stations_v),
seen AS (
  SELECT (round(start_station_latitude, 3), round(start_station_longitude, 3)) IN (SELECT (y, x) FROM known) AS s,
         (round(end_station_latitude, 3), round(end_station_longitude, 3)) IN (SELECT (y, x) FROM known) AS e
  FROM trips_v
)
SELECT count(*) AS trips, count_if(s AND e) AS matched, count_if(NOT s) AS start_unmatched, count_if(NOT e) AS end_unmatched FROM seen
""",
    "route_busiest_month": DRY_MART + ROUTE_MONTHS + f"""
SELECT start_station_name, end_station_name, {ROUTE},
       max_by(trip_month, (trips, trip_month)) AS busiest_month, max(trips) AS trips_in_month
FROM route_months GROUP BY start_station_name, end_station_name
""",
    "latest_month_top_routes": DRY_MART + ROUTE_MONTHS + f"""
SELECT trip_month AS latest_month, start_station_name, end_station_name, {ROUTE}, trips AS trips_in_month
FROM route_months QUALIFY trip_month = max(trip_month) OVER ()
ORDER BY trips DESC, start_station_name, end_station_name LIMIT 10
""",
    "monthly_by_usertype": DRY_MART + """
SELECT date_trunc('month', start_date)::DATE AS trip_month, usertype, count(*) AS trips FROM dry_mart GROUP BY ALL
""",
    "time_of_day_hist": DRY_MART + "SELECT time_of_day, count(*) AS trips FROM dry_mart GROUP BY ALL",
    "season_hist": DRY_MART + "SELECT season, count(*) AS trips FROM dry_mart GROUP BY ALL",
    "start_station_map": DRY_MART + """
SELECT m.start_station_name, count(*) AS trips, s.latitude, s.longitude, s.borough, s.neighborhood
FROM dry_mart m LEFT JOIN stations_v s ON s.name = m.start_station_name GROUP BY ALL
""",
    "start_area_summary": _area_summary(),
    "top_destinations": DRY_MART + """
SELECT end_borough, end_neighborhood, count(*) AS trips,
       row_number() OVER (ORDER BY count(*) DESC, end_borough, end_neighborhood)::INT AS rank
FROM dry_mart GROUP BY end_borough, end_neighborhood QUALIFY rank <= 10
""",
    "station_flows": DRY_MART + _station_flows("dry_mart"),
    "sliced_station_flows": WET_MART
    + _station_flows("trip_mart", "season IN ('Summer', 'Fall') AND time_of_day IN ('Morning', 'Evening') AND precipitation > 0"),
    "utilization_by_month": STATION_DAYS + """
SELECT date_trunc('month', trip_date)::DATE AS trip_month, round(avg(trips_per_dock), 6) AS utilization_rate FROM station_day GROUP BY ALL
""",
    "net_flow_map": STATION_DAYS + """
SELECT station_name, latitude, longitude, avg(net_flow) AS avg_net_flow, sum(trips_started + trips_ended)::BIGINT AS trip_count,
       ['Origin (shortage)', 'Balanced', 'Destination (surplus)'][sign(avg(net_flow))::INT + 2] AS flow_class
FROM station_day GROUP BY station_name, latitude, longitude
""",
    "station_metrics": STATION_DAYS + STATION_METRICS.format("TRUE"),
    "sliced_station_metrics": STATION_DAYS + STATION_METRICS.format(f"{IN_RANGE} AND borough IN ('ASIA', 'EUROPE')"),
    "station_rush_hours": with_views(STATIONS_V, TRIPS_V) + f""",
{_label_table("hours", _HOURS)},
sides AS (
  SELECT start_station_name AS place, starttime AS moment, TRUE AS leaves FROM trips_v
  UNION ALL
  SELECT end_station_name, stoptime, FALSE FROM trips_v
),
flow AS (
  SELECT place, moment::DATE AS day, label, count_if(leaves) AS left_here, count_if(NOT leaves) AS came_here
  FROM sides JOIN hours ON n = hour(moment) WHERE label IN ('Morning', 'Evening') GROUP BY ALL
)""" + "," + RATES_V + STATION_METRICS.format("TRUE"),
    "weather_usage": DAYS_AND_WEATHER + """
SELECT coalesce(if(precipitation > 0, 'Rain', if(precipitation = 0, 'No rain', NULL)), 'Unknown') AS rain_condition,
       count(*) AS days, avg(daily_trips) AS avg_daily_trips, round(avg(temperature), 6) AS avg_temperature
FROM daily GROUP BY rain_condition
""",
    "weather_correlation": DAYS_AND_WEATHER + """
SELECT round(corr(daily_trips, temperature), 6) AS corr_temperature, round(corr(daily_trips, precipitation), 6) AS corr_precipitation,
       round(corr(daily_trips, wind_speed), 6) AS corr_wind_speed, count(*) AS days
FROM daily
""",
    "route_distances": with_views(STATIONS_V, TRIPS_V) + f""",
ends AS (SELECT name, latitude AS lat, longitude AS lon FROM stations_v)
SELECT start_station_name, end_station_name, {_great_circle_km("a.", "b.")} AS distance_km
FROM (SELECT DISTINCT start_station_name, end_station_name FROM trips_v)
JOIN ends a ON a.name = start_station_name JOIN ends b ON b.name = end_station_name
""",
    # brute force: every position against every station
    "nearest_station": with_views(STATIONS_V, TRIPS_V) + f""",
starts AS (
  SELECT start_station_latitude AS lat, start_station_longitude AS lon, count(*) AS trips FROM trips_v GROUP BY ALL
),
ends AS (SELECT name, latitude AS lat, longitude AS lon FROM stations_v),
near AS (
  SELECT a.lat, a.lon, min_by(b.name, ({_great_circle_km("a.", "b.")}, b.name)) AS name
  FROM starts a JOIN ends b ON {_great_circle_km("a.", "b.")} * 1000 <= 60 GROUP BY a.lat, a.lon
)
SELECT s.lat AS start_station_latitude, s.lon AS start_station_longitude, n.name AS near_name, s.trips
FROM starts s LEFT JOIN near n USING (lat, lon)
""",
    "textual_nulls": """
WITH shown AS (
  SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'nan' WHEN 1 THEN '  ' WHEN 2 THEN ' NaN ' WHEN 3 THEN NULL ELSE event_type END AS event_type
  FROM events
)
SELECT * FROM shown WHERE lower(trim(event_type)) NOT IN ('', 'nan')
""",
    "numeric_coerce": """
WITH shown AS (
  SELECT event_id, user_id, CASE event_id % 5 WHEN 0 THEN user_id::VARCHAR WHEN 1 THEN user_id || '.0' WHEN 2 THEN user_id || '.75' WHEN 3 THEN 'x' END AS value_text
  FROM events
)
SELECT event_id, value_text, if(event_id % 5 < 3, user_id, NULL) AS whole FROM shown
""",
    # a month of 1997 that has reloaded rows holds nothing else
    "month_reload": with_views(TRIPS_V) + """,
tagged AS (SELECT *, strftime(starttime, '%Y_%m') AS year_month, year(starttime) = 1997 AND tripduration >= 1800 AS anew FROM trips_v),
months AS (SELECT DISTINCT year_month FROM tagged WHERE anew)
SELECT year_month, if(anew, 'reloaded', usertype) AS usertype, count(*) AS trips, sum(tripduration)::BIGINT AS seconds
FROM tagged WHERE anew OR year_month NOT IN (FROM months) GROUP BY ALL
""",
    "weather_guarded_load": with_views(WEATHER_RAW_V, WEATHER_V) + "SELECT * FROM weather_v",
    "flawed_trip_files": """
SELECT (o_orderkey % 3600)::INT AS tripduration, o_orderdate::TIMESTAMP AS starttime, o_custkey::INT AS bikeid, o_orderpriority AS usertype,
       if(o_orderkey % 13 = 0, NULL, 1940 + o_orderkey % 60)::INT AS birth_year, o_orderdate::DATE AS start_day,
       strftime(o_orderdate, '%Y_%m') AS year_month
FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 4 <> 0
""",
    "ingest_counts": """
WITH o AS (
  SELECT o_orderkey % 5 = 0 AS bad, o_orderkey % 5 <> 0 AND o_orderkey % 7 = 0 AS none, o_orderkey % 11 = 0 AS untimed,
         o_orderkey % 4 = 0 AS unnumbered, o_orderkey % 13 = 0 AS unborn, o_orderkey % 2 = 0 AS coloured
  FROM orders
)
SELECT unnest(['rows_read', 'rows_stored', 'rows_rejected', 'missing_tripduration', 'unreadable_tripduration', 'missing_starttime',
               'unreadable_starttime', 'missing_bikeid', 'unreadable_bikeid', 'unreadable_birth_year', 'extra_cells',
               'unreadable_stoptime', 'unreadable_start_station_id', 'unreadable_start_station_latitude', 'unreadable_start_station_longitude',
               'unreadable_end_station_id', 'unreadable_end_station_latitude', 'unreadable_end_station_longitude',
               'files: no month', 'files: unknown header']) AS measure,
       unnest([count(*), count_if(NOT (bad OR none OR untimed OR unnumbered)), count_if(bad OR none OR untimed OR unnumbered), count_if(none),
               count_if(bad), 0, count_if(untimed), count_if(unnumbered), 0, count_if(unborn), count_if(coloured),
               0, 0, 0, 0, 0, 0, 0, 1, 1]) AS n
FROM o
""",
    "trips_by_day_store": with_views(TRIPS_V) + "SELECT bikeid, tripduration, usertype, start_day FROM trips_v",
    "weather_table_load": with_views(WEATHER_RAW_V, WEATHER_V) + "SELECT * FROM weather_v WHERE year(timestamp) BETWEEN 1996 AND 1999",
    "header_layout_union": """
WITH o AS (
  SELECT o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS time, strftime(o_orderdate, '%Y_%m') AS year_month,
         o_custkey::VARCHAR AS cust, o_orderpriority AS priority
  FROM orders
)
SELECT if(k % 3 = 2, NULL, if(k % 5 = 0, 'bad', (k % 3600)::VARCHAR)) AS tripduration, time AS starttime, NULL::VARCHAR AS stoptime,
       NULL::VARCHAR AS start_station_id, if(k % 3 = 2, NULL, 'St ' || (k % 7) || ', North') AS start_station_name,
       NULL::VARCHAR AS start_station_latitude, NULL::VARCHAR AS start_station_longitude, NULL::VARCHAR AS end_station_id,
       NULL::VARCHAR AS end_station_name, NULL::VARCHAR AS end_station_latitude, NULL::VARCHAR AS end_station_longitude,
       if(k % 4 = 0, NULL, cust) AS bikeid, if(k % 3 = 2, NULL, priority) AS usertype, NULL::VARCHAR AS birth_year, NULL::VARCHAR AS gender,
       year_month
FROM o
""",
    # odd months were written without seconds
    "trip_file_ingest": with_views(TRIPS_V) + """,
shown AS (
  SELECT * REPLACE (if(month(t.starttime) % 2 = 1, date_trunc('minute', t.starttime), t.starttime) AS starttime,
                    if(month(t.starttime) % 2 = 1, date_trunc('minute', t.stoptime), t.stoptime) AS stoptime)
  FROM trips_v t
)
SELECT * REPLACE (starttime AS start_date, starttime::DATE AS start_day), strftime(starttime, '%Y_%m') AS year_month FROM shown
""",
}

# --- spatial -------------------------------------------------------------------

NATION_SQUARES = """
nation_sq AS (
  SELECT CAST(n.n_nationkey AS VARCHAR) AS area_id, r.r_name AS borough, n.n_name AS neighborhood,
         n.n_regionkey AS region, CAST((n.n_nationkey % 5) * 10 AS DOUBLE) AS x0,
         CAST((n.n_nationkey // 5) * 10 AS DOUBLE) AS y0
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

# strictly inside the outer square and not in the closed hole
_IN_NATION = (
    "{x} > a.x0 AND {x} < a.x0 + 8 AND {y} > a.y0 AND {y} < a.y0 + 8 "
    "AND NOT ({x} >= a.x0 + 3 AND {x} <= a.x0 + 5 AND {y} >= a.y0 + 3 AND {y} <= a.y0 + 5)"
)

ORACLE_SQL.update(
    {
        "points_in_areas": with_views(NATION_SQUARES) + """,
pts AS (
  SELECT c_custkey AS point_id, CAST((c_custkey * 53) % 4900 AS DOUBLE) / 100 AS latitude,
         CAST((c_custkey * 37) % 4900 AS DOUBLE) / 100 AS longitude
  FROM customer
),
hits AS (
  SELECT p.point_id, a.area_id, a.borough, a.neighborhood
  FROM pts p JOIN nation_sq a ON """ + _IN_NATION.format(x="p.longitude", y="p.latitude") + """
  UNION ALL
  SELECT DISTINCT p.point_id, 'R' || CAST(a.region AS VARCHAR), a.borough, a.borough || ' (all)'
  FROM pts p JOIN nation_sq a
    ON p.longitude > a.x0 AND p.longitude < a.x0 + 8 AND p.latitude > a.y0 AND p.latitude < a.y0 + 8
)
SELECT p.point_id, p.latitude, p.longitude, h.area_id, h.borough, h.neighborhood
FROM pts p LEFT JOIN hits h ON p.point_id = h.point_id
""",
        "station_dimension": with_views(NATION_SQUARES) + """,
info AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS station_id, s_name AS name,
         CASE WHEN s_suppkey % 11 <> 0 THEN 'SS' || CAST(s_suppkey AS VARCHAR) END AS short_name,
         CAST((s_suppkey * 53) % 4900 AS DOUBLE) / 100 AS lat,
         CAST((s_suppkey * 37) % 4900 AS DOUBLE) / 100 AS lon,
         CASE WHEN s_suppkey % 13 = 0 THEN 'x' ELSE CAST(s_nationkey AS VARCHAR) || '.0' END AS region_id,
         CAST(s_suppkey % 40 AS VARCHAR) AS capacity
  FROM supplier
),
placed AS (
  SELECT i.station_id, i.name, i.short_name, i.lat AS latitude, i.lon AS longitude,
         TRY_CAST(TRY_CAST(i.region_id AS DOUBLE) AS BIGINT) AS region_id,
         TRY_CAST(TRY_CAST(i.capacity AS DOUBLE) AS BIGINT) AS capacity,
         a.borough, a.neighborhood
  FROM info i
  LEFT JOIN nation_sq a ON """ + _IN_NATION.format(x="i.lon", y="i.lat") + """
  WHERE i.station_id IN (SELECT CAST(l_suppkey AS VARCHAR) FROM lineitem)
)
SELECT * FROM placed
WHERE station_id IS NOT NULL AND name IS NOT NULL AND short_name IS NOT NULL AND latitude IS NOT NULL
  AND longitude IS NOT NULL AND region_id IS NOT NULL AND capacity IS NOT NULL
  AND borough IS NOT NULL AND neighborhood IS NOT NULL
""",
    }
)

# tiles of a slice: station-days of the sides that the slice lets through
_SLICES = {
    "all": "TRUE",
    "autumn mornings and evenings": "day BETWEEN DATE '1996-09-01' AND DATE '1996-11-30' AND (hour BETWEEN 5 AND 11 OR hour BETWEEN 17 AND 20)",
    "two segments in asia": "usertype IN ('BUILDING', 'MACHINERY') AND borough = 'ASIA'",
    "northern nights": "(hour < 5 OR hour > 20) AND usertype = 'FURNITURE' AND neighborhood IN ('EUROPE North', 'AMERICA North')",
}
_TILES = " UNION ALL ".join(
    f"""
SELECT '{name}' AS slice, sum(s)::BIGINT AS total_trips, count(DISTINCT place) AS active_stations,
       round(avg((s + e) / nullif(capacity, 0)), 6) AS utilization_rate, avg(e - s) AS avg_net_flow
FROM (SELECT place, day, capacity, count_if(leaves) AS s, count_if(NOT leaves) AS e FROM sides WHERE {where} GROUP BY ALL) HAVING count(*) > 0"""
    for name, where in _SLICES.items()
)

ORACLE_SQL.update(
    {
        "sliced_tiles": with_views(STATIONS_V, TRIPS_V) + """,
ends AS (
  SELECT start_station_name AS place, starttime AS moment, usertype, TRUE AS leaves FROM trips_v
  UNION ALL SELECT end_station_name, stoptime, usertype, FALSE FROM trips_v
),
sides AS (
  SELECT place, moment::DATE AS day, hour(moment) AS hour, usertype, leaves, borough, neighborhood, capacity
  FROM ends JOIN stations_v ON name = place
)""" + _TILES,
        "distinct_bikes_sketched": with_views(TRIPS_V) + """
SELECT start_station_name, count(DISTINCT bikeid) AS bikes, TRUE AS within_error FROM trips_v GROUP BY ALL
""",
        "bike_usage": with_views(TRIPS_V) + """
SELECT bikeid, count(*) AS trips, sum(tripduration)::BIGINT AS seconds, count(DISTINCT start_day) AS days FROM trips_v GROUP BY ALL
""",
        "weather_sibling_tables": ORACLE_SQL["weather_table_load"],
        "weather_by_connector": ORACLE_SQL["weather_table_load"],
        "station_status_rows": ORACLE_SQL["station_dimension"].replace(
            "SELECT * FROM placed", "SELECT p.station_id, p.name, p.neighborhood, count(*) AS rows FROM placed p JOIN lineitem l ON l.l_suppkey::VARCHAR = p.station_id"
        ).replace("WHERE station_id IS NOT NULL AND name", "WHERE p.station_id IS NOT NULL AND name") + " GROUP BY ALL",
        "point_parts": with_views(TRIPS_V) + """
SELECT count(*) AS points, count_if(bikeid % 5 <> 0) AS latitudes, count_if(bikeid % 5 <> 0 AND bikeid % 7 <> 0) AS longitudes,
       count_if(bikeid % 5 <> 0 AND bikeid % 7 <> 0) AS same
FROM trips_v
""",
    }
)

# the station job reads the same feeds from files and writes the same rows to its table
ORACLE_SQL["station_table_load"] = ORACLE_SQL["station_dimension"]

ORACLE_SQL.update(
    {
        "parse_trip_times": """
SELECT event_id,
       CASE WHEN event_type = 'error' THEN 'n/a'
            WHEN event_id % 4 = 0 THEN strftime(ts, '%-m/%-d/%Y %-H:%M')
            WHEN event_id % 4 = 1 THEN strftime(ts, '%-m/%-d/%Y %-H:%M:%S')
            WHEN event_id % 4 = 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
            ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS time_text,
       CASE WHEN event_type = 'error' THEN NULL
            WHEN event_id % 4 = 0 THEN date_trunc('minute', ts)
            ELSE date_trunc('second', ts) END AS parsed
FROM events
""",
    }
)
