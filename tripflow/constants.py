"""Fixed values the results depend on.

These must stay equal to the pipeline whose results we reproduce; they are
listed here plainly, in their natural order, so they can be checked at a glance.
"""

# --- Fixed values: trip file header synonyms (normalised header -> canonical name)
HEADER_SYNONYMS = {
    "tripduration": "tripduration",
    "trip_duration": "tripduration",
    "starttime": "starttime",
    "start_time": "starttime",
    "stoptime": "stoptime",
    "stop_time": "stoptime",
    "start_station_id": "start_station_id",
    "start_station_name": "start_station_name",
    "start_station_latitude": "start_station_latitude",
    "start_station_longitude": "start_station_longitude",
    "end_station_id": "end_station_id",
    "end_station_name": "end_station_name",
    "end_station_latitude": "end_station_latitude",
    "end_station_longitude": "end_station_longitude",
    "bikeid": "bikeid",
    "bike_id": "bikeid",
    "usertype": "usertype",
    "user_type": "usertype",
    "birth_year": "birth_year",
    "gender": "gender",
}

# --- Fixed values: trip time text layouts (Spark datetime patterns)
US_LAYOUT = "M/d/yyyy H:mm:ss"
US_LAYOUT_NO_SECONDS = "M/d/yyyy H:mm"
ISO_LAYOUT = "yyyy-MM-dd HH:mm:ss"
FRACTION_PATTERN = r"\.[0-9]+"
FILE_MONTH_PATTERN = r"^(\d{4})(\d{2})"

# --- Fixed values: time of day by hour (inclusive bands), anything else is Night
TIME_OF_DAY_BANDS = [
    ("Morning", 5, 11),
    ("Afternoon", 12, 16),
    ("Evening", 17, 20),
]
TIME_OF_DAY_OTHER = "Night"

# --- Fixed values: season by month, anything else is Winter
SEASON_MONTHS = [
    ("Summer", (6, 7, 8)),
    ("Fall", (9, 10, 11)),
    ("Spring", (3, 4, 5)),
]
SEASON_OTHER = "Winter"

# --- Fixed values: station-day utilisation labels (trips per dock)
OVERUSED_ABOVE = 15
UNDERUSED_BELOW = 6
OVERUSED = "Overused"
UNDERUSED = "Underused"
EFFICIENT = "Efficient"

# --- Fixed values: daily weather missing-value codes (column -> code)
WEATHER_SENTINELS = {
    "temp": 9999.9,
    "visib": 999.9,
    "wdsp": "999.9",
    "gust": 999.9,
    "prcp": 99.99,
    "sndp": 999.9,
}
# raw column -> output column
WEATHER_OUTPUTS = {
    "temp": "temperature",
    "visib": "visibility",
    "wdsp": "wind_speed",
    "gust": "wind_gust",
    "prcp": "precipitation",
    "sndp": "snow_depth",
}
WEATHER_STATIONS = ("725030", "744860")
WEATHER_YEARS = (2014, 2019)

# --- Fixed values: mart ranges
MART_YEARS = (2014, 2015, 2016)
STATION_DAY_RANGE = ("2014-01-01", "2016-12-31")

# --- Fixed values: textual null marker produced by str() of a missing value
TEXTUAL_NULLS = ("nan",)

# --- Sphere radius for great-circle distance, metres (public S2 library figure)
EARTH_RADIUS_M = 6371010.0
