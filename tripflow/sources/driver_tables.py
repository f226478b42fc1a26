"""Trip-, station-, weather- and area-shaped views over the driver's Parquet tables.

The driver tables hold orders, not bike trips, so the operators run on
analogous columns:

* a **trip** is a line item: it starts at its supplier's nation and ends at its
  customer's nation; it starts on the ship day at a minute of day derived from
  the keys and lasts 0-3599 seconds; user type is the customer's market segment;
* a **station** is a nation (25 of them); borough = region, neighbourhood =
  region + North/South; capacity = key mod 8 (so zero capacity occurs);
  coordinates are whole micro-degrees, and trip coordinates sit a few
  micro-degree steps off their station so a 3-decimal match sometimes fails;
* a **weather reading** is a line item shaped like a daily weather row, with the
  weather source's missing-value codes where the line item hits a chosen value;
* an **area** is a square per nation with a square hole (and optionally one
  two-or-more-part MultiPolygon per region); **sites** are suppliers or
  customers placed on the same plane.

Every view is a plain DataFrame plan over the Parquet scans, so filters and
column pruning reach the files. The SQL twins live in ``tripflow.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Plane layout of the synthetic areas: nation k is the square
# [GRID*(k%5), GRID*(k%5)+SIDE] x [GRID*(k//5), GRID*(k//5)+SIDE] with the hole
# [+HOLE_LO, +HOLE_HI]^2 cut out.
GRID, SIDE, HOLE_LO, HOLE_HI = 10, 8, 3, 5
PLANE_MOD = 4900  # site coordinates are (key * mult % PLANE_MOD) / 100


# Declared, so that making a plan reads no file.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table."""
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _micro_degrees(base: int, key: Column, step: int, offset: int, jitter: Column | None) -> Column:
    v = F.lit(base) + key.cast("bigint") * F.lit(step) + F.lit(offset)
    if jitter is not None:
        v = v + jitter * F.lit(200)
    return v.cast("double") / F.lit(1_000_000)


def station_latitude(key: Column, jitter: Column | None = None) -> Column:
    return _micro_degrees(40_600_000, key, 12_340, 310, jitter)


def station_longitude(key: Column, jitter: Column | None = None) -> Column:
    return -_micro_degrees(73_900_000, key, 8_760, 470, jitter)


def stations_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station dimension: one row per nation (schema of the station table)."""
    nation = load(spark, sf_dir, "nation")
    region = load(spark, sf_dir, "region")
    k = F.col("n_nationkey")
    # region has 5 rows by the table's definition, a fixed bound
    return nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select(
        k.cast("string").alias("station_id"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("S"), F.lpad(k.cast("string"), 3, "0")).alias("short_name"),
        station_latitude(k).alias("latitude"),
        station_longitude(k).alias("longitude"),
        F.col("n_regionkey").cast("bigint").alias("region_id"),
        (k % 8).cast("bigint").alias("capacity"),
        F.col("r_name").alias("borough"),
        F.concat(F.col("r_name"), F.when(k % 2 == 0, " North").otherwise(" South")).alias("neighborhood"),
    )


def trips_view(spark: SparkSession, sf_dir: str, by_month: bool = False) -> DataFrame:
    """Cleaned trip table (canonical trip schema plus ``start_day``). With ``by_month`` rows are dealt by the month of their
    start (AQE splits a heavy one), a column ``month`` (``YYYYMM``); they move while they hold keys only."""
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"
    )
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    supplier = load(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    start_nation = F.broadcast(nation.toDF("s_nk", "start_station_name"))  # 25 rows by definition
    end_nation = F.broadcast(nation.toDF("c_nk", "end_station_name"))

    buyers = orders.join(customer, orders.o_custkey == customer.c_custkey)
    joined = (
        li.join(buyers, li.l_orderkey == buyers.o_orderkey)
        .join(supplier, li.l_suppkey == supplier.s_suppkey)
    )
    offset_s = ((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13) % 1440) * 60 + F.col("l_partkey") % 60
    start = F.timestamp_add("SECOND", offset_s, F.col("l_shipdate"))
    month = ["month"] if by_month else []
    if by_month:
        keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "s_suppkey", "s_nationkey", "c_custkey", "c_nationkey", "c_mktsegment"]
        joined = joined.select(*keys, F.date_format(start, "yyyyMM").alias("month")).hint("rebalance", "month")
    joined = (
        joined.join(start_nation, F.col("s_nationkey") == F.col("s_nk"))
        .join(end_nation, F.col("c_nationkey") == F.col("c_nk"))
    )
    duration = ((F.col("l_partkey") * 31 + F.col("l_suppkey") * 17 + F.col("l_linenumber")) % 3600).cast("int")
    s_jit = F.col("s_suppkey") % 5 - 2
    c_jit = F.col("c_custkey") % 5 - 2
    return joined.select(
        duration.alias("tripduration"),
        start.alias("starttime"),
        F.timestamp_add("SECOND", duration, start).alias("stoptime"),
        F.col("s_nationkey").cast("int").alias("start_station_id"),
        F.col("start_station_name"),
        station_latitude(F.col("s_nationkey"), s_jit).alias("start_station_latitude"),
        station_longitude(F.col("s_nationkey"), s_jit).alias("start_station_longitude"),
        F.col("c_nationkey").cast("int").alias("end_station_id"),
        F.col("end_station_name"),
        station_latitude(F.col("c_nationkey"), c_jit).alias("end_station_latitude"),
        station_longitude(F.col("c_nationkey"), c_jit).alias("end_station_longitude"),
        (F.col("l_partkey") % 2_000_000_000).cast("int").alias("bikeid"),
        F.col("c_mktsegment").alias("usertype"),
        (F.lit(1940) + F.col("c_custkey") % 60).cast("int").alias("birth_year"),
        (F.col("c_custkey") % 3).cast("string").alias("gender"),
        start.alias("start_date"),
        F.to_date(start).alias("start_day"),
        *month,
    )


def weather_raw_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily-weather-shaped readings (one per line item) with missing-value codes.

    Readings are whole numbers, halves or quarters, so daily sums are exact.
    """
    li = load(spark, sf_dir, "lineitem")
    ship = F.col("l_shipdate")
    q, ln, tax, disc = F.col("l_quantity"), F.col("l_linenumber"), F.col("l_tax"), F.col("l_discount")
    return li.select(
        F.when(F.col("l_returnflag") == "A", "725030")
        .when(F.col("l_returnflag") == "N", "744860")
        .otherwise("725053")
        .alias("stn"),
        F.year(ship).cast("string").alias("year"),
        F.lpad(F.month(ship).cast("string"), 2, "0").alias("mo"),
        F.lpad(F.dayofmonth(ship).cast("string"), 2, "0").alias("da"),
        F.when(q == 50, F.lit(9999.9)).otherwise(q + 20).alias("temp"),
        F.when(ln == 7, F.lit(999.9)).otherwise(ln * 1.5).alias("visib"),
        F.when(tax == 0.08, F.lit("999.9")).otherwise((ln * 2 + 0.5).cast("string")).alias("wdsp"),
        F.when(disc == 0, F.lit(999.9)).otherwise(F.round(disc * 100)).alias("gust"),
        F.when(q == 49, F.lit(99.99)).when(tax <= 0.02, F.lit(0.0)).otherwise(ln / 4.0).alias("prcp"),
        F.when(F.col("l_linestatus") == "O", F.lit(999.9)).otherwise(F.floor(q / 8).cast("double")).alias("sndp"),
    )


def _square(x0: Column, y0: Column, lo: int, hi: int) -> Column:
    """Closed ring of the square [x0+lo, x0+hi] x [y0+lo, y0+hi], counter-clockwise."""
    a, b = x0 + F.lit(float(lo)), x0 + F.lit(float(hi))
    c, d = y0 + F.lit(float(lo)), y0 + F.lit(float(hi))
    return F.array(
        F.array(a, c), F.array(b, c), F.array(b, d), F.array(a, d), F.array(a, c)
    )


def areas_view(spark: SparkSession, sf_dir: str, with_regions: bool = False) -> DataFrame:
    """Area polygons as GeoJSON-style MultiPolygon coordinates.

    One square-with-hole per nation (borough = region name, neighbourhood =
    nation name); with ``with_regions`` also one MultiPolygon per region made of
    its nations' outer squares (neighbourhood = ``'<region> (all)'``), which
    overlaps the nation areas.
    """
    nation = load(spark, sf_dir, "nation")
    region = load(spark, sf_dir, "region")
    k = F.col("n_nationkey")
    x0 = ((k % 5) * GRID).cast("double")
    y0 = ((k / 5).cast("int") * GRID).cast("double")
    nations = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select(
        k.cast("string").alias("area_id"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("neighborhood"),
        F.array(F.array(_square(x0, y0, 0, SIDE), _square(x0, y0, HOLE_LO, HOLE_HI))).alias("geometry"),
        F.col("n_regionkey").alias("_region"),
        _square(x0, y0, 0, SIDE).alias("_outer"),
    )
    out = nations.drop("_region", "_outer")
    if with_regions:
        # group of <= 25 nation rows: the nation table's fixed size bounds it
        regions = nations.groupBy("_region", "borough").agg(
            F.sort_array(F.collect_list(F.struct(F.col("area_id").cast("int").alias("k"), "_outer"))).alias("parts")
        ).select(
            F.concat(F.lit("R"), F.col("_region").cast("string")).alias("area_id"),
            F.col("borough"),
            F.concat(F.col("borough"), F.lit(" (all)")).alias("neighborhood"),
            F.transform("parts", lambda p: F.array(p["_outer"])).alias("geometry"),
        )
        out = out.unionByName(regions)
    return out


def _plane(key: Column, mult: int) -> Column:
    return ((key * mult) % PLANE_MOD).cast("double") / F.lit(100.0)


def customer_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One point per customer on the area plane (``point_id``, ``latitude``, ``longitude``)."""
    c = load(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(k.alias("point_id"), _plane(k, 53).alias("latitude"), _plane(k, 37).alias("longitude"))


def supplier_sites(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(information, status) feeds for the station dimension job.

    information: every supplier as a station, with text-typed ``region_id`` and
    ``capacity`` as a live feed delivers them (some unparsable); status: the
    suppliers that appear on any line item, once per line item (not unique).
    """
    s = load(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    info = s.select(
        k.cast("string").alias("station_id"),
        F.col("s_name").alias("name"),
        F.when(k % 11 != 0, F.concat(F.lit("SS"), k.cast("string"))).alias("short_name"),
        _plane(k, 53).alias("lat"),
        _plane(k, 37).alias("lon"),
        F.when(k % 13 == 0, F.lit("x")).otherwise(F.concat(F.col("s_nationkey").cast("string"), F.lit(".0"))).alias(
            "region_id"
        ),
        (k % 40).cast("string").alias("capacity"),
    )
    status = load(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("station_id"))
    return info, status


def render_feeds(info: DataFrame, status: DataFrame, areas: DataFrame, folder: str) -> None:
    """Station and area feeds as JSON documents, one to a file: the stations dealt over some
    documents, the areas as GeoJSON feature collections, one per borough."""
    for name, rows in (("information", info), ("status", status.distinct())):
        part = F.pmod(F.xxhash64("station_id"), F.lit(16)).alias("part")
        stations = F.struct(F.collect_list(F.struct(*rows.columns)).alias("stations")).alias("data")
        rows.groupBy(part).agg(stations).select("part", F.to_json(F.struct("data"))).write.partitionBy("part").text(f"{folder}/{name}")
    feature = F.struct(
        F.create_map(F.lit("boroname"), F.col("borough"), F.lit("ntaname"), F.col("neighborhood")).alias("properties"),
        F.struct(F.lit("MultiPolygon").alias("type"), F.col("geometry").alias("coordinates")).alias("geometry"),
    )
    doc = areas.groupBy("borough").agg(F.collect_list(feature).alias("features"))
    doc.select("borough", F.to_json(F.struct("features"))).write.partitionBy("borough").text(f"{folder}/areas")
