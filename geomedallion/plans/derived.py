"""Inputs derived from the supplied tables.

The supplied tables carry no coordinates, place names or landed payloads, so the workloads
derive them with plain column arithmetic. Every derivation is a projection of a whole table
(its size grows with the table); the same arithmetic appears in the DuckDB oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed coordinate derivation parameters (shared with the oracle SQL).
OBS_LAT_MULT, OBS_LON_MULT = 7919, 104729
LOC_LAT_MULT, LOC_LON_MULT = 6607, 3571
LAT_BASE, LAT_SPAN = 25.0, 2500   # 25.00 .. 49.99
LON_BASE, LON_SPAN = -125.0, 6000  # -125.00 .. -65.01

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def derived_lat(key: Column, mult: int) -> Column:
    return F.lit(LAT_BASE) + (key * F.lit(mult) % F.lit(LAT_SPAN)) / F.lit(100.0)


def derived_lon(key: Column, mult: int) -> Column:
    return F.lit(LON_BASE) + (key * F.lit(mult) % F.lit(LON_SPAN)) / F.lit(100.0)


def customer_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        k.alias("obs_id"),
        F.col("c_name").alias("obs_name"),
        derived_lat(k, OBS_LAT_MULT).alias("lat"),
        derived_lon(k, OBS_LON_MULT).alias("lon"),
    )


def event_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    return e.select(
        k.alias("event_id"),
        F.col("ts"),
        F.col("event_type"),
        F.col("value").alias("mag"),
        derived_lat(k, OBS_LAT_MULT).alias("latitude"),
        derived_lon(k, OBS_LON_MULT).alias("longitude"),
    )


def part_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        k.alias("loc_id"),
        F.col("p_name").alias("loc_name"),
        derived_lat(k, LOC_LAT_MULT).alias("geo_lat"),
        derived_lon(k, LOC_LON_MULT).alias("geo_lon"),
    )


def supplier_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        k.alias("loc_id"),
        F.col("s_name").alias("loc_name"),
        derived_lat(k, LOC_LAT_MULT).alias("geo_lat"),
        derived_lon(k, LOC_LON_MULT).alias("geo_lon"),
    )


def census_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Census-style area names "<area>, <state>" from customer x nation.

    The area suffix cycles County / Parish / none by nation key; some names have no comma,
    some have two, so the area/state split and county extraction see every shape.
    """
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    nk = F.col("c_nationkey")
    area = (
        F.when(nk % 3 == 0, F.concat(F.col("c_name"), F.lit(" County")))
        .when(nk % 3 == 1, F.concat(F.col("c_name"), F.lit(" Parish")))
        .otherwise(F.col("c_name"))
    )
    name = (
        F.when(nk % 5 == 4, area)
        .when(nk % 7 == 6, F.concat(area, F.lit(", "), F.col("n_name"), F.lit(", US")))
        .otherwise(F.concat(area, F.lit(", "), F.col("n_name")))
    )
    return c.join(n, c.c_nationkey == n.n_nationkey).select(F.col("c_custkey").alias("census_id"), name.alias("name"))


def order_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge target: orders up to 1999, last updated at their order date."""
    o = table(spark, sf_dir, "orders")
    return o.where(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")).withColumn("update_tm", F.col("o_orderdate"))


def order_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge source: orders from 1999 on, re-stated (price + 1, status F); overlaps the target in 1999."""
    o = table(spark, sf_dir, "orders")
    return o.where(F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", "o_custkey", F.lit("F").alias("o_orderstatus"),
        (F.col("o_totalprice") + F.lit(1.0)).alias("o_totalprice"), "o_orderdate", "o_orderpriority",
    )


RUN_LOG_SUCCEEDED_UNTIL = "2024-01-20"
RUN_LOG_FAILED_UNTIL = "2024-01-25"


def event_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run log with one job per event day: Succeeded up to 01-20, Failed to 01-25, then Running."""
    e = table(spark, sf_dir, "events")
    day = F.to_date("ts")
    status = (
        F.when(F.col("day") <= F.lit(RUN_LOG_SUCCEEDED_UNTIL).cast("date"), F.lit("Succeeded"))
        .when(F.col("day") <= F.lit(RUN_LOG_FAILED_UNTIL).cast("date"), F.lit("Failed"))
        .otherwise(F.lit("Running"))
    )
    return (
        e.groupBy(day.alias("day"))
        .agg(F.max("ts").alias("last_updated"))
        .select(F.date_format("day", "yyyyMMdd").alias("job_id"), "last_updated", status.alias("status"))
    )


def weather_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather-style Kelvin readings from events: min = value - 10, max null for error events."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    return e.select(
        k.alias("reading_id"),
        derived_lat(k, OBS_LAT_MULT).alias("lat"),
        derived_lon(k, OBS_LON_MULT).alias("lon"),
        F.col("ts").alias("date"),
        (F.col("value") - F.lit(10.0)).alias("temperature_min"),
        F.when(F.col("event_type") != "error", F.col("value") + F.lit(10.0)).alias("temperature_max"),
    )


# --- landed payloads derived from the supplied tables ---------------------------------------

FEED_CHUNK = 100  # features per derived GeoJSON payload (event_id div FEED_CHUNK)


def event_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One GeoJSON feature per event, with every shape the flattener must handle:
    1-char place (error), missing place (signup), commas in place (click), missing
    ``updated`` (view), a single coordinate (purchase)."""
    e = table(spark, sf_dir, "events")
    k, et = F.col("event_id"), F.col("event_type")
    lat, lon = derived_lat(k, OBS_LAT_MULT), derived_lon(k, OBS_LON_MULT)
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    place = (
        F.when(et == "error", F.lit("x"))
        .when(et == "signup", F.lit(None).cast("string"))
        .when(et == "click", F.concat(F.lit("near user "), F.col("user_id").cast("string"), F.lit(", CA")))
        .otherwise(F.concat(et, F.lit(" zone")))
    )
    props = F.struct(
        F.col("value").alias("mag"), place.alias("place"), ms.alias("time"),
        F.when(et != "view", ms + F.lit(60000)).alias("updated"),
        F.concat(F.lit("https://example.invalid/q/"), k.cast("string")).alias("url"),
        F.concat(F.lit("https://example.invalid/d/"), k.cast("string")).alias("detail"),
        F.lit("reviewed").alias("status"), F.lit(0).alias("tsunami"), F.col("user_id").cast("int").alias("sig"),
        F.lit("ev").alias("net"), k.cast("string").alias("code"), F.lit(",ev,").alias("ids"),
        F.lit(",ev,").alias("sources"), F.lit(",origin,").alias("types"),
        (F.col("value") / F.lit(10.0)).alias("rms"), F.lit("md").alias("magType"), F.lit("earthquake").alias("type"),
        F.concat(F.lit("Event "), k.cast("string")).alias("title"),
    )
    coords = F.when(et == "purchase", F.array(lon)).otherwise(F.array(lon, lat, F.col("value")))
    return e.select(k.alias("event_id"), F.struct(props.alias("properties"), F.struct(coords.alias("coordinates")).alias("geometry")).alias("feature"))


def event_feed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed GeoJSON text: payloads of at most FEED_CHUNK features (bounded groups)."""
    f = event_features(spark, sf_dir)
    grouped = f.groupBy((F.col("event_id") / FEED_CHUNK).cast("long").alias("payload_id")).agg(
        F.collect_list("feature").alias("features"))
    return grouped.select("payload_id", F.to_json(F.struct("features")).alias("value"))


ODD_FEED_MS = 1705233600000  # 2024-01-14T12:00:00Z, inside the window of the layers' run
ODD_FEED_CASES = 10


def odd_feed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event payload per customer that breaks a rule of the feed's shape, by ``c_custkey % 10``: no features (0, 1),
    no properties (2), no geometry (3), a title of one character (4), no time (5), text cut short (6), an array (7),
    features of another type (8); 9 is sound."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    ms = F.lit(ODD_FEED_MS) + k
    case = k % ODD_FEED_CASES
    props = F.struct(
        F.lit(3.0).alias("mag"), F.concat(F.lit("customer "), k.cast("string")).alias("place"), F.when(case != 5, ms).alias("time"), ms.alias("updated"),
        F.when(case == 4, F.lit("t")).otherwise(F.concat(F.lit("Customer "), k.cast("string"))).alias("title"),
    )
    point = F.struct(F.array(derived_lon(k, OBS_LON_MULT), derived_lat(k, OBS_LAT_MULT)).alias("coordinates"))
    feature = F.struct(F.when(case != 2, props).alias("properties"), F.when(case != 3, point).alias("geometry"))
    sound = F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.array(feature).alias("features")))
    text = (
        F.when(case == 0, F.lit('{"type":"FeatureCollection","features":[]}')).when(case == 1, F.lit('{"type":"FeatureCollection"}'))
        .when(case == 6, F.substring(sound, 1, 41)).when(case == 7, F.concat(F.lit("["), k.cast("string"), F.lit("]")))
        .when(case == 8, F.lit('{"features":"none"}')).otherwise(sound)
    )
    return c.select(k.alias("payload_id"), text.alias("value"))


def weather_payload_text(spark: SparkSession, sf_dir: str, days: tuple[str, str] | None = None) -> DataFrame:
    """One landed weather JSON per reading; ``wind`` absent for signup, ``wind.max`` a scalar
    for view, ``temperature`` absent for error events. ``days`` (from, before): the readings of these days,
    told by the table's own time, so that no text is built or read to find them."""
    e = table(spark, sf_dir, "events")
    if days:
        date, no_text = F.date_format("ts", "yyyy-MM-dd"), (F.col("event_type") == "view") & F.col("value").isNull()
        e = e.where((date >= days[0]) & (date < days[1]) & ~F.coalesce(no_text, F.lit(False)))
    k, et, v = F.col("event_id"), F.col("event_type"), F.col("value")
    base = F.to_json(F.struct(
        derived_lat(k, OBS_LAT_MULT).alias("lat"), derived_lon(k, OBS_LON_MULT).alias("lon"), F.lit("UTC").alias("tz"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"), F.lit("standard").alias("units"),
        F.struct(F.col("user_id").cast("double").alias("afternoon")).alias("cloud_cover"),
        F.struct(v.alias("afternoon")).alias("humidity"),
        F.struct((v / F.lit(4.0)).alias("total")).alias("precipitation"),
        F.when(et != "error", F.struct((v + F.lit(250.0)).alias("min"), (v + F.lit(260.0)).alias("max"))).alias("temperature"),
        F.struct((F.lit(1000.0) + F.col("user_id")).alias("afternoon")).alias("pressure"),
    ))
    speed = v / F.lit(3.0)
    wind = (
        F.when(et == "signup", F.lit(""))
        .when(et == "view", F.concat(F.lit(',"wind":{"max":'), speed.cast("string"), F.lit("}}")))
        .otherwise(F.concat(F.lit(',"wind":'), F.to_json(F.struct(F.struct(speed.alias("speed"), F.lit(10).alias("deg")).alias("max")))))
    )
    text = F.concat(F.expr("substring(__b, 1, length(__b) - 1)"), wind, F.lit("}"))
    return e.select(k.alias("reading_id"), base.alias("__b"), et, v).select("reading_id", text.alias("value"))


CENSUS_CHUNK = 100
CENSUS_HEADER = ("NAME", "POP", "HISP", "state", "county")


def census_payload_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Census array tables: header row then up to CENSUS_CHUNK rows of strings."""
    n = census_names(spark, sf_dir)
    cid = F.col("census_id")
    pop = F.when(cid % 50 == 0, F.lit("n/a")).otherwise((cid * 37 % 100000).cast("string"))
    row = F.array(F.col("name"), pop, F.lit("0"), (cid % 56).cast("string"), (cid % 1000).cast("string"))
    grouped = n.groupBy((cid / CENSUS_CHUNK).cast("long").alias("payload_id")).agg(F.collect_list(row).alias("rows"))
    header = F.array(*[F.lit(h) for h in CENSUS_HEADER])
    return grouped.select("payload_id", F.to_json(F.concat(F.array(header), F.col("rows"))).alias("value"))


GEOCODE_RESULTS_PER_QUERY = 6


def geocode_payload_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One geocode response per supplier, 6 results: result 1 repeats result 0, result 2 is another
    name at result 0's point, result 3 is outside the US, result 5 is past the 5-result limit."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    lat0, lon0 = derived_lat(k, LOC_LAT_MULT), derived_lon(k, LOC_LON_MULT)

    def result(i):
        shift = F.when(i <= 2, F.lit(0)).otherwise(i) * F.lit(0.01)
        return F.struct(
            F.when(i == 2, F.concat(F.col("s_name"), F.lit(" Heights"))).otherwise(F.col("s_name")).alias("name"),
            F.create_map(F.lit("en"), F.col("s_name")).alias("local_names"),
            (lat0 + shift).alias("lat"), (lon0 + shift).alias("lon"),
            F.when(i == 3, F.lit("CA")).otherwise(F.lit("US")).alias("country"),
            F.concat(F.lit("S"), F.col("s_nationkey").cast("string")).alias("state"),
        )

    results = F.transform(F.sequence(F.lit(0), F.lit(GEOCODE_RESULTS_PER_QUERY - 1)), result)
    return s.select(k.alias("query_id"), F.to_json(results).alias("value"))


# --- silver-style inputs for the gold layer ---------------------------------------------------

SILVER_TS = "2024-02-01 00:00:00"
CENSUS_MIN_SIZE = 10  # census rows of smaller parts name another state: left-join misses


def _place_name(p: DataFrame) -> Column:
    return F.concat(F.upper(F.col("p_name")), F.lit(" "), F.col("p_partkey").cast("string"))


def geocode_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """geocode_raw-shaped rows: one US place per part."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        _place_name(p).alias("name"), derived_lat(k, LOC_LAT_MULT).alias("lat"), derived_lon(k, LOC_LON_MULT).alias("lon"),
        F.lit("US").alias("country"), F.col("p_brand").alias("state"),
        F.lit(SILVER_TS).cast("timestamp").alias("update_tm"),
    )


def census_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """census_raw-shaped rows, one per part: "<place> County, <brand>", or "..., Elsewhere" for
    parts smaller than CENSUS_MIN_SIZE (those find no geocode place in the same state)."""
    p = table(spark, sf_dir, "part")
    state = F.when(F.col("p_size") >= CENSUS_MIN_SIZE, F.col("p_brand")).otherwise(F.lit("Elsewhere"))
    return p.select(
        F.concat(_place_name(p), F.lit(" County, "), state).alias("name"),
        (F.col("p_size") * 1000).alias("pop"), F.lit(0).alias("hisp"), F.lit(1).alias("state"), F.lit(1).alias("county"),
        F.lit(SILVER_TS).cast("timestamp").alias("update_tm"),
    )


def weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """weather_raw-shaped rows from events (Kelvin; minimum below 0 K when value < 5)."""
    e = table(spark, sf_dir, "events")
    k, v = F.col("event_id"), F.col("value")
    return e.select(
        derived_lat(k, OBS_LAT_MULT).alias("lat"), derived_lon(k, OBS_LON_MULT).alias("lon"), F.lit("UTC").alias("tz"),
        F.date_trunc("day", F.col("ts").cast("timestamp")).alias("date"), F.lit("standard").alias("units"),
        F.col("user_id").cast("double").alias("cloud_cover"), v.alias("humidity"), (v / F.lit(4.0)).alias("precipitation"),
        (v - F.lit(5.0)).alias("temperature_min"), (v + F.lit(260.0)).alias("temperature_max"),
        (F.lit(1000.0) + F.col("user_id")).alias("pressure"), (v / F.lit(3.0)).alias("wind"),
        F.lit(SILVER_TS).cast("timestamp").alias("update_tm"),
    )


def order_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: the customer's derived location and a depot location derived from the order key."""
    o = table(spark, sf_dir, "orders")
    c, k = F.col("o_custkey"), F.col("o_orderkey")
    return o.select(
        "o_orderkey", derived_lat(c, OBS_LAT_MULT).alias("cust_lat"), derived_lon(c, OBS_LON_MULT).alias("cust_lon"),
        derived_lat(k, LOC_LAT_MULT).alias("depot_lat"), derived_lon(k, LOC_LON_MULT).alias("depot_lon"),
    )
