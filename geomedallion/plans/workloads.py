"""Registered workloads over the supplied tables: one per operator of SURVEY §2.

Each workload is ``fn(spark, sf_dir) -> DataFrame`` and, where the operator is expressible
in SQL, has a DuckDB oracle in ``ORACLE``. Workloads read whole tables; nothing is sampled.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from typing import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geomedallion import schemas as SC
from geomedallion.functions import columns as C
from geomedallion.functions import nested as N
from geomedallion.operators import calendar as CAL
from geomedallion.operators import quality as QC
from geomedallion.operators.dedup import dedup_by_key
from geomedallion.operators.extract import extract_since, watermark
from geomedallion.operators.location import location_dimension, location_fact
from geomedallion.operators.merge import DuplicateSourceKeyError, merge_upsert
from geomedallion.operators.nearest import bin_join, nearest_location
from geomedallion.plans import derived as D
from geomedallion.plans import intake as IN
from geomedallion.plans import layers as LY
from geomedallion.plans import oracle as O
from geomedallion.plans.landing import land_payloads, work_dir
from geomedallion.sinks import tables as K
from geomedallion.sources import landed as LD
from geomedallion.sources.csv import read_csv

Workload = Callable[[SparkSession, str], DataFrame]
WORKLOADS: dict[str, Workload] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Workload) -> Workload:
        WORKLOADS[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# --- geo: J2, F8, F11, W1/W2 -------------------------------------------------------------

@register(
    "nearest_location",
    O.nearest_sql(O.CUSTOMER_OBS, ["obs_id", "obs_name", "lat", "lon"], "obs_id", "lat", "lon", O.PART_LOCS),
)
def nearest_location_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest part-derived place for every customer-derived observation."""
    return nearest_location(
        D.customer_observations(spark, sf_dir),
        D.part_locations(spark, sf_dir),
        id_col="obs_id", obs_lat="lat", obs_lon="lon", tie_breakers=["loc_id"], ids_unique=True,
    )


@register(
    "nearest_event_location",
    O.nearest_sql(O.EVENT_OBS, ["event_id", "ts", "event_type", "mag", "latitude", "longitude"],
                  "event_id", "latitude", "longitude", O.PART_LOCS),
)
def nearest_event_location_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest place for every event (quake side); ids checked, not assumed unique."""
    return nearest_location(
        D.event_observations(spark, sf_dir),
        D.part_locations(spark, sf_dir),
        id_col="event_id", obs_lat="latitude", obs_lon="longitude", tie_breakers=["loc_id"],
    )


@register(
    "nearest_location_chunked",
    O.nearest_sql(O.EVENT_OBS, ["event_id", "ts", "event_type", "mag", "latitude", "longitude"],
                  "event_id", "latitude", "longitude", O.PART_LOCS),
)
def nearest_location_chunked_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 through the unbounded-location plan (bins chunked, shuffle join), same answer."""
    return nearest_location(
        D.event_observations(spark, sf_dir),
        D.part_locations(spark, sf_dir),
        id_col="event_id", obs_lat="latitude", obs_lon="longitude", tie_breakers=["loc_id"],
        broadcast_max_rows=0, chunk_size=2,
    )


@register(
    "nearest_location_subcells",
    O.nearest_sql(O.EVENT_OBS, ["event_id", "ts", "event_type", "mag", "latitude", "longitude"],
                  "event_id", "latitude", "longitude", O.PART_LOCS),
)
def nearest_location_subcells_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 with a fine sub-grid forced on every bin (3x3 sub-cells first, proven or searched again),
    same answer as the brute-force oracle."""
    return nearest_location(
        D.event_observations(spark, sf_dir),
        D.part_locations(spark, sf_dir),
        id_col="event_id", obs_lat="latitude", obs_lon="longitude", tie_breakers=["loc_id"],
        cell_places=0.3,
    )


@register(
    "bin_join_candidates",
    O.bin_candidates_sql(O.CUSTOMER_OBS, ["obs_id", "obs_name", "lat", "lon"], "lat", "lon", O.SUPPLIER_LOCS),
)
def bin_join_candidates_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer with each supplier place in its grid bin (left join), with distance."""
    out = bin_join(
        D.customer_observations(spark, sf_dir),
        D.supplier_locations(spark, sf_dir),
        left_lat="lat", left_lon="lon", right_lat="geo_lat", right_lon="geo_lon",
    )
    return out.select("obs_id", "obs_name", "lat", "lon", "lat_bin", "lon_bin",
                      "loc_id", "loc_name", "geo_lat", "geo_lon", "dist_miles")


@register("great_circle_miles", f"""
SELECT o_orderkey, {O.miles_expr(O.lat_expr('o_custkey', D.OBS_LAT_MULT), O.lon_expr('o_custkey', D.OBS_LON_MULT),
                                 O.lat_expr('o_orderkey', D.LOC_LAT_MULT), O.lon_expr('o_orderkey', D.LOC_LON_MULT))} AS dist_miles
FROM orders""")
def great_circle_miles_q(spark, sf_dir):
    """great-circle miles from each order's customer to its depot (row-wise, no join)."""
    from geomedallion.functions.geo import rounded_miles

    r = D.order_routes(spark, sf_dir)
    return r.select("o_orderkey", rounded_miles("cust_lat", "cust_lon", "depot_lat", "depot_lon").alias("dist_miles"))


# --- calendar: A1, F15-F21 ---------------------------------------------------------------


@register("date_bounds", """
SELECT min(CAST(o_orderdate AS DATE)) AS min_date, max(CAST(o_orderdate AS DATE)) AS max_date FROM orders
WHERE CAST(o_orderdate AS DATE) <> DATE '1970-01-01'""")
def date_bounds_q(spark, sf_dir):
    """A1: global min/max order date (one lazy row)."""
    return CAL.date_bounds(D.table(spark, sf_dir, "orders"), "o_orderdate")


@register("date_series", f"SELECT d AS date FROM ({O.date_series_sql('o_orderdate', 'orders')}) x")
def date_series_q(spark, sf_dir):
    """every day between the order-date bounds."""
    return CAL.date_series(CAL.date_bounds(D.table(spark, sf_dir, "orders"), "o_orderdate"))


@register("date_dimension", O.calendar_sql(O.date_series_sql("o_orderdate", "orders")))
def date_dimension_q(spark, sf_dir):
    """X3 dim_date (18 columns) over the order-date span."""
    return CAL.date_dimension(D.table(spark, sf_dir, "orders"), "o_orderdate")


# --- scalar column functions: F1-F14, P4, P7, P8, F22, P3, P10 -----------------------------

@register("name_key", "SELECT p_partkey, p_name, replace(lower(p_name), ' ', '') AS name_key FROM part")
def name_key_q(spark, sf_dir):
    """F1 over part names (lowercase, spaces removed)."""
    p = D.table(spark, sf_dir, "part")
    return p.select("p_partkey", "p_name", C.name_key("p_name").alias("name_key"))


@register("split_area_state", f"""
SELECT census_id, name, {O.area_sql('name')} AS area, {O.state_sql('name')} AS state_name FROM ({O.CENSUS_NAMES}) n""")
def split_area_state_q(spark, sf_dir):
    """split census names at the first comma."""
    n = D.census_names(spark, sf_dir)
    area, state = C.split_area_state("name")
    return n.select("census_id", "name", area.alias("area"), state.alias("state_name"))


@register("county_name", f"""
SELECT census_id, name, {O.county_sql(O.area_sql('name'))} AS county,
       replace(lower({O.county_sql(O.area_sql('name'))}), ' ', '') AS name_key
FROM ({O.CENSUS_NAMES}) n""")
def county_name_q(spark, sf_dir):
    """F2 + F1: county name of the area part, and its normalised key (ruling D24)."""
    n = D.census_names(spark, sf_dir)
    area, _ = C.split_area_state("name")
    return n.select("census_id", "name", C.county_name(area).alias("county"),
                    C.name_key(C.county_name(area)).alias("name_key"))


@register("row_hash_id", """
SELECT o_orderkey, sha256(concat_ws('||', strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f'), CAST(o_custkey AS VARCHAR),
       CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR))) AS row_id
FROM orders""")
def row_hash_id_q(spark, sf_dir):
    """sha2-256 of concat_ws('||', ...) over canonical text of typed columns."""
    o = D.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", C.row_hash_id(o, ["o_orderdate", "o_custkey", "o_totalprice"]).alias("row_id"))


@register("kelvin_to_celsius", f"""
SELECT reading_id, temperature_min - {O.dbl(273.15)} AS temperature_min,
       temperature_max - {O.dbl(273.15)} AS temperature_max
FROM ({O.WEATHER_READINGS}) w""")
def kelvin_to_celsius_q(spark, sf_dir):
    """F10 on weather-style readings."""
    w = D.weather_readings(spark, sf_dir)
    return w.select("reading_id", C.kelvin_to_celsius("temperature_min").alias("temperature_min"),
                    C.kelvin_to_celsius("temperature_max").alias("temperature_max"))


@register("valid_range_filter", f"""
SELECT * FROM ({O.WEATHER_READINGS}) w
WHERE temperature_min IS NOT NULL AND temperature_min >= 0 AND temperature_max IS NOT NULL AND temperature_max >= 0""")
def valid_range_filter_q(spark, sf_dir):
    """Keep readings with both temperatures present and >= 0 K (ruling D22)."""
    w = D.weather_readings(spark, sf_dir)
    return w.where(C.valid_range("temperature_min") & C.valid_range("temperature_max"))


@register("round_coords", f"""
SELECT event_id,
  CAST(round(CAST(CAST(({O.dbl(25.0)} + CAST(event_id * 7919 % 250000 AS DOUBLE) / {O.dbl(10000.0)}) AS VARCHAR) AS DECIMAL(38, 20)), 2) AS DOUBLE) AS lat,
  CAST(round(CAST(CAST(({O.dbl(-125.0)} + CAST(event_id * 104729 % 600000 AS DOUBLE) / {O.dbl(10000.0)}) AS VARCHAR) AS DECIMAL(38, 20)), 2) AS DOUBLE) AS lon
FROM events""")
def round_coords_q(spark, sf_dir):
    """coordinates with 4 decimals rounded half-up to 2."""
    e = D.table(spark, sf_dir, "events")
    k = F.col("event_id")
    lat = F.lit(25.0) + (k * 7919 % 250000) / F.lit(10000.0)
    lon = F.lit(-125.0) + (k * 104729 % 600000) / F.lit(10000.0)
    return e.select("event_id", C.round_coord(lat).alias("lat"), C.round_coord(lon).alias("lon"))


@register("fill_epoch", """
SELECT event_id, coalesce(CASE WHEN event_type <> 'error' THEN ts END, TIMESTAMP '1970-01-01 00:00:00') AS ts FROM events""")
def fill_epoch_q(spark, sf_dir):
    """Null timestamps (error events) filled with the epoch."""
    e = D.table(spark, sf_dir, "events")
    ts = F.when(F.col("event_type") != "error", F.col("ts"))
    return e.select("event_id", C.fill_epoch(ts, e.schema["ts"].dataType).alias("ts"))


@register("null_short_strings", """
SELECT conv_id, turn, CASE WHEN length(text) >= 2 THEN replace(text, ',', '|') END AS text,
       CASE WHEN length(role) >= 2 THEN replace(role, ',', '|') END AS role
FROM conversations""")
def null_short_strings_q(spark, sf_dir):
    """P8 + F4 over whole conversation texts."""
    c = D.table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", C.null_short_strings("text").alias("text"), C.null_short_strings("role").alias("role"))


@register("parse_date", """
SELECT event_id, CAST(try_strptime(CASE WHEN event_type = 'error' THEN 'n/a' ELSE strftime(ts, '%Y-%m-%d') END, '%Y-%m-%d')
       AS TIMESTAMP) AS date FROM events""")
def parse_date_q(spark, sf_dir):
    """yyyy-MM-dd text to timestamp; malformed text gives null."""
    e = D.table(spark, sf_dir, "events")
    txt = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return e.select("event_id", C.parse_date(txt).cast("timestamp_ntz").alias("date"))


@register("project_cast", """
SELECT event_id AS id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       TRY_CAST(event_type AS INTEGER) AS type_code, CAST(user_id AS INTEGER) AS user_id FROM events""")
def project_cast_q(spark, sf_dir):
    """Select, alias and null-safe casts (malformed text -> null)."""
    e = D.table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("id"),
        C.try_cast_to(F.get_json_object("props", "$.k"), "bigint").alias("k"),
        C.try_cast_to(F.col("event_type"), "int").alias("type_code"),
        C.try_cast_to(F.col("user_id"), "int").alias("user_id"),
    )


@register("drop_columns", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def drop_columns_q(spark, sf_dir):
    """Drop columns (census hisp/state/county analogue)."""
    return D.table(spark, sf_dir, "customer").drop("c_acctbal", "c_mktsegment")


FEED_RUN_TS = "2024-01-15 13:45:00"


@register("feed_window_filter", """
SELECT * FROM events
WHERE ts >= TIMESTAMP '2024-01-14 00:00:00' AND ts < TIMESTAMP '2024-01-15 00:00:00' AND value >= 2""")
def feed_window_filter_q(spark, sf_dir):
    """P10 + F14: the day before the run, magnitude >= 2."""
    e = D.table(spark, sf_dir, "events")
    start, end = C.day_window(F.lit(FEED_RUN_TS).cast("timestamp_ntz"))
    return e.where(C.in_window("ts", start, end) & (F.col("value") >= F.lit(2.0)))


# --- de-duplication, merge, watermark: A3, M1-M3, S6, J5, X4 -----------------------------


@register("dedup_by_key", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id, value, props) AS rn
  FROM events) x WHERE rn = 1""")
def dedup_by_key_q(spark, sf_dir):
    """A3: newest event per (user, type); ties by the remaining columns (ruling D17)."""
    return dedup_by_key(D.table(spark, sf_dir, "events"), ["user_id", "event_type"], newest_first=["ts"])


MERGE_RUN_TS = "2002-01-01 00:00:00"


@register("merge_upsert", f"""
WITH t AS ({O.ORDER_TARGET}), s AS ({O.ORDER_SOURCE})
SELECT s.*, TIMESTAMP '{MERGE_RUN_TS}' AS update_tm FROM s
UNION ALL
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)""")
def merge_upsert_q(spark, sf_dir):
    """M1: upsert re-stated orders into the older order table by key."""
    return merge_upsert(D.order_target(spark, sf_dir), D.order_source(spark, sf_dir), ["o_orderkey"],
                        F.lit(MERGE_RUN_TS).cast("timestamp_ntz"))


MERGE_WATERMARK = "1999-06-01 00:00:00"


@register("merge_upsert_watermarked", f"""
WITH t AS ({O.ORDER_TARGET}), s AS ({O.ORDER_SOURCE})
SELECT s.*, TIMESTAMP '{MERGE_RUN_TS}' AS update_tm FROM s
UNION ALL
SELECT * FROM t WHERE NOT (update_tm > TIMESTAMP '{MERGE_WATERMARK}'
                           AND EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey))""")
def merge_upsert_watermarked_q(spark, sf_dir):
    """M2: only target rows newer than the watermark can match; older ones stay beside the insert."""
    return merge_upsert(D.order_target(spark, sf_dir), D.order_source(spark, sf_dir), ["o_orderkey"],
                        F.lit(MERGE_RUN_TS).cast("timestamp_ntz"),
                        target_predicate=F.col("update_tm") > F.lit(MERGE_WATERMARK).cast("timestamp_ntz"))


@register("run_log_watermark", f"""
SELECT coalesce(max(last_updated), TIMESTAMP '1970-01-01 00:00:00') AS watermark
FROM ({O.EVENT_RUN_LOG}) r WHERE status = 'Succeeded'""")
def run_log_watermark_q(spark, sf_dir):
    """Newest successful run of the run log (epoch when none)."""
    return watermark(D.event_run_log(spark, sf_dir), D.table(spark, sf_dir, "events").schema["ts"].dataType)


@register("incremental_extract", f"""
SELECT * FROM events WHERE ts > (
  SELECT coalesce(max(last_updated), TIMESTAMP '1970-01-01 00:00:00') FROM ({O.EVENT_RUN_LOG}) r WHERE status = 'Succeeded')""")
def incremental_extract_q(spark, sf_dir):
    """Events newer than the run-log watermark (scalar subquery pushed to the scan)."""
    return extract_since(D.table(spark, sf_dir, "events"), D.event_run_log(spark, sf_dir), "ts")


# --- data-quality checks: A5-A8 ----------------------------------------------------------


@register("duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_keys_q(spark, sf_dir):
    """A5: (l_orderkey, l_linenumber) values held by more than one row."""
    return QC.duplicate_keys(D.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("null_key_rows", """
SELECT event_id, place, ts AS time FROM (
  SELECT event_id, CASE WHEN event_type <> 'error' THEN event_type END AS place, ts FROM events) x
WHERE place IS NULL OR ts IS NULL""")
def null_key_rows_q(spark, sf_dir):
    """Quake-style rows missing a key part (place, time)."""
    e = D.table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("event_type")).alias("place"), F.col("ts").alias("time"))
    return QC.null_key_rows(e, ["place", "time"])


@register("value_in_set", "SELECT * FROM conversations WHERE role NOT IN ('user', 'assistant')")
def value_in_set_q(spark, sf_dir):
    """Rows whose role is outside the allowed set."""
    return QC.value_in_set(D.table(spark, sf_dir, "conversations"), "role", ["user", "assistant"])


@register("too_long_strings", "SELECT page_id, url FROM pages WHERE length(url) > 40")
def too_long_strings_q(spark, sf_dir):
    """Rows exceeding a VARCHAR(40) limit."""
    return QC.too_long_strings(D.table(spark, sf_dir, "pages").select("page_id", "url"), {"url": 40})


# --- landed payload readers: S1-S4, T2, A4, A9 ----------------------------------------------


_EVENT_COLS = [c for c, _ in SC.USGS_COLUMNS]


def _parsed_feed(spark, sf_dir):
    return D.event_feed_text(spark, sf_dir).select(F.from_json("value", SC.EVENT_FEED).alias("feed"))


@register("flatten_events", f"SELECT {', '.join(chr(34) + c + chr(34) for c in _EVENT_COLS)} FROM ({O.EVENT_FLAT}) e")
def flatten_events_q(spark, sf_dir):
    """GeoJSON payloads (100 features each) parsed and flattened to quake rows."""
    out = LD.flatten_event_feed(_parsed_feed(spark, sf_dir))
    return out.withColumns({"time": F.col("time").cast("timestamp_ntz"), "updated": F.col("updated").cast("timestamp_ntz")})


@register("feed_shape_report", O.FEED_SHAPE)
def feed_shape_report_q(spark, sf_dir):
    """Payloads or features that break each feed-shape rule, over all landed event payloads and odd ones."""
    text = D.event_feed_text(spark, sf_dir).select("value").union(D.odd_feed_text(spark, sf_dir).select("value"))
    return IN.shape_report(IN.intake(text, "usgs"))


@register("flatten_weather", f"""
SELECT {O.lat_expr('event_id', D.OBS_LAT_MULT)} AS lat, {O.lon_expr('event_id', D.OBS_LON_MULT)} AS lon, 'UTC' AS tz,
       strftime(ts, '%Y-%m-%d') AS date, 'standard' AS units, CAST(user_id AS DOUBLE) AS cloud_cover, value AS humidity,
       value / {O.dbl(4.0)} AS precipitation,
       CASE WHEN event_type <> 'error' THEN value + {O.dbl(250.0)} END AS temperature_min,
       CASE WHEN event_type <> 'error' THEN value + {O.dbl(260.0)} END AS temperature_max,
       {O.dbl(1000.0)} + user_id AS pressure,
       CASE WHEN event_type NOT IN ('signup', 'view') THEN value / {O.dbl(3.0)} END AS wind
FROM events""")
def flatten_weather_q(spark, sf_dir):
    """Nested weather payloads (absent / scalar sub-objects) flattened by name."""
    w = D.weather_payload_text(spark, sf_dir)
    return LD.flatten_weather(w.select(F.from_json("value", SC.WEATHER_PAYLOAD).alias("payload")))


@register("array_table_rows", f"""
SELECT name, TRY_CAST(CASE WHEN census_id % 50 = 0 THEN 'n/a' ELSE CAST(census_id * 37 % 100000 AS VARCHAR) END AS INTEGER) AS pop,
       CAST(0 AS INTEGER) AS hisp, CAST(census_id % 56 AS INTEGER) AS state, CAST(census_id % 1000 AS INTEGER) AS county
FROM ({O.CENSUS_NAMES}) n""")
def array_table_rows_q(spark, sf_dir):
    """S3: census array tables (header row skipped) bound to typed columns by position."""
    p = D.census_payload_text(spark, sf_dir).select(F.from_json("value", SC.CENSUS_PAYLOAD).alias("payload"))
    rows = LD.array_table_rows(p)
    return rows.select(*[F.col(c).try_cast(t).alias(c) for c, t in SC.CENSUS_COLUMNS])


def _geocode_payloads(spark, sf_dir):
    g = D.geocode_payload_text(spark, sf_dir)
    return g.select("query_id", F.from_json("value", SC.GEOCODE_PAYLOAD).alias("payload"))


@register("geocode_filter_distinct", f"""
SELECT DISTINCT name, lat, lon, country, state FROM ({O.GEOCODE_RESULTS}) r WHERE result_pos < 5 AND country = 'US'""")
def geocode_filter_distinct_q(spark, sf_dir):
    """S4 + A4: first 5 results, US only, local_names dropped, whole-record distinct."""
    return LD.geocode_results(_geocode_payloads(spark, sf_dir), limit=SC.GEOCODE_RESULT_LIMIT).drop("result_pos").distinct()


@register("topk_per_key", f"SELECT * FROM ({O.GEOCODE_RESULTS}) r WHERE result_pos < 5")
def topk_per_key_q(spark, sf_dir):
    """At most 5 results per looked-up area, by payload position (no shuffle)."""
    return LD.geocode_results(_geocode_payloads(spark, sf_dir), country=None, limit=SC.GEOCODE_RESULT_LIMIT, keep=("query_id",))


# --- nested helpers: N1-N4 -----------------------------------------------------------------


@register("nested_get_default", """
SELECT event_id, coalesce(json_extract_string(props, '$.k'), 'none') AS k,
       coalesce(json_extract_string(props, '$.x.y'), 'none') AS xy FROM events""")
def nested_get_default_q(spark, sf_dir):
    """Value at a path of a JSON object, default when a step is missing."""
    e = D.table(spark, sf_dir, "events")
    return e.select("event_id", N.json_get("props", ["k"], "none").alias("k"), N.json_get("props", ["x", "y"], "none").alias("xy"))


@register("nested_lift", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k_value, CAST(NULL AS VARCHAR) AS xy FROM events""")
def nested_lift_q(spark, sf_dir):
    """Lift props.k to a top-level column (old object removed); a missing path lifts null."""
    e = D.table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint, x struct<z: string>").alias("p"))
    out = N.struct_lift(e, ["k_value"], ["p", "k"])
    out = N.struct_lift(out.withColumn("q", F.struct(F.lit(1).alias("a"))), ["xy"], ["q", "x", "y"])
    return out.select("event_id", "k_value", F.col("xy").cast("string").alias("xy"))


@register("nested_set", """
SELECT event_id, event_type AS meta_kind_type, user_id AS meta_kind_user, value * 2 AS meta_value, props AS meta_raw
FROM events""")
def nested_set_q(spark, sf_dir):
    """N2 + N4: build meta.kind.{type,user}, set meta.value twice (overwrite), flatten with '_'."""
    e = D.table(spark, sf_dir, "events")
    out = N.struct_set(e.select("event_id", "event_type", "user_id", "value", "props"), ["meta", "kind", "type"], F.col("event_type"))
    out = N.struct_set(out, ["meta", "kind", "user"], F.col("user_id"))
    out = N.struct_set(out, ["meta", "value"], F.col("value"))
    out = N.struct_set(out, ["meta", "value"], F.col("value") * 2)
    out = N.struct_set(out, ["meta", "raw"], F.col("props"))
    return N.flatten_struct(out.select("event_id", "meta"), sep="_")


@register("flatten_struct", """
SELECT s_suppkey, s_name AS "info.s_name", s_nationkey AS "info.account.s_nationkey",
       s_acctbal AS "info.account.s_acctbal" FROM supplier""")
def flatten_struct_q(spark, sf_dir):
    """A JSON document per supplier parsed and flattened to dotted column names."""
    s = D.table(spark, sf_dir, "supplier")
    doc = F.to_json(F.struct("s_suppkey", F.struct("s_name", F.struct("s_nationkey", "s_acctbal").alias("account")).alias("info")))
    schema = "s_suppkey bigint, info struct<s_name: string, account: struct<s_nationkey: int, s_acctbal: double>>"
    return N.flatten_struct(s.select(F.from_json(doc, schema).alias("d")).select("d.*"))


# --- gold layer: J1, J4, X3 -------------------------------------------------------------------


def _ntz(df):
    """Wall-clock timestamps for comparison with the oracle (session time zone is UTC)."""
    return df.withColumns({f.name: F.col(f"`{f.name}`").cast("timestamp_ntz") for f in df.schema.fields
                           if f.dataType.typeName() == "timestamp"})


def _gold_inputs(spark, sf_dir):
    """Silver frames for the gold layer, produced by the silver transforms themselves."""
    weather = LY.silver_weather(D.weather_raw(spark, sf_dir))
    staged, _ = LY.stage_usgs(LD.flatten_event_feed(_parsed_feed(spark, sf_dir)))
    usgs = LY.silver_usgs(staged.withColumn("update_tm", F.lit(D.SILVER_TS).cast("timestamp")))
    geocode = LY.silver_geocode(D.geocode_raw(spark, sf_dir))
    census = LY.silver_census(D.census_raw(spark, sf_dir))
    return weather, usgs, geocode, census


@register("location_dimension", O.LOCATION_DIM)
def location_dimension_q(spark, sf_dir):
    """Geocode places LEFT JOIN census areas on (name_key, state); area_name coalesced."""
    _, _, geocode, census = _gold_inputs(spark, sf_dir)
    return location_dimension(geocode, census, keys=["name_key", "state"])


@register("location_fact", O.location_fact_sql())
def location_fact_q(spark, sf_dir):
    """Customers and events matched to their nearest part place, joined on that place."""
    locs = D.part_locations(spark, sf_dir)
    w = nearest_location(D.customer_observations(spark, sf_dir), locs, id_col="obs_id", obs_lat="lat", obs_lon="lon",
                         tie_breakers=["loc_id"], ids_unique=True)
    q = nearest_location(D.event_observations(spark, sf_dir), locs, id_col="event_id", obs_lat="latitude",
                         obs_lon="longitude", tie_breakers=["loc_id"])
    return location_fact(w, q)


@register("gold_fact", O.GOLD_FACT)
def gold_fact_q(spark, sf_dir):
    """X3 flagship: silver weather/quakes/places -> nearest places -> attribute_table."""
    return _ntz(LY.gold_tables(*_gold_inputs(spark, sf_dir))["attribute_table"])


@register("gold_dim_date", O.GOLD_DIM_DATE)
def gold_dim_date_q(spark, sf_dir):
    """dim_date spanning the fact's weather dates."""
    return LY.gold_tables(*_gold_inputs(spark, sf_dir))["dim_date"]


# --- sinks, round trips and the layers over landed files: S5, S7, S8, K1-K7, X1-X4 -----------


CSV_RUN_TS = _dt.datetime(2024, 1, 15, 6, 0, 0)


@register("csv_roundtrip", "SELECT * FROM orders")
def csv_roundtrip_q(spark, sf_dir):
    """K1 + S5: orders landed as dated header CSV, read back bound by name to the typed schema."""
    o = D.table(spark, sf_dir, "orders")
    path = K.write_landed_csv(o, work_dir(spark, "csv"), "orders", CSV_RUN_TS)
    return read_csv(spark, path, o.schema)


@register("csv_roundtrip_text", "SELECT * FROM conversations")
def csv_roundtrip_text_q(spark, sf_dir):
    """K2 + S5 on whole texts (commas, quotes, line breaks survive the CSV hand-off)."""
    c = D.table(spark, sf_dir, "conversations")
    path = work_dir(spark, "csvtext")
    K.write_export(c, path, "overwrite")
    return read_csv(spark, path, c.schema, multi_line=True)


def _database(spark, label):
    root = work_dir(spark, label)
    db = f"gm_{root.rsplit('-', 1)[-1]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root}/_database'")
    return db, root


@register("full_extract", "SELECT * FROM lineitem")
def full_extract_q(spark, sf_dir):
    """S7 + K7: a typed catalog table created empty, loaded, then extracted whole."""
    li = D.table(spark, sf_dir, "lineitem")
    db, root = _database(spark, "extract")
    K.create_table(spark, f"{db}.lineitem", li.schema, root)
    K.replace_table(li, f"{db}.lineitem", root, "1")
    return spark.table(f"{db}.lineitem")


@register("bulk_load_by_name", "SELECT o_orderpriority, o_totalprice, o_orderkey, o_orderdate FROM orders")
def bulk_load_by_name_q(spark, sf_dir):
    """K4 + K5: staging truncated, then loaded from a frame whose column order differs (bound by name)."""
    from pyspark.sql import types as T

    db, root = _database(spark, "staging")
    schema = T.StructType([T.StructField("o_orderpriority", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
                           T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderdate", T.TimestampNTZType())])
    t = f"{db}.orders_insert"
    K.create_table(spark, t, schema, root)
    o = D.table(spark, sf_dir, "orders")
    K.append_staging(o.withColumn("o_totalprice", F.lit(0.0)), t)  # a stale load
    K.truncate_staging(spark, [t])
    K.append_staging(o, t)
    return spark.table(t)


@register("gold_publish", O.LOCATION_DIM)
def gold_publish_q(spark, sf_dir):
    """K6: the location dimension published to the catalog, read back from the table."""
    _, _, geocode, census = _gold_inputs(spark, sf_dir)
    db, root = _database(spark, "gold")
    K.publish(location_dimension(geocode, census, keys=["name_key", "state"]), f"{db}.location_dimension", root, "1")
    return spark.table(f"{db}.location_dimension")


def _run_layers(spark, sf_dir, silver: bool, odd: bool = False, rules: dict | None = None):
    db, root = _database(spark, "layers")
    landed = land_payloads(spark, sf_dir, f"{root}/landed", odd)
    m = LY.Medallion(spark, db, f"{root}/warehouse")
    m.create()
    run_ts = _dt.datetime.fromisoformat(O.BRONZE_RUN_TS)
    m.bronze(landed, run_ts, rules=rules)
    if silver:
        m.silver(run_ts)
    return m


def _layer_query(name: str, sql: str, layer: str, doc: str) -> None:
    def query(spark, sf_dir):
        m = _run_layers(spark, sf_dir, silver=layer == "silver")
        return _ntz(m.read(name) if layer == "silver" else spark.table(m.t(name)))

    query.__doc__ = doc
    register(f"{layer}_{name.split('_')[0]}", sql)(query)


_layer_query("weather_raw", O.BRONZE_WEATHER, "bronze", "X1: weather_raw after one run.")
_layer_query("census_raw", O.BRONZE_CENSUS, "bronze", "X1: census_raw after one run.")
_layer_query("geocode_raw", O.BRONZE_GEOCODE, "bronze", "X1: geocode_raw after one run.")
_layer_query("usgs_silver", O.SILVER_USGS_AFTER_RUN, "silver", "X2: usgs_silver after one run.")
_layer_query("census_silver", O.SILVER_CENSUS_AFTER_RUN, "silver", "X2: census_silver after one run.")
_layer_query("geocode_silver", O.SILVER_GEOCODE_AFTER_RUN, "silver", "X2: geocode_silver after one run.")


@register("gold_layer", O.GOLD_FACT_AFTER_RUN)
def gold_layer_q(spark, sf_dir):
    """One full run over landed folders; the published attribute_table."""
    m = _run_layers(spark, sf_dir, silver=True)
    run_ts = _dt.datetime.fromisoformat(O.BRONZE_RUN_TS)
    m.gold("first")
    m.record_run("first", run_ts)
    return _ntz(m.read("attribute_table"))


@register("gold_second_run", O.GOLD_FACT_AFTER_SECOND_RUN)
def gold_second_run_q(spark, sf_dir):
    """The fact after a second run, which pairs the new weather days and the places of new quakes only."""
    db, root = _database(spark, "layers")
    m = LY.Medallion(spark, db, f"{root}/warehouse")
    m.create()
    runs = ((O.BRONZE_RUN_TS, ("0000", O.SECOND_WEATHER_DAY)), (O.SECOND_RUN_TS, (O.SECOND_WEATHER_DAY, "9999")))
    for n, (at, days) in enumerate(runs):
        run_ts = _dt.datetime.fromisoformat(at)
        m.bronze(land_payloads(spark, sf_dir, f"{root}/landed{n}", weather_days=days), run_ts)
        m.silver(run_ts)
        mode = m.gold(f"run{n}")
        m.record_run(f"run{n}", run_ts)
    return _ntz(m.read("attribute_table")).withColumn("mode", F.lit(mode))


@register("run_log_append", "SELECT 'orders' AS job_id, max(o_orderdate) AS last_updated, 'Succeeded' AS status FROM orders")
def run_log_append_q(spark, sf_dir):
    """A run recorded with the newest order time; the log as it reads back."""
    db, root = _database(spark, "log")
    m = LY.Medallion(spark, db, f"{root}/warehouse")
    m.create()
    newest = D.table(spark, sf_dir, "orders").agg(F.max("o_orderdate").cast("timestamp_ntz")).first()[0]
    m.record_run("orders", newest)
    return _ntz(spark.table(m.t("run_log")))


@register("export_refuses_existing", "SELECT *, true AS refused FROM customer")
def export_refuses_existing_q(spark, sf_dir):
    """K3: an export to a path that exists fails and leaves what is there."""
    n = D.table(spark, sf_dir, "customer")
    path = work_dir(spark, "export")
    K.write_export(n, path)
    try:
        K.write_export(n.limit(0), path)
        refused = False
    except AnalysisException as ex:
        refused = "PATH_ALREADY_EXISTS" in str(ex)
    return read_csv(spark, path, n.schema).withColumn("refused", F.lit(refused))


@register("merge_rejects_duplicates", """
SELECT true AS rejected, count(*) AS n_keys FROM (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1) d""")
def merge_rejects_duplicates_q(spark, sf_dir):
    """M3: a source with several rows for a key fails the merge; the keys that do."""
    li = D.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    try:
        merge_upsert(li.limit(0), li, ["l_orderkey"], update_col=None)
        rejected = False
    except DuplicateSourceKeyError:
        rejected = True
    return QC.duplicate_keys(li, ["l_orderkey"]).agg(F.count("*").alias("n_keys")).withColumn("rejected", F.lit(rejected))


@register("replay_reaches_silver", O.SILVER_WEATHER_AFTER_REPLAY)
def replay_reaches_silver_q(spark, sf_dir):
    """S8 + X2 + X4: a recorded run, then its landed weather CSV corrected (one degree more) and replayed
    at the same run time; silver holds the corrected rows, though its watermark had passed the run."""
    m = _run_layers(spark, sf_dir, silver=True)
    run_ts = _dt.datetime.fromisoformat(O.BRONZE_RUN_TS)
    m.record_run("first", run_ts)
    base = f"{m.root.rsplit('/', 1)[0]}/landed/csv"
    landed = read_csv(spark, K.landed_csv_path(base, "weather", run_ts), SC.STAGING["weather"], multi_line=True)
    fixed = landed.withColumn("temperature_max", F.col("temperature_max") + 1.0)
    K.write_landed_csv(fixed, f"{base}-fixed/csv", "weather", run_ts)
    for e in ("usgs", "census", "geocode"):
        same = read_csv(spark, K.landed_csv_path(base, e, run_ts), SC.STAGING[e], multi_line=True)
        K.write_landed_csv(same, f"{base}-fixed/csv", e, run_ts)
    m.bronze(f"{base}-fixed", run_ts, source="csv")
    m.silver(run_ts)
    return _ntz(m.read("weather_silver").drop("update_tm"))


@register("replay_equals_fresh", O.dedup_sql(
    f"SELECT {', '.join(chr(34) + c + chr(34) for c in _EVENT_COLS)} FROM ({O.EVENT_FLAT}) e "
    "WHERE place IS NOT NULL AND time IS NOT NULL", ["place", "time"],
    ["updated DESC NULLS LAST"] + O.asc_last([c for c in _EVENT_COLS if c not in ("place", "time", "updated")])))
def replay_equals_fresh_q(spark, sf_dir):
    """The landed CSV of a backfill over all days replayed into empty tables of another database gives the tables of the run."""
    first = _run_layers(spark, sf_dir, silver=False, rules={})
    landed = f"{first.root.rsplit('/', 1)[0]}/landed"
    db, root = _database(spark, "replayed")
    m = LY.Medallion(spark, db, f"{root}/warehouse")
    m.create()
    m.bronze(landed, _dt.datetime.fromisoformat(O.BRONZE_RUN_TS), source="csv", rules={})
    return _ntz(spark.table(m.t("usgs_raw")).select(*_EVENT_COLS))


@register("bronze_outcomes", O.BRONZE_OUTCOMES)
def bronze_outcomes_q(spark, sf_dir):
    """What became of every landed row and payload, by feed, and how many of them a table keeps for inspection."""
    m = _run_layers(spark, sf_dir, silver=False, odd=True)
    bad = spark.table(m.t("rejected_payloads")).select("entity", F.lit("bad_payload").alias("outcome"))
    rejected = [spark.table(m.t(f"{e}_rejected")).select(F.lit(e).alias("entity"), F.lit("rejected").alias("outcome")) for e in LY.ENTITIES]
    kept = reduce(DataFrame.union, rejected, bad).groupBy("entity", "outcome").agg(F.count("*").alias("n"))
    counts = spark.table(m.t("feed_outcomes")).drop("reported_tm").join(kept, ["entity", "outcome"], "left")
    inspected = F.col("outcome").isin("bad_payload", "rejected")
    return counts.select("entity", "outcome", "n_rows", F.when(inspected, F.coalesce("n", F.lit(0))).alias("n_kept"))


@register("bronze_rejected_payloads", O.BRONZE_REJECTED_PAYLOADS)
def bronze_rejected_payloads_q(spark, sf_dir):
    """The text of every landed payload that does not parse, as the layer keeps it."""
    m = _run_layers(spark, sf_dir, silver=False, odd=True)
    return spark.table(m.t("rejected_payloads")).select("entity", "payload")


@register("bronze_feed_report", O.FEED_SHAPE)
def bronze_feed_report_q(spark, sf_dir):
    """A9 + X1: the shape report that a run keeps."""
    m = _run_layers(spark, sf_dir, silver=False, odd=True)
    return spark.table(m.t("feed_report")).select("rule", "n_rejected")


@register("bronze_rejects", O.BRONZE_REJECTS)
def bronze_rejects_q(spark, sf_dir):
    """A6 + A8: every landed quake is valid, rejected (kept in a table) or outside the feed window."""
    m = _run_layers(spark, sf_dir, silver=False)
    rejected = spark.table(m.t("usgs_rejected"))
    return rejected.agg(
        F.count("*").alias("n_rejected"), F.count_if(F.col("place").isNull()).alias("no_place"), F.count_if(F.col("time").isNull()).alias("no_time"),
        F.count_if(F.col("mag").isNull()).alias("no_mag"),
    )


@register("bronze_stream", O.STREAM_USGS)
def bronze_stream_q(spark, sf_dir):
    """Bronze through Structured Streaming: landed folders read as file streams (availableNow),
    each micro-batch staged and merged; usgs_raw without its wall-clock update_tm."""
    from geomedallion.streaming import bronze_streams

    db, root = _database(spark, "stream")
    landed = land_payloads(spark, sf_dir, f"{root}/landed")
    m = LY.Medallion(spark, db, f"{root}/warehouse")
    m.create()
    bronze_streams(m, landed, f"{root}/streams", entities=("usgs",))
    return _ntz(spark.table(m.t("usgs_raw")).drop("update_tm"))


@register("bronze_layer", O.BRONZE_USGS)
def bronze_layer_q(spark, sf_dir):
    """Landed payload folders -> window, checks, staging, merge -> usgs_raw."""
    m = _run_layers(spark, sf_dir, silver=False)
    return _ntz(spark.table(m.t("usgs_raw")))


@register("silver_layer", O.SILVER_WEATHER_AFTER_RUN)
def silver_layer_q(spark, sf_dir):
    """Bronze then silver (watermark from an empty run log = epoch) -> weather_silver."""
    m = _run_layers(spark, sf_dir, silver=True)
    return _ntz(spark.table(m.t("weather_silver")))
