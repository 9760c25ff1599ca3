"""DuckDB SQL equivalents of the registered workloads (the correctness oracle).

Built from the same fixed values as the Spark side. Double constants are written as
``CAST('<repr>' AS DOUBLE)`` because a plain decimal literal is DECIMAL in DuckDB.
"""

from __future__ import annotations

from geomedallion.functions.geo import DISTANCE_DIGITS, EARTH_RADIUS_KM, GRID_BIN_DEGREES, KM_PER_MILE
from geomedallion.plans import derived as D


def dbl(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def lat_expr(key: str, mult: int) -> str:
    return f"({dbl(D.LAT_BASE)} + CAST({key} * {mult} % {D.LAT_SPAN} AS DOUBLE) / {dbl(100.0)})"


def lon_expr(key: str, mult: int) -> str:
    return f"({dbl(D.LON_BASE)} + CAST({key} * {mult} % {D.LON_SPAN} AS DOUBLE) / {dbl(100.0)})"


def bin_expr(c: str) -> str:
    return f"CAST(floor({c} / {dbl(GRID_BIN_DEGREES)}) AS BIGINT)"


def round_half_up(x: str, digits: int) -> str:
    s = dbl(10.0 ** digits)
    return f"(floor(({x}) * {s} + {dbl(0.5)}) / {s})"


def miles_expr(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    h = (
        f"pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)"
    )
    s = f"sqrt({h})"
    raw = f"{dbl(2 * EARTH_RADIUS_KM / KM_PER_MILE)} * asin(CASE WHEN {s} > {dbl(1.0)} THEN {dbl(1.0)} ELSE {s} END)"
    return round_half_up(raw, DISTANCE_DIGITS)


CUSTOMER_OBS = f"""
  SELECT c_custkey AS obs_id, c_name AS obs_name,
         {lat_expr('c_custkey', D.OBS_LAT_MULT)} AS lat, {lon_expr('c_custkey', D.OBS_LON_MULT)} AS lon
  FROM customer"""

EVENT_OBS = f"""
  SELECT event_id, ts, event_type, value AS mag,
         {lat_expr('event_id', D.OBS_LAT_MULT)} AS latitude, {lon_expr('event_id', D.OBS_LON_MULT)} AS longitude
  FROM events"""

PART_LOCS = f"""
  SELECT p_partkey AS loc_id, p_name AS loc_name,
         {lat_expr('p_partkey', D.LOC_LAT_MULT)} AS geo_lat, {lon_expr('p_partkey', D.LOC_LON_MULT)} AS geo_lon
  FROM part"""

SUPPLIER_LOCS = f"""
  SELECT s_suppkey AS loc_id, s_name AS loc_name,
         {lat_expr('s_suppkey', D.LOC_LAT_MULT)} AS geo_lat, {lon_expr('s_suppkey', D.LOC_LON_MULT)} AS geo_lon
  FROM supplier"""


def nearest_sql(obs_sql: str, obs_cols: list[str], id_col: str, lat: str, lon: str, locs_sql: str) -> str:
    oc = ", ".join(f"o.{c}" for c in obs_cols)
    return f"""
WITH o AS (SELECT *, {bin_expr(lat)} AS lat_bin, {bin_expr(lon)} AS lon_bin FROM ({obs_sql}) x),
l AS (SELECT *, {bin_expr('geo_lat')} AS lat_bin, {bin_expr('geo_lon')} AS lon_bin FROM ({locs_sql}) y
      WHERE geo_lat IS NOT NULL AND geo_lon IS NOT NULL),
c AS (
  SELECT {oc}, o.lat_bin, o.lon_bin, l.loc_id, l.loc_name, l.geo_lat, l.geo_lon,
         {miles_expr('o.' + lat, 'o.' + lon, 'l.geo_lat', 'l.geo_lon')} AS dist_miles
  FROM o LEFT JOIN l ON o.lat_bin = l.lat_bin AND o.lon_bin = l.lon_bin),
r AS (SELECT *, row_number() OVER (PARTITION BY {id_col} ORDER BY dist_miles ASC NULLS LAST, loc_id ASC) AS rn FROM c)
SELECT * EXCLUDE (rn) FROM r WHERE rn = 1
"""


def bin_candidates_sql(obs_sql: str, obs_cols: list[str], lat: str, lon: str, locs_sql: str) -> str:
    oc = ", ".join(f"o.{c}" for c in obs_cols)
    return f"""
WITH o AS (SELECT *, {bin_expr(lat)} AS lat_bin, {bin_expr(lon)} AS lon_bin FROM ({obs_sql}) x),
l AS (SELECT *, {bin_expr('geo_lat')} AS lat_bin, {bin_expr('geo_lon')} AS lon_bin FROM ({locs_sql}) y)
SELECT {oc}, o.lat_bin, o.lon_bin, l.loc_id, l.loc_name, l.geo_lat, l.geo_lon,
       {miles_expr('o.' + lat, 'o.' + lon, 'l.geo_lat', 'l.geo_lon')} AS dist_miles
FROM o LEFT JOIN l ON o.lat_bin = l.lat_bin AND o.lon_bin = l.lon_bin
"""


CENSUS_NAMES = """
  SELECT c_custkey AS census_id,
         CASE WHEN c_nationkey % 5 = 4 THEN area
              WHEN c_nationkey % 7 = 6 THEN area || ', ' || n_name || ', US'
              ELSE area || ', ' || n_name END AS name
  FROM (SELECT c.*, n.n_name,
               CASE WHEN c_nationkey % 3 = 0 THEN c_name || ' County'
                    WHEN c_nationkey % 3 = 1 THEN c_name || ' Parish'
                    ELSE c_name END AS area
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey) z"""


def area_sql(c: str) -> str:
    return f"trim(CASE WHEN strpos({c}, ',') > 0 THEN substr({c}, 1, strpos({c}, ',') - 1) ELSE {c} END)"


def state_sql(c: str) -> str:
    return f"trim(CASE WHEN strpos({c}, ',') > 0 THEN substr({c}, strpos({c}, ',') + 1) END)"


def county_sql(c: str) -> str:
    return f"coalesce(nullif(regexp_extract({c}, '^(.+) County', 1), ''), {c})"


ORDER_TARGET = """
  SELECT *, o_orderdate AS update_tm FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'"""

ORDER_SOURCE = f"""
  SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, o_totalprice + {dbl(1.0)} AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01 00:00:00'"""

EVENT_RUN_LOG = """
  SELECT strftime(day, '%Y%m%d') AS job_id, last_updated,
         CASE WHEN day <= DATE '2024-01-20' THEN 'Succeeded'
              WHEN day <= DATE '2024-01-25' THEN 'Failed' ELSE 'Running' END AS status
  FROM (SELECT CAST(ts AS DATE) AS day, max(ts) AS last_updated FROM events GROUP BY 1) d"""

WEATHER_READINGS = f"""
  SELECT event_id AS reading_id,
         {lat_expr('event_id', D.OBS_LAT_MULT)} AS lat, {lon_expr('event_id', D.OBS_LON_MULT)} AS lon,
         ts AS date, value - {dbl(10.0)} AS temperature_min,
         CASE WHEN event_type <> 'error' THEN value + {dbl(10.0)} END AS temperature_max
  FROM events"""


def calendar_sql(dates_sql: str) -> str:
    return f"""
SELECT d AS date, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(year(d) AS INTEGER) AS year,
       CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
       strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_short, CAST(day(d) AS INTEGER) AS day,
       CAST(isodow(d) AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_name,
       CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(year(date_trunc('week', d)) AS INTEGER) AS iso_year,
       strftime(d, '%Y-%m') AS year_month, isodow(d) IN (6, 7) AS is_weekend, day(d) = 1 AS is_month_start,
       last_day(d) = d AS is_month_end, month(d) = 1 AND day(d) = 1 AS is_year_start,
       month(d) = 12 AND day(d) = 31 AS is_year_end
FROM ({dates_sql}) s"""


def date_series_sql(col_sql: str, table: str) -> str:
    return f"""
SELECT CAST(g AS DATE) AS d FROM (
  SELECT min(CAST({col_sql} AS DATE)) AS lo, max(CAST({col_sql} AS DATE)) AS hi FROM {table}
  WHERE CAST({col_sql} AS DATE) <> DATE '1970-01-01') b,
  generate_series(b.lo, b.hi, INTERVAL 1 DAY) t(g)"""


def typed_null(t: str) -> str:
    return f"CAST(NULL AS {t})"


EVENT_FLAT = f"""
  SELECT value AS mag,
         CASE WHEN event_type IN ('error', 'signup') THEN NULL
              WHEN event_type = 'click' THEN 'near user ' || CAST(user_id AS VARCHAR) || '| CA'
              ELSE event_type || ' zone' END AS place,
         date_trunc('millisecond', ts) AS time,
         CASE WHEN event_type <> 'view' THEN date_trunc('millisecond', ts) + INTERVAL 60 SECOND END AS updated,
         {typed_null('VARCHAR')} AS tz, {typed_null('VARCHAR')} AS felt, {typed_null('VARCHAR')} AS cdi,
         {typed_null('VARCHAR')} AS mmi, {typed_null('VARCHAR')} AS alert, 'reviewed' AS status,
         CAST(0 AS INTEGER) AS tsunami, CAST(user_id AS INTEGER) AS sig, 'ev' AS net, CAST(event_id AS VARCHAR) AS code,
         {typed_null('INTEGER')} AS nst, {typed_null('DOUBLE')} AS dmin, value / {dbl(10.0)} AS rms,
         {typed_null('INTEGER')} AS gap, 'md' AS "magType", 'earthquake' AS type, 'Event ' || CAST(event_id AS VARCHAR) AS title,
         CASE WHEN event_type <> 'purchase' THEN {lat_expr('event_id', D.OBS_LAT_MULT)} END AS latitude,
         CASE WHEN event_type <> 'purchase' THEN {lon_expr('event_id', D.OBS_LON_MULT)} END AS longitude,
         event_type
  FROM events"""

GEOCODE_RESULTS = f"""
  SELECT query_id, CAST(i AS INTEGER) AS result_pos,
         CASE WHEN i = 2 THEN s_name || ' Heights' ELSE s_name END AS name,
         {lat_expr('query_id', D.LOC_LAT_MULT)} + (CASE WHEN i <= 2 THEN 0 ELSE i END) * {dbl(0.01)} AS lat,
         {lon_expr('query_id', D.LOC_LON_MULT)} + (CASE WHEN i <= 2 THEN 0 ELSE i END) * {dbl(0.01)} AS lon,
         CASE WHEN i = 3 THEN 'CA' ELSE 'US' END AS country, 'S' || CAST(s_nationkey AS VARCHAR) AS state
  FROM (SELECT s_suppkey AS query_id, s_name, s_nationkey, unnest(range(0, 6)) AS i FROM supplier) s"""


# --- gold layer --------------------------------------------------------------------------------

def round2(x: str) -> str:
    """Spark's round(double, 2): half-up on the shortest decimal text of the double."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38, 20)), 2) AS DOUBLE)"


def dedup_sql(src: str, keys: list[str], order: list[str]) -> str:
    return f"""SELECT * FROM ({src}) d
  QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {', '.join(order)}) = 1"""


def asc_last(cols) -> list[str]:
    return [f'"{c}" ASC NULLS LAST' for c in cols]


SILVER_TS_SQL = f"TIMESTAMP '{D.SILVER_TS}'"
PLACE_NAME = "upper(p_name) || ' ' || CAST(p_partkey AS VARCHAR)"

GEOCODE_SILVER = dedup_sql(f"""
  SELECT {PLACE_NAME} AS name, replace(lower({PLACE_NAME}), ' ', '') AS name_key,
         {round2(lat_expr('p_partkey', D.LOC_LAT_MULT))} AS lat, {round2(lon_expr('p_partkey', D.LOC_LON_MULT))} AS lon,
         'US' AS country, p_brand AS state, {SILVER_TS_SQL} AS update_tm
  FROM part""", ["name_key", "lat", "lon"], ["update_tm DESC NULLS LAST"] + asc_last(["name", "country", "state"]))

_CENSUS_STATE = f"CASE WHEN p_size >= {D.CENSUS_MIN_SIZE} THEN p_brand ELSE 'Elsewhere' END"
_CENSUS_NAME = f"{PLACE_NAME} || ' County, ' || {_CENSUS_STATE}"
CENSUS_SILVER = dedup_sql(f"""
  SELECT {_CENSUS_NAME} AS name,
         replace(lower({county_sql(area_sql(_CENSUS_NAME))}), ' ', '') AS name_key,
         {state_sql(_CENSUS_NAME)} AS state_name, CAST(p_size * 1000 AS INTEGER) AS pop, {SILVER_TS_SQL} AS update_tm
  FROM part""", ["name"], ["update_tm DESC NULLS LAST"] + asc_last(["pop", "state_name", "name_key"]))

LOCATION_DIM = f"""
  SELECT g.name_key, g.lat AS geo_lat, g.lon AS geo_lon, g.country, g.state, CAST(c.pop AS BIGINT) AS pop,
         coalesce(g.name, c.name) AS area_name
  FROM ({GEOCODE_SILVER}) g LEFT JOIN ({CENSUS_SILVER}) c ON g.name_key = c.name_key AND g.state = c.state_name"""

_WEATHER_COLS = ["tz", "units", "cloud_cover", "humidity", "precipitation", "temperature_min", "temperature_max",
                 "pressure", "wind"]
WEATHER_SILVER = dedup_sql(f"""
  SELECT lat, lon, tz, date, units, cloud_cover, humidity, precipitation,
         temperature_min - {dbl(273.15)} AS temperature_min, temperature_max - {dbl(273.15)} AS temperature_max,
         pressure, wind, update_tm
  FROM (
    SELECT {round2(lat_expr('event_id', D.OBS_LAT_MULT))} AS lat, {round2(lon_expr('event_id', D.OBS_LON_MULT))} AS lon,
           'UTC' AS tz, coalesce(date_trunc('day', ts), TIMESTAMP '1970-01-01 00:00:00') AS date, 'standard' AS units,
           CAST(user_id AS DOUBLE) AS cloud_cover, value AS humidity, value / {dbl(4.0)} AS precipitation,
           value - {dbl(5.0)} AS temperature_min, value + {dbl(260.0)} AS temperature_max,
           {dbl(1000.0)} + user_id AS pressure, value / {dbl(3.0)} AS wind, {SILVER_TS_SQL} AS update_tm
    FROM events) r
  WHERE temperature_min IS NOT NULL AND temperature_min >= 0 AND temperature_max IS NOT NULL AND temperature_max >= 0""",
    ["lat", "lon", "date"], ["update_tm DESC NULLS LAST"] + asc_last(_WEATHER_COLS))

_USGS = ["mag", "place", "time", "updated", "tz", "felt", "cdi", "mmi", "alert", "status", "tsunami", "sig", "net", "code",
         "nst", "dmin", "rms", "gap", "magType", "type", "title", "latitude", "longitude"]
_USGS_REST = [c for c in _USGS if c not in ("place", "time", "updated")]


def _usgs_staged(condition: str = "") -> str:
    return dedup_sql(
        f"SELECT {', '.join(chr(34) + c + chr(34) for c in _USGS)} FROM ({EVENT_FLAT}) e WHERE place IS NOT NULL AND time IS NOT NULL{condition}",
        ["place", "time"], ["updated DESC NULLS LAST"] + asc_last(_USGS_REST))


_USGS_STAGED = _usgs_staged()
USGS_SILVER = dedup_sql(f"""
  SELECT mag, place, coalesce(time, TIMESTAMP '1970-01-01 00:00:00') AS time,
         coalesce(updated, TIMESTAMP '1970-01-01 00:00:00') AS updated, tz, felt, cdi, mmi, alert, status, tsunami, sig,
         net, code, nst, dmin, rms, gap, "magType", type, title, {round2('latitude')} AS latitude,
         {round2('longitude')} AS longitude, {SILVER_TS_SQL} AS update_tm
  FROM ({_USGS_STAGED}) s""", ["place", "time"], ["update_tm DESC NULLS LAST"] + asc_last([c for c in _USGS if c not in ("place", "time")]))


def _id_sql(ts: str, lat: str, lon: str) -> str:
    return (f"sha256(concat_ws('||', strftime({ts}, '%Y-%m-%d %H:%M:%S.%f'), CAST(CAST({lat} AS DECIMAL(18, 2)) AS VARCHAR), "
            f"CAST(CAST({lon} AS DECIMAL(18, 2)) AS VARCHAR)))")


_LOC_COLS = ["name_key", "geo_lat", "geo_lon", "country", "state", "pop", "area_name"]


def _nearest_gold(obs_sql: str, obs_cols: list[str], id_col: str, lat: str, lon: str, unique: bool, places: str) -> str:
    oc = ", ".join(f'o."{c}"' for c in obs_cols)
    lc = ", ".join(f"l.{c}" for c in _LOC_COLS)
    rest = [c for c in obs_cols + ["lat_bin", "lon_bin"] if c != id_col]
    order = ["dist_miles ASC NULLS LAST", "geo_lat ASC NULLS FIRST", "geo_lon ASC NULLS FIRST", "name_key ASC NULLS FIRST"]
    if not unique:
        order += [f'"{c}" ASC NULLS FIRST' for c in rest]
    return f"""
  SELECT * EXCLUDE (rn) FROM (
    SELECT c.*, row_number() OVER (PARTITION BY {id_col} ORDER BY {', '.join(order)}) AS rn FROM (
      SELECT {oc}, o.lat_bin, o.lon_bin, {lc},
             {miles_expr('o.' + lat, 'o.' + lon, 'l.geo_lat', 'l.geo_lon')} AS dist_miles
      FROM (SELECT *, {bin_expr(lat)} AS lat_bin, {bin_expr(lon)} AS lon_bin FROM ({obs_sql}) x) o
      LEFT JOIN (SELECT *, {bin_expr('geo_lat')} AS lat_bin, {bin_expr('geo_lon')} AS lon_bin FROM ({places}) y
                 WHERE geo_lat IS NOT NULL AND geo_lon IS NOT NULL) l
        ON o.lat_bin = l.lat_bin AND o.lon_bin = l.lon_bin) c) r
  WHERE rn = 1"""


_W_OBS = ["lat", "lon", "tz", "date", "units", "cloud_cover", "humidity", "precipitation", "temperature_min",
          "temperature_max", "pressure", "wind", "update_tm", "weather_id"]
_Q_OBS = _USGS + ["update_tm", "usgs_id"]
_FACT_W = [c for c in _W_OBS if c != "update_tm"] + ["lat_bin", "lon_bin"] + _LOC_COLS + ["dist_miles"]
_FACT_Q = [c for c in _USGS] + ["dist_miles", "usgs_id"]


def gold_fact_sql(weather: str, usgs: str, places: str) -> str:
    w = _nearest_gold(f"SELECT *, {_id_sql('date', 'lat', 'lon')} AS weather_id FROM ({weather}) w", _W_OBS, "weather_id", "lat", "lon", True, places)
    q = _nearest_gold(f"SELECT *, {_id_sql('time', 'latitude', 'longitude')} AS usgs_id FROM ({usgs}) u", _Q_OBS, "usgs_id", "latitude", "longitude", False, places)
    return f"""
SELECT {', '.join(f'w."{c}"' for c in _FACT_W)},
       {', '.join(f'q."{c}" AS "{c if c.startswith("usgs_") else "usgs_" + c}"' for c in _FACT_Q)}
FROM ({w}) w LEFT JOIN ({q}) q ON w.geo_lat = q.geo_lat AND w.geo_lon = q.geo_lon"""


GOLD_FACT = gold_fact_sql(WEATHER_SILVER, USGS_SILVER, LOCATION_DIM)

GOLD_DIM_DATE = calendar_sql(f"""
SELECT CAST(g AS DATE) AS d FROM (
  SELECT min(CAST(date AS DATE)) AS lo, max(CAST(date AS DATE)) AS hi FROM ({GOLD_FACT}) f
  WHERE CAST(date AS DATE) <> DATE '1970-01-01') b, generate_series(b.lo, b.hi, INTERVAL 1 DAY) t(g)""")


def location_fact_sql() -> str:
    w = nearest_sql(CUSTOMER_OBS, ["obs_id", "obs_name", "lat", "lon"], "obs_id", "lat", "lon", PART_LOCS)
    q = nearest_sql(EVENT_OBS, ["event_id", "ts", "event_type", "mag", "latitude", "longitude"],
                    "event_id", "latitude", "longitude", PART_LOCS)
    qcols = ["event_id", "ts", "event_type", "mag", "latitude", "longitude", "loc_id", "loc_name", "dist_miles"]
    return f"""
SELECT w.*, {', '.join(f'q.{c} AS usgs_{c}' for c in qcols)}
FROM ({w}) w LEFT JOIN ({q}) q ON w.geo_lat = q.geo_lat AND w.geo_lon = q.geo_lon"""


# --- layers over landed files ------------------------------------------------------------------

BRONZE_RUN_TS = "2024-01-15 06:00:00"
BRONZE_WINDOW = ("2024-01-14 00:00:00", "2024-01-15 00:00:00")



def _usgs_raw(start: str, end: str) -> str:
    staged = dedup_sql(
        f"""SELECT {', '.join(chr(34) + c + chr(34) for c in _USGS)} FROM ({EVENT_FLAT}) e
        WHERE place IS NOT NULL AND time IS NOT NULL AND time >= TIMESTAMP '{start}'
          AND time < TIMESTAMP '{end}' AND mag >= 2""",
        ["place", "time"], ["updated DESC NULLS LAST"] + asc_last(_USGS_REST))
    return f"SELECT *, TIMESTAMP '{BRONZE_RUN_TS}' AS update_tm, CAST(time AS DATE) AS day FROM ({staged}) b"


BRONZE_USGS = _usgs_raw(*BRONZE_WINDOW)

_WEATHER_STAGED = dedup_sql(f"""
  SELECT {lat_expr('event_id', D.OBS_LAT_MULT)} AS lat, {lon_expr('event_id', D.OBS_LON_MULT)} AS lon, 'UTC' AS tz,
         CAST(CAST(ts AS DATE) AS TIMESTAMP) AS date, 'standard' AS units, CAST(user_id AS DOUBLE) AS cloud_cover,
         value AS humidity, value / {dbl(4.0)} AS precipitation,
         CASE WHEN event_type <> 'error' THEN value + {dbl(250.0)} END AS temperature_min,
         CASE WHEN event_type <> 'error' THEN value + {dbl(260.0)} END AS temperature_max,
         {dbl(1000.0)} + user_id AS pressure,
         CASE WHEN event_type NOT IN ('signup', 'view') THEN value / {dbl(3.0)} END AS wind
  FROM events""", ["lat", "lon", "date"], asc_last(_WEATHER_COLS))

def _silver_weather(correction: str = "") -> str:
    return dedup_sql(f"""
  SELECT {round2('lat')} AS lat, {round2('lon')} AS lon, tz, coalesce(date, TIMESTAMP '1970-01-01 00:00:00') AS date,
         units, cloud_cover, humidity, precipitation, temperature_min - {dbl(273.15)} AS temperature_min,
         temperature_max{correction} - {dbl(273.15)} AS temperature_max, pressure, wind, TIMESTAMP '{BRONZE_RUN_TS}' AS update_tm,
         CAST(coalesce(date, TIMESTAMP '1970-01-01 00:00:00') AS DATE) AS day
  FROM ({_WEATHER_STAGED}) s
  WHERE temperature_min IS NOT NULL AND temperature_min >= 0 AND temperature_max IS NOT NULL AND temperature_max >= 0""",
    ["lat", "lon", "date"], ["update_tm DESC NULLS LAST"] + asc_last(_WEATHER_COLS))


_RUN_TM = f"TIMESTAMP '{BRONZE_RUN_TS}' AS update_tm"
BRONZE_WEATHER = f"SELECT *, {_RUN_TM}, CAST(date AS DATE) AS day FROM ({_WEATHER_STAGED}) s"

CENSUS_ROWS = f"""
  SELECT name, TRY_CAST(CASE WHEN census_id % 50 = 0 THEN 'n/a' ELSE CAST(census_id * 37 % 100000 AS VARCHAR) END AS INTEGER) AS pop,
         CAST(0 AS INTEGER) AS hisp, CAST(census_id % 56 AS INTEGER) AS state, CAST(census_id % 1000 AS INTEGER) AS county
  FROM ({CENSUS_NAMES}) n"""
BRONZE_CENSUS = f"""SELECT *, {_RUN_TM} FROM ({dedup_sql(
    f"SELECT * FROM ({CENSUS_ROWS}) c WHERE name IS NOT NULL AND length(name) <= 50", ["name"], asc_last(["pop", "hisp", "state", "county"]))}) s"""
BRONZE_GEOCODE = f"""SELECT *, {_RUN_TM} FROM ({dedup_sql(
    f"""SELECT DISTINCT name, lat, lon, country, state FROM ({GEOCODE_RESULTS}) g
        WHERE result_pos < 5 AND country = 'US' AND name IS NOT NULL AND length(name) <= 50 AND length(state) <= 50""",
    ["name", "lat", "lon"], asc_last(["country", "state"]))}) s"""



def _silver_usgs(raw: str) -> str:
    return dedup_sql(f"""
  SELECT mag, place, coalesce(time, TIMESTAMP '1970-01-01 00:00:00') AS time,
         coalesce(updated, TIMESTAMP '1970-01-01 00:00:00') AS updated, tz, felt, cdi, mmi, alert, status, tsunami, sig,
         net, code, nst, dmin, rms, gap, "magType", type, title, {round2('latitude')} AS latitude,
         {round2('longitude')} AS longitude, update_tm
  FROM ({raw}) s""", ["place", "time"], ["update_tm DESC NULLS LAST"] + asc_last([c for c in _USGS if c not in ("place", "time")]))


SILVER_USGS_AFTER_RUN = _silver_usgs(BRONZE_USGS)
SILVER_CENSUS_AFTER_RUN = dedup_sql(f"""
  SELECT name, replace(lower({county_sql(area_sql('name'))}), ' ', '') AS name_key, {state_sql('name')} AS state_name, pop, update_tm
  FROM ({BRONZE_CENSUS}) s""", ["name"], ["update_tm DESC NULLS LAST"] + asc_last(["pop", "state_name", "name_key"]))
SILVER_GEOCODE_AFTER_RUN = dedup_sql(f"""
  SELECT name, replace(lower(name), ' ', '') AS name_key, {round2('lat')} AS lat, {round2('lon')} AS lon, country, state, update_tm
  FROM ({BRONZE_GEOCODE}) s""", ["name_key", "lat", "lon"], ["update_tm DESC NULLS LAST"] + asc_last(["name", "country", "state"]))

SILVER_WEATHER_AFTER_RUN = _silver_weather()
SILVER_WEATHER_AFTER_REPLAY = f"SELECT * EXCLUDE (update_tm, day) FROM ({_silver_weather(f' + {dbl(1.0)}')}) s"

BRONZE_REJECTS = f"""
  SELECT count(*) AS n_rejected, count(*) FILTER (place IS NULL) AS no_place, count(*) FILTER (time IS NULL) AS no_time,
         count(*) FILTER (mag IS NULL) AS no_mag
  FROM ({EVENT_FLAT}) e WHERE place IS NULL OR time IS NULL OR mag IS NULL"""


ODD_CASE = f"c_custkey % {D.ODD_FEED_CASES}"
FEED_SHAPE = f"""
  SELECT rule, CAST(sum(n) AS BIGINT) AS n_rejected FROM (
    SELECT unnest(['no_features', 'no_properties', 'no_geometry', 'short_coordinates', 'bad_place', 'bad_title', 'no_time', 'no_updated']) AS rule,
           unnest([0, 0, 0, count_if(event_type = 'purchase'), count_if(event_type IN ('error', 'signup')), 0, 0, count_if(event_type = 'view')]) AS n
    FROM events
    UNION ALL
    SELECT unnest(['no_features', 'no_properties', 'no_geometry', 'short_coordinates', 'bad_place', 'bad_title', 'no_time', 'no_updated']),
           unnest([count_if({ODD_CASE} IN (0, 1, 8)), count_if({ODD_CASE} = 2), count_if({ODD_CASE} = 3), count_if({ODD_CASE} = 3),
                   count_if({ODD_CASE} = 2), count_if({ODD_CASE} IN (2, 4)), count_if({ODD_CASE} IN (2, 5)), count_if({ODD_CASE} = 2)])
    FROM customer) r GROUP BY rule"""

_USGS_OUTCOME = f"""CASE WHEN place IS NULL OR time IS NULL OR mag IS NULL THEN 'rejected'
  WHEN time >= TIMESTAMP '{BRONZE_WINDOW[0]}' AND time < TIMESTAMP '{BRONZE_WINDOW[1]}' AND mag >= 2 THEN 'valid' ELSE 'out_of_window' END"""
BRONZE_OUTCOMES = f"""
  WITH found AS (
    SELECT 'usgs' AS entity, {_USGS_OUTCOME} AS outcome FROM ({EVENT_FLAT}) e
    UNION ALL
    SELECT 'usgs', CASE WHEN {ODD_CASE} IN (0, 1, 8) THEN 'empty_payload' WHEN {ODD_CASE} IN (6, 7) THEN 'bad_payload'
                        WHEN {ODD_CASE} IN (2, 5) THEN 'rejected' ELSE 'valid' END FROM customer
    UNION ALL
    SELECT 'census', CASE WHEN name IS NULL OR length(name) > 50 THEN 'rejected' ELSE 'valid' END FROM ({CENSUS_ROWS}) c
    UNION ALL
    SELECT 'geocode', CASE WHEN name IS NULL OR length(name) > 50 OR length(state) > 50 THEN 'rejected' ELSE 'valid' END
    FROM ({GEOCODE_RESULTS}) g WHERE result_pos < 5 AND country = 'US'
    UNION ALL
    SELECT 'weather', CASE WHEN ts IS NULL THEN 'rejected' ELSE 'valid' END FROM events),
  every AS (
    SELECT entity, outcome FROM (SELECT unnest(['usgs', 'census', 'geocode', 'weather']) AS entity) e,
           (SELECT unnest(['valid', 'rejected', 'out_of_window', 'bad_payload', 'empty_payload']) AS outcome) o),
  counted AS (
    SELECT every.entity, every.outcome, count(found.entity) AS n_rows
    FROM every LEFT JOIN found ON every.entity = found.entity AND every.outcome = found.outcome GROUP BY every.entity, every.outcome)
  SELECT *, CASE WHEN outcome IN ('bad_payload', 'rejected') THEN n_rows END AS n_kept FROM counted"""

BRONZE_REJECTED_PAYLOADS = f"""
  SELECT 'usgs' AS entity, CASE WHEN {ODD_CASE} = 7 THEN '[' || c_custkey || ']' ELSE '{{"type":"FeatureCollection","features":[{{' END AS payload
  FROM customer WHERE {ODD_CASE} IN (6, 7)"""

STREAM_USGS = f"SELECT *, CAST(time AS DATE) AS day FROM ({_usgs_staged(' AND mag >= 2')}) s"

_PLACES_AFTER_RUN = f"""
  SELECT g.name_key, g.lat AS geo_lat, g.lon AS geo_lon, g.country, g.state, CAST(c.pop AS BIGINT) AS pop,
         coalesce(g.name, c.name) AS area_name
  FROM ({SILVER_GEOCODE_AFTER_RUN}) g LEFT JOIN ({SILVER_CENSUS_AFTER_RUN}) c ON g.name_key = c.name_key AND g.state = c.state_name"""
GOLD_FACT_AFTER_RUN = gold_fact_sql(SILVER_WEATHER_AFTER_RUN, SILVER_USGS_AFTER_RUN, _PLACES_AFTER_RUN)

# a second run a day later, which lands the weather from SECOND_WEATHER_DAY on and quakes of the next window
SECOND_RUN_TS, SECOND_WEATHER_DAY = "2024-01-16 06:00:00", "2024-01-24"
_SECOND_USGS = _silver_usgs(_usgs_raw(BRONZE_WINDOW[0], "2024-01-16 00:00:00"))
GOLD_FACT_AFTER_SECOND_RUN = f"""SELECT *, 'delta' AS mode FROM ({gold_fact_sql(SILVER_WEATHER_AFTER_RUN, _SECOND_USGS, _PLACES_AFTER_RUN)}) f"""
