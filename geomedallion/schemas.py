"""Schemas, keys and length limits of the payloads and the bronze / silver / gold tables.

Column lists, keys and VARCHAR limits are fixed values of the source tables (FIXTURES.md);
our tables bind every column by name (ruling D2).
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, I, L, TS, DT, B = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.TimestampType(), T.DateType(), T.BooleanType()


def struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# --- landed payloads ----------------------------------------------------------------------

EVENT_PROPERTIES = struct(
    ("mag", D), ("place", S), ("time", L), ("updated", L), ("tz", S), ("url", S), ("detail", S),
    ("felt", S), ("cdi", S), ("mmi", S), ("alert", S), ("status", S), ("tsunami", I), ("sig", I),
    ("net", S), ("code", S), ("ids", S), ("sources", S), ("types", S), ("nst", I), ("dmin", D),
    ("rms", D), ("gap", I), ("magType", S), ("type", S), ("title", S),
)
EVENT_FEATURE = struct(("properties", EVENT_PROPERTIES), ("geometry", struct(("coordinates", T.ArrayType(D)))))
EVENT_FEED = struct(("features", T.ArrayType(EVENT_FEATURE)))
EVENT_DROPPED = ("url", "detail", "sources", "types", "ids")

WEATHER_PAYLOAD = struct(
    ("lat", D), ("lon", D), ("tz", S), ("date", S), ("units", S),
    ("cloud_cover", struct(("afternoon", D))),
    ("humidity", struct(("afternoon", D))),
    ("precipitation", struct(("total", D))),
    ("temperature", struct(("min", D), ("max", D))),
    ("pressure", struct(("afternoon", D))),
    ("wind", struct(("max", struct(("speed", D))))),
)

CENSUS_PAYLOAD = T.ArrayType(T.ArrayType(S))
CENSUS_FIELDS = ("name", "pop", "hisp", "state", "county")

GEOCODE_RESULT = struct(
    ("name", S), ("local_names", T.MapType(S, S)), ("lat", D), ("lon", D), ("country", S), ("state", S),
)
GEOCODE_PAYLOAD = T.ArrayType(GEOCODE_RESULT)
GEOCODE_RESULT_LIMIT = 5  # results per looked-up area (API limit)

# --- bronze (raw) tables ------------------------------------------------------------------

USGS_COLUMNS = (
    ("mag", D), ("place", S), ("time", TS), ("updated", TS), ("tz", S), ("felt", S), ("cdi", S), ("mmi", S),
    ("alert", S), ("status", S), ("tsunami", I), ("sig", I), ("net", S), ("code", S), ("nst", I), ("dmin", D),
    ("rms", D), ("gap", I), ("magType", S), ("type", S), ("title", S), ("latitude", D), ("longitude", D),
)
CENSUS_COLUMNS = (("name", S), ("pop", I), ("hisp", I), ("state", I), ("county", I))
GEOCODE_COLUMNS = (("name", S), ("lat", D), ("lon", D), ("country", S), ("state", S))
WEATHER_COLUMNS = (
    ("lat", D), ("lon", D), ("tz", S), ("date", TS), ("units", S), ("cloud_cover", D), ("humidity", D),
    ("precipitation", D), ("temperature_min", D), ("temperature_max", D), ("pressure", D), ("wind", D),
)
UPDATE_COL = ("update_tm", TS)

STAGING = {
    "usgs": struct(*USGS_COLUMNS),
    "census": struct(*CENSUS_COLUMNS),
    "geocode": struct(*GEOCODE_COLUMNS),
    "weather": struct(*WEATHER_COLUMNS),
}
RAW = {k: struct(*[(f.name, f.dataType) for f in v.fields], UPDATE_COL) for k, v in STAGING.items()}

RAW_KEYS = {
    "usgs": ("place", "time"),
    "census": ("name",),
    "geocode": ("name", "lat", "lon"),  # ruling D34
    "weather": ("lat", "lon", "date"),
}

VARCHAR_LIMITS = {
    "usgs": {c: 50 for c, t in USGS_COLUMNS if t == S},
    "census": {"name": 50},
    "geocode": {"name": 50, "country": 50, "state": 50},
    "weather": {"tz": 25, "units": 15},
    "run_log": {"status": 20},
}

# Time-series tables are partitioned by the day of a key column, so a daily merge rewrites
# only the partitions its source touches (the key fixes the partition: rows never move).
PARTITION_COL = "day"
PARTITION_SOURCE = {"usgs": "time", "weather": "date"}

# Which day partitions each merge touched (table, day, run time): lets the silver pull read only
# the raw partitions changed since the watermark (dynamic partition pruning).
REJECTED_PAYLOADS = struct(("entity", S), ("payload", S), ("rejected_tm", TS))
FEED_OUTCOMES = struct(("entity", S), ("outcome", S), ("n_rows", L), ("reported_tm", TS))
FEED_REPORT = struct(("rule", S), ("n_rejected", L), ("reported_tm", TS))
GOLD_MARKS = struct(("mark", L))  # newest silver merge (microseconds) that each gold run has seen
GOLD_PLACES = struct(("geo_lat", D), ("geo_lon", D), ("mark", L))  # places whose quakes changed
TOUCHED_DAYS = struct(("table_name", S), ("day", DT), ("run_ts", TS), ("merge_id", S))

# --- silver tables ------------------------------------------------------------------------

SILVER = {
    "usgs": RAW["usgs"],
    "census": struct(("name", S), ("name_key", S), ("state_name", S), ("pop", I), UPDATE_COL),
    "geocode": struct(("name", S), ("name_key", S), ("lat", D), ("lon", D), ("country", S), ("state", S), UPDATE_COL),
    "weather": RAW["weather"],
}
SILVER_KEYS = {
    "usgs": ("place", "time"),
    "census": ("name",),  # ruling D23
    "geocode": ("name_key", "lat", "lon"),
    "weather": ("lat", "lon", "date"),
}
