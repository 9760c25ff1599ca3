"""Readers of landed payloads (S1-S4) and their parsers.

Each payload kind has a *parser* over a DataFrame holding the payload (a struct column or
JSON text) and a *reader* for landed files. Readers take whole directories, so one job
reads every landed file of a run (ruling D3) instead of one request at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geomedallion import schemas as SC
from geomedallion.functions.columns import epoch_millis_to_ts, null_short_strings
from geomedallion.operators.quality import rule_report

__all__ = [
    "flatten_event_feed", "event_columns", "event_rules", "event_feed_report", "read_event_feed", "read_events",
    "flatten_weather", "weather_columns", "read_weather",
    "array_table_rows", "array_columns", "read_array_table",
    "geocode_results", "read_geocode",
]


# Rules of the event feed's shape; the first is one of payloads, the others of features.
EVENT_RULES = ("no_features", "no_properties", "no_geometry", "short_coordinates", "bad_place", "bad_title", "no_time", "no_updated")


# --- S1: GeoJSON event feed ----------------------------------------------------------------

def _features(feed: DataFrame, col: str) -> DataFrame:
    return feed.select(F.explode(F.col(col).getField("features")).alias("f"))


def flatten_event_feed(feed: DataFrame, col: str = "feed") -> DataFrame:
    """One row per feature (all features, ruling D1), properties projected.

    latitude = coordinates[1], longitude = coordinates[0], both null when fewer than two;
    url/detail/sources/types/ids dropped; time/updated epoch-ms -> timestamp (UTC);
    place/title null when missing or shorter than 2 characters, else ',' -> '|'.
    """
    return _features(feed, col).select(*event_columns(F.col("f")))


def event_columns(f: Column) -> list[Column]:
    """The kept columns of one feature."""
    p = f.getField("properties")
    coords = f.getField("geometry").getField("coordinates")
    has_xy = F.coalesce(F.size(coords) >= 2, F.lit(False))
    kept = [c for c in SC.EVENT_PROPERTIES.fieldNames() if c not in SC.EVENT_DROPPED]
    special = {
        "place": null_short_strings(p.getField("place")),
        "title": null_short_strings(p.getField("title")),
        "time": epoch_millis_to_ts(p.getField("time")),
        "updated": epoch_millis_to_ts(p.getField("updated")),
    }
    cols = [special.get(c, p.getField(c)).alias(c) for c in kept]
    return cols + [
        F.when(has_xy, F.try_element_at(coords, F.lit(2))).alias("latitude"),
        F.when(has_xy, F.try_element_at(coords, F.lit(1))).alias("longitude"),
    ]


def event_rules(f: Column) -> dict[str, Column]:
    """The rules that a feature (not a payload) can break."""
    p, coords = f.getField("properties"), f.getField("geometry").getField("coordinates")
    return dict(zip(EVENT_RULES[1:], (
        p.isNull(),
        f.getField("geometry").isNull(),
        F.coalesce(F.size(coords) < 2, F.lit(True)),
        F.coalesce(F.length(p.getField("place")) < 2, F.lit(True)),
        F.coalesce(F.length(p.getField("title")) < 2, F.lit(True)),
        p.getField("time").isNull(),
        p.getField("updated").isNull(),
    ), strict=True))


def event_feed_report(feed: DataFrame, col: str = "feed") -> DataFrame:
    """Per-rule reject counts of a feed: payloads without features, and features
    lacking properties / geometry / two coordinates / a usable place or title / time / updated."""
    payloads = rule_report(feed, {EVENT_RULES[0]: F.coalesce(F.size(F.col(col).getField("features")) < 1, F.lit(True))})
    return payloads.unionByName(rule_report(_features(feed, col), event_rules(F.col("f"))))


def read_event_feed(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Landed GeoJSON payloads as a frame with one ``feed`` struct column.

    Default layout is one payload per line (JSON Lines: files split across tasks);
    ``multi_line=True`` reads one pretty-printed payload per file.
    """
    raw = spark.read.schema(SC.EVENT_FEED).option("multiLine", multi_line).option("mode", "PERMISSIVE").json(path)
    return raw.select(F.struct("features").alias("feed"))


def read_events(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return flatten_event_feed(read_event_feed(spark, path, multi_line))


# --- S2: weather day summaries ---------------------------------------------------------------

def flatten_weather(payload: DataFrame, col: str = "payload") -> DataFrame:
    """Nested day summary -> flat row, bound by name (ruling D2). Each nested value is null
    when its path is absent or a step is not an object (N1 semantics via the typed reader)."""
    return payload.select(*weather_columns(F.col(col)))


def weather_columns(w: Column) -> list[Column]:
    """The flat columns of one day summary."""
    return [
        w.getField("lat").alias("lat"),
        w.getField("lon").alias("lon"),
        w.getField("tz").alias("tz"),
        w.getField("date").alias("date"),
        w.getField("units").alias("units"),
        w.getField("cloud_cover").getField("afternoon").alias("cloud_cover"),
        w.getField("humidity").getField("afternoon").alias("humidity"),
        w.getField("precipitation").getField("total").alias("precipitation"),
        w.getField("temperature").getField("min").alias("temperature_min"),
        w.getField("temperature").getField("max").alias("temperature_max"),
        w.getField("pressure").getField("afternoon").alias("pressure"),
        w.getField("wind").getField("max").getField("speed").alias("wind"),
    ]


def read_weather(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All landed weather payloads of a directory in one read (one per line, or per file)."""
    raw = spark.read.schema(SC.WEATHER_PAYLOAD).option("multiLine", multi_line).json(path)
    return flatten_weather(raw.select(F.struct(*[F.col(c) for c in SC.WEATHER_PAYLOAD.fieldNames()]).alias("payload")))


# --- S3: array table with a header row -------------------------------------------------------

def array_table_rows(payload: DataFrame, names=SC.CENSUS_FIELDS, col: str = "payload") -> DataFrame:
    """S3: skip element 0 (the header) of each payload, name the remaining positions."""
    rows = payload.select(F.posexplode(F.col(col)).alias("__pos", "__row")).where(F.col("__pos") > 0)
    return rows.select(*array_columns(F.col("__row"), names))


def array_columns(row: Column, names=SC.CENSUS_FIELDS) -> list[Column]:
    """The named positions of one array row (S3)."""
    return [F.try_element_at(row, F.lit(i + 1)).alias(n) for i, n in enumerate(names)]


def _payload_text(spark: SparkSession, path: str, whole_text: bool) -> DataFrame:
    return spark.read.text(path, wholetext=whole_text)


def read_array_table(spark: SparkSession, path: str, names=SC.CENSUS_FIELDS, whole_text: bool = False) -> DataFrame:
    text = _payload_text(spark, path, whole_text)
    return array_table_rows(text.select(F.from_json("value", SC.CENSUS_PAYLOAD).alias("payload")), names)


# --- S4: geocode results ---------------------------------------------------------------------

def geocode_results(payload: DataFrame, col: str = "payload", country: str | None = "US",
                    limit: int | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Explode result arrays (position kept), optionally keep the first ``limit`` results of
    each payload (T2), keep ``country`` results, drop local_names."""
    r = payload.select(*keep, F.posexplode(F.col(col)).alias("result_pos", "__g"))
    if limit is not None:
        r = r.where(F.col("result_pos") < limit)
    if country is not None:
        r = r.where(F.col("__g.country") == country)
    return r.select(*keep, "result_pos", *[F.col("__g").getField(c).alias(c) for c, _ in SC.GEOCODE_COLUMNS])


def read_geocode(spark: SparkSession, path: str, whole_text: bool = False, limit: int | None = SC.GEOCODE_RESULT_LIMIT) -> DataFrame:
    """Landed geocode payloads -> first ``limit`` results (T2), US only, whole-record distinct (A4)."""
    text = _payload_text(spark, path, whole_text)
    parsed = text.select(F.from_json("value", SC.GEOCODE_PAYLOAD).alias("payload"))
    return geocode_results(parsed, limit=limit).drop("result_pos").distinct()
