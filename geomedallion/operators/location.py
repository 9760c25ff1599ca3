"""Gold-layer joins: the location dimension (J1) and the location fact."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geomedallion.operators.joins import DEFAULT_ROWS_PER_SALT, salted_left_join
from geomedallion.operators.nearest import BIN_COLS
from geomedallion.session import ensure_checkpoint_dir

__all__ = ["location_dimension", "location_fact", "LOCATION_ATTRS", "USGS_PREFIX"]

LOCATION_ATTRS = ("name_key", "country", "state", "pop", "area_name")
USGS_PREFIX = "usgs_"


def location_dimension(geocode: DataFrame, census: DataFrame, keys: Sequence[str] = ("name_key",)) -> DataFrame:
    """Geocode LEFT JOIN census on the normalised name key; ``area_name`` is the geocode
    name, else the census name; both source names are dropped (ruling D24 for ``keys``).

    geocode: name_key, name, lat, lon, country, state. census: name_key, name, pop
    (and ``state_name`` when ``state`` is a key). The census side is small (one row per
    county); Spark/AQE choose broadcast from its size, no hint is forced here.
    """
    match = [geocode["name_key"] == census["name_key"]]
    if "state" in keys:
        match.append(geocode["state"] == census["state_name"])
    return geocode.join(census, match, "left").select(
        geocode["name_key"],
        geocode["lat"].cast("double").alias("geo_lat"),
        geocode["lon"].cast("double").alias("geo_lon"),
        geocode["country"],
        geocode["state"],
        census["pop"].cast("long").alias("pop"),
        F.coalesce(geocode["name"], census["name"]).alias("area_name"),
    )


def location_fact(
    weather_loc: DataFrame,
    usgs_loc: DataFrame,
    *,
    drop: Sequence[str] = ("update_tm",),
    rows_per_salt: int = DEFAULT_ROWS_PER_SALT,
    location_rows_bound: int | None = None,
    checkpoint_quakes: bool = True,
    checkpoint_weather: bool = True,
) -> DataFrame:
    """Weather-with-location LEFT JOIN quake-with-location on exact (geo_lat, geo_lon).

    Every weather day pairs with every quake of its location (no time predicate); null
    locations never match. Quake side: bins and location attributes dropped, the rest
    prefixed ``usgs_`` (ruling D28). The join is salted against hot locations.
    ``location_rows_bound``: proven row bound of the location dimension (bounds the keys).
    ``checkpoint_quakes``: the salted join reads the quake side twice (per-key counts, rows);
    a reliable checkpoint (shared ``spark.checkpoint.dir``) computes the nearest match once
    and cuts its lineage. ``checkpoint_weather``: likewise for the weather side, which the join reads twice
    (days with quakes and days without).
    """
    keys = ["geo_lat", "geo_lon"]
    w = weather_loc.drop(*[c for c in drop if c in weather_loc.columns])
    q = usgs_loc.drop(*[c for c in (*drop, *BIN_COLS, *LOCATION_ATTRS) if c in usgs_loc.columns])
    q = q.select(*keys, *[F.col(f"`{c}`").alias(c if c.startswith(USGS_PREFIX) else USGS_PREFIX + c)
                          for c in q.columns if c not in keys])
    if checkpoint_quakes:
        ensure_checkpoint_dir(q.sparkSession)
        q = q.checkpoint(eager=True)
    if checkpoint_weather:
        ensure_checkpoint_dir(w.sparkSession)
        w = w.checkpoint(eager=True)
    return salted_left_join(w, q, keys, rows_per_salt=rows_per_salt, key_rows_bound=location_rows_bound)
