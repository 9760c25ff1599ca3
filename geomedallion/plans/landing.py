"""Scratch locations and landed-payload folders for workloads that write.

Scratch space is always under the shared checkpoint folder the session names in
``spark.checkpoint.dir``; where that is unset, local sessions (tests) use a private folder and a cluster
gets an error.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from geomedallion.plans import derived as D
from geomedallion.session import ensure_checkpoint_dir


def work_dir(spark: SparkSession, label: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/geomedallion-work/{label}-{uuid.uuid4().hex[:12]}"


def land_payloads(spark: SparkSession, sf_dir: str, landed_dir: str, odd: bool = False, weather_days: tuple[str, str] | None = None) -> str:
    """Write the derived payloads as landed JSON Lines folders: events/ weather/ census/ geocode/; with ``odd``,
    event payloads that break the feed's rules land beside the others; ``weather_days`` (from, before) limits weather."""
    d = landed_dir.rstrip("/")
    D.event_feed_text(spark, sf_dir).select("value").write.mode("overwrite").text(f"{d}/events")
    if odd:
        D.odd_feed_text(spark, sf_dir).select("value").write.mode("append").text(f"{d}/events")
    weather = D.weather_payload_text(spark, sf_dir, weather_days)
    weather.select("value").write.mode("overwrite").text(f"{d}/weather")
    D.census_payload_text(spark, sf_dir).select("value").write.mode("overwrite").text(f"{d}/census")
    D.geocode_payload_text(spark, sf_dir).select("value").write.mode("overwrite").text(f"{d}/geocode")
    return d
