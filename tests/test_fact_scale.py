"""The work of the fact's two steps: how often a side is computed, and which plan many places at few points take."""

import datetime as dt

from pyspark.sql import functions as F

from geomedallion.operators.location import location_fact
from geomedallion.operators.nearest import nearest_location
from geomedallion.plans import derived as D


def counted(df, seen):
    """``df`` with an accumulator of the rows that were computed."""

    def through(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return df.mapInArrow(through, df.schema)


def _observations(spark, n=300):
    at = [(F.col("id") * k % 97 / 50.0) for k in (7, 13)]
    far = F.when(F.col("id") % 5 == 0, F.lit(60.0)).when(F.col("id") % 7 == 0, F.lit(None)).otherwise(at[0])
    return spark.range(n).select(F.col("id").alias("obs_id"), far.cast("double").alias("lat"), at[1].alias("lon"))


def _places(spark, n, points):
    k = F.col("id") % points
    return spark.range(n).select(F.col("id").alias("loc_id"), (k % 10 / 5.0).alias("geo_lat"), (k % 9 / 5.0).alias("geo_lon"))


def test_shuffle_plan_computes_observations_once(spark):
    seen = spark.sparkContext.accumulator(0)
    obs = counted(_observations(spark), seen)
    found = nearest_location(obs, _places(spark, 90, 90), id_col="obs_id", obs_lat="lat", obs_lon="lon", tie_breakers=["loc_id"], ids_unique=True, broadcast_max_rows=0)
    want = nearest_location(_observations(spark), _places(spark, 90, 90), id_col="obs_id", obs_lat="lat", obs_lon="lon", tie_breakers=["loc_id"], ids_unique=True)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert seen.value == 300


def test_many_places_at_few_points_are_broadcast(spark):
    seen = spark.sparkContext.accumulator(0)
    args = dict(id_col="obs_id", obs_lat="lat", obs_lon="lon", tie_breakers=["loc_id"], ids_unique=True)
    found = nearest_location(counted(_observations(spark), seen), _places(spark, 2000, 20), broadcast_max_rows=50, **args)
    assert seen.value == 0  # the shuffle plan writes what it found to a checkpoint while it is planned
    want = nearest_location(_observations(spark), _places(spark, 2000, 20), **args)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert seen.value == 300


def test_fact_computes_each_side_once(spark):
    days, quakes = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)
    w = spark.range(200).select(F.col("id").alias("w"), (F.col("id") % 20).cast("double").alias("geo_lat"), F.lit(1.0).alias("geo_lon"))
    q = spark.range(90).select(F.col("id").alias("q"), (F.col("id") % 10).cast("double").alias("geo_lat"), F.lit(1.0).alias("geo_lon"))
    fact = location_fact(counted(w, days), counted(q, quakes), rows_per_salt=4)
    assert fact.count() == 100 * 9 + 100 and fact.where("usgs_q IS NULL").count() == 100
    assert days.value == 200 and quakes.value == 90


def test_weather_of_some_days_is_chosen_by_the_table(spark, tmp_path):
    start, kinds = dt.datetime(2024, 1, 20, 23, 0, 0), ("view", "click", "signup", "error", None)
    rows = [(i, None if i == 9 else start + dt.timedelta(hours=5 * i), i, kinds[i % 5], None if i % 6 == 0 else i / 3, "{}") for i in range(40)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/events.parquet")
    whole, date = D.weather_payload_text(spark, str(tmp_path)), F.get_json_object("value", "$.date")
    want = whole.where((date >= "2024-01-21") & (date < "2024-01-25"))
    found = D.weather_payload_text(spark, str(tmp_path), ("2024-01-21", "2024-01-25"))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    assert 5 < found.count() < 40
    assert "get_json_object" not in found._jdf.queryExecution().toString()
