import datetime as dt
import math


from geomedallion.functions import columns as C
from geomedallion.functions import geo as G


def test_name_key_county_and_split(spark):
    df = spark.createDataFrame(
        [("Autauga County, Alabama",), ("Acadia Parish, Louisiana",), ("No Comma",), ("A County, B, C",)], "name string")
    area, state = C.split_area_state("name")
    got = df.select(area.alias("a"), state.alias("s"), C.county_name(area).alias("c"),
                    C.name_key(C.county_name(area)).alias("k")).collect()
    assert [tuple(r) for r in got] == [
        ("Autauga County", "Alabama", "Autauga", "autauga"),
        ("Acadia Parish", "Louisiana", "Acadia Parish", "acadiaparish"),
        ("No Comma", None, "No Comma", "nocomma"),
        ("A County", "B, C", "A", "a"),
    ]


def test_null_short_strings(spark):
    df = spark.createDataFrame([("x",), (None,), ("a, b",), ("ab",)], "s string")
    assert [r[0] for r in df.select(C.null_short_strings("s")).collect()] == [None, None, "a| b", "ab"]


def test_fill_epoch_and_parse_date(spark):
    df = spark.createDataFrame([("2024-03-05",), ("garbage",), (None,)], "s string")
    parsed = df.select(C.parse_date("s").alias("d"))
    got = [r[0] for r in parsed.select(C.fill_epoch("d")).collect()]
    assert got[0] == dt.datetime(2024, 3, 5)
    assert got[1] == got[2] == dt.datetime(1970, 1, 1)


def test_valid_range_and_kelvin(spark):
    df = spark.createDataFrame([(300.0,), (-1.0,), (None,), (0.0,)], "t double")
    kept = df.where(C.valid_range("t")).select(C.kelvin_to_celsius("t")).collect()
    assert [round(r[0], 2) for r in kept] == [26.85, -273.15]


def test_row_hash_id_skips_nulls_and_formats_types(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5), 1.5, None), (dt.datetime(2024, 1, 2, 3, 4, 5), 1.5, 2.0)],
                               "t timestamp, a double, b double")
    text = [r[0] for r in df.select(C.row_id_text(df, ["t", "a", "b"])).collect()]
    assert text == ["2024-01-02 03:04:05.000000||1.50", "2024-01-02 03:04:05.000000||1.50||2.00"]
    ids = [r[0] for r in df.select(C.row_hash_id(df, ["t", "a", "b"])).collect()]
    assert len(ids[0]) == 64 and ids[0] != ids[1]


def test_day_window(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 15, 13, 45),)], "ts timestamp")
    s, e = C.day_window("ts")
    r = df.select(s, e).first()
    assert (r[0], r[1]) == (dt.datetime(2024, 1, 14), dt.datetime(2024, 1, 15))


def test_great_circle_matches_haversine(spark):
    pts = [(40.7128, -74.0060, 34.0522, -118.2437), (10.0, 10.0, 10.0, 10.0), (0.0, 0.0, 0.0, 180.0)]
    df = spark.createDataFrame(pts, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(G.great_circle_miles("a", "b", "c", "d")).collect()]
    for (a, b, c, d), g in zip(pts, got):
        p1, p2 = math.radians(a), math.radians(c)
        h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(d - b) / 2) ** 2
        want = 2 * G.EARTH_RADIUS_KM * math.asin(min(1.0, math.sqrt(h))) / G.KM_PER_MILE
        assert abs(g - want) < 1e-6
    assert abs(got[0] - 2445.6) < 1.0  # New York - Los Angeles


def test_great_circle_null_input_is_null(spark):
    df = spark.createDataFrame([(None, 1.0, 2.0, 3.0)], "a double, b double, c double, d double")
    assert df.select(G.great_circle_miles("a", "b", "c", "d")).first()[0] is None


def test_grid_bin(spark):
    df = spark.createDataFrame([(0.69,), (0.7,), (-0.1,), (None,)], "x double")
    assert [r[0] for r in df.select(G.grid_bin("x")).collect()] == [0, 1, -1, None]


def test_literals_do_not_depend_on_the_time_zone_of_the_process(spark):
    import os
    import subprocess
    import sys

    code = """
import datetime as dt, sys
sys.path.insert(0, %r)
from geomedallion.session import local_session
from geomedallion.functions import columns as C
from pyspark.sql import functions as F
s = local_session(cores=1, shuffle_partitions=1)
d = s.range(1).select(C.fill_epoch(F.lit(None).cast("timestamp")).cast("string"), C.ts_literal(dt.datetime(2024, 1, 2, 3)).cast("string"))
print("GOT", *d.first())
""" % os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], env=os.environ | {"TZ": "America/New_York"}, capture_output=True, text=True, timeout=120)
    assert "GOT 1970-01-01 00:00:00 2024-01-02 03:00:00" in out.stdout


def test_ids_tell_times_within_a_second_apart(spark):
    rows = [(dt.datetime(2024, 1, 2, 3, 4, 5, 100_000), 1.0), (dt.datetime(2024, 1, 2, 3, 4, 5, 900_000), 1.0)]
    df = spark.createDataFrame(rows, "t timestamp, a double")
    assert df.select(C.row_hash_id(df, ["t", "a"]).alias("i")).distinct().count() == 2
