import datetime as dt

import payloads as P
from pyspark.sql import functions as F

from geomedallion import schemas as SC
from geomedallion.sinks import tables as K
from geomedallion.sources import landed as LD
from geomedallion.sources.csv import read_csv


def test_read_events_all_features(spark, tmp_path):
    root = P.write(str(tmp_path))
    ev = LD.read_events(spark, f"{root}/events")
    rows = {r.title + str(r.mag): r for r in ev.collect()}
    assert ev.count() == 8  # every feature, not only the first (ruling D1)
    assert set(ev.columns) == {c for c, _ in SC.USGS_COLUMNS}
    good = rows["M title2.5"]
    assert (good.place, good.latitude, good.longitude) == ("10 km N of Town| CA", 35.21, -120.51)
    assert good.time == dt.datetime(2024, 3, 1, 10, 0) and good.updated == dt.datetime(2024, 3, 1, 10, 1)
    lone = rows["M title2.2"]
    assert lone.latitude is None and lone.longitude is None
    assert rows["M title2.3"].place is None and rows["M title2.4"].place is None
    assert rows["M title2.6"].updated is None


def test_event_feed_report(spark, tmp_path):
    root = P.write(str(tmp_path))
    rep = {r.rule: r.n_rejected for r in LD.event_feed_report(LD.read_event_feed(spark, f"{root}/events")).collect()}
    assert rep["no_features"] == 1 and rep["short_coordinates"] == 1 and rep["bad_place"] == 2 and rep["no_updated"] == 1


def test_read_weather_by_name(spark, tmp_path):
    root = P.write(str(tmp_path))
    w = {r.lat: r for r in LD.read_weather(spark, f"{root}/weather").collect()}
    full = w[35.2123]
    assert (full.cloud_cover, full.humidity, full.precipitation, full.pressure, full.wind) == (40.0, 60.0, 1.5, 1015.0, 7.5)
    assert (full.temperature_min, full.temperature_max) == (280.15, 290.15)  # bound by name (ruling D2)
    assert w[34.05].wind is None and w[36.5].wind is None and w[36.5].temperature_min == 281.0
    assert w[33.0].temperature_min is None and w[33.7].temperature_max is None


def test_read_array_table_skips_header(spark, tmp_path):
    root = P.write(str(tmp_path))
    rows = LD.read_array_table(spark, f"{root}/census").collect()
    assert len(rows) == 6 and rows[0].name == "San Luis Obispo County, California" and rows[0].county == "079"


def test_read_geocode_limit_us_distinct(spark, tmp_path):
    root = P.write(str(tmp_path))
    g = sorted((r.name, r.lat) for r in LD.read_geocode(spark, f"{root}/geocode").collect())
    assert g == [("Obispo Town", 35.21), ("Orange", 28.54), ("Orange", 34.05), ("Quiet Valley", 36.5),
                 ("San Luis Obispo", 35.21), ("San Luis Obispo", 35.2828)]


def test_csv_roundtrip_and_modes(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", ok\nnext', dt.datetime(2024, 1, 1, 5))], "id int, txt string, ts timestamp")
    path = K.write_landed_csv(df, str(tmp_path), "usgs", dt.datetime(2024, 1, 2, 3, 4, 5))
    assert path.endswith("run_date=2024-01-02/2024-01-02_03-04-05_usgs_raw")
    back = read_csv(spark, path, df.schema, multi_line=True).collect()  # the text holds a line break
    assert [tuple(r) for r in back] == [tuple(r) for r in df.collect()]
    try:
        K.write_export(df, path)  # default mode refuses an existing path (K3)
        raised = False
    except Exception:
        raised = True
    assert raised
    K.write_export(df.where(F.lit(False)), path, "overwrite")  # K2
    assert read_csv(spark, path).count() == 0


def test_csv_bind_by_name_malformed_and_missing(spark, tmp_path):
    from pyspark.sql import types as T

    path = str(tmp_path / "in.csv")
    with open(path, "w") as fh:
        fh.write("pop,name,extra\n12,A,x\nn/a,B,y\n")
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("pop", T.IntegerType()),
                           T.StructField("county", T.IntegerType())])
    got = [tuple(r) for r in read_csv(spark, path, schema).orderBy("name").collect()]
    assert got == [("A", 12, None), ("B", None, None)]  # by name; malformed -> null; absent -> null


def test_staging_load_fails_on_missing_columns_and_malformed_values(spark, tmp_path):
    import pytest
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.DoubleType())])
    spark.sql("CREATE DATABASE IF NOT EXISTS gm_test_strict")
    K.create_table(spark, "gm_test_strict.staged", schema, str(tmp_path))
    good = spark.createDataFrame([("1.5", 1), (None, 2)], "v string, id int")
    K.load_staging(good, "gm_test_strict.staged")
    assert sorted(tuple(r) for r in spark.table("gm_test_strict.staged").collect()) == [(1, 1.5), (2, None)]
    with pytest.raises(ValueError, match="missing"):
        K.append_staging(good.drop("v"), "gm_test_strict.staged")
    with pytest.raises(Exception, match="malformed value in v"):
        K.append_staging(spark.createDataFrame([("x", 3)], "v string, id int"), "gm_test_strict.staged")
