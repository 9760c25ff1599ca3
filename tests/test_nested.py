"""The reference's four unit cases (nested set / get / lift / lift with a missing path), on Spark."""

import json

from pyspark.sql import functions as F

from geomedallion.functions import nested as N

DOC = {"one": {"two": {"three": {"one": "testing", "two": "thing", "three": "thing2"}, "four": "leaf"}}}
SCHEMA = "one struct<two: struct<three: struct<one: string, two: string, three: string>, four: string>>"


def _doc_frame(spark):
    return spark.createDataFrame([(json.dumps(DOC),)], "j string").select(F.from_json("j", SCHEMA).alias("d")).select("d.*")


def test_set_creates_intermediate_objects(spark):
    df = spark.range(1)
    df = N.struct_set(df, ["one", "two", "three"], "test")
    df = N.struct_set(df, ["one", "two", "four", "leaf"], "testing")
    df = N.struct_set(df, ["one", "three", "four"], "testing")
    got = json.loads(df.select(F.to_json("one")).first()[0])
    assert got == {"two": {"three": "test", "four": {"leaf": "testing"}}, "three": {"four": "testing"}}


def test_set_overwrites_existing_leaf_and_null_parent(spark):
    df = spark.createDataFrame([(1, None), (2, (5,))], "id int, a struct<b: int>")
    out = N.struct_set(df, ["a", "b"], F.lit(9))
    assert [r[0] for r in out.orderBy("id").select("a.b").collect()] == [9, 9]


def test_get_returns_leaf(spark):
    df = _doc_frame(spark)
    assert df.select(N.struct_get(df, ["one", "two", "three", "two"])).first()[0] == "thing"


def test_get_default_when_step_missing_or_not_object(spark):
    df = _doc_frame(spark)
    assert df.select(N.struct_get(df, ["one", "two", "six", "one"], "dflt")).first()[0] == "dflt"
    assert df.select(N.struct_get(df, ["one", "two", "four", "x"], "dflt")).first()[0] == "dflt"


def test_lift_replaces_top_level_object(spark):
    out = N.struct_lift(_doc_frame(spark), ["one"], ["one", "two", "three", "one"])
    assert out.columns == ["one"]
    assert out.first()["one"] == "testing"


def test_lift_missing_path_sets_null(spark):
    out = N.struct_lift(_doc_frame(spark), ["one"], ["one", "two", "six", "one"])
    assert "one" in out.columns
    assert out.first()["one"] is None


def test_json_get(spark):
    df = spark.createDataFrame([('{"a": {"b": 3}}',), ('{"a": 5}',), ("{}",)], "j string")
    got = [r[0] for r in df.select(N.json_get("j", ["a", "b"], "none")).collect()]
    assert got == ["3", "none", "none"]


def test_flatten_struct(spark):
    df = _doc_frame(spark)
    flat = N.flatten_struct(df)
    assert flat.columns == ["one.two.three.one", "one.two.three.two", "one.two.three.three", "one.two.four"]
    assert N.flatten_struct(df, sep="_").columns[0] == "one_two_three_one"


def test_present_null_is_not_missing(spark):
    from pyspark.sql import functions as F

    from geomedallion.functions import nested as N

    rows = [('{"a": null, "x": {"y": null}}',), ('{"a": 1, "x": 5}',), ('{"x": null}',), ("[1]",), (None,)]
    df = spark.createDataFrame(rows, "j string")
    got = [tuple(r) for r in df.select(N.json_get("j", ["a"], "none"), N.json_get("j", ["x", "y"], "none")).collect()]
    assert got == [(None, None), ("1", "none"), ("none", "none"), ("none", "none"), ("none", "none")]
    st = spark.createDataFrame([((None,),), (None,)], "p struct<k: string>")
    assert [r[0] for r in st.select(N.struct_get(st, ["p", "k"], "none")).collect()] == [None, "none"]
