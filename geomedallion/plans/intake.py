"""X1 intake: landed payloads are parsed once, into rows that say what becomes of them.

``intake`` turns the landed text of a feed into one frame: the staging columns of every row, and

- ``outcome``: ``valid``, ``rejected`` (A6 a null key part, A8 an over-long string) or ``out_of_window`` (P10) for
  rows; ``bad_payload`` for a payload that is no JSON or not of the feed's shape; ``empty_payload`` for one without rows;
- ``payload``: the text of a bad payload;
- ``broken``: the feed-shape rules (A9) that a payload or feature of the event feed breaks.

The bronze layer writes this frame and feeds all its sinks from it, so the landed text is read and parsed once,
and the outcomes add up to what landed. Everything here is stateless and works on streams too.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geomedallion import schemas as SC
from geomedallion.functions import columns as C
from geomedallion.operators import quality as QC
from geomedallion.sources import landed as LD
from geomedallion.sources.csv import bind_by_name

__all__ = ["ROW_OUTCOMES", "OUTCOMES", "payloads", "intake", "row_outcome", "tag_rows", "intake_schema", "feed_rows", "shape_report"]

VALID, REJECTED, OUT_OF_WINDOW, BAD_PAYLOAD, EMPTY_PAYLOAD = "valid", "rejected", "out_of_window", "bad_payload", "empty_payload"
ROW_OUTCOMES = (VALID, REJECTED, OUT_OF_WINDOW)
OUTCOMES = (*ROW_OUTCOMES, BAD_PAYLOAD, EMPTY_PAYLOAD)
FEED_SCHEMAS = {"usgs": SC.EVENT_FEED, "census": SC.CENSUS_PAYLOAD, "geocode": SC.GEOCODE_PAYLOAD, "weather": SC.WEATHER_PAYLOAD}
_META = T.StructType([
    T.StructField("outcome", T.StringType()), T.StructField("payload", T.StringType()), T.StructField("broken", T.ArrayType(T.StringType())),
])


def intake_schema(entity: str) -> T.StructType:
    return T.StructType([*SC.STAGING[entity].fields, *_META.fields])


def payloads(text: DataFrame, schema: T.DataType, col: str = "value") -> DataFrame:
    """``doc, bad, payload``: each payload parsed once; ``payload`` holds the text of the bad ones only.

    Bad is what is no JSON, or no object (array) where ``schema`` has one. A member of another type than the
    schema's reads as null (N1) and makes no payload bad. Blank lines are no payloads.
    """
    struct = isinstance(schema, T.StructType)
    read = T.StructType([*schema.fields, T.StructField("__corrupt", T.StringType())]) if struct else schema
    options = {"columnNameOfCorruptRecord": "__corrupt"} if struct else {}
    lines = text.select(F.col(col).alias("__text")).where(F.trim("__text") != "")
    parsed = lines.select("__text", F.from_json("__text", read, options).alias("doc"))
    other = ~F.startswith(F.trim("__text"), F.lit("{" if struct else "["))
    if struct:
        # a record is also reported corrupt for a member of another type: only those few are looked at again
        other |= F.when(F.col("doc").isNull() | F.col("doc.__corrupt").isNotNull(), F.try_parse_json("__text").isNull()).otherwise(False)
    else:
        other |= F.col("doc").isNull()
    return parsed.withColumn("bad", other).select("doc", "bad", F.when(F.col("bad"), F.col("__text")).alias("payload"))


def _rows(docs: DataFrame, elements: Column) -> DataFrame:
    """``payload, bad, pos, row``: one row per element, or one without ``pos`` for a payload that has none."""
    good = F.when(~F.col("bad"), elements)
    return docs.select("payload", "bad", F.posexplode_outer(good).alias("pos", "row"))


def _events(docs: DataFrame) -> DataFrame:
    rows = _rows(docs, F.col("doc.features"))
    broken = [F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in LD.event_rules(F.col("row")).items()]
    shape = F.when(F.col("pos").isNotNull(), F.array_compact(F.array(*broken))).when(~F.col("bad"), F.array(F.lit(LD.EVENT_RULES[0])))
    return rows.select("payload", "bad", "pos", *LD.event_columns(F.col("row")), shape.alias("broken"))


def _weather(docs: DataFrame) -> DataFrame:
    rows = _rows(docs, F.array("doc"))
    return rows.select("payload", "bad", "pos", *LD.weather_columns(F.col("row")))


def _census(docs: DataFrame) -> DataFrame:
    rows = _rows(docs, F.col("doc")).where(F.col("pos").isNull() | (F.col("pos") > 0))
    return rows.select("payload", "bad", "pos", *LD.array_columns(F.col("row")))


def _geocode(docs: DataFrame) -> DataFrame:
    kept = (F.col("pos") < SC.GEOCODE_RESULT_LIMIT) & (F.col("row.country") == "US")
    rows = _rows(docs, F.col("doc")).where(F.col("pos").isNull() | kept)
    return rows.select("payload", "bad", "pos", *[F.col("row").getField(c).alias(c) for c, _ in SC.GEOCODE_COLUMNS])


_EXPLODED = {"usgs": _events, "weather": _weather, "census": _census, "geocode": _geocode}


def row_outcome(entity: str, window: tuple | None = None, min_mag: float | None = None) -> Column:
    """What becomes of a row in staging columns. The quarantine goes first: a null time or magnitude has no
    answer to the window (ruling D35). A null condition passes."""
    also = ("mag",) if min_mag is not None else ()
    bad = QC.any_null((*SC.RAW_KEYS[entity], *also)) | QC.too_long(SC.VARCHAR_LIMITS[entity])
    outside = F.lit(False)
    if window is not None:
        outside |= ~C.in_window("time", C.ts_literal(window[0]), C.ts_literal(window[1]))
    if min_mag is not None:
        outside |= F.col("mag") < F.lit(min_mag)
    return F.when(bad, F.lit(REJECTED)).when(outside, F.lit(OUT_OF_WINDOW)).otherwise(F.lit(VALID))


def feed_rows(rows: DataFrame, entity: str) -> DataFrame:
    """The feed in staging columns: nothing is filtered, checked or de-duplicated."""
    if entity == "weather" and dict(rows.dtypes).get("date") == "string":
        rows = rows.withColumn("date", C.parse_date("date"))  # F13, before binding
    return bind_by_name(rows, SC.STAGING[entity])


def tag_rows(rows: DataFrame, entity: str, **rules) -> DataFrame:
    """Rows without payloads (a replayed CSV) in the shape of :func:`intake`."""
    bound = feed_rows(rows, entity)
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in _META.fields[1:]]
    return bound.select(*bound.columns, row_outcome(entity, **rules).alias("outcome"), *nothing)


def intake(text: DataFrame, entity: str, col: str = "value", **rules) -> DataFrame:
    """The landed text of a feed as rows with their outcome (``rules``: see :func:`row_outcome`)."""
    rows = _EXPLODED[entity](payloads(text, FEED_SCHEMAS[entity], col))
    if "broken" not in rows.columns:
        rows = rows.withColumn("broken", F.lit(None).cast(_META["broken"].dataType))
    if entity == "weather":
        rows = rows.withColumn("date", C.parse_date("date"))
    staging = SC.STAGING[entity]
    bound = bind_by_name(rows, T.StructType([*staging.fields, *_META.fields[1:], T.StructField("bad", T.BooleanType()), T.StructField("pos", T.IntegerType())]))
    outcome = F.when(F.col("bad"), F.lit(BAD_PAYLOAD)).when(F.col("pos").isNull(), F.lit(EMPTY_PAYLOAD)).otherwise(row_outcome(entity, **rules))
    return bound.select(*staging.fieldNames(), outcome.alias("outcome"), "payload", "broken")


def shape_report(rows: DataFrame) -> DataFrame:
    """A9 over the intake of the event feed: payloads or features that break each rule."""
    rules: Mapping[str, Column] = {r: F.array_contains("broken", r) for r in LD.EVENT_RULES}
    return QC.rule_report(rows, rules)
