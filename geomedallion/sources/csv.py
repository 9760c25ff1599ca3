"""CSV scan (S5) bound by header name to an entity schema, and replay of landed CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = ["read_csv", "bind_by_name", "bind_strictly"]


def bind_by_name(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns by name with null-safe casts; absent columns become null."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


def bind_strictly(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns by name; a missing column or a value its cast would lose is an error (K4)."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the load: {missing}")

    def bound(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if df.schema[f.name].dataType == f.dataType:
            return c.alias(f.name)
        cast = c.try_cast(f.dataType)
        lost = F.raise_error(F.concat(F.lit(f"malformed value in {f.name}: "), c.cast("string"))).cast(f.dataType)
        return F.when(cast.isNull() & c.isNotNull(), lost).otherwise(cast).alias(f.name)

    return df.select(*[bound(f) for f in schema.fields])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False) -> DataFrame:
    """Header CSV read as strings (no inference pass over the data), then bound by name.

    Quote and escape are both '"' (the doubled-quote dialect the CSV sink writes). ``multi_line`` is for
    texts that may hold line breaks; such files cannot be split, so it is off unless asked for.
    """
    raw = (
        spark.read.option("header", True).option("quote", '"').option("escape", '"')
        .option("multiLine", multi_line).option("inferSchema", False).csv(path)
    )
    return raw if schema is None else bind_by_name(raw, schema)
