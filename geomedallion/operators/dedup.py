"""Key-based de-duplication (A3) and first-row-per-key.

``first_by_key`` keeps, for every key, the row that sorts first under a total order. The
order is encoded as one struct and the least row is chosen in an aggregation: map-side partial aggregation collapses a hot key before the shuffle (no window over the key).
Descending numeric / temporal columns are negated inside the struct; a descending column of
another type falls back to ``row_number() = 1`` (Spark then plans a partial WindowGroupLimit).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = ["Order", "first_per_key", "first_by_key", "dedup_by_key", "orderable"]


@dataclass(frozen=True)
class Order:
    col: str
    desc: bool = False
    nulls_first: bool = False

    def column(self) -> Column:
        c = F.col(f"`{self.col}`")
        if self.desc:
            return c.desc_nulls_first() if self.nulls_first else c.desc_nulls_last()
        return c.asc_nulls_first() if self.nulls_first else c.asc_nulls_last()


def orderable(dt: T.DataType) -> bool:
    if isinstance(dt, (T.MapType, T.VariantType)):
        return False
    if isinstance(dt, T.ArrayType):
        return orderable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(orderable(f.dataType) for f in dt.fields)
    return True


def _negated(c: Column, dt: T.DataType) -> Column | None:
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType)):
        return F.lit(0).cast("long") - c.cast("long")
    if isinstance(dt, (T.LongType, T.FloatType, T.DoubleType, T.DecimalType)):
        return -c
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return -F.unix_micros(c.cast("timestamp"))
    if isinstance(dt, T.DateType):
        return -F.unix_date(c)
    if isinstance(dt, T.BooleanType):
        return ~c
    return None


def _sort_struct(df: DataFrame, order: Sequence[Order]) -> Column | None:
    parts: list[Column] = []
    types = {f.name: f.dataType for f in df.schema.fields}
    for i, o in enumerate(order):
        c = F.col(f"`{o.col}`")
        flag = c.isNotNull() if o.nulls_first else c.isNull()  # False sorts first
        value = _negated(c, types[o.col]) if o.desc else c
        if value is None:
            return None
        parts += [flag.alias(f"n{i}"), value.alias(f"v{i}")]
    return F.struct(*parts)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows per key under ``order`` (window form; used for n > 1 and fallbacks).
    ``row_number() <= n`` gets a partial WindowGroupLimit before the shuffle."""
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    rn = "__rn"
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= n).drop(rn)


def _least_row(df: DataFrame, keys: Sequence[str], order: Sequence[Order], sort: Column) -> DataFrame:
    """The least (sort columns, other columns) struct of each key; every column travels once.

    Keys come back from the grouping, ascending sort columns from the sort part.
    """
    held = {o.col: f"v{i}" for i, o in enumerate(order) if not o.desc}
    rest = [c for c in df.columns if c not in keys and c not in held]
    least = F.min(F.struct(sort.alias("s"), F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in rest]).alias("r")))
    picked = df.groupBy(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)]).agg(least.alias("__r"))
    place = {k: F.col(f"__k{i}") for i, k in enumerate(keys)}
    place |= {c: F.col("__r.s").getField(v) for c, v in held.items() if c not in place}
    place |= {c: F.col("__r.r").getField(c) for c in rest}
    return picked.select(*[place[c].alias(c) for c in df.columns])


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Order]) -> DataFrame:
    """The first row of each key under ``order`` (one row per key, nulls grouped together)."""
    key = _sort_struct(df, order)
    if key is None:
        return first_per_key(df, keys, [o.column() for o in order])
    if all(orderable(f.dataType) for f in df.schema.fields):
        return _least_row(df, keys, order, key)
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    picked = df.groupBy(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)]).agg(F.min_by(row, key).alias("__r"))
    return picked.select(*[F.col("__r").getField(c).alias(c) for c in df.columns])


def dedup_by_key(
    df: DataFrame,
    keys: Sequence[str],
    newest_first: Sequence[str] = (),
    then_by: Sequence[str] | None = None,
) -> DataFrame:
    """A3 (ruling D17): one row per key; newest ``newest_first`` columns win, then the lowest
    remaining columns (nulls last), so the survivor does not depend on input order."""
    types = {f.name: f.dataType for f in df.schema.fields}
    if then_by is None:
        then_by = [c for c in df.columns if c not in keys and c not in newest_first and orderable(types[c])]
    order = [Order(c, desc=True) for c in newest_first] + [Order(c) for c in then_by]
    return first_by_key(df, keys, order)
