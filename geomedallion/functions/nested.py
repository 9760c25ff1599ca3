"""Nested-value helpers (N1-N4) over struct columns and JSON text columns.

Semantics follow the reference's dict helpers:
  get   - the value at a path, or a default when any step is missing or not an object
  set   - write a value at a path, creating intermediate objects; an existing leaf is overwritten
  lift  - read a value at one path, remove the old top-level key, write the value at a new path
  flatten - nested struct fields become top-level columns named by their dotted path
"""

from __future__ import annotations

from typing import Any, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = ["json_path", "json_get", "struct_get", "struct_set", "struct_lift", "flatten_struct"]


def _lit(value: Any) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def json_path(path: Sequence[str]) -> str:
    return "$" + "".join(f"['{p}']" if not p.isidentifier() else f".{p}" for p in path)


def json_get(c, path: Sequence[str], default: Any = None) -> Column:
    """N1 over JSON text: the value at the path; the default only where the path is missing.

    A step is missing when its parent is not an object or has no such key; a present null is returned
    as null. Without a default both give null.
    """
    c = F.col(c) if isinstance(c, str) else c
    got = F.get_json_object(c, json_path(path))
    if default is None:
        return got
    parent = F.get_json_object(c, json_path(path[:-1])) if len(path) > 1 else c
    present = F.coalesce(F.array_contains(F.json_object_keys(parent), path[-1]), F.lit(False))
    return F.when(got.isNotNull() | present, got).otherwise(_lit(default).cast("string"))


def struct_get(df: DataFrame, path: Sequence[str], default: Any = None) -> Column:
    """N1 over struct columns: path[0] is a top-level column; a missing step gives ``default``.

    Missing steps are resolved from the schema (no per-row work). A null parent holds nothing, so it
    gives the default; a field that is null inside a present parent is returned as null.
    """
    top = path[0]
    if top not in df.columns:
        return _lit(default)
    dt = df.schema[top].dataType
    c = F.col(f"`{top}`")
    parent = None
    for p in path[1:]:
        if not isinstance(dt, T.StructType) or p not in dt.fieldNames():
            return _lit(default)
        parent, c = c, c.getField(p)
        dt = dt[p].dataType
    if default is None or parent is None:
        return c
    return F.when(parent.isNotNull(), c).otherwise(_lit(default))


def _null_struct(dt: T.StructType) -> Column:
    return F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in dt.fields])


def _build(path: Sequence[str], value: Column) -> Column:
    out = value
    for p in reversed(path):
        out = F.struct(out.alias(p))
    return out


def _set_in(parent: Column, parent_type: T.DataType | None, path: Sequence[str], value: Column) -> Column:
    if not isinstance(parent_type, T.StructType):
        # absent or not an object: replaced by a fresh object holding the path
        return _build(path, value)
    # a null object is an object with every field null, so the write is not lost
    base = F.when(parent.isNull(), _null_struct(parent_type)).otherwise(parent)
    head, rest = path[0], path[1:]
    if not rest:
        return base.withField(head, value)
    child_type = parent_type[head].dataType if head in parent_type.fieldNames() else None
    return base.withField(head, _set_in(base.getField(head), child_type, rest, value))


def struct_set(df: DataFrame, path: Sequence[str], value: Any) -> DataFrame:
    """Set ``value`` at ``path`` (path[0] a top-level column), creating objects on the way."""
    value = _lit(value)
    top, rest = path[0], list(path[1:])
    if not rest:
        return df.withColumn(top, value)
    top_type = df.schema[top].dataType if top in df.columns else None
    return df.withColumn(top, _set_in(F.col(f"`{top}`"), top_type, rest, value))


def struct_lift(df: DataFrame, new_path: Sequence[str], old_path: Sequence[str], default: Any = None) -> DataFrame:
    """Value at ``old_path`` (or default) moves to ``new_path``; the old top-level key is removed."""
    value = struct_get(df, old_path, default)
    tmp = "__lift_value"
    out = df.withColumn(tmp, value)
    if old_path[0] in out.columns:
        out = out.drop(old_path[0])
    return struct_set(out, new_path, F.col(tmp)).drop(tmp)


def flatten_struct(df: DataFrame, sep: str = ".", keep: Sequence[str] = ()) -> DataFrame:
    """Every nested struct field becomes a column named by its path joined with ``sep``.

    Columns in ``keep`` stay nested. Arrays and maps are left as they are (as json_normalize does).
    """
    cols: list[Column] = []

    def walk(prefix: list[str], dt: T.DataType):
        if isinstance(dt, T.StructType) and (len(prefix) > 1 or prefix[0] not in keep):
            for f in dt.fields:
                walk(prefix + [f.name], f.dataType)
        else:
            ref = F.col(".".join(f"`{p}`" for p in prefix))
            cols.append(ref.alias(sep.join(prefix)))

    for f in df.schema.fields:
        walk([f.name], f.dataType)
    return df.select(*cols)
