"""Data-quality checks standing in for the reference's table constraints.

Each check is a DataFrame operator; ``split`` returns ``(valid, rejected)`` so a layer can
quarantine rejected rows instead of failing the load. Counts use partial aggregation.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = [
    "RUN_STATUSES",
    "split",
    "duplicate_keys",
    "null_key_rows",
    "any_null",
    "not_in_set",
    "too_long",
    "value_in_set",
    "too_long_strings",
    "rule_report",
]

# Fixed value set of the run-log status column.
RUN_STATUSES = ("Running", "Succeeded", "Failed")


def _any(conds: Iterable[Column]) -> Column:
    conds = list(conds)
    return reduce(lambda a, b: a | b, conds) if conds else F.lit(False)


def split(df: DataFrame, reject_when: Column) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected); a null condition counts as passing, as a SQL CHECK does."""
    bad = F.coalesce(reject_when, F.lit(False))
    return df.where(~bad), df.where(bad)


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "n_rows") -> DataFrame:
    """A5: each key value held by more than one row, with its row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).where(F.col(count_col) > 1)


def any_null(cols: Sequence[str]) -> Column:
    return _any(F.col(c).isNull() for c in cols)


def null_key_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a null in any key or required column."""
    return df.where(any_null(cols))


def not_in_set(col: str, allowed: Sequence) -> Column:
    return ~F.col(col).isin(*allowed)


def too_long(limits: Mapping[str, int]) -> Column:
    return _any(F.length(F.col(c)) > F.lit(n) for c, n in limits.items())


def value_in_set(df: DataFrame, col: str, allowed: Sequence) -> DataFrame:
    """Rows whose value lies outside ``allowed`` (null passes, as in CHECK)."""
    return split(df, not_in_set(col, allowed))[1]


def too_long_strings(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Rows where any column exceeds its VARCHAR(n) length."""
    return split(df, too_long(limits))[1]


def rule_report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per rule with the number of rows it rejects (one pass over ``df``)."""
    counts = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in rules.items()])
    stack = ", ".join(f"'{n}', `{n}`" for n in rules)
    return counts.selectExpr(f"stack({len(rules)}, {stack}) AS (rule, n_rejected)")
