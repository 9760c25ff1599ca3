"""Skew-safe many-to-many left join.

``left LEFT JOIN right USING (keys)`` where one key may hold a large share of ``right``
(e.g. one location with a third of all quakes). AQE can split only the left side of a left
outer join, so a hot right-side key would land in one task. Instead:

  1. count right rows per key (partial aggregation, one row per key);
  2. a key gets ``n = ceil(count / rows_per_salt)`` salts; right rows take salt
     ``pmod(xxhash64(row), n)``; each left row is replicated once per salt of its key
  3. join on (keys, salt): every pair is produced exactly once, a hot key's pairs are spread over n tasks. A key
     with right rows has at least one non-empty bucket, so every left row with such a key appears;
  4. what is joined to a left row are lists of at most ``ROWS_PER_LIST`` right rows of its bucket, and the pairs are
     made from them row by row. A join that multiplies rows buffers a copy of each pair it makes; reading a list does not;
  5. left rows without right rows (an unknown key, or a null one) enter no exchange at all: they leave
     beside the join, padded with nulls, and are unioned back.

The left side is read twice (rows with and without right rows), the right side twice (counts, rows); what lies
above a shuffle of theirs is computed once, as Spark reuses the exchange.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geomedallion.operators.sizing import DEFAULT_BROADCAST_MAX_ROWS, broadcast_if_small

__all__ = ["salted_left_join", "DEFAULT_ROWS_PER_SALT"]

DEFAULT_ROWS_PER_SALT = 100_000
ROWS_PER_LIST = 1024  # right rows a list, at most


def _lists(salted: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """The rows of each (__hash, keys, __salt) in lists of at most ``ROWS_PER_LIST``: columns __h, __at, __k0, ... and __rows.

    Rows are numbered within the hash of their keys and the salt, so that one exchange of plain rows serves the numbers,
    the lists and the join (keys of one hash share the numbers: their lists are shorter).
    """
    bucket = Window.partitionBy("__hash", "__salt").orderBy("__salt")
    numbered = salted.withColumn("__list", F.floor((F.row_number().over(bucket) - 1) / F.lit(ROWS_PER_LIST)))
    by = [F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)]
    found = numbered.groupBy(F.col("__hash").alias("__h"), F.col("__salt").alias("__at"), *by, "__list").agg(
        F.collect_list(F.struct(*[F.col(f"`{c}`") for c in cols])).alias("__rows"))
    return found.drop("__list")


def salted_left_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    *,
    rows_per_salt: int = DEFAULT_ROWS_PER_SALT,
    broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
    key_rows_bound: int | None = None,
) -> DataFrame:
    """``key_rows_bound``: a proven upper bound on the number of distinct right keys (e.g. the
    row count of the dimension the keys come from); when it is within ``broadcast_max_rows``
    the per-key counts are broadcast without probing them."""
    keys = list(keys)
    right_cols = [c for c in right.columns if c not in keys]
    clash = set(right_cols) & set(left.columns)
    if clash:
        raise ValueError(f"left and right share non-key columns {sorted(clash)}")
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()

    counts = right.where(present).groupBy(*keys).agg(
        F.ceil(F.count(F.lit(1)) / F.lit(float(rows_per_salt))).cast("int").alias("__n"))
    counts = counts.withColumn("__hash", F.xxhash64(*[F.col(f"`{k}`") for k in keys]))
    without_key = None
    if key_rows_bound is not None and key_rows_bound <= broadcast_max_rows:
        counts_b = F.broadcast(counts)  # keys and a number
    else:
        counts_b, small = broadcast_if_small(counts, broadcast_max_rows)
        if not small:  # null keys would meet in one task of this join
            left, without_key = left.where(present), left.where(~present)

    salted_right = (
        right.where(present).join(counts_b, keys)
        .withColumn("__salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in right.columns]), F.col("__n")).cast("int"))
        .drop("__n")
    )
    marked = left.join(counts_b, keys, "left")
    salted_left = marked.where(F.col("__n").isNotNull()).withColumn("__salt", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    if right_cols:
        lists = _lists(salted_right, keys, right_cols)
        # the hash is the counts' on both sides; the keys are compared as a range, so as not to be exchanged by
        same = [F.col("__hash") == F.col("__h"), F.col("__salt") == F.col("__at")]
        same += [c for i, k in enumerate(keys) for c in (F.col(f"`{k}`") >= F.col(f"__k{i}"), F.col(f"`{k}`") <= F.col(f"__k{i}"))]
        paired = salted_left.join(lists, same).select(*left.columns, "__rows").select(*left.columns, F.inline("__rows"))
    else:
        paired = salted_left.join(salted_right.drop("__hash"), keys + ["__salt"]).select(*left.columns)
    alone = marked.where(F.col("__n").isNull()).select(*left.columns)
    if without_key is not None:
        alone = alone.unionByName(without_key)
    nothing = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in right_cols]
    return paired.unionByName(alone.select(*left.columns, *nothing))
