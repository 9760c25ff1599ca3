"""Size checks that guard every explicit broadcast.

A side is broadcast only after it was measured small, in rows and in bytes. The measure is one aggregation, so it
runs on all tasks of the side and returns one row; above the bounds the caller takes its shuffle plan instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default bounds for broadcasting a dimension.
DEFAULT_BROADCAST_MAX_ROWS = 1_000_000
DEFAULT_BROADCAST_MAX_BYTES = 256 << 20
ROW_BYTES = 32  # what a row takes besides its values, about


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int

    def fits(self, max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES, copies: int = 1) -> bool:
        return self.bytes * copies <= max_bytes


def measure(df: DataFrame) -> Size:
    """Rows of ``df``, and their bytes by the length of their JSON text."""
    text = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)])))
    r = df.select(text.alias("n")).agg(F.count("*").alias("rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("bytes")).first()
    return Size(r["rows"], r["bytes"] + ROW_BYTES * r["rows"])


def broadcast_if_small(
    df: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS, max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES
) -> tuple[DataFrame, bool]:
    """Return (df with a broadcast hint, True) when it is measured within both bounds, else (df, False)."""
    if max_rows > 0:
        size = measure(df)
        if size.rows <= max_rows and size.fits(max_bytes):
            return F.broadcast(df), True
    return df, False
