"""Incremental extraction by high watermark.

The watermark is ``max(last_updated)`` over the *Succeeded* runs, with the epoch when there
are none (ruling D16). It is an uncorrelated scalar subquery: evaluated once and pushed to
the Parquet scan of the extracted table as ``GreaterThan(ts, ScalarSubquery)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geomedallion.functions.columns import EPOCH, ts_literal

__all__ = ["RUN_LOG_SCHEMA", "watermark", "extract_since"]

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("job_id", T.StringType(), False),
    T.StructField("last_updated", T.TimestampType(), False),
    T.StructField("status", T.StringType(), False),
])


def watermark(run_log: DataFrame, data_type: T.DataType | None = None) -> DataFrame:
    """One-row frame ``(watermark)``: newest successful run, or the epoch."""
    lu = F.col("last_updated")
    if data_type is not None:
        lu = lu.cast(data_type)
    epoch = ts_literal(EPOCH)
    if data_type is not None:
        epoch = epoch.cast(data_type)
    return run_log.where(F.col("status") == "Succeeded").agg(F.coalesce(F.max(lu), epoch).alias("watermark"))


def extract_since(df: DataFrame, run_log: DataFrame, ts_col: str = "update_tm") -> DataFrame:
    """Rows of ``df`` with ``ts_col`` strictly newer than the watermark."""
    wm = watermark(run_log, df.schema[ts_col].dataType)
    return df.where(F.col(ts_col) > wm.select("watermark").scalar())
