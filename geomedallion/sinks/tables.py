"""Table and file sinks.

Tables are Parquet tables in the session catalog whose LOCATION is a snapshot folder
``<root>/<table>/snapshot=<id>``. A merge writes the merged rows to a new snapshot and then
points the table at it (``ALTER TABLE ... SET LOCATION``): a Parquet table cannot be
overwritten while it is being read, and readers never see a half-written table.
``root`` must be shared storage on a cluster (the caller's warehouse path).
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geomedallion.sources.csv import bind_strictly

__all__ = [
    "landed_csv_path", "write_landed_csv", "write_export", "create_table",
    "append_staging", "load_staging", "truncate_staging", "replace_table", "replace_partitions", "remove_folder", "remove_stale", "publish", "table_location",
]


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def landed_csv_path(base_dir: str, entity: str, run_ts: _dt.datetime) -> str:
    """K1 naming: ``<base>/run_date=<yyyy-mm-dd>/<yyyy-mm-dd_HH-MM-SS>_<entity>_raw``."""
    stamp = run_ts.strftime("%Y-%m-%d_%H-%M-%S")
    return f"{base_dir.rstrip('/')}/run_date={run_ts:%Y-%m-%d}/{stamp}_{entity}_raw"


def write_landed_csv(df: DataFrame, base_dir: str, entity: str, run_ts: _dt.datetime) -> str:
    """K1: header CSV, UTF-8, quotes doubled; returns the folder written."""
    path = landed_csv_path(base_dir, entity, run_ts)
    write_export(df, path, "overwrite")
    return path


def write_export(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """K2 (mode='overwrite') / K3 (default: fail when the path exists)."""
    (df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
     .option("encoding", "UTF-8").csv(path))


def table_location(root: str, table: str, snapshot: str) -> str:
    return f"{root.rstrip('/')}/{table.split('.')[-1]}/snapshot={snapshot}"


def create_table(spark: SparkSession, table: str, schema: T.StructType, root: str, snapshot: str = "0",
                 partition_by: str | None = None) -> None:
    """K7 for one table: an empty typed Parquet table at its first snapshot folder, optionally
    partitioned by a (last) column whose partitions are tracked in the catalog."""
    if spark.catalog.tableExists(table):
        return
    loc = table_location(root, table, snapshot)
    part = f" PARTITIONED BY (`{partition_by}`)" if partition_by else ""
    spark.sql(f"CREATE TABLE {table} ({_ddl(schema)}) USING parquet{part} LOCATION '{loc}'")


def append_staging(df: DataFrame, table: str) -> None:
    """K4: bind by column *name* (never by position, ruling D2) and append; a missing column or a
    malformed value fails the load."""
    spark = df.sparkSession
    bind_strictly(df, spark.table(table).schema).write.insertInto(table, overwrite=False)


def load_staging(df: DataFrame, table: str) -> None:
    """K5 + K4: replace the staging rows with ``df`` (bound by name, as in K4). Spark deletes the old
    files before it writes the new ones; a failed load is run again."""
    spark = df.sparkSession
    bind_strictly(df, spark.table(table).schema).write.insertInto(table, overwrite=True)


def truncate_staging(spark: SparkSession, tables) -> None:
    """K5: empty staging tables (overwrite with no rows; works for tables with a LOCATION)."""
    for t in tables:
        spark.createDataFrame([], spark.table(t).schema).write.insertInto(t, overwrite=True)


def replace_table(df: DataFrame, table: str, root: str, snapshot: str) -> None:
    """Write ``df`` as a new snapshot of ``table`` and point the table at it.

    The folder name gets a unique suffix: a rerun with the same label must not write into
    the folder the table (and so ``df`` itself) is still reading.
    """
    spark = df.sparkSession
    loc = table_location(root, table, f"{snapshot}-{uuid.uuid4().hex[:8]}")
    df.write.mode("overwrite").parquet(loc)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{loc}'")
    spark.catalog.refreshTable(table)


def _folder(spark: SparkSession, path: str):
    """The folder and its file system, wherever the session keeps it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    folder, files = _folder(spark, path)
    files.delete(folder, True)


def replace_partitions(df: DataFrame, table: str, root: str, snapshot: str, partition_col: str) -> None:
    """Write ``df`` to a new snapshot folder and point the partitions it holds at it; other partitions are
    neither read nor rewritten. New partitions are registered 500 in a statement. One that exists is re-pointed by
    a statement of its own: Spark has none for several, and to drop and add them again would hide them in between
    (and lose them in a crash)."""
    spark = df.sparkSession
    folder = table_location(root, table, f"{snapshot}-{uuid.uuid4().hex[:8]}")
    df.write.mode("overwrite").partitionBy(partition_col).parquet(folder)
    path, files = _folder(spark, folder)
    written = [s.getPath().getName() for s in files.listStatus(path) if s.isDirectory()]
    values = sorted(name.partition("=")[2] for name in written)
    existing = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    spec = lambda v: f"PARTITION (`{partition_col}`='{v}')"
    where = lambda v: f"LOCATION '{folder}/{partition_col}={v}'"
    old = [v for v in values if f"{partition_col}={v}" in existing]
    new = [v for v in values if f"{partition_col}={v}" not in existing]
    for i in range(0, len(new), 500):  # new days in one statement each 500
        spark.sql(f"ALTER TABLE {table} ADD " + " ".join(f"{spec(v)} {where(v)}" for v in new[i : i + 500]))
    for v in old:
        spark.sql(f"ALTER TABLE {table} {spec(v)} SET {where(v)}")
    spark.catalog.refreshTable(table)


def remove_stale(spark: SparkSession, table: str, root: str, before: _dt.datetime) -> list[str]:
    """K6 retention: delete the snapshot folders of ``table`` that were last changed before ``before`` and that neither
    the table nor any of its partitions reads. Readers planned on a deleted snapshot fail, and a snapshot being
    written is in no table yet, so ``before`` must lie further back than any reader or write takes."""
    live = {r["data_type"].rstrip("/").rsplit("/", 1)[-1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r["col_name"] == "Location"}
    named = F.regexp_extract("_metadata.file_path", r"/(snapshot=[^/]+)/", 1).alias("snapshot")
    live |= {r["snapshot"] for r in spark.table(table).select(named).distinct().collect()}  # folders in use, not files
    folder, files = _folder(spark, table_location(root, table, "").rpartition("/")[0])
    if not files.exists(folder):
        return []
    limit = int(before.replace(tzinfo=before.tzinfo or _dt.timezone.utc).timestamp() * 1000)
    stale = [s.getPath() for s in files.listStatus(folder) if s.isDirectory() and s.getPath().getName() not in live and s.getModificationTime() < limit]
    for path in stale:
        files.delete(path, True)
    return sorted(path.getName() for path in stale)


def publish(df: DataFrame, table: str, root: str, snapshot: str) -> None:
    """K6: publish a gold table to the catalog (created on first use, then snapshot-replaced)."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        loc = table_location(root, table, f"{snapshot}-{uuid.uuid4().hex[:8]}")
        df.write.mode("overwrite").parquet(loc)
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{loc}'")
    else:
        replace_table(df, table, root, snapshot)
