"""Incremental bronze ingestion of landed payload folders with Structured Streaming.

The batch layer re-reads a whole landed folder per run. Here each entity folder is a file
stream: the streaming checkpoint remembers which files were processed, so every landed file
is merged once, across restarts and executor loss. Each micro-batch runs the same staging
(checks, de-duplication) and keyed merge as the batch layer, through ``foreachBatch``. A
replayed micro-batch merges the same rows again, which the keyed upsert absorbs.

``available_now=True`` processes everything landed so far and stops (scheduled runs);
otherwise the queries keep running with ``processing_time`` triggers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from geomedallion.plans import intake as IN
from geomedallion.plans import layers as LY
from geomedallion.session import ensure_checkpoint_dir

__all__ = ["landed_stream", "bronze_streams"]

# no feed window in streaming mode: a file counts when it lands
RULES = {"usgs": {"min_mag": LY.MIN_MAGNITUDE}}


def landed_stream(spark: SparkSession, landed_dir: str, entity: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming intake of one entity folder (JSON Lines files): rows with their outcome.

    Nothing is made distinct here, which would keep every record in state forever: each micro-batch is
    de-duplicated by key in staging, and the merge is keyed.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    text = reader.text(f"{landed_dir.rstrip('/')}/{LY.FEED_FOLDERS[entity]}")
    return IN.intake(text, entity, **RULES.get(entity, {}))


def _merge_batch(medallion: "LY.Medallion", entity: str):
    def run(batch: DataFrame, epoch_id: int) -> None:
        # the batch is written by its own, cloned session; all else goes through the medallion's, whose
        # table cache the caller sees refreshed
        medallion.merge_batch(entity, batch, f"stream-{epoch_id}")

    return run


def bronze_streams(
    medallion: "LY.Medallion",
    landed_dir: str,
    checkpoint_root: str | None = None,
    entities=LY.ENTITIES,
    available_now: bool = True,
    processing_time: str = "1 minute",
) -> list[StreamingQuery]:
    """Start one file-stream query per entity; each micro-batch is staged and merged.

    ``checkpoint_root`` defaults to the shared folder of ``spark.checkpoint.dir``. Each entity
    has its own staging and raw tables, so the queries run side by side; with
    ``available_now`` the call returns when all of them have drained their folders.
    """
    spark = medallion.spark
    root = (checkpoint_root or f"{ensure_checkpoint_dir(spark).rstrip('/')}/geomedallion-streams").rstrip("/")
    queries = []
    for e in entities:
        w = landed_stream(spark, landed_dir, e).writeStream.foreachBatch(_merge_batch(medallion, e))
        w = w.option("checkpointLocation", f"{root}/{medallion.database}/{e}")
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
        queries.append(w.queryName(f"bronze_{medallion.database}_{e}").start())
    if available_now:
        for e, q in zip(entities, queries):
            q.awaitTermination()
            spark.catalog.refreshTable(medallion.t(f"{e}_raw"))
    return queries
