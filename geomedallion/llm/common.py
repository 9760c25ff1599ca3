"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import json
import threading
import uuid
import weakref
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geomedallion.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_WRITTEN: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
_OPEN = threading.local()  # operators on several driver threads each delete their own tables


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once, as Parquet in the shared checkpoint folder, and go on from there.

    Used where a result is read several times. The files survive the loss of executors, later reads take
    only the columns they need, and plans made from them know their real size (a chain of checkpoints
    multiplies estimates with every join).
    """
    path = scratch_folder(df.sparkSession, "step")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _WRITTEN[out] = path
    if getattr(_OPEN, "made", None):
        _OPEN.made[-1].append(out)
    return out


@contextlib.contextmanager
def steps() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Deletes at its end what was materialised inside, but for what goes through the function it yields."""
    made: list[DataFrame] = []
    if not hasattr(_OPEN, "made"):
        _OPEN.made = []
    _OPEN.made.append(made)

    def keep(df: DataFrame) -> DataFrame:
        out = materialise(df)
        made.pop()
        return out

    try:
        yield keep
    finally:
        _OPEN.made.pop()
        release(*made)


def release(*tables: DataFrame | None) -> None:
    """Delete what :func:`materialise` wrote for tables that nothing reads any more."""
    for df in tables:
        path = _WRITTEN.pop(df, None) if df is not None else None
        if path:
            spark = df.sparkSession
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


BROADCAST_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast of ``df`` (a materialised table of narrow rows) if it has at most ``rows`` rows."""
    return F.broadcast(df) if df.count() <= rows else df


ARROW_ROWS = 512


def in_arrow(df: DataFrame, run, schema, rows: int = ARROW_ROWS) -> DataFrame:
    """``df.mapInArrow(run, schema)``, where ``run`` gets at most ``rows`` rows at a time.

    Whole texts are long rows; 10,000 of them in one batch, Spark's default, set the size of the JVM's buffers and of
    Python workers. Spark reads the setting when a job runs, not when its plan is made, so it is lowered for the
    session to ``ARROW_ROWS`` and stays so (a smaller one is kept); callers who need the default set it again after
    their results are written. Batches are split further without a copy.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key, "10000")) <= ARROW_ROWS:
        conf.set(key, str(ARROW_ROWS))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return run(batch.slice(at, rows) for batch in batches for at in range(0, batch.num_rows, rows))

    return df.mapInArrow(split, schema)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def crc_bucket(col: Column, n: int) -> Column:
    """``crc32(id as text) mod n``, the split of rows into folds that the queries use."""
    return F.crc32(col.cast("string")) % n


def fresh_name(taken: list[str], base: str) -> str:
    """A column name that is not in ``taken`` (names are compared without case)."""
    low = {t.lower() for t in taken}
    name = base
    while name.lower() in low:
        name = f"_{name}"
    return name


def tokenizer(name: str, path: str | None = None) -> tuple[bytes, str]:
    """A public ranks file (read on the driver and sent with the tasks) and its splitting pattern."""
    import public_tokenizers

    with open(path or public_tokenizers.path(name), "rb") as f:
        return f.read(), public_tokenizers.PATTERN


def added_tokens(name: str, path: str | None = None) -> dict[str, int]:
    """Strings and ids of the tokens that a tokenizer file adds to its vocabulary."""
    import public_tokenizers

    with open(path or public_tokenizers.path(name), "rb") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


def piece_model(name: str, path: str | None = None) -> bytes:
    """A public sentencepiece model, read on the driver and sent with the tasks."""
    import public_tokenizers

    with open(path or public_tokenizers.path(name), "rb") as f:
        return f.read()
