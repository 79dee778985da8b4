"""Where jobs keep written tables and checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`, or the context's own setting.

    Only a local session may go without either; it then gets a temporary folder, once.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="refgauge-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def new_path(spark: SparkSession, name: str) -> str:
    """A path not used before, below the shared folder."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if _made.get() is not None:
        _made.get().append(path)
    return path


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Removes the tables written inside, once what was made of them is stored elsewhere."""
    token = _made.set([])
    try:
        yield
    finally:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        for path in _made.get():
            place = hadoop.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
        _made.reset(token)


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Readies a session for rows of some size in Python workers.

    Batches of Spark's default 64 MB are made smaller; other settings are kept.
    """
    if spark.conf.get(BATCH_BYTES) == f"{64 << 20}b":
        spark.conf.set(BATCH_BYTES, 4 << 20)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of `df` from a table written once, so later jobs do not compute them again.

    The table outlives lost executors, and values that depend on task layout are fixed in it.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
