"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_OPEN: ContextVar[list[str] | None] = ContextVar("tables_of_the_open_scratch", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a cluster must name one, only a local session may do without."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if context.master != "local" and not context.master.startswith("local["):
                raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="arealis-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished plans, which otherwise stay until the driver's heap happens to be collected."""
    gc.collect()  # plans that only Python still holds
    spark.range(1).write.mode("overwrite").format("noop").save()  # the session holds on to the plan that ran last
    spark.sparkContext._jvm.System.gc()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside are deleted at the end, but for those that are kept."""
    mine: list[str] = []
    token = _OPEN.set(mine)
    try:
        yield
    finally:
        _OPEN.reset(token)
        for path in mine:
            place, files = _place(spark, path)
            files.delete(place, True)


def stored(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Cut the lineage: write to the shared folder, read again. Survives lost executors.

    A kept table, and one outside of ``scratch``, lives as long as the session.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    mine = _OPEN.get()
    if keep or mine is None:
        place, files = _place(spark, path)
        files.deleteOnExit(place)
    else:
        mine.append(path)
    return spark.read.schema(df.schema).parquet(path)
