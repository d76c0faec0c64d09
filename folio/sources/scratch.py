"""Tables and trees that a job needs for a while, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession

from folio.sources import storage

#: What is still there, and goes with the driver's process at the latest.
_held: dict[str, SparkSession] = {}


def folder(spark: SparkSession, name: str) -> str:
    """A new folder's path: in spark.checkpoint.dir, or in a temporary folder where there is no cluster and none is set."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        shared = tempfile.gettempdir()
    path = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _held[path] = spark
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a written table: what reads it reads that, however often, and its lineage ends there."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, **counters: Column) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """df with counters that are taken while it is written, and what gives them afterwards.

    Rows that the planner knows to be none take the counters away with them: these are 0.
    """
    seen = Observation()

    def counts() -> dict[str, int]:
        try:
            return {k: v or 0 for k, v in seen.get.items()}
        except Py4JJavaError:
            return dict.fromkeys(counters, 0)

    return df.observe(seen, *(c.alias(k) for k, c in counters.items())), counts


def drop(path: str) -> None:
    spark = _held.pop(path, None)
    if spark is not None:
        storage.delete(spark, path)


@atexit.register
def _drop_all() -> None:
    for path in list(_held):
        with contextlib.suppress(Exception):  # the session may have ended
            drop(path)
