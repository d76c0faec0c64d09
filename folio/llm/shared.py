"""What the corpus operators share: tables in the cluster's shared folder, and bounded filters over hashes.

Hot keys: counts are combined before shuffles; large joins have a stored table on either side, so that the
adaptive planner can cut a hot partition in parts; nothing of unknown size is broadcast by name.
"""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.batches import SLICE_BYTES

#: Only where the session names no shared folder and has no cluster, as in tests on one machine.
LOCAL_FOLDER = "/tmp/checkpoints"
#: Bits of a filter over hashes: 4 MB for the driver and each worker, whatever the input.
FILTER_BITS = 1 << 25


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = LOCAL_FOLDER
    return folder.rstrip("/")


#: Settings of the jobs that write or fetch intermediate tables: shuffle files go at once, and Arrow batches stay small on the JVM's side too.
TIDY = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(SLICE_BYTES)}


@contextlib.contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Actions inside leave no shuffle files: their results are written or small, so nothing reads these files again.

    Else they would stay until the driver happens to collect its garbage, and disks fill meanwhile.
    """
    before = {k: spark.conf.get(k, None) for k in TIDY}
    for k, v in TIDY.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Paths of stored tables that are still there.
_paths: dict[str, SparkSession] = {}


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: lineage ends here, and lost executors cost no more than their tasks.

    The table goes with drop(), or with the driver's process.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _paths[path] = spark
    with tidy(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete stored tables that nothing will read again."""
    for t in tables:
        _delete(t._stored_at)


def _delete(path: str) -> None:
    spark = _paths.pop(path, None)
    if spark is not None:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@atexit.register
def _delete_all() -> None:
    for path in list(_paths):
        with contextlib.suppress(Exception):  # the session may have ended
            _delete(path)


def bit_filter(hashes: DataFrame, column: str) -> np.ndarray:
    """A bit for the low bits of every value of a long column: FILTER_BITS / 64 numbers at most come to the driver.

    It only says which rows can't matter; those it lets through are judged exactly later. When it fills up, it lets all through.
    """
    words = (
        hashes.select(F.pmod(F.col(column), F.lit(FILTER_BITS).cast("long")).alias("bit"))
        .selectExpr("cast(bit div 64 as int) as w", "shiftleft(1L, cast(bit % 64 as int)) as b")
        .groupBy("w")
        .agg(F.bit_or("b").alias("b"))
    )
    out = np.zeros(FILTER_BITS // 64, np.int64)
    with tidy(hashes.sparkSession):
        got = words.toArrow()
    for batch in got.to_batches():
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return out.view(np.uint8)


def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes (64-bit) a bit_filter() lets through."""
    at = hashes.view(np.uint64) & np.uint64(FILTER_BITS - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
