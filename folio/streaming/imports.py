"""The import of pages as an incremental job: each run takes the files that came since the last one.

This goes beyond one-off imports: the file source keeps what it has read in the
checkpoint, the chain is the same narrow one, and no state is held.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folio.functions import html
from folio.functions.charset import decode_as
from folio.plans.jobs import import_pages

FILE = "path string, modificationTime timestamp, length long, content binary"


def stream_pages(spark: SparkSession, source: str) -> DataFrame:
    """(path, text) of new pages under source, as a stream."""
    raw = spark.readStream.format("binaryFile").schema(FILE).option("recursiveFileLookup", True).option("pathGlobFilter", "*.htm").load(source)
    return import_pages(raw.select("path", decode_as(F.col("content"), html.charset(F.col("content"))).alias("html")))


def import_new(spark: SparkSession, source: str, out: str, checkpoint: str) -> StreamingQuery:
    """Append what is new under source to a Parquet table, and stop."""
    return stream_pages(spark, source).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
