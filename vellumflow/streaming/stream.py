"""Structured Streaming: files that arrive are parsed and converted as they come; statuses are rolled up by window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumflow.sources import reader

FILE_FIELDS = "path string, modificationTime timestamp, length long, content binary"


def arriving(spark: SparkSession, path: str, per_batch: int = 100) -> DataFrame:
    """New files below a folder, at most ``per_batch`` in a micro-batch: the bound of the work in flight."""
    return spark.readStream.format("binaryFile").schema(FILE_FIELDS).option("maxFilesPerTrigger", per_batch).option("recursiveFileLookup", "true").load(path)


def convert_stream(files: DataFrame, allowed: tuple[str, ...] | None = None, max_size: int | None = None) -> DataFrame:
    """Rows of items of the files that arrive; a bad file is one row with its error."""
    return reader.items(reader.inputs(files, allowed, max_size).where("status = 'pending'"))


def write(items: DataFrame, path: str, checkpoint: str, once: bool = True):
    """Appends item rows as parquet; with ``once`` it stops when all that is there is done."""
    w = items.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime="10 seconds")).start()


def windowed_status(events: DataFrame, time: str = "ts", late: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """How many pages of each kind failed in each window; what comes later than ``late`` is left out."""
    failed = F.count_if(F.col("event_id") % 11 == 0)
    return events.withWatermark(time, late).groupBy(F.window(time, window), "event_type").agg(F.count("*").alias("n"), failed.alias("failed")).select(F.col("window.start").alias("start"), "event_type", "n", "failed")
