"""Incremental ingest: new mesh files as a stream, each content once, finished ones left out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.rollups import pending
from ..sources.files import PATTERNS, read_or_empty, with_hash


def stream_meshes(spark: SparkSession, root: str, patterns=PATTERNS, per_trigger: int = 1000) -> DataFrame:
    """An unbounded (path, modificationTime, length, content, sha256)."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "{" + ",".join(patterns) + "}").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", per_trigger)
    return with_hash(files.load(root))


def ingest(files: DataFrame, process: Callable[[DataFrame], DataFrame], reports: str, checkpoint: str, once: bool = True, watermark: str = "7 days") -> StreamingQuery:
    """Process each new content into Parquet reports; a micro-batch skips what has a report, so a replayed one changes nothing. Contents seen within the watermark are dropped from the stream's state."""
    fresh = files.withWatermark("modificationTime", watermark).dropDuplicatesWithinWatermark(["sha256"])

    def batch(rows: DataFrame, _: int) -> None:
        spark = rows.sparkSession
        done = read_or_empty(spark, reports, "sha256 string")
        process(pending(rows, done, "sha256")).write.mode("append").parquet(reports)

    writer = fresh.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def accept_rate(reports: DataFrame, window: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Accept rate by window of a stream of (ts, accepted)."""
    return reports.withWatermark("ts", late).groupBy(F.window("ts", window)).agg(F.count("*").alias("n"), F.count_if("accepted").alias("n_accept"))
