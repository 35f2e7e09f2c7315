"""Incremental counterparts of the batch operators, over file streams.

Event times arrive without a zone and are cast, since watermarks need timestamps; late rows beyond the watermark
are the stream's own business, the upserts take every row.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltstone.sources.versioned import VersionedLog


def events(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    """A stream of Parquet files of events."""
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


def error_counts(stream: DataFrame) -> DataFrame:
    """Occurrences, first and last time of each error, for update mode."""
    k = F.get_json_object("props", "$.k").cast("long") % 10
    key = F.concat_ws(":", "event_type", k.cast("string"))
    return stream.groupBy(F.left(F.md5(key), F.lit(8)).alias("hash"), F.col("event_type").alias("category"), k.alias("key_info")).agg(
        F.count("*").alias("occurrences"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen")
    )


def upsert_into(counts: DataFrame, path: str, checkpoint: str, compact_every: int = 50) -> StreamingQuery:
    """Add each batch's changed rows to a versioned log, as a delta tagged with the batch's number.

    A batch that is run again finds its tag and adds nothing, so every change counts once. Every so many batches the log is compacted and
    the folders of the batches it covers are removed.
    """

    def write(batch: DataFrame, number: int) -> None:
        log = _log(batch.sparkSession, path)
        log.upsert(batch.withColumn("batch", F.lit(number)), tag=f"batch-{number:010d}")
        if number % compact_every == compact_every - 1:
            compact_upserts(batch.sparkSession, path)

    return counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start()


def _log(spark: SparkSession, path: str) -> VersionedLog:
    return VersionedLog(spark, path, ["hash"], "batch")


def read_upserts(spark: SparkSession, path: str) -> DataFrame:
    """The last state of each key."""
    return _log(spark, path).read().drop("batch")


def windowed_counts(stream: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Events of each kind in windows of time, for append mode."""
    return stream.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def adaptive_factor(stream: DataFrame) -> DataFrame:
    """(user_id, factor): the factor of the batch fold, kept as state; rows of one batch are taken in the order of their ids."""

    def fold(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        factor = state.get[0] if state.exists else 1.0
        rows = pd.concat(frames).sort_values("event_id")
        for kind in rows["event_type"]:
            factor = max(0.8, factor * 0.95) if kind != "error" else min(3.0, factor * 1.1)
        state.update((factor,))
        yield pd.DataFrame({"user_id": [key[0]], "factor": [factor]})

    return stream.groupBy("user_id").applyInPandasWithState(fold, "user_id long, factor double", "factor double", "update", "NoTimeout")


def persist_every(stream: DataFrame, path: str, checkpoint: str, seconds: int = 10) -> StreamingQuery:
    """Append a stream's rows to a table at intervals, not at every event."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(processingTime=f"{seconds} seconds").start()


def compact_upserts(spark: SparkSession, path: str) -> int:
    """One base in place of all batches up to now, whose folders go but for those of the version before; how many entries went."""
    log = _log(spark, path)
    log.compact()
    return log.vacuum()
