"""Adaptive factors as a stream: state by user, timers for users that fall silent, results in a versioned log.

Each user's state is the factor so far and a map of how many events of each kind came in. A batch's rows of a user are taken in the order
of their ids; what a trigger takes in bounds them. A timer, put off by each batch of a user's, closes who has been silent: the last
state is given out once more, marked as closed, and forgotten. The map forgets kinds by itself after TTL.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from siltstone.session import scratch
from siltstone.sources.versioned import VersionedLog

FLOOR, CEILING, EASED, RAISED = 0.8, 3.0, 0.95, 1.1
SCHEMA = "user_id long, factor double, events long, errors long, closed boolean"
TTL_MS = 30 * 24 * 3600 * 1000


class FactorProcessor(StatefulProcessor):
    """user_id, factor, number of events and errors, whenever a user's events come in, and once when the user is closed."""

    def __init__(self, idle_ms: int, ttl_ms: int = TTL_MS):
        self.idle_ms, self.ttl_ms = idle_ms, ttl_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.factor = handle.getValueState("factor", "factor double")
        self.kinds = handle.getMapState("kinds", "kind string", "n long", self.ttl_ms)

    def _row(self, key: tuple, factor: float, closed: bool) -> pd.DataFrame:
        kinds = {k[0]: v[0] for k, v in self.kinds.iterator()}
        return pd.DataFrame({"user_id": [key[0]], "factor": [factor], "events": [sum(kinds.values())], "errors": [kinds.get("error", 0)], "closed": [closed]})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat([r[["event_id", "event_type"]] for r in rows]).sort_values("event_id")
        factor = self.factor.get()[0] if self.factor.exists() else 1.0
        for failed in (batch["event_type"] == "error").tolist():
            factor = min(CEILING, factor * RAISED) if failed else max(FLOOR, factor * EASED)
        self.factor.update((factor,))
        for kind, n in batch["event_type"].fillna("").value_counts().items():
            known = self.kinds.getValue((kind,)) if self.kinds.containsKey((kind,)) else None
            self.kinds.updateValue((kind,), (int(n) + (known[0] if known else 0),))
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield self._row(key, factor, False)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.factor.exists():
            yield self._row(key, self.factor.get()[0], True)
            self.factor.clear()
            self.kinds.clear()

    def close(self) -> None:
        pass


#: The store that such processors need; and no batches without rows, which timers would ask for without end.
_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


@contextmanager
def settings(spark: SparkSession) -> Iterator[None]:
    """Within, streams that start run with what such processors need."""
    before = {k: spark.conf.get(k, None) for k in _SETTINGS}
    for k, v in _SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def factors(stream: DataFrame, idle_ms: int = 3_600_000) -> DataFrame:
    """A stream of SCHEMA."""
    return stream.groupBy("user_id").transformWithStateInPandas(FactorProcessor(idle_ms), SCHEMA, "update", "processingTime")


def keep_factors(stream: DataFrame, log: str, checkpoint: str) -> StreamingQuery:
    """Take in all there is, batch by batch, into a versioned log of the users' last states."""

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("batch", F.lit(number).cast("long"))
        _log(batch.sparkSession, log).upsert(rows, tag=f"batch-{number:010d}")

    with settings(stream.sparkSession):
        q = stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start()
        q.awaitTermination()
    return q


def _log(spark: SparkSession, path: str) -> VersionedLog:
    return VersionedLog(spark, path, ["user_id"], "batch", buckets=8)


def read_factors(spark: SparkSession, path: str) -> DataFrame:
    """The last state of each user."""
    return _log(spark, path).read()


def streamed_factors(spark: SparkSession, folder: str, name: str = "events.parquet") -> DataFrame:
    """Run a folder's events as a stream to their end; the last state of each user."""
    schema = spark.read.parquet(f"{folder}/{name}").schema
    # A pattern, since a stream's path must be a folder or a pattern, and the table may be one file.
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/{name[:-1]}[{name[-1]}]")
    path = scratch(spark, "factors")
    q = keep_factors(factors(events), f"{path}/log", f"{path}/checkpoint")
    if q.exception():
        raise q.exception()
    return read_factors(spark, f"{path}/log")
