"""Exact trailing counts for each event of a stream, with keyed state and event-time timers.

The state of an entity is its events that a later one can still touch: those within ``horizon`` of the watermark. A batch is merged
into them in time order, and each event whose count is new or has grown is emitted, so a row that comes late but ahead of the
watermark also corrects the counts of events after it. Rows behind the watermark are handed on as late, without a count. A timer
drops the state of an entity once the watermark has passed all that it holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import itemgetter

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from logvigil.functions.rules import failed_auth
from logvigil.streaming.feeds import start

US_PER_MS, US_PER_SECOND = 1_000, 1_000_000
COUNTED = Row("event_id", "entity_id", "ts_us", "failed_auth_count_5min", "late")
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def trailing_counts(events: list[tuple], horizon_s: int) -> Iterator[int]:
    """For (ts_us, event_id, failed, ...) in order: failures up to each one, from the whole second ``horizon_s`` before its own."""
    first = total = 0
    for ts_us, _, failed, *_ in events:
        total += failed
        start_us = (ts_us // US_PER_SECOND - horizon_s) * US_PER_SECOND
        while events[first][0] < start_us:
            total -= events[first][2]
            first += 1
        yield total


class FailedLogins(StatefulProcessor):
    """Failed logins of the last ``horizon_s`` seconds at each event of an entity."""

    def __init__(self, id_type: str, horizon_s: int = 300):
        self.id_type, self.horizon_s = id_type, horizon_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.recent = handle.getListState("recent", f"ts_us long, event_id {self.id_type}, failed long, n long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        behind_us = max(0, timerValues.getCurrentWatermarkInMs()) * US_PER_MS
        new = []
        for row in rows:
            if row.ts_us < behind_us:
                yield COUNTED(row.event_id, key[0], row.ts_us, None, True)
            else:
                new.append((row.ts_us, row.event_id, row.failed, -1))
        if not new:
            return
        old = [tuple(held) for held in self.recent.get()]
        known = sorted(old + new, key=itemgetter(0, 1))
        keep, keep_us = [], behind_us - (self.horizon_s + 1) * US_PER_SECOND
        for (ts_us, event_id, failed, before), n in zip(known, trailing_counts(known, self.horizon_s), strict=True):
            # events behind the watermark are only there to be counted: what came before them may have been dropped
            if n != before and ts_us >= behind_us:
                yield COUNTED(event_id, key[0], ts_us, n, False)
            if ts_us >= keep_us:
                keep.append((ts_us, event_id, failed, n))
        self.recent.put(keep)
        if old:  # without state there is no timer
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
        self.handle.registerTimer(known[-1][0] // US_PER_MS + (self.horizon_s + 1) * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.recent.clear()
        return iter([])

    def close(self) -> None:
        pass


def failed_auth_per_event(events: DataFrame, delay: str = "10 minutes", horizon_s: int = 300) -> DataFrame:
    """Per event: event_id, entity_id, ts_us, failed_auth_count_5min, late. An event comes again when its count has grown.

    ``events`` has ts (timestamp), entity_id, event_id, session_duration and auth_method. The watermark runs ``delay`` behind the
    latest event of earlier batches; rows behind it are late and have no count. Its column is left behind on purpose: Spark would drop
    late rows that carry it. Needs the RocksDB state store (:func:`start_per_event` sets it).
    """
    id_type = events.schema["event_id"].dataType.simpleString()
    rows = events.withWatermark("ts", delay).select(
        "entity_id", "event_id", (F.unix_micros("ts") + F.lit(0)).alias("ts_us"),
        failed_auth(F.col("session_duration"), F.col("auth_method")).alias("failed"),
    )
    schema = f"event_id {id_type}, entity_id string, ts_us long, failed_auth_count_5min long, late boolean"
    return rows.groupBy("entity_id").transformWithState(
        FailedLogins(id_type, horizon_s), outputStructType=schema, outputMode="Update", timeMode="EventTime"
    )


def start_per_event(counts: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Write what :func:`failed_auth_per_event` emits, a folder for each batch; a batch that is retried overwrites its own."""
    spark = counts.sparkSession

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch-{batch_id}")

    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)  # read when the query starts
    try:
        return start(counts.writeStream.foreachBatch(put).outputMode("update").option("checkpointLocation", checkpoint), once)
    finally:
        spark.conf.set(STATE_STORE, before)


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """The latest count of each event: counts only grow."""
    rows = spark.read.option("recursiveFileLookup", True).parquet(path).where("NOT late")
    return rows.groupBy("event_id", "entity_id", "ts_us").agg(F.max("failed_auth_count_5min").alias("failed_auth_count_5min"))


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """The rows that came behind the watermark, for a later batch run."""
    return spark.read.option("recursiveFileLookup", True).parquet(path).where("late").select("event_id", "entity_id", "ts_us")
