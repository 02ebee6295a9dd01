"""The live alert feed and a streaming failure count."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logvigil.functions.rules import failed_auth
from logvigil.sources import schema
from logvigil.sources.writers import live_rows

# fixed values
POLL = "5 seconds"


def live_alerts(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Tail a folder of JSON lines; broken lines are dropped."""
    reader = spark.readStream.schema(schema.LIVE_ALERT).option("mode", "DROPMALFORMED").option("recursiveFileLookup", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def start(writer, once: bool) -> StreamingQuery:
    """Every five seconds, or (``once``) up to what is there now."""
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=POLL)).start()


def to_table(stream: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append a stream to a parquet table, every five seconds or (``once``) up to what is there now."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    return start(writer.option("checkpointLocation", checkpoint), once)


def alert_sink(alerts: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append alert rows to the feed. A batch that is retried overwrites its own folder."""

    def append(batch: DataFrame, batch_id: int) -> None:
        live_rows(batch).write.mode("overwrite").json(f"{path}/batch-{batch_id}")

    writer = alerts.writeStream.foreachBatch(append).outputMode("append")
    return start(writer.option("checkpointLocation", checkpoint), once)


def window_sink(counts: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Write windows as they grow, finished or not, so that a bounded run leaves none out.

    Each batch writes the windows it changed to a folder of its own; a batch that is retried overwrites that.
    """

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch-{batch_id}")

    writer = counts.writeStream.foreachBatch(put).outputMode("update")
    return start(writer.option("checkpointLocation", checkpoint), once)


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    """The latest count of each window that :func:`window_sink` wrote: counts only grow."""
    rows = spark.read.option("recursiveFileLookup", True).parquet(path)
    return rows.groupBy("entity_id", "start_us", "end_us").agg(F.max("failed").alias("failed"))


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after the watermark had passed their windows and so are in no count."""
    return sum(s.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for s in p["stateOperators"])


def failed_auth_windows(
    events: DataFrame, window: str = "5 minutes", slide: str = "1 minute", delay: str = "10 minutes"
) -> DataFrame:
    """Failed logins per entity on a sliding grid. In append mode a window is emitted once the watermark has passed it, in
    update mode (:func:`window_sink`) with every batch that changes it.

    ``events`` has ``ts`` (timestamp). Successes are filtered before the state.
    """
    failed = events.where(failed_auth(F.col("session_duration"), F.col("auth_method")) == 1)
    counts = failed.withWatermark("ts", delay).groupBy(F.window("ts", window, slide), "entity_id")
    return counts.agg(F.count("*").alias("failed")).select(
        "entity_id", F.unix_micros("window.start").alias("start_us"), F.unix_micros("window.end").alias("end_us"), "failed"
    )
