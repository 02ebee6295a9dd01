"""Streams run over everything that is there (available-now) and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from logvigil.plans import derived, verdicts
from logvigil.plans.catalog_sources import ISO
from logvigil.plans.oracle import r4
from logvigil.plans.registry import query
from logvigil.session import scratch_dir
from logvigil.sources import readers, writers
from logvigil.streaming import feeds, stateful

ALERT_SQL = f"SELECT cast(event_id AS varchar) AS event_id, {ISO} AS timestamp, entity_id, predicted_attack_type, {r4('risk_score')} FROM ra"


@verdicts.shown("stream_live_alerts", ALERT_SQL)
def stream_live_alerts(spark, sf):
    base = scratch_dir(spark)
    writers.write_live_alerts(derived.alerts(spark, sf), f"{base}/feed")
    stream = feeds.live_alerts(spark, f"{base}/feed", files_per_trigger=2)
    feeds.to_table(stream, f"{base}/table", f"{base}/progress", once=True).awaitTermination()
    return spark.read.parquet(f"{base}/table")


@verdicts.shown("stream_alert_sink", ALERT_SQL)
def stream_alert_sink(spark, sf):
    base = scratch_dir(spark)
    writers.write_table(derived.alerts(spark, sf), f"{base}/alerts")
    alerts = spark.readStream.schema(spark.read.parquet(f"{base}/alerts").schema).parquet(f"{base}/alerts")
    feeds.alert_sink(alerts, f"{base}/feed", f"{base}/progress", once=True).awaitTermination()
    return readers.read_live_alerts(spark, f"{base}/feed")


@query("stream_failed_auth_windows", """SELECT entity_id, s AS start_us, s + 300000000 AS end_us, count(*) AS failed FROM (
  SELECT entity_id, ts_us // 60000000 * 60000000 - i * 60000000 AS s FROM al CROSS JOIN range(5) r(i) WHERE failed = 1) GROUP BY entity_id, s""")
def stream_failed_auth_windows(spark, sf):
    """Failed logins on a sliding grid of five-minute windows."""
    base = scratch_dir(spark)
    log = derived.access_log(spark, sf).select(
        "entity_id", F.timestamp_micros("ts_us").alias("ts"), "session_duration", "auth_method"
    )
    writers.write_table(log, f"{base}/log")
    events = spark.readStream.schema(log.schema).parquet(f"{base}/log")
    feeds.window_sink(feeds.failed_auth_windows(events), f"{base}/table", f"{base}/progress", once=True).awaitTermination()
    return feeds.read_windows(spark, f"{base}/table")


DAYS = 10 * 86_400_000_000  # of each of the first parts that the log comes in
DELAY_US = DAYS  # of a watermark that part of the rows held back are ahead of


def _per_event(spark, sf, parts, delay_us=600_000_000):
    """Run the per-event count over the log, which comes in parts, one after the other; the folder it writes."""
    base = scratch_dir(spark)
    log = derived.access_log(spark, sf).select(
        "entity_id", "event_id", F.timestamp_micros("ts_us").alias("ts"), "ts_us", "session_duration", "auth_method"
    )
    for part in parts:
        writers.write_table(log.where(part), f"{base}/log", mode="append")
        events = spark.readStream.schema(log.schema).parquet(f"{base}/log")
        counts = stateful.failed_auth_per_event(events, f"{delay_us // 1_000_000} seconds")
        stateful.start_per_event(counts, f"{base}/table", f"{base}/progress", once=True).awaitTermination()
    return f"{base}/table"


@query("stream_failed_auth", "SELECT al.event_id, entity_id, ts_us, failed_auth_count_5min FROM fa JOIN al USING (event_id)")
def stream_failed_auth(spark, sf):
    """The count at each event while the log comes in, in order and in three parts."""
    first, second = (F.lit(derived.START_US + n * DAYS) for n in (1, 2))
    ts = F.col("ts_us")
    parts = (ts < first, (ts >= first) & (ts < second), ts >= second)
    return stateful.read_counts(spark, _per_event(spark, sf, parts))


HELD_BACK = "event_id % 10 = 3"  # rows that come when all others have come


@query("stream_late_rows", f"""SELECT event_id, entity_id, ts_us FROM al WHERE {HELD_BACK}
  AND ts_us < (SELECT (max(ts_us) - {DELAY_US}) // 1000 * 1000 FROM al WHERE NOT {HELD_BACK})""")
def stream_late_rows(spark, sf):
    """Rows behind the watermark, kept in a table of their own."""
    return stateful.read_late(spark, _per_event(spark, sf, (~F.expr(HELD_BACK), F.expr(HELD_BACK)), DELAY_US))


@query("stream_corrected_counts", f"""SELECT event_id, entity_id, ts_us, failed_auth_count_5min FROM (
  SELECT event_id, entity_id, ts_us, cast(sum(failed) OVER (PARTITION BY entity_id ORDER BY sec RANGE BETWEEN 300 PRECEDING AND CURRENT ROW)
    - coalesce(sum(failed) OVER (PARTITION BY entity_id, sec ORDER BY ts_us, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0)
    AS bigint) AS failed_auth_count_5min
  FROM al WHERE NOT ({HELD_BACK}) OR ts_us >= (SELECT (max(ts_us) - {DELAY_US}) // 1000 * 1000 FROM al WHERE NOT ({HELD_BACK})))""")
def stream_corrected_counts(spark, sf):
    """The counts of the same run: rows ahead of the watermark count, and correct what was said before."""
    return stateful.read_counts(spark, _per_event(spark, sf, (~F.expr(HELD_BACK), F.expr(HELD_BACK)), DELAY_US))
