"""Queries behind the analyst's queue, alert page and entity page."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logvigil.functions import clock, rules, scores
from logvigil.functions.clock import US_PER_DAY
from logvigil.operators.timeline import entity_tail

# fixed values
PAGE_SIZE = 25
RISK_DIGITS = 4
HISTORY_EVENTS, TRAJECTORY_EVENTS, TIMELINE_EVENTS = 5, 20, 100
REASON_COLUMNS = ("predicted_attack_type", "geo_velocity_kmh", "geo_distance_prev_km", "failed_auth_count_5min", "risk_score")
QUEUE_COLUMNS = ("event_id", "timestamp", "entity_id", "entity_type", "attack_type", "risk_score", "top_reason")


def queue_filter(
    alerts: DataFrame, first_day_us: int | None = None, last_day_us: int | None = None,
    entity_types: Sequence[str] = (), attacks: Sequence[str] = (), min_risk: float = 0.5,
) -> DataFrame:
    """Days from first to last, both whole; an empty list means no filter."""
    keep = F.col("risk_score") >= min_risk
    if first_day_us is not None:
        keep = keep & (F.col("ts_us") >= first_day_us)
    if last_day_us is not None:
        keep = keep & (F.col("ts_us") < last_day_us + US_PER_DAY)
    if entity_types:
        keep = keep & F.col("entity_type").isin(*entity_types)
    if attacks:
        keep = keep & F.col("predicted_attack_type").isin(*attacks)
    return alerts.where(keep)


def queue_search(alerts: DataFrame, text: str) -> DataFrame:
    """Literal, case-insensitive search in entity and event id."""
    wanted = text.strip().lower()
    if not wanted:
        return alerts
    return alerts.where(
        F.lower("entity_id").contains(wanted) | F.lower(F.col("event_id").cast("string")).contains(wanted)
    )


def _queue_order() -> list[Column]:
    return [F.col("risk_score").desc(), F.col("ts_us"), F.col("event_id")]


def alert_queue(alerts: DataFrame) -> DataFrame:
    return alerts.orderBy(*_queue_order())


def queue_page(alerts: DataFrame, page: int = 1, size: int = PAGE_SIZE) -> DataFrame:
    """One page of the queue: top-k of the partitions, no global sort."""
    return alerts.orderBy(*_queue_order()).offset((page - 1) * size).limit(size)


def page_count(alerts: DataFrame, size: int = PAGE_SIZE) -> DataFrame:
    return alerts.agg(F.greatest(F.lit(1), F.ceil(F.count("*") / size)).cast("long").alias("pages"))


def present_columns(alerts: DataFrame) -> DataFrame:
    """Queue columns as shown: formatted time, rounded risk, renamed type, main reason; absent ones are 0.0, or NULL for texts."""
    shown = alerts.withColumn("timestamp", F.date_format(clock.wall_clock(F.col("ts_us")), "yyyy-MM-dd HH:mm:ss"))
    if "top_reason" not in shown.columns and {*REASON_COLUMNS} <= {*shown.columns}:
        shown = shown.withColumn("top_reason", rules.top_reason(*[F.col(c) for c in REASON_COLUMNS]))
    shown = shown.withColumnsRenamed({"predicted_attack_type": "attack_type"})
    if "risk_score" in shown.columns:
        shown = shown.withColumn("risk_score", F.round("risk_score", RISK_DIGITS))
    return shown.select(*[F.col(c) if c in shown.columns else (F.lit(0.0) if c == "risk_score" else F.lit(None).cast("string")).alias(c) for c in QUEUE_COLUMNS])


def kpi_counts(alerts: DataFrame) -> DataFrame:
    band = scores.severity_band(F.col("risk_score"))
    return alerts.agg(F.count_if(band == "critical").alias("critical"), F.count_if(band == "medium").alias("medium"))


def filter_domains(alerts: DataFrame) -> DataFrame:
    """Choices of the queue filters as (domain, value): types, attacks, entities, first and last day."""
    columns = {"entity_type": "entity_type", "attack_type": "predicted_attack_type", "entity_id": "entity_id"}
    choices = F.array(*[F.struct(F.lit(d).alias("domain"), F.col(c).alias("value")) for d, c in columns.items()])
    listed = alerts.select(F.explode(choices).alias("c")).select("c.*").distinct()

    def day(ts_us: Column) -> Column:
        return F.date_format(clock.wall_clock(ts_us), "yyyy-MM-dd")

    ends = alerts.agg(F.min("ts_us").alias("first"), F.max("ts_us").alias("last"))
    days = ends.select(
        F.explode(
            F.array(
                F.struct(F.lit("first_day").alias("domain"), day(F.col("first")).alias("value")),
                F.struct(F.lit("last_day").alias("domain"), day(F.col("last")).alias("value")),
            )
        ).alias("c")
    ).select("c.*")
    return listed.unionByName(days).orderBy("domain", "value")


def event_lookup(events: DataFrame, event_id) -> DataFrame:
    """Rows of one event; an unknown id is an error. The filter reaches the scan, which runs once. For tables that are looked up
    often see :mod:`logvigil.sources.stores`."""
    found = events.where(F.col("event_id") == event_id)
    rows = found.collect()  # an id names one event
    if not rows:
        raise ValueError(f"no event with id {event_id}")
    return events.sparkSession.createDataFrame(rows, events.schema)


def latest_decisions(feedback: DataFrame) -> DataFrame:
    """The last decision on each event (as text): event_id, analyst_action, comments, decided_at."""
    last = F.max_by(F.struct("analyst_action", "comments", "timestamp"), F.struct("timestamp", "decision_id"))
    return feedback.groupBy("event_id").agg(last.alias("d")).select("event_id", "d.analyst_action", "d.comments", F.col("d.timestamp").alias("decided_at"))


def with_decisions(alerts: DataFrame, feedback: DataFrame) -> DataFrame:
    """Alerts with the last decision on them and ``open``, true where there is none."""
    known = latest_decisions(feedback).withColumnRenamed("event_id", "decided_event")
    rows = alerts.join(known, F.col("event_id").cast("string") == F.col("decided_event"), "left")
    return rows.withColumn("open", F.col("decided_event").isNull()).drop("decided_event")


def hour_histogram(events: DataFrame, entity_id: str | None = None) -> DataFrame:
    """Events per entity and hour of the day."""
    rows = events if entity_id is None else events.where(F.col("entity_id") == entity_id)
    hour = F.floor(clock.hour_of_day(F.col("ts_us"))).cast("int")
    return rows.groupBy("entity_id", hour.alias("hour")).agg(F.count("*").alias("n"))


def entity_header(features: DataFrame, profiles: DataFrame) -> DataFrame:
    """Profile numbers and the latest decay per entity; entities without a profile show defaults."""
    latest = features.groupBy("entity_id").agg(
        F.count("*").alias("seen"),
        F.max_by("profile_decay_factor", F.struct("ts_us", "event_id")).alias("decay"),
    )
    profile = profiles.select("entity_id", "num_events", "home_lat", "home_lon", "avg_radius")
    return latest.join(profile, "entity_id", "left").select(
        "entity_id", F.coalesce("num_events", "seen").alias("events"),
        F.coalesce("home_lat", F.lit(0.0)).alias("home_lat"), F.coalesce("home_lon", F.lit(0.0)).alias("home_lon"),
        F.coalesce("avg_radius", F.lit(10.0)).alias("avg_radius"), "decay",
    )


def risk_timeline(alerts: DataFrame, n: int = TIMELINE_EVENTS) -> DataFrame:
    return entity_tail(alerts.select("entity_id", "event_id", "ts_us", "risk_score"), n).drop("back")


def geo_trajectory(events: DataFrame, n: int = TRAJECTORY_EVENTS) -> DataFrame:
    return entity_tail(events.select("entity_id", "event_id", "ts_us", "lat", "lon", "source_ip"), n).drop("back")


def decay_timeline(features: DataFrame) -> DataFrame:
    return features.select("entity_id", "event_id", "ts_us", "profile_decay_factor")


