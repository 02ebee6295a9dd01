"""Data-quality checks: one row (check, passed, found) each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logvigil.functions.clock import second_of
from logvigil.functions.geo import haversine_km
from logvigil.functions.rules import CLASSES, NORMAL
from logvigil.operators.timeline import with_previous
from logvigil.session import written

# fixed values
MANDATORY = (
    "event_id", "entity_id", "entity_type", "timestamp", "source_ip", "geo_location",
    "resource_accessed", "auth_method", "session_duration", "bytes_transferred", "device_fingerprint",
)
TARGET_RATE, RATE_TOLERANCE = 2.0, 0.5
BENIGN_KMH, BENIGN_KM = 500.0, 50.0
TRAVEL_KMH, TRAVEL_KM, TRAVEL_SHARE = 900.0, 500.0, 0.8
MIN_STEP_US = 1000


def _verdict(rows: DataFrame, check: str, passed: Column, found: Column) -> DataFrame:
    return rows.select(F.lit(check).alias("check"), passed.cast("int").alias("passed"), found.cast("double").alias("found"))


def dq_nulls(logs: DataFrame, mandatory: tuple[str, ...] = MANDATORY) -> DataFrame:
    """No NULL and no empty text in the mandatory columns; ``found`` counts both, or missing columns."""
    missing = [c for c in mandatory if c not in logs.columns]
    if missing:
        one = logs.sparkSession.range(1)
        return _verdict(one, "mandatory_columns", F.lit(False), F.lit(len(missing)))
    bad = sum((F.count_if(F.col(c).isNull() | (F.col(c).cast("string") == "")) for c in mandatory), F.lit(0))
    return _verdict(logs.agg(bad.alias("n")), "no_missing_values", F.col("n") == 0, F.col("n"))


def dq_alignment(logs: DataFrame, labels: DataFrame) -> DataFrame:
    """Both tables hold the same ids equally often; ``found`` counts ids that differ."""
    sides = logs.select("event_id", F.lit(1).alias("side")).unionByName(labels.select("event_id", F.lit(-1).alias("side")))
    off = sides.groupBy("event_id").agg(F.sum("side").alias("d"))
    return _verdict(off.agg(F.count_if(F.col("d") != 0).alias("n")), "labels_aligned", F.col("n") == 0, F.col("n"))


def dq_anomaly_rate(labels: DataFrame) -> DataFrame:
    rate = labels.agg((F.count_if(F.col("label") != NORMAL) / F.count("*") * 100.0).alias("rate"))
    return _verdict(rate, "anomaly_rate", F.abs(F.col("rate") - TARGET_RATE) <= RATE_TOLERANCE, F.col("rate"))


def missing_classes(labels: DataFrame, expected: tuple[str, ...] = CLASSES) -> DataFrame:
    """Expected classes without a row."""
    wanted = labels.sparkSession.createDataFrame([(c,) for c in expected], "label string")
    return wanted.join(labels.select("label").distinct(), "label", "left_anti")


def dq_taxonomy(labels: DataFrame, expected: tuple[str, ...] = CLASSES) -> DataFrame:
    lost = missing_classes(labels, expected).agg(F.count("*").alias("n"))
    return _verdict(lost, "all_classes_present", F.col("n") == 0, F.col("n"))


def timeline_counts(logs: DataFrame) -> DataFrame:
    """One row with everything the three timeline checks count, from one pass over the entities."""
    rows = with_previous(
        logs.select("entity_id", "event_id", "ts_us", "lat", "lon", "label"), "ts_us", "lat", "lon", "label"
    )
    prev, travel = F.col("prev"), F.col("label") == "impossible_travel"
    hours = (second_of(F.col("ts_us")) - second_of(prev["ts_us"])) / 3600.0
    km = haversine_km(prev["lat"], prev["lon"], F.col("lat"), F.col("lon"))
    rows = rows.withColumn("km", km).withColumn("kmh", F.when(hours > 0, F.try_divide(F.col("km"), hours)))
    normal = (F.col("label") == NORMAL) & (prev["label"] == NORMAL)
    return rows.agg(
        F.count_if(F.col("ts_us") - prev["ts_us"] < MIN_STEP_US).alias("stuck"),
        F.count_if(normal & (F.col("kmh") > BENIGN_KMH) & (F.col("km") > BENIGN_KM)).alias("fast"),
        F.count_if(travel).alias("travel"),
        F.count_if(travel & (F.col("km") > TRAVEL_KM) & (F.col("kmh") > TRAVEL_KMH)).alias("valid"),
    )


def dq_chronology(logs: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """No step of less than a millisecond within an entity."""
    counts = timeline_counts(logs) if counts is None else counts
    return _verdict(counts, "increasing_time", F.col("stuck") == 0, F.col("stuck"))


def dq_benign_velocity(logs: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """No fast and far step between two normal events."""
    counts = timeline_counts(logs) if counts is None else counts
    return _verdict(counts, "benign_velocity", F.col("fast") == 0, F.col("fast"))


def dq_travel_constraint(logs: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """At least 80 % of the travel events are fast and far; ``found`` is the share (1 without any)."""
    counts = timeline_counts(logs) if counts is None else counts
    share = F.coalesce(F.try_divide(F.col("valid").cast("double"), F.col("travel").cast("double")), F.lit(1.0))
    return _verdict(counts, "travel_constraint", share >= TRAVEL_SHARE, share)


def audit(raw_logs: DataFrame, logs: DataFrame, labels: DataFrame) -> DataFrame:
    """All seven checks. ``raw_logs`` has the source columns, ``logs`` the parsed ones with labels."""
    counts = written(timeline_counts(logs))
    parts = [
        dq_nulls(raw_logs), dq_alignment(raw_logs, labels), dq_anomaly_rate(labels), dq_taxonomy(labels),
        dq_chronology(logs, counts), dq_benign_velocity(logs, counts), dq_travel_constraint(logs, counts),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
