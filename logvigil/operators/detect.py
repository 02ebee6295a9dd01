"""Detectors for the attack signatures, as aggregations over time buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logvigil.functions.clock import US_PER_DAY, US_PER_MINUTE, day_of, div, exact_hour
from logvigil.functions.rules import MAX_VELOCITY_KMH, MIN_JUMP_KM
from logvigil.operators.trailing import geo_velocity, trailing_features

# fixed values
BURST_MIN_ATTEMPTS = 50
STUFFING_MIN_ENTITIES = 20
STUFFING_FAIL_SHARE = 0.8
LATERAL_MIN_RESOURCES = 5
OFF_HOURS = (1.0, 4.0)
EXFIL_DAYS = 28
EXFIL_MIN_DAYS = 14
EXFIL_RESOURCES = ("/vault/secrets/api_keys", "/backup/nightly_dump.tar.gz")


def _bucket(minutes: int):
    width = minutes * US_PER_MINUTE
    return (div(F.col("ts_us"), width) * width).alias("window_us")


def brute_force(events: DataFrame, min_attempts: int = BURST_MIN_ATTEMPTS, minutes: int = 10) -> DataFrame:
    """Zero-length password logins from one address on one entity, per tumbling window."""
    attempts = events.where((F.col("session_duration") == 0) & (F.col("auth_method") == "password"))
    counts = attempts.groupBy("entity_id", "source_ip", _bucket(minutes)).agg(F.count("*").alias("attempts"))
    return counts.where(F.col("attempts") >= min_attempts)


def impossible_travel(events: DataFrame, min_kmh: float = MAX_VELOCITY_KMH, min_km: float = MIN_JUMP_KM) -> DataFrame:
    """Events too far from the entity's previous one for the time between."""
    return geo_velocity(events).where(
        (F.col("geo_velocity_kmh") > min_kmh) & (F.col("geo_distance_prev_km") > min_km)
    )


def credential_stuffing(
    events: DataFrame, min_entities: int = STUFFING_MIN_ENTITIES, min_fail_share: float = STUFFING_FAIL_SHARE, minutes: int = 30,
) -> DataFrame:
    """One address trying many entities with a high share of failures.

    Counted per (address, window, entity) first, so an address behind a third of all rows is
    spread over its entities before the last step.
    """
    logins = events.where(F.col("auth_method") == "password")
    per_entity = logins.groupBy("source_ip", _bucket(minutes), "entity_id").agg(
        F.count("*").alias("attempts"), F.count_if(F.col("session_duration") == 0).alias("failed")
    )
    counts = per_entity.groupBy("source_ip", "window_us").agg(
        F.count("*").alias("entities"), F.sum("attempts").alias("attempts"), F.sum("failed").alias("failed")
    )
    counts = counts.withColumn("fail_share", F.col("failed") / F.col("attempts"))
    return counts.where((F.col("entities") >= min_entities) & (F.col("fail_share") >= min_fail_share))


def lateral_movement(events: DataFrame, typical: DataFrame, min_resources: int = LATERAL_MIN_RESOURCES) -> DataFrame:
    """Events that end an hour with that many resources new to the entity."""
    rows = trailing_features(events, typical, failures=False, addresses=False, travel=False)
    return rows.where(F.col("new_resource_count_1h") >= min_resources)


def device_spoofing(events: DataFrame, known_macs: DataFrame, known_os: DataFrame) -> DataFrame:
    """Known entities on a device and an operating system they never used.

    The lookups are long tables (entity_id, mac) and (entity_id, os). Distinct (entity, mac, os)
    combinations are tested, not events.
    """
    combos = events.select("entity_id", "mac", "os").distinct()
    known = known_os.select("entity_id").distinct()
    new = (
        combos.join(known, "entity_id", "left_semi")
        .join(known_macs.select("entity_id", "mac"), ["entity_id", "mac"], "left_anti")
        .join(known_os.select("entity_id", "os"), ["entity_id", "os"], "left_anti")
    )
    return events.join(new, ["entity_id", "mac", "os"], "left_semi")


def low_slow_exfil(
    events: DataFrame, resources: tuple[str, ...] = EXFIL_RESOURCES, days: int = EXFIL_DAYS, min_days: int = EXFIL_MIN_DAYS,
) -> DataFrame:
    """Off-hours reads of sensitive resources on many days: rolling bytes and active days per entity.

    Reads are summed per day before the window, so a partition holds at most one row per day.
    """
    hour = exact_hour(F.col("ts_us"))
    reads = events.where(F.col("resource_accessed").isin(*resources) & (hour >= OFF_HOURS[0]) & (hour < OFF_HOURS[1]))
    daily = reads.groupBy("entity_id", day_of(F.col("ts_us")).alias("day")).agg(
        F.sum("bytes_transferred").alias("bytes"), F.count("*").alias("reads")
    )
    trail = Window.partitionBy("entity_id").orderBy("day").rangeBetween(-(days - 1), 0)
    rolled = daily.select(
        "entity_id", "day", F.sum("bytes").over(trail).alias("bytes"), F.sum("reads").over(trail).alias("reads"),
        F.count("*").over(trail).alias("active_days"),
    )
    return rolled.where(F.col("active_days") >= min_days)


SLOPE_DIGITS = 9


def insider_drift(events: DataFrame, typical: DataFrame, min_weeks: int = 3, min_slope: float = 0.0) -> DataFrame:
    """Entities whose weekly share of unusual resources rises. Slopes are compared at nine places: the noise of sums is no rise."""
    used = events.groupBy("entity_id", "resource_accessed", div(F.col("ts_us"), 7 * US_PER_DAY).alias("week")).agg(
        F.count("*").alias("n")
    )
    usual = typical.select("entity_id", "resource_accessed", F.lit(1).alias("usual"))
    weekly = (
        used.join(usual, ["entity_id", "resource_accessed"], "left")
        .groupBy("entity_id", "week")
        .agg((F.sum(F.when(F.col("usual").isNull(), F.col("n")).otherwise(F.lit(0))) / F.sum("n")).alias("share"))
    )
    trend = weekly.groupBy("entity_id").agg(
        F.count("*").alias("weeks"), F.regr_slope(F.col("share"), F.col("week").cast("double")).alias("slope"),
        F.max("share").alias("max_share"),
    )
    return trend.where((F.col("weeks") >= min_weeks) & (F.round("slope", SLOPE_DIGITS) > min_slope))
