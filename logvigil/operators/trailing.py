"""Trailing-window features per event, as one sweep over each entity's timeline.

A trailing count changes only when something enters or leaves the window. Every entry and every
exit becomes a signed row on the timeline, and a running total of the signs is the window value at
each event. There is no per-row list of the window, so a burst of millions of events in an hour
costs the same per row as a quiet hour. Exits (and, with hot entities, entries) are folded per second
before they are shuffled.

Windows are inclusive on whole seconds (sec >= now - horizon) and end at the row itself: later
events of the same second do not count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logvigil.functions.clock import US_PER_SECOND, second_of
from logvigil.functions.geo import haversine_km
from logvigil.functions.rules import failed_auth
from logvigil.operators.timeline import is_sliced, running, with_width

SWEEP_ORDER = ("ts_us", "event_id", "kind")


def _exit_us(second, horizon: int):
    """First microsecond at which an entry of that second has left the window."""
    return (second + (horizon + 1)) * US_PER_SECOND


def _entity(rows: DataFrame) -> list[str]:
    return ["entity_id", "width"] if is_sliced(rows) else ["entity_id"]


def _sum_exits(rows: DataFrame, value: str, horizon: int) -> DataFrame:
    """Signed rows that take each second's total out again once it has left the window."""
    return (
        rows.where(F.col(value) != 0)
        .groupBy(*_entity(rows), second_of(F.col("ts_us")).alias("sec"))
        .agg((-F.sum(value)).alias(value))
        .select(*_entity(rows), value, _exit_us(F.col("sec"), horizon).alias("ts_us"))
    )


def _distinct_marks(rows: DataFrame, key: str, value: str, horizon: int, except_for: DataFrame | None = None) -> DataFrame:
    """+1 where a key value comes into the window, -1 where its last use has left it.

    With hot entities around, rows are first folded to one per (entity, key value, second), so a
    hot pair shuffles at most the seconds of the time span; otherwise that step would only cost.
    """
    uses = rows.where(F.col(key).isNotNull()).withColumn("sec", second_of(F.col("ts_us")))
    at = F.struct("ts_us", "event_id").alias("first")
    if is_sliced(rows):
        seconds = uses.groupBy(*_entity(rows), key, "sec").agg(F.min(at).alias("first"))
    else:
        seconds = uses.select("entity_id", key, "sec", at)
    if except_for is not None:  # after folding, so that a hot pair is small here too
        seconds = seconds.join(except_for.select("entity_id", key), ["entity_id", key], "left_anti")
    order = Window.partitionBy("entity_id", key).orderBy("sec", "first")
    gaps = seconds.withColumns(
        {"last_sec": F.lag("sec").over(order), "next_sec": F.lead("sec").over(order)}
    )
    event_type = rows.schema["event_id"].dataType
    opens = F.col("last_sec").isNull() | (F.col("sec") - F.col("last_sec") > horizon)
    closes = F.col("next_sec").isNull() | (F.col("next_sec") - F.col("sec") > horizon)
    enter = F.when(
        opens,
        F.struct(F.col("first.ts_us").alias("ts_us"), F.col("first.event_id").alias("event_id"), F.lit(1).cast("long").alias(value)),
    )
    leave = F.when(
        closes,
        F.struct(
            _exit_us(F.col("sec"), horizon).alias("ts_us"),
            F.lit(None).cast(event_type).alias("event_id"),
            F.lit(-1).cast("long").alias(value),
        ),
    )
    marks = F.filter(F.array(enter, leave), lambda m: m.isNotNull())
    return gaps.select(*_entity(rows), F.explode(marks).alias("m")).select(*_entity(rows), "m.*")


def trailing_features(
    events: DataFrame,
    typical: DataFrame | None = None,
    failures: bool = True,
    addresses: bool = True,
    travel: bool = True,
    failure_horizon: int = 300,
    distinct_horizon: int = 3600,
    hot_rows: int | None = None,
) -> DataFrame:
    """Add the trailing features that are asked for.

    ``events`` is read once per feature, each time only the columns needed: pass a table, not the
    end of a long chain.

    * ``failed_auth_count_5min``: failed logins in the last 300 s (``failures``)
    * ``distinct_ip_count_1h``: distinct source addresses in the last 3600 s (``addresses``)
    * ``new_resource_count_1h``: distinct resources outside ``typical`` (entity_id,
      resource_accessed) in the last 3600 s; an entity without rows there has none typical
    * ``geo_distance_prev_km``, ``geo_velocity_kmh``: from the previous event (``travel``)
    """
    rows = with_width(events, hot_rows)
    sums, parts = [], []
    zero = F.lit(0).cast("long")
    if failures:
        sums.append("failed_auth_count_5min")
        rows = rows.withColumn(sums[-1], failed_auth(F.col("session_duration"), F.col("auth_method")))
        parts.append(_sum_exits(rows, sums[-1], failure_horizon))
    if addresses:
        sums.append("distinct_ip_count_1h")
        parts.append(_distinct_marks(rows, "source_ip", sums[-1], distinct_horizon))
    if typical is not None:
        sums.append("new_resource_count_1h")
        parts.append(_distinct_marks(rows, "resource_accessed", sums[-1], distinct_horizon, typical))
    rows = rows.withColumns({c: zero for c in sums if c != "failed_auth_count_5min"})
    timeline = rows.withColumn("kind", F.lit(1))
    for part in parts:
        timeline = timeline.unionByName(part.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    place = None
    if travel:
        point = F.struct("lat", "lon", second_of(F.col("ts_us")).alias("sec"))
        place = F.when(F.col("kind") == 1, point)
    swept = running(timeline.fillna(0, sums), tuple(sums), place, SWEEP_ORDER)
    out = swept.where(F.col("kind") == 1).drop("kind")
    out = out if is_sliced(events) else out.drop("width")
    return _add_travel(out) if travel else out


def _add_travel(rows: DataFrame) -> DataFrame:
    prev = F.col("prev")
    distance = haversine_km(prev["lat"], prev["lon"], F.col("lat"), F.col("lon"))
    rows = rows.withColumn("geo_distance_prev_km", F.coalesce(distance, F.lit(0.0)))
    hours = (second_of(F.col("ts_us")) - prev["sec"]) / 3600.0
    speed = F.when(hours > 0, F.try_divide(F.col("geo_distance_prev_km"), hours))
    return rows.withColumn("geo_velocity_kmh", F.coalesce(speed, F.lit(0.0))).drop("prev")


def geo_velocity(events: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Distance and speed from the entity's previous event; 0 for its first one."""
    return trailing_features(events, failures=False, addresses=False, hot_rows=hot_rows)
