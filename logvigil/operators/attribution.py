"""Why an event was flagged: weighted features, three reasons, recent history, alert cards.

The 27 features of an event stay in its row as an array; ranking them needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logvigil.functions import clock
from logvigil.functions.rules import MAX_FAILURES, MAX_VELOCITY_KMH, MIN_JUMP_KM, feature_narrative
from logvigil.operators.timeline import drop_context, row_window, with_context, with_width
from logvigil.operators.triage import event_lookup

# fixed values
MODEL_WEIGHT = 0.6
SEQUENCE_WEIGHT = 0.4
REASONS = 3
HISTORY = 5
ERROR_OF_FEATURE = {
    "session_duration": "rec_err_duration",
    "norm_session_duration": "rec_err_duration",
    "hour_of_day": "rec_err_hour_sin",
    "geo_distance_from_centroid_km": "rec_err_geo_dist",
}


def _candidates(importances: dict[str, float], sequence: bool) -> Column:
    """Array of (rank key, place, feature, value, weight), heaviest first, ties in feature order."""
    entries = []
    for place, (name, importance) in enumerate(importances.items()):
        value = F.col(name).cast("double")
        weight = F.abs(value) * float(importance)
        if sequence:
            error = ERROR_OF_FEATURE.get(name)
            weight = MODEL_WEIGHT * weight + SEQUENCE_WEIGHT * (F.col(error) if error else F.lit(0.0))
        entries.append(
            F.struct(
                (-weight).alias("key"), F.lit(place).alias("place"), F.lit(name).alias("feature"),
                value.alias("value"), weight.alias("weight"),
            )
        )
    return F.array_sort(F.array(*entries))


def importance_attribution(events: DataFrame, importances: dict[str, float], k: int = REASONS) -> DataFrame:
    """The k features with the largest absolute value times importance, one row per (event, rank)."""
    top = F.slice(_candidates(importances, sequence=False), 1, k)
    rows = events.select("event_id", F.posexplode(top).alias("rank", "c"))
    return rows.select("event_id", (F.col("rank") + 1).alias("rank"), "c.feature", "c.value", "c.weight")


def combined_attribution(events: DataFrame, importances: dict[str, float]) -> DataFrame:
    """Weight of every feature, model and sequence part combined, one row per (event, feature)."""
    rows = events.select("event_id", F.explode(_candidates(importances, sequence=True)).alias("c"))
    return rows.select("event_id", "c.feature", "c.value", "c.weight")


def with_reasons(events: DataFrame, importances: dict[str, float], attack: str = "predicted_attack_type") -> DataFrame:
    """Add ``reasons``: three (feature, value, narrative); those of a rule that fired come first."""
    velocity, distance = F.col("geo_velocity_kmh"), F.col("geo_distance_prev_km")
    failures = F.col("failed_auth_count_5min")

    def reason(name: str) -> Column:
        return F.struct(F.lit(name).alias("feature"), F.col(name).cast("double").alias("value"))

    nothing = F.array().cast("array<struct<feature:string,value:double>>")
    travel = (F.col(attack) == "impossible_travel") & (velocity > MAX_VELOCITY_KMH) & (distance > MIN_JUMP_KM)
    burst = (F.col(attack) == "brute_force") & (failures > MAX_FAILURES)
    by_rule = (
        F.when(travel, F.array(reason("geo_velocity_kmh"), reason("geo_distance_prev_km")))
        .when(burst, F.array(reason("failed_auth_count_5min")))
        .otherwise(nothing)
    )
    # at most two rule reasons, so five candidates always leave three
    best = F.slice(_candidates(importances, sequence=True), 1, REASONS + 2)
    rows = events.withColumn("by_rule", by_rule).withColumn("best", best)
    others = F.filter("best", lambda c: ~F.array_contains(F.col("by_rule.feature"), c["feature"]))
    others = F.transform(others, lambda c: F.struct(c["feature"].alias("feature"), c["value"].alias("value")))
    rows = rows.withColumn("top", F.slice(F.concat("by_rule", others), 1, REASONS))
    told = F.transform(
        "top",
        lambda c: F.struct(
            c["feature"].alias("feature"), c["value"].alias("value"),
            feature_narrative(c["feature"], c["value"]).alias("narrative"),
        ),
    )
    return rows.withColumn("reasons", told).drop("by_rule", "best", "top")


def history_snippet(events: DataFrame, length: int = HISTORY, hot_rows: int | None = None, wanted: str | None = None) -> DataFrame:
    """Per event ``history``: the last ``length`` events of the entity up to and including it.

    With ``wanted`` (a boolean column) only for marked events: others are dropped straight after the window.
    """
    item = F.struct(
        F.col("event_id").cast("string").alias("event_id"), clock.iso_text(F.col("ts_us")).alias("timestamp"),
        "resource_accessed", "source_ip", "auth_method", F.col("session_duration").cast("long").alias("session_duration"),
    )
    rows = events.select(
        "event_id", "entity_id", "ts_us", "resource_accessed", "source_ip", "auth_method", "session_duration", *([wanted] if wanted else [])
    )
    rows = with_context(with_width(rows, hot_rows), length - 1)
    rows = rows.withColumn("history", F.collect_list(item).over(row_window(-(length - 1), 0)))
    rows = drop_context(rows)
    return (rows.where(wanted) if wanted else rows).select("event_id", "history")


def explain_cards(alerts: DataFrame, events: DataFrame, importances: dict[str, float]) -> DataFrame:
    """Cards for all alerts as one job. ``events`` is the full log the history comes from.

    ``alerts`` carries features, ``score_ensemble``, ``predicted_attack_type`` and ``cold_start``.
    """
    reasoned = with_reasons(alerts, importances).select(
        "event_id", F.round("score_ensemble", 4).alias("risk_score"), F.col("predicted_attack_type").alias("attack_type"),
        "reasons", (F.col("cold_start") == 1).alias("cold_start"),
    )
    watched = events.join(alerts.select("entity_id").distinct(), "entity_id", "left_semi")
    marked = watched.join(alerts.select("event_id", F.lit(True).alias("is_alert")), "event_id", "left")
    histories = history_snippet(marked, wanted="is_alert")
    return reasoned.join(histories, "event_id").withColumnRenamed("history", "entity_history_snippet")


def explain_event(cards: DataFrame, event_id) -> DataFrame:
    """The card of one event; an unknown id is an error. On a written card table this is a filter."""
    return event_lookup(cards, event_id)
