"""Score calibration over the whole stream: ensembles, thresholds, rolling normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logvigil.functions import scores
from logvigil.functions.clock import US_PER_DAY, US_PER_HOUR, US_PER_SECOND, div
from logvigil.operators.ranks import exact_percentile
from logvigil.session import written

# fixed values
ALERT_QUANTILE = 0.99
FALLBACK_QUANTILE = 0.95
ROLLING_DAYS = 30
SECONDS_PER_DAY = 86_400
HOURS_PER_DAY = 24
MOST_RECORDS = 100_000  # that are broadcast


def minmax(df: DataFrame, column: str) -> tuple[float, float]:
    row = df.agg(F.min(column).alias("low"), F.max(column).alias("high")).first()
    return row["low"], row["high"]


def calibrated_threshold(scored: DataFrame, score: str = "score_ensemble") -> float:
    """99th percentile of the benign validation scores; without benign rows the 95th of all."""
    val = scored.where(F.col("split") == "val")
    (value,) = exact_percentile(val.where(F.col("label") == "normal"), score, ALERT_QUANTILE)
    if value is None:
        (value,) = exact_percentile(val, score, FALLBACK_QUANTILE)
    if value is None:
        raise ValueError("no validation rows to calibrate on")
    return value


def add_flag(scored: DataFrame, threshold: float, score: str = "score") -> DataFrame:
    return scored.withColumn("threshold", F.lit(threshold)).withColumn("is_anomaly", F.col(score) >= threshold)


def ensemble(scored: DataFrame, w_seq: float = 0.5, w_base: float = 0.5) -> DataFrame:
    """Add ``score_seq``, ``score_base``, ``score_ensemble`` from ``seq_error``, ``score``, ``split``.

    The sequence error is scaled by the validation range and clipped, the base score by its range
    over all rows.
    """
    val = F.when(F.col("split") == "val", F.col("seq_error"))
    r = scored.agg(
        F.min(val).alias("seq_low"), F.max(val).alias("seq_high"),
        F.min("score").alias("base_low"), F.max("score").alias("base_high"),
    ).first()
    seq = scores.minmax_clip(F.col("seq_error"), F.lit(r["seq_low"]), F.lit(r["seq_high"]))
    base = scores.minmax_eps(F.col("score"), F.lit(r["base_low"]), F.lit(r["base_high"]))
    return scored.withColumns({"score_seq": seq, "score_base": base}).withColumn(
        "score_ensemble", scores.ensemble_score(F.col("score_seq"), F.col("score_base"), w_seq, w_base)
    )


def with_score_defaults(events: DataFrame, scored: DataFrame) -> DataFrame:
    """Left join of the three score columns in use, with defaults for events without a score."""
    out = events.join(scored.select("event_id", "score_ensemble", "threshold", "is_anomaly"), "event_id", "left")
    return out.fillna(
        {"score_ensemble": scores.DEFAULT_SCORE, "threshold": scores.DEFAULT_THRESHOLD, "is_anomaly": False}
    )


def is_flagged() -> Column:
    return F.col("is_anomaly") | (F.col("score_ensemble") >= F.col("threshold"))


def _extremes() -> list[Column]:
    return [F.min("low").alias("low"), F.max("high").alias("high")]


def _shifted(table: DataFrame, key: str, shift: int, group: str, group_shift: int) -> DataFrame:
    """Every row twice: as it is, and moved forward by ``shift``, where it leaves the window."""
    none = F.lit(None).cast("double")
    now = F.struct(
        F.col(group), F.col(key), F.col("low"), F.col("high"), none.alias("old_low"), none.alias("old_high"),
        F.lit(0).alias("leaving"),
    )
    old = F.struct(
        (F.col(group) + group_shift).alias(group), (F.col(key) + shift).alias(key), none.alias("low"), none.alias("high"),
        F.col("low").alias("old_low"), F.col("high").alias("old_high"), F.lit(1).alias("leaving"),
    )
    return table.select(F.explode(F.array(now, old)).alias("r")).select("r.*")


def _head_and_tail(table: DataFrame, key: str, shift: int, group: str, group_shift: int, name: str) -> DataFrame:
    """Per row: extremes of earlier rows of its group (head) and of the rows of the group one
    window length ago that are later than one window length ago (tail)."""
    both = _shifted(table, key, shift, group, group_shift)
    head = Window.partitionBy(group).orderBy(F.col(key), "leaving").rowsBetween(Window.unboundedPreceding, -1)
    tail = Window.partitionBy(group).orderBy(F.col(key).desc(), "leaving").rowsBetween(Window.unboundedPreceding, -1)
    out = both.withColumns(
        {
            f"{name}_low": F.least(F.min("low").over(head), F.min("old_low").over(tail)),
            f"{name}_high": F.greatest(F.max("high").over(head), F.max("old_high").over(tail)),
        }
    )
    return out.where(F.col("leaving") == 0).select(group, key, "low", "high", f"{name}_low", f"{name}_high")


def _records(rows: DataFrame, cell: str, later: bool) -> DataFrame:
    """The rows of each cell that are lower or higher than all before them in it (``later``: all after them)."""
    order = [F.col(c).desc() if later else F.col(c).asc() for c in ("ts_us", "event_id")]
    others = Window.partitionBy(cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"least": F.min("v").over(others), "most": F.max("v").over(others)})
    return rows.where(F.col("least").isNull() | (F.col("v") < F.col("least")) | (F.col("v") > F.col("most"))).drop("least", "most")


def _hourly(events: DataFrame, value: str, days: int) -> tuple[DataFrame, int]:
    """Per hour: extremes of the whole hours that stay in the window all through it (``core_low``, ``core_high``), and the ``comes`` and ``goes``:
    events of the hour, and of the hour that leaves the window meanwhile, that are beyond these and were not topped before (after). Also
    the number of all of them.

    An event that is not beyond what stays in the window can be left out whatever else comes or goes. The rest are records of
    their second and then of their hour, so no task holds more than a second, or the records of an hour's seconds.
    """
    hours = days * HOURS_PER_DAY
    slim = events.select("event_id", "ts_us", F.col(value).alias("v"), div(F.col("ts_us"), US_PER_HOUR).alias("hour"))
    ends = slim.groupBy("hour").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    # an hour that nothing happens in is no key that any event asks for; one row an hour
    inner = Window.orderBy("hour").rangeBetween(-(hours - 1), -1)
    core = written(ends.select("hour", F.min("low").over(inner).alias("low"), F.max("high").over(inner).alias("high")))
    beyond = (F.col("low").isNull() & F.col("v").isNotNull()) | (F.col("v") < F.col("low")) | (F.col("v") > F.col("high"))
    parts = []
    for kind, shift in (("comes", 0), ("goes", hours)):
        rows = slim.withColumn("hour", F.col("hour") + shift).join(F.broadcast(core), "hour").where(beyond).drop("low", "high")
        rows = _records(_records(rows.withColumn("sec", div(F.col("ts_us"), US_PER_SECOND)), "sec", shift > 0), "hour", shift > 0)
        parts.append(rows.select("hour", "ts_us", "event_id", "v", F.lit(kind).alias("kind")))
    records = written(parts[0].unionByName(parts[1]))
    point = F.struct("ts_us", "event_id", "v")
    listed = records.groupBy("hour").agg(*[F.collect_list(F.when(F.col("kind") == kind, point)).alias(kind) for kind in ("comes", "goes")])
    table = core.select(F.col("hour").alias("roll_hour"), F.col("low").alias("core_low"), F.col("high").alias("core_high"), "hour").join(listed, "hour", "left")
    return written(table.drop("hour")), records.count()


def rolling_extremes(events: DataFrame, value: str, days: int = ROLLING_DAYS, most_records: int = MOST_RECORDS) -> DataFrame:
    """Add ``roll_low`` and ``roll_high``: extremes over (t - days, t] of the whole stream. Events of one instant count in the order of their ids.

    The extremes of a stream change seldom. The records that change them go to the events as a broadcast table by hour, so that no event is shuffled.
    Should there be more than ``most_records`` of them, say because scores rise all the time, :func:`joined_extremes` gives the same.
    """
    by_hour, records = _hourly(events, value, days)
    if records > most_records:
        return written(joined_extremes(events, value, days))
    now, start = F.struct("ts_us", "event_id"), F.col("ts_us") - days * US_PER_DAY
    came = F.transform(F.filter("comes", lambda r: F.struct(r["ts_us"], r["event_id"]) <= now), lambda r: r["v"])
    left = F.transform(F.filter("goes", lambda r: r["ts_us"] > start), lambda r: r["v"])
    rows = events.withColumn("roll_hour", div(F.col("ts_us"), US_PER_HOUR)).join(F.broadcast(by_hour), "roll_hour", "left")
    rows = rows.withColumns(
        {
            "roll_low": F.least("core_low", F.array_min(came), F.array_min(left)),
            "roll_high": F.greatest("core_high", F.array_max(came), F.array_max(left)),
        }
    )
    return rows.drop(*by_hour.columns)


def joined_extremes(events: DataFrame, value: str, days: int = ROLLING_DAYS) -> DataFrame:
    """The same by a join of all events with the extremes before their instants.

    The window is put together from three levels: microseconds within a second, seconds within a
    day, whole days. A window partition holds at most the microseconds of two seconds or the
    seconds of two days, however many events there are; the day table has one row per day. Events
    of one instant count in the order of their ids.
    """
    window_us = days * US_PER_DAY
    instants = events.groupBy("ts_us").agg(F.min(value).alias("low"), F.max(value).alias("high"))
    instants = instants.withColumn("sec", div(F.col("ts_us"), US_PER_SECOND))
    seconds = instants.groupBy("sec").agg(*_extremes())
    seconds = seconds.withColumn("day", div(F.col("sec"), SECONDS_PER_DAY))
    by_day = seconds.groupBy("day").agg(*_extremes())
    full = Window.orderBy("day").rangeBetween(-(days - 1), -1)  # one row per day
    full_days = by_day.select(
        "day", F.min("low").over(full).alias("day_low"), F.max("high").over(full).alias("day_high")
    )
    in_day = _head_and_tail(seconds, "sec", days * SECONDS_PER_DAY, "day", days, "s").drop("low", "high")
    in_day = in_day.join(full_days, "day").select(
        "sec", F.least("s_low", "day_low").alias("s_low"), F.greatest("s_high", "day_high").alias("s_high")
    )
    in_second = _head_and_tail(instants, "ts_us", window_us, "sec", days * SECONDS_PER_DAY, "u").drop("low", "high")
    before = in_second.join(in_day, "sec").select(
        "ts_us", F.least("u_low", "s_low").alias("b_low"), F.greatest("u_high", "s_high").alias("b_high")
    )
    ties = Window.partitionBy("ts_us").orderBy("event_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return events.join(before, "ts_us").withColumns(
        {
            "roll_low": F.least(F.min(value).over(ties), F.col("b_low")),
            "roll_high": F.greatest(F.max(value).over(ties), F.col("b_high")),
        }
    ).drop("b_low", "b_high")


def rolling_minmax(events: DataFrame, value: str, out: str = "normalized_score", days: int = ROLLING_DAYS) -> DataFrame:
    """Add the score scaled by the extremes of the trailing window; an empty range counts as 1."""
    rows = rolling_extremes(events, value, days)
    width = F.col("roll_high") - F.col("roll_low")
    width = F.when(width == 0, F.lit(1.0)).otherwise(width)
    norm = scores.clip((F.col(value) - F.col("roll_low")) / width)
    return rows.withColumn(out, F.coalesce(norm, F.lit(0.0))).drop("roll_low", "roll_high")
