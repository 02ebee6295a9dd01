"""Score arithmetic: profile components, ensembles, normalisation, bands."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values
GEO_SCALE_KM = 150.0
DENSITY_SCALE = 0.25
NOVELTY_WEIGHT = 2.5
WEIGHT_TOTAL = 8.0
DECAY_HALF_LIFE_DAYS = 7.0
DEFAULT_SCORE = 0.5
DEFAULT_THRESHOLD = 0.8
CRITICAL_RISK = 0.80
MEDIUM_RISK = 0.50


def clip(value: Column) -> Column:
    """Into [0, 1]; NULL stays NULL (greatest and least alone would skip it)."""
    return F.when(value.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))


def norm_session_duration(duration: Column, mean: Column, std: Column) -> Column:
    return (duration - mean) / (std + 1e-5)


def profile_decay(ts_us: Column, last_ts_us: Column) -> Column:
    """Halves every seven days since the last profile event, whole seconds; 1 without one."""
    days = (F.floor(ts_us / 1e6) - last_ts_us / 1e6) / 86400.0
    elapsed = F.greatest(F.lit(0.0), F.coalesce(days, F.lit(0.0)))
    return F.exp(elapsed * (-math.log(2.0) / DECAY_HALF_LIFE_DAYS))


def score_geo(distance_km: Column) -> Column:
    return F.least(F.lit(1.0), distance_km / GEO_SCALE_KM)


def score_duration(norm_duration: Column) -> Column:
    return 1.0 - F.exp(-F.abs(norm_duration) / 2.0)


def score_time(density: Column) -> Column:
    """Low density of the hour scores high; 0.5 where no density could be fitted."""
    return F.coalesce(clip(1.0 - density / DENSITY_SCALE), F.lit(0.5))


def stat_score(geo: Column, duration: Column, time: Column, resource_new: Column, device_new: Column) -> Column:
    return (geo + duration + time + NOVELTY_WEIGHT * resource_new + NOVELTY_WEIGHT * device_new) / WEIGHT_TOTAL


def minmax_clip(value: Column, low: Column, high: Column) -> Column:
    width = F.when(F.abs(high - low) < 1e-8, F.lit(1.0)).otherwise(high - low)
    return clip((value - low) / width)


def minmax_eps(value: Column, low: Column, high: Column) -> Column:
    return (value - low) / (high - low + 1e-8)


def ensemble_score(seq: Column, base: Column, w_seq: float = 0.5, w_base: float = 0.5) -> Column:
    return w_seq * seq + w_base * base


def severity_band(risk: Column) -> Column:
    return (
        F.when(risk >= CRITICAL_RISK, F.lit("critical")).when(risk >= MEDIUM_RISK, F.lit("medium")).otherwise(F.lit("low"))
    )
