"""The whole chain from raw events to ensembled, flagged scores, and its 27-column feature matrix."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from logvigil.functions import rules
from logvigil.operators import metrics, models, profiles, ranks, scoring, sequence, trailing
from logvigil.operators.timeline import DECIDED, find_hot, mark_hot
from logvigil.session import JOIN_IN_PLACE, held, sized_files, sized_tasks, written

# fixed values
FEATURES = (
    *profiles.BASE_FEATURES,
    *sequence.ERROR_COLUMNS,
    "failed_auth_count_5min", "distinct_ip_count_1h", "new_resource_count_1h", "geo_velocity_kmh", "geo_distance_prev_km",
)


@dataclass(frozen=True)
class Learned:
    """What is learned from the training part. Tables are written once, constants are one row."""

    events: DataFrame  # with column split
    profiles: DataFrame
    devices: DataFrame
    everybody: Row
    hot: DataFrame | None  # entities with too many rows for one task


def learn(events: DataFrame) -> Learned:
    """Split by time and learn profiles from normal training rows only (never from later rows).

    The log is written once first: every later pass reads that table, however costly parsing and joining it were.
    """
    events = written(events, sized_files())
    with held(events.sparkSession, sized_tasks(events.sparkSession, events.count())):
        split = ranks.chrono_split(events)
        normal = profiles.normal_training(split)
        hot = find_hot(events)
        return Learned(
            split,
            written(profiles.entity_profile(normal, hot)),
            written(profiles.owned(normal, "mac")),
            profiles.global_constants(normal),
            hot,
        )


def base_scores(learned: Learned, events: DataFrame | None = None) -> DataFrame:
    """Base features and the statistical score for all events."""
    rows = learned.events if events is None else events
    features = profiles.base_features(rows, learned.profiles, learned.devices, learned.everybody, learned.hot, learned.events)
    return profiles.stat_profile_score(features, learned.profiles, learned.everybody, learned.events)


#: The base models, and the column that :func:`models.baseline_candidates` gives the score of each in.
BASE_MODELS = {"stat_profile": "score", "isolation_forest": "iforest_score", "one_class": "one_class_score"}


def best_base_scores(scored: DataFrame) -> tuple[DataFrame, str]:
    """``scored`` (a table from :func:`base_scores`) with ``score`` by the base model that has the largest ROC area on the validation part, and
    the name of that model; ties go by name."""
    rows = written(models.baseline_candidates(scored, profiles.BASE_FEATURES))
    val = rows.where(F.col("split") == "val").withColumn("y", rules.binary_label(F.col("label")))
    best = metrics.model_comparison(val, BASE_MODELS).where("best = 1").first()["model"]
    drop = [c for name, c in BASE_MODELS.items() if c != "score"]
    return rows.withColumn("score", F.col(BASE_MODELS[best])).drop(*drop), best


def sequence_errors(split_events: DataFrame, hot: DataFrame | None = None, swept: DataFrame | None = None) -> DataFrame:
    """Add the seven sequence errors and their sum to all events, learned from the training part.

    ``swept`` are the same events with more columns (:func:`trailing_events`), to be kept: they are only gone through once.
    """
    rows = sequence.with_last_values(mark_hot(split_events, hot), hot_rows=DECIDED)
    train = split_events.where(F.col("split") == "train")
    transitions = written(sequence.transition_counts(rows.where(F.col("split") == "train")))
    columns = split_events.columns
    if swept is not None:
        rows, columns = sequence.with_last_values(swept, hot_rows=DECIDED), [c for c in swept.columns if c != "width"]
    centroids, everywhere = sequence.centroid_fit(train), sequence.global_centroid(train)
    scaling = sequence.scaling_fit(sequence.centroid_lookup(train, centroids, everywhere, hot)).first()
    rows = sequence.scale_features(sequence.centroid_lookup(rows, centroids, everywhere, hot), scaling)
    rows = sequence.sequence_surprise(rows, transitions, sequence.vocabulary_sizes(transitions), hot_rows=DECIDED)
    return rows.select(*columns, *sequence.ERROR_COLUMNS, "seq_error")


def trailing_events(learned: Learned) -> DataFrame:
    """All events with their trailing features (and, with hot entities, ``width``)."""
    rows = mark_hot(learned.events, learned.hot)
    return trailing.trailing_features(rows, profiles.typical_pairs(learned.profiles), hot_rows=DECIDED)


def ensemble_scores(learned: Learned, best_base: bool = False, with_trailing: bool = False) -> DataFrame:
    """Base score, sequence errors, ensemble, threshold and flag per event; ``with_trailing`` also the trailing features.

    Each step adds columns to the same rows; nothing is joined back by event. Events are exchanged by entity once and written once: what
    is looked up by entity finds them there, and all that comes after the write is constants and a broadcast table. The base score
    is the profile's, or with ``best_base`` that of the base model that wins on the validation part.
    """
    spark = learned.events.sparkSession
    with held(spark, sized_tasks(spark, learned.events.count())):
        swept = trailing_events(learned) if with_trailing else None
        rows = base_scores(learned, sequence_errors(learned.events, learned.hot, swept))
        # an entity that is cut into slices does not lie by entity, and must not
        scored = written(rows, JOIN_IN_PLACE if learned.hot is None else None)
    if best_base:
        scored, _ = best_base_scores(scored)
    rows = scoring.ensemble(scored)
    rows = scoring.add_flag(rows, scoring.calibrated_threshold(rows), "score_ensemble")
    return scoring.rolling_minmax(rows, "score_ensemble", "score_rolling_ensemble")


def combined_features(learned: Learned, scored: DataFrame) -> DataFrame:
    """All 27 features plus scores per event; rows that have the trailing ones already stay as they are."""
    if {*FEATURES} <= {*scored.columns}:
        return scored
    rows = mark_hot(scored, learned.hot)
    out = trailing.trailing_features(rows, profiles.typical_pairs(learned.profiles), hot_rows=DECIDED)
    return out.select(*scored.columns, *[c for c in out.columns if c in FEATURES and c not in scored.columns])
