"""Event sequences per entity: windows, encoding, and how surprising an event is after its past.

The surprise of an event has seven parts. Numeric parts are the squared gap to the mean of the
previous scaled rows of the window; categorical parts are -ln P(value | previous value) with
add-one smoothing over training transitions. Additive counts make the model refreshable.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from logvigil.functions import clock
from logvigil.functions.geo import haversine_km
from logvigil.functions.rules import NORMAL
from logvigil.operators.ranks import running_totals
from logvigil.operators.timeline import (
    drop_context,
    entity_lookup,
    is_sliced,
    row_window,
    with_context,
    with_previous,
    with_width,
)
from logvigil.session import written

# fixed values
SEQ_LENGTH = 32
PAD = "<PAD>"
UNK = "<UNK>"
PAD_INDEX = 0
UNK_INDEX = 1
MIN_SCALE = 1e-4

MOST_PAIRS = 10_000  # transitions that are broadcast

CATEGORICAL = {"resource": "resource_accessed", "auth": "auth_method", "os": "os"}
NUMERIC = ("duration", "hour_sin", "hour_cos", "geo_dist")
ERROR_COLUMNS = tuple(f"rec_err_{n}" for n in (*NUMERIC, *CATEGORICAL))


def vocab_fit(events: DataFrame, column: str) -> DataFrame:
    """value -> index from 2 on, by first appearance, then value. Empty values get none."""
    values = (
        events.where(F.col(column).isNotNull() & (F.col(column) != ""))
        .groupBy(F.col(column).alias("value"))
        .agg(F.min("ts_us").alias("first_us"))
        .withColumn("one", F.lit(1))
    )
    # a vocabulary is small beside the log, and is read three times here
    ranked = running_totals(written(values), "first_us", ("one",), ties=("value",))
    return ranked.select("value", (F.col("cum_one") + (UNK_INDEX)).cast("long").alias("idx"))


def vocab_encode(events: DataFrame, column: str, vocab: DataFrame, out: str) -> DataFrame:
    """Index of the value; unseen values get the index of unknown. Small vocabularies broadcast by size."""
    lookup = vocab.select(F.col("value").alias(column), F.col("idx").alias(out))
    return events.join(lookup, column, "left").withColumn(out, F.coalesce(F.col(out), F.lit(UNK_INDEX).cast("long")))


def centroid_fit(train: DataFrame) -> DataFrame:
    """Mean place per entity over all training rows."""
    return train.groupBy("entity_id").agg(F.avg("lat").alias("c_lat"), F.avg("lon").alias("c_lon"))


def centroid_lookup(events: DataFrame, centroids: DataFrame, everybody: Row, hot: DataFrame | None = None) -> DataFrame:
    """Add the entity's centroid, else the global one, and the distance to it."""
    out = entity_lookup(events, centroids, hot).withColumns(
        {
            "c_lat": F.coalesce("c_lat", F.lit(float(everybody["lat"]))),
            "c_lon": F.coalesce("c_lon", F.lit(float(everybody["lon"]))),
        }
    )
    return out.withColumn("geo_distance", haversine_km(F.col("c_lat"), F.col("c_lon"), F.col("lat"), F.col("lon")))


def global_centroid(train: DataFrame) -> Row:
    return train.agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon")).first()


def scaling_fit(train: DataFrame) -> DataFrame:
    """One row: mean and sample deviation of duration and distance on normal rows, on all rows
    when none is normal; a deviation of next to nothing counts as 1. Needs ``geo_distance``."""
    normal = F.col("label") == NORMAL
    stats = train.groupBy(normal.alias("normal")).agg(
        F.avg("session_duration").alias("mean_dur"),
        F.stddev_samp("session_duration").alias("std_dur"),
        F.avg("geo_distance").alias("mean_dist"),
        F.stddev_samp("geo_distance").alias("std_dist"),
    )
    best = stats.orderBy(F.col("normal").desc()).limit(1)

    def scale(name: str) -> Column:
        return F.when(F.col(name) > MIN_SCALE, F.col(name)).otherwise(F.lit(1.0)).alias(name)

    return best.select("mean_dur", scale("std_dur"), "mean_dist", scale("std_dist"))


def scale_features(events: DataFrame, scaling: Row) -> DataFrame:
    """Add the four scaled numeric features. Needs ``geo_distance``."""
    return events.withColumns(
        {
            "x_duration": (F.col("session_duration") - scaling["mean_dur"]) / scaling["std_dur"],
            "x_hour_sin": clock.hour_sin(F.col("ts_us")),
            "x_hour_cos": clock.hour_cos(F.col("ts_us")),
            "x_geo_dist": (F.col("geo_distance") - scaling["mean_dist"]) / scaling["std_dist"],
        }
    )


def sequence_windows(events: DataFrame, length: int = SEQ_LENGTH, hot_rows: int | None = None) -> DataFrame:
    """Per event: ids of the last ``length`` events up to it, with start, end and count."""
    rows = events.select("event_id", "entity_id", "ts_us")
    rows = with_context(with_width(rows, hot_rows), length - 1)
    frame = row_window(-(length - 1), 0)
    rows = rows.withColumn("log_ids", F.collect_list("event_id").over(frame)).withColumn(
        "start_us", F.min("ts_us").over(frame)
    )
    return drop_context(rows).select(
        "event_id", "entity_id", "start_us", F.col("ts_us").alias("end_us"),
        F.size("log_ids").alias("event_count"), "log_ids",
    )


def left_pad(values: Column, length: int = SEQ_LENGTH, pad: Column | None = None) -> Column:
    """Fill an array from the left up to ``length`` with ``pad`` (0 by default)."""
    pad = F.lit(PAD_INDEX).cast("long") if pad is None else pad
    return F.concat(F.array_repeat(pad, F.lit(length) - F.size(values)), values)


def with_last_values(events: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Add ``prev_<feature>`` for the categorical features; the first event of an entity follows PAD.

    Run it on the whole timeline before splitting: training rows come first in it, so their
    predecessors are training rows as well.
    """
    known = {n: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(UNK)) for n, c in CATEGORICAL.items()}
    rows = events.withColumns({f"cur_{n}": c for n, c in known.items()})
    rows = with_previous(rows, *[f"cur_{n}" for n in CATEGORICAL], hot_rows=hot_rows)
    return rows.withColumns(
        {f"prev_{n}": F.coalesce(F.col(f"prev.cur_{n}"), F.lit(PAD)) for n in CATEGORICAL}
    ).drop("prev")


def transition_counts(train: DataFrame) -> DataFrame:
    """(feature, prev, cur) -> c over training rows from :func:`with_last_values`."""
    pairs = F.array(
        *[F.struct(F.lit(n).alias("feature"), F.col(f"prev_{n}").alias("prev"), F.col(f"cur_{n}").alias("cur")) for n in CATEGORICAL]
    )
    return (
        train.select(F.explode(pairs).alias("p")).select("p.*").groupBy("feature", "prev", "cur").agg(F.count("*").alias("c"))
    )


def vocabulary_sizes(transitions: DataFrame) -> dict[str, int]:
    """Known values per feature plus PAD and UNK."""
    known = transitions.where(F.col("cur") != UNK).select("feature", "cur").distinct()
    rows = known.groupBy("feature").agg(F.count("*").alias("n")).collect()  # one row per feature
    sizes = {r["feature"]: r["n"] for r in rows}
    return {n: sizes.get(n, 0) + 2 for n in CATEGORICAL}


def _sized(sizes: dict[str, int]) -> Column:
    """Smoothed size of the vocabulary of the row's ``feature``."""
    out = F.lit(None).cast("double")
    for name, size in sizes.items():
        out = F.when(F.col("feature") == name, F.lit(float(size))).otherwise(out)
    return out


def transition_costs(transitions: DataFrame, sizes: dict[str, int]) -> tuple[DataFrame, DataFrame]:
    """-ln P(cur | prev) with add-one smoothing: (feature, prev, cur, c, cost) of the pairs seen, and (feature, prev, n, cost) of any other
    value after ``prev``."""
    starts = transitions.groupBy("feature", "prev").agg(F.sum("c").alias("n"))
    seen = transitions.join(starts, ["feature", "prev"])
    share = (F.col("c") + 1.0) / (F.col("n") + _sized(sizes))
    unseen = starts.select("feature", "prev", "n", (-F.log(1.0 / (F.col("n") + _sized(sizes)))).alias("cost"))
    return seen.select("feature", "prev", "cur", "c", (-F.log(share)).alias("cost")), unseen


def _frequent(costs: DataFrame, count: str, most: int) -> DataFrame:
    """The ``most`` rows with the highest count: a table of known size."""
    order = [c for c in ("feature", "prev", "cur") if c in costs.columns]
    return costs.orderBy(F.col(count).desc(), *order).limit(most)


def add_costs(rows: DataFrame, transitions: DataFrame, sizes: dict[str, int], most: int = MOST_PAIRS) -> DataFrame:
    """Add ``rec_err_<feature>`` for the categorical features, from prev_<feature> and cur_<feature>.

    The ``most`` most frequent pairs, and values to follow on, are broadcast: rows are looked up where they are. If there are more, only the
    pairs that these do not hold are shuffled, for all features at once and without the rows they come from.
    """
    seen, unseen = (written(t) for t in transition_costs(transitions, sizes))
    fits = seen.count() <= most
    pairs = seen if fits else written(_frequent(seen, "c", most))
    starts = unseen if fits else written(_frequent(unseen, "n", most))
    for n in CATEGORICAL:
        pair = pairs.where(F.col("feature") == n).select(F.col("prev").alias(f"prev_{n}"), F.col("cur").alias(f"cur_{n}"), F.col("cost").alias(f"rec_err_{n}"))
        rows = rows.join(F.broadcast(pair), [f"prev_{n}", f"cur_{n}"], "left")  # at most ``most`` rows
        if fits:
            start = starts.where(F.col("feature") == n).select(F.col("prev").alias(f"prev_{n}"), F.col("cost").alias("other"))
            rows = rows.join(F.broadcast(start), f"prev_{n}", "left")  # no more than there are pairs
            unknown = F.lit(math.log(sizes[n]))
            rows = rows.withColumn(f"rec_err_{n}", F.coalesce(f"rec_err_{n}", "other", unknown)).drop("other")
    if fits:
        return rows
    rows = written(rows)
    asked = [
        F.when(F.col(f"rec_err_{n}").isNull(), F.struct(F.lit(n).alias("feature"), F.col(f"prev_{n}").alias("prev"), F.col(f"cur_{n}").alias("cur")))
        for n in CATEGORICAL
    ]
    missing = rows.select("event_id", F.explode(F.filter(F.array(*asked), lambda p: p.isNotNull())).alias("p")).select("event_id", "p.*")
    rare = seen.select("feature", "prev", "cur", F.col("cost").alias("own"))
    found = missing.join(rare, ["feature", "prev", "cur"], "left")
    often = starts.select("feature", "prev", F.col("cost").alias("often"))
    found = found.join(F.broadcast(often), ["feature", "prev"], "left")  # at most ``most`` rows
    known = F.coalesce("own", "often")
    # what is still open follows on a rare value, so this exchange has no hot key
    key = [F.when(known.isNull(), F.col(c)).otherwise(F.concat(F.lit("="), F.col("event_id").cast("string"))).alias(c) for c in ("feature", "prev")]
    found = found.select("event_id", F.col("feature").alias("of"), known.alias("known"), *key)
    found = found.join(unseen.select("feature", "prev", F.col("cost").alias("seldom")), ["feature", "prev"], "left")
    unknown = F.lit(None).cast("double")
    for n, size in sizes.items():
        unknown = F.when(F.col("of") == n, F.lit(math.log(size))).otherwise(unknown)
    found = found.select("event_id", "of", F.coalesce("known", "seldom", unknown).alias("cost"))
    wide = found.groupBy("event_id").agg(*[F.max(F.when(F.col("of") == n, F.col("cost"))).alias(f"far_{n}") for n in CATEGORICAL])
    rows = rows.join(wide, "event_id", "left")
    return rows.withColumns({f"rec_err_{n}": F.coalesce(f"rec_err_{n}", f"far_{n}") for n in CATEGORICAL}).drop(*[f"far_{n}" for n in CATEGORICAL])


def sequence_surprise(
    events: DataFrame, transitions: DataFrame, sizes: dict[str, int], length: int = SEQ_LENGTH,
    hot_rows: int | None = None, most_pairs: int = MOST_PAIRS,
) -> DataFrame:
    """Add the seven error columns and their sum ``seq_error``.

    ``events`` carries the scaled features and the columns of :func:`with_last_values`, and an event_id of its own in each row. The mean
    of an empty past counts as 0, the mean of the scaled features.
    """
    rows = with_context(with_width(events, hot_rows), length - 1)
    past = row_window(-(length - 1), -1)
    rows = rows.withColumns(
        {
            f"rec_err_{n}": F.pow(F.col(f"x_{n}") - F.coalesce(F.avg(f"x_{n}").over(past), F.lit(0.0)), 2.0)
            for n in NUMERIC
        }
    )
    rows = drop_context(rows)
    rows = rows if is_sliced(events) else rows.drop("width")
    rows = add_costs(rows, transitions, sizes, most_pairs)
    total = sum((F.col(c) for c in ERROR_COLUMNS[1:]), F.col(ERROR_COLUMNS[0]))
    drop = [f"{side}_{n}" for side in ("cur", "prev") for n in CATEGORICAL]
    return rows.withColumn("seq_error", total).drop(*drop)


def join_errors(events: DataFrame, errors: DataFrame) -> DataFrame:
    """Left join of the error columns; events without any get zeros."""
    out = events.join(errors.select("event_id", *ERROR_COLUMNS), "event_id", "left")
    return out.fillna(0.0, list(ERROR_COLUMNS))
