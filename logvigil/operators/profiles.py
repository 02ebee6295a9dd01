"""Normal behaviour per entity and for the population, learned from normal training rows.

Everything with a natural bound (five resources, 1,440 minutes of the day) is an array in the
profile row. Sets that grow with the data (devices, operating systems) stay long tables and are
looked up by a join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from logvigil.functions import clock, scores
from logvigil.functions.geo import haversine_km
from logvigil.functions.rules import AUTH_METHODS, NORMAL, auth_flag
from logvigil.operators.timeline import entity_lookup

# fixed values
MIN_PROFILE_EVENTS = 5
ENTITY_RESOURCES = 5
GLOBAL_RESOURCES = 10
SINGLE_EVENT_STD = 10.0
GLOBAL_RADIUS_KM = 1000.0
KDE_BANDWIDTH = 0.2
KDE_MIN_VARIANCE = 1e-4
BASE_FEATURES = (
    "hour_of_day", "day_of_week", "is_weekend", "session_duration", "norm_session_duration",
    "geo_distance_from_centroid_km", "resource_novelty", "device_fingerprint_hash_novelty",
    "auth_password", "auth_token", "auth_certificate", "auth_biometric", "cold_start",
    "is_cold_start", "profile_decay_factor",
)

EVERYBODY = ""  # owner key of the population's rows in the lookup tables


def normal_training(split_events: DataFrame) -> DataFrame:
    return split_events.where((F.col("split") == "train") & (F.col("label") == NORMAL))


def top_resources(events: DataFrame, k: int) -> DataFrame:
    """The k most used resources per entity: count descending, then name. Counted before ranked."""
    used = events.groupBy("entity_id", "resource_accessed").agg(F.count("*").alias("n"))
    order = Window.partitionBy("entity_id").orderBy(F.col("n").desc(), F.col("resource_accessed"))
    return used.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def distinct_values(events: DataFrame, column: str, scope: str = "entity") -> DataFrame:
    """Distinct non-empty values of a column, per entity or for everybody, one row each."""
    known = events.where(F.col(column).isNotNull() & (F.col(column) != ""))
    keys = ["entity_id", column] if scope == "entity" else [column]
    return known.select(*keys).distinct()


def minute_histogram(events: DataFrame, *keys: str) -> DataFrame:
    """Column ``minutes``: (minute of day, count) pairs, at most 1,440 of them."""
    counted = events.groupBy(*keys, clock.minute_of_day(F.col("ts_us")).alias("minute")).agg(F.count("*").alias("n"))
    return counted.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("minute", "n"))).alias("minutes"))


def _moments() -> list[Column]:
    hour = clock.hour_of_day(F.col("ts_us"))
    return [
        F.count("*").alias("num_events"),
        F.avg("lat").alias("home_lat"),
        F.avg("lon").alias("home_lon"),
        F.avg("session_duration").alias("duration_mean"),
        F.stddev_pop("session_duration").alias("duration_std"),
        F.stddev_samp(hour).alias("hour_std"),
        F.var_pop(hour).alias("hour_var"),
        F.max("ts_us").alias("last_ts_us"),
    ]


def entity_profile(normal: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """One row per entity. ``hot`` comes from :func:`timeline.find_hot`."""
    base = normal.groupBy("entity_id").agg(*_moments())
    homes = base.select("entity_id", "home_lat", "home_lon")
    places = entity_lookup(normal.select("entity_id", "event_id", "lat", "lon"), homes, hot, "inner")
    km = haversine_km(F.col("home_lat"), F.col("home_lon"), F.col("lat"), F.col("lon"))
    radius = places.groupBy("entity_id").agg(F.avg(km).alias("avg_radius"))
    resources = (
        top_resources(normal, ENTITY_RESOURCES)
        .groupBy("entity_id")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "resource_accessed"))).alias("ranked"))
        .select("entity_id", F.col("ranked.resource_accessed").alias("typical_resources"))
    )
    profile = (
        base.join(radius, "entity_id").join(resources, "entity_id").join(minute_histogram(normal, "entity_id"), "entity_id")
    )
    single = F.when(F.col("num_events") > 1, F.col("duration_std")).otherwise(F.lit(SINGLE_EVENT_STD))
    return profile.withColumn("duration_std", single)


def global_profile(normal: DataFrame) -> DataFrame:
    """One row for the population, with the columns of :func:`entity_profile`."""
    base = normal.agg(*_moments()).where(F.col("num_events") > 0)
    top = (
        normal.groupBy("resource_accessed")
        .agg(F.count("*").alias("n"))
        .orderBy(F.col("n").desc(), "resource_accessed")
        .limit(GLOBAL_RESOURCES)
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "resource_accessed"))).alias("ranked"))
        .select(F.col("ranked.resource_accessed").alias("typical_resources"))
    )
    hours = minute_histogram(normal.withColumn("one", F.lit(1)), "one").drop("one")
    # three one-row tables folded into one row
    parts = base.unionByName(top, allowMissingColumns=True).unionByName(hours, allowMissingColumns=True)
    folded = parts.agg(*[F.first(c, ignorenulls=True).alias(c) for c in parts.columns])
    return folded.withColumn("avg_radius", F.lit(GLOBAL_RADIUS_KM))


def global_constants(normal: DataFrame) -> Row:
    """The population row on the driver: a few numbers, 10 names and at most 1,440 pairs."""
    row = global_profile(normal).first()
    if not row["num_events"]:
        raise ValueError("no normal training rows to learn from")
    return row


def _texts(values) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def profile_lookup(events: DataFrame, profiles: DataFrame, everybody: Row, hot: DataFrame | None = None) -> DataFrame:
    """Add the profile that applies: the entity's own from five events on, else the population's.

    The fallback has no last event, so its decay is 1. ``owner`` keys the device and density tables.
    """
    own = profiles.where(F.col("num_events") >= MIN_PROFILE_EVENTS).select(
        "entity_id",
        *[
            F.col(c).alias(f"p_{c}")
            for c in ("home_lat", "home_lon", "duration_mean", "duration_std", "typical_resources", "last_ts_us")
        ],
    )
    cold = F.col("p_home_lat").isNull()
    out = entity_lookup(events, own, hot).withColumns(
        {
            "cold_start": cold.cast("int"),
            "owner": F.when(cold, F.lit(EVERYBODY)).otherwise(F.col("entity_id")),
            "p_typical_resources": F.coalesce("p_typical_resources", _texts(everybody["typical_resources"])),
        }
    )
    fallback = {c: everybody[c] for c in ("home_lat", "home_lon", "duration_mean", "duration_std")}
    return out.withColumns({f"p_{c}": F.coalesce(f"p_{c}", F.lit(float(v))) for c, v in fallback.items()})


def owned(normal: DataFrame, column: str) -> DataFrame:
    """Long lookup table (owner, column): each entity's values and, under ``EVERYBODY``, all values."""
    mine = distinct_values(normal, column).withColumnRenamed("entity_id", "owner")
    return mine.unionByName(distinct_values(normal, column, "all").withColumn("owner", F.lit(EVERYBODY)))


def known_devices(log: DataFrame, profiles: DataFrame, devices: DataFrame) -> DataFrame:
    """(entity_id, mac) of the devices that are known for an entity: its own, or without a profile of its own everybody's among those it uses.

    By entity and not by owner, so that events which lie by entity are looked up where they are.
    """
    warm = profiles.where((F.col("num_events") >= MIN_PROFILE_EVENTS) & F.col("home_lat").isNotNull()).select("entity_id")
    own = devices.where(F.col("owner") != EVERYBODY).select(F.col("owner").alias("entity_id"), "mac").join(warm, "entity_id", "left_semi")
    used = log.join(warm, "entity_id", "left_anti").select("entity_id", "mac").distinct()
    return own.unionByName(used.join(devices.where(F.col("owner") == EVERYBODY).select("mac"), "mac", "left_semi"))


def base_features(
    events: DataFrame, profiles: DataFrame, devices: DataFrame, everybody: Row, hot: DataFrame | None = None, log: DataFrame | None = None
) -> DataFrame:
    """The 15 base features per event. ``devices`` is ``owned(normal, "mac")``; ``log`` holds (at least) the devices of the same
    events, before any feature was computed."""
    looked_up = profile_lookup(events, profiles, everybody, hot)
    known = known_devices(events if log is None else log, profiles, devices).withColumn("device_known", F.lit(True))
    looked_up = looked_up.join(known, ["entity_id", "mac"], "left")
    ts = F.col("ts_us")
    return looked_up.withColumns(
        {
            "hour_of_day": clock.hour_of_day(ts),
            "day_of_week": clock.day_of_week(ts).cast("int"),
            "is_weekend": clock.is_weekend(ts),
            "norm_session_duration": scores.norm_session_duration(
                F.col("session_duration"), F.col("p_duration_mean"), F.col("p_duration_std")
            ),
            "geo_distance_from_centroid_km": haversine_km(
                F.col("p_home_lat"), F.col("p_home_lon"), F.col("lat"), F.col("lon")
            ),
            "resource_novelty": (~F.coalesce(
                F.array_contains("p_typical_resources", F.col("resource_accessed")), F.lit(False)
            )).cast("int"),
            "device_fingerprint_hash_novelty": F.col("device_known").isNull().cast("int"),
            **{f"auth_{m}": auth_flag(F.col("auth_method"), m) for m in AUTH_METHODS},
            "is_cold_start": F.col("cold_start").cast("double"),
            "profile_decay_factor": scores.profile_decay(ts, F.col("p_last_ts_us")),
            "audit_trail": F.when(F.col("cold_start") == 1, F.lit("cold_start=True")).otherwise(F.lit("cold_start=False")),
        }
    ).drop("device_known", *[c for c in looked_up.columns if c.startswith("p_")])


def hour_density(pairs: DataFrame, profiles: DataFrame, everybody: Row) -> DataFrame:
    """Gaussian kernel density of the hour for each (owner, minute) pair asked for.

    The hour has only 1,440 values, so a density is a sum over the owner's minute histogram and is
    evaluated once per pair, not once per event. No row where the hours hardly vary.
    """
    columns = ("minutes", "num_events", "hour_std", "hour_var")
    own = profiles.where(
        (F.col("num_events") >= MIN_PROFILE_EVENTS) & (F.col("hour_var") >= KDE_MIN_VARIANCE)
    ).select(F.col("entity_id").alias("owner"), *columns)
    if (everybody["hour_var"] or 0.0) > 0.0:
        row = [(EVERYBODY, *[everybody[c] for c in columns])]
        own = own.unionByName(profiles.sparkSession.createDataFrame(row, own.schema))
    sigma = F.col("hour_std") * KDE_BANDWIDTH
    # per owner, so that the kernel itself is one product and one exp per pair of minutes
    own = own.select(
        "owner", "minutes", (-0.5 / F.pow(sigma * 60.0, 2.0)).alias("steep"),
        (F.col("num_events") * sigma * math.sqrt(2.0 * math.pi)).alias("area"),
    )

    def kernel(total: Column, pair: Column) -> Column:
        gap = F.col("minute") - pair["minute"]
        return total + pair["n"] * F.exp(gap * gap * F.col("steep"))

    density = F.aggregate("minutes", F.lit(0.0), kernel) / F.col("area")
    return (
        pairs.select("owner", "minute").distinct().join(own, "owner").select("owner", "minute", density.alias("density"))
    )


def owner_minutes(events: DataFrame, profiles: DataFrame) -> DataFrame:
    """The (owner, minute) pairs that occur in a log, at most 1,440 per entity: found from two columns, before any join of events."""
    pairs = events.select("entity_id", clock.minute_of_day(F.col("ts_us")).alias("minute")).distinct()
    own = profiles.where(F.col("num_events") >= MIN_PROFILE_EVENTS).select("entity_id", F.lit(True).alias("has_profile"))
    owner = F.when(F.col("has_profile"), F.col("entity_id")).otherwise(F.lit(EVERYBODY))
    return pairs.join(own, "entity_id", "left").select(owner.alias("owner"), "minute").distinct()


def stat_profile_score(features: DataFrame, profiles: DataFrame, everybody: Row, log: DataFrame | None = None) -> DataFrame:
    """Add ``score`` in [0, 1] to the output of :func:`base_features`.

    ``log`` holds (at least) the same events before any feature was computed; the minutes to evaluate are then listed from it
    instead of from the features, whose plan would otherwise run a second time for that.
    """
    rows = features.withColumn("minute", clock.minute_of_day(F.col("ts_us")))
    pairs = rows if log is None else owner_minutes(log, profiles)
    own, common = (hour_density(pairs.where(mine), profiles, everybody) for mine in (F.col("owner") != EVERYBODY, F.col("owner") == EVERYBODY))
    # by entity and not by owner: rows without a profile of their own would all meet under one owner's 1,440 minutes
    own = own.select(F.col("owner").alias("entity_id"), "minute", F.col("density").alias("own_density"))
    common = F.broadcast(common.select("minute", F.col("density").alias("common_density")))  # at most 1,440 rows
    rows = rows.join(own, ["entity_id", "minute"], "left").join(common, "minute", "left")
    density = F.when(F.col("owner") == EVERYBODY, F.col("common_density")).otherwise(F.col("own_density"))
    rows = rows.withColumn("density", density).drop("own_density", "common_density")
    score = scores.stat_score(
        scores.score_geo(F.col("geo_distance_from_centroid_km")),
        scores.score_duration(F.col("norm_session_duration")),
        scores.score_time(F.col("density")),
        F.col("resource_novelty"),
        F.col("device_fingerprint_hash_novelty"),
    )
    return rows.withColumn("score", score)


def typical_pairs(profiles: DataFrame) -> DataFrame:
    """Long table (entity_id, resource_accessed) of the typical resources."""
    return profiles.select("entity_id", F.explode("typical_resources").alias("resource_accessed"))


MOMENTS = ("lat", "lon", "duration", "hour")
MOMENT = "struct<n:bigint,mean:double,m2:double>"


def profile_moments(events: DataFrame) -> DataFrame:
    """Per entity: number of events, latest one, and count, mean and sum of squared deviations of place, duration and hour.

    Squares of values are never summed, so that nothing cancels however many events there are.
    """
    values = {
        "lat": F.col("lat"), "lon": F.col("lon"), "duration": F.col("session_duration").cast("double"),
        "hour": clock.hour_of_day(F.col("ts_us")),
    }

    def moment(value: Column) -> Column:
        n = F.count(value)
        return F.struct(n.alias("n"), F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"), F.coalesce(F.var_pop(value) * n, F.lit(0.0)).alias("m2"))

    return events.groupBy("entity_id").agg(
        F.count("*").alias("num_events"), F.max("ts_us").alias("last_ts_us"), *[moment(v).alias(name) for name, v in values.items()]
    )


def merged_moment(parts: Column) -> Column:
    """One moment of an array of them: means move by their difference, and its square adds to the deviations."""

    def merge(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        gap, share = b["mean"] - a["mean"], F.coalesce(F.try_divide(b["n"].cast("double"), n.cast("double")), F.lit(0.0))
        return F.struct(n.alias("n"), (a["mean"] + gap * share).alias("mean"), (a["m2"] + b["m2"] + gap * gap * a["n"] * share).alias("m2"))

    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.aggregate(F.array_sort(parts), none, merge)


def merge_moments(old: DataFrame, new: DataFrame) -> DataFrame:
    """The moments of both logs together: two rows an entity at most."""
    folded = [merged_moment(F.collect_list(m)).alias(m) for m in MOMENTS]
    return old.unionByName(new).groupBy("entity_id").agg(F.sum("num_events").alias("num_events"), F.max("last_ts_us").alias("last_ts_us"), *folded)


def merge_sums(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Fold new additive counts into old ones."""
    values = [c for c in old.columns if c not in keys]
    return old.unionByName(new).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in values])


COUNTED = {"places": ["entity_id", "lat", "lon"], "resources": ["entity_id", "resource_accessed"], "minutes": ["entity_id", "minute"]}


def profile_parts(events: DataFrame) -> dict[str, DataFrame]:
    """All of a profile that can be merged: moments, and counts of places, resources, minutes and devices.

    The mean radius depends on the home, which moves with new events; over counted places it can be taken again without the old
    events. There are at most as many as distinct places.
    """
    seen = events.withColumn("minute", clock.minute_of_day(F.col("ts_us")))
    counted = {name: seen.groupBy(*keys).agg(F.count("*").alias("n")) for name, keys in COUNTED.items()}
    return {"moments": profile_moments(events), **counted, "devices": distinct_values(events, "mac")}


def merge_parts(old: dict[str, DataFrame], new: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The parts of both logs together."""
    merged = {name: merge_sums(old[name], new[name], keys) for name, keys in COUNTED.items()}
    return merged | {
        "moments": merge_moments(old["moments"], new["moments"]), "devices": old["devices"].unionByName(new["devices"]).distinct()
    }


def profile_from_moments(moments: DataFrame) -> DataFrame:
    """The columns of :func:`entity_profile` that moments give."""
    duration, hour = F.col("duration"), F.col("hour")
    std = F.when(F.col("num_events") > 1, F.sqrt(duration["m2"] / duration["n"])).otherwise(F.lit(SINGLE_EVENT_STD))
    return moments.select(
        "entity_id", "num_events", F.col("lat.mean").alias("home_lat"), F.col("lon.mean").alias("home_lon"),
        duration["mean"].alias("duration_mean"), std.alias("duration_std"),
        F.when(hour["n"] > 1, F.sqrt(hour["m2"] / (hour["n"] - 1))).alias("hour_std"),
        F.try_divide(hour["m2"], hour["n"].cast("double")).alias("hour_var"), "last_ts_us",
    )


def profile_from_parts(parts: dict[str, DataFrame], resources: int = ENTITY_RESOURCES) -> DataFrame:
    """The profile of :func:`entity_profile`, column by column."""
    base = profile_from_moments(parts["moments"])
    km = haversine_km(F.col("home_lat"), F.col("home_lon"), F.col("lat"), F.col("lon"))
    placed = parts["places"].join(base.select("entity_id", "home_lat", "home_lon"), "entity_id").withColumn("km", km)
    radius = placed.where("km IS NOT NULL").groupBy("entity_id").agg((F.sum(F.col("km") * F.col("n")) / F.sum("n")).alias("avg_radius"))
    order = Window.partitionBy("entity_id").orderBy(F.col("n").desc(), F.col("resource_accessed"))
    top = parts["resources"].withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= resources)
    ranked = top.groupBy("entity_id").agg(F.array_sort(F.collect_list(F.struct("rank", "resource_accessed"))).alias("r"))
    names = ranked.select("entity_id", F.col("r.resource_accessed").alias("typical_resources"))
    minutes = parts["minutes"].groupBy("entity_id").agg(F.array_sort(F.collect_list(F.struct("minute", "n"))).alias("minutes"))
    return base.join(radius, "entity_id").join(names, "entity_id").join(minutes, "entity_id")
