import math
import random
import statistics

import pytest
from clock_rows import DAY, SECOND, T0
from pyspark.sql import functions as F

from logvigil.functions import clock, rules, scores
from logvigil.operators import chain, profiles, sequence


def learned(events):
    normal = events.where("label = 'normal'")
    profile = profiles.entity_profile(normal)
    return profile, profiles.owned(normal, "mac"), profiles.global_constants(normal)


def features(events, train=None):
    profile, devices, everybody = learned(events if train is None else train)
    return profiles.base_features(events, profile, devices, everybody), profile, everybody


def test_cold_start_needs_five_events(log):
    rows = [{"entity_id": "FOUR", "sec": i} for i in range(4)] + [{"entity_id": "FIVE", "sec": i} for i in range(5)]
    rows.append({"entity_id": "NEVER", "sec": 9})
    events = log(rows)
    got, _, _ = features(events, events.where("entity_id <> 'NEVER'"))
    flags = {r["entity_id"]: (r["cold_start"], r["audit_trail"]) for r in got.collect()}
    assert flags == {"FOUR": (1, "cold_start=True"), "FIVE": (0, "cold_start=False"), "NEVER": (1, "cold_start=True")}


def test_profile_numbers(log):
    rows = [{"entity_id": "A", "sec": 60 * i, "session_duration": d, "resource_accessed": r} for i, (d, r) in enumerate(
        [(10, "x"), (20, "x"), (60, "y"), (10, "z"), (0, "w"), (5, "v"), (5, "u")])]
    rows.append({"entity_id": "B", "sec": 5, "mac": ""})
    by_id = {r["entity_id"]: r for r in profiles.entity_profile(log(rows)).collect()}
    a, b = by_id["A"], by_id["B"]
    assert a["duration_std"] == pytest.approx(statistics.pstdev([10, 20, 60, 10, 0, 5, 5]))
    assert a["typical_resources"] == ["x", "u", "v", "w", "y"]  # count, then name; z is sixth
    assert b["duration_std"] == 10.0 and b["num_events"] == 1
    assert sum(m["n"] for m in a["minutes"]) == 7
    owners = {(r["owner"], r["mac"]) for r in profiles.owned(log(rows), "mac").collect()}
    assert owners == {("A", "m1"), ("", "m1")}


def test_novelty_own_or_global(log):
    train = [{"entity_id": "A", "sec": i, "resource_accessed": "x", "mac": "ma"} for i in range(6)]
    train += [{"entity_id": "C", "sec": i, "resource_accessed": "y", "mac": "mc"} for i in range(2)]
    probe = [
        {"event_id": 100, "entity_id": "A", "sec": 50, "resource_accessed": "y", "mac": "mc"},
        {"event_id": 101, "entity_id": "C", "sec": 50, "resource_accessed": "x", "mac": "ma"},
        {"event_id": 102, "entity_id": "C", "sec": 50, "resource_accessed": "q", "mac": ""},
    ]
    got, _, _ = features(log(probe), log(train))
    flags = {r["event_id"]: (r["resource_novelty"], r["device_fingerprint_hash_novelty"]) for r in got.collect()}
    assert flags == {100: (1, 1), 101: (0, 0), 102: (1, 1)}


def test_decay_halves_in_a_week(log):
    train = [{"entity_id": "A", "sec": i} for i in range(5)]
    probe = [{"entity_id": "A", "ts_us": T0 + 4 * SECOND}, {"entity_id": "A", "ts_us": T0 + 4 * SECOND + 7 * DAY},
             {"entity_id": "Z", "ts_us": T0 + 70 * DAY}]
    got, _, _ = features(log(probe), log(train))
    assert [round(r["profile_decay_factor"], 9) for r in got.orderBy("event_id").collect()] == [1.0, 0.5, 1.0]


def test_constant_hours_score_half(log):
    train = [{"entity_id": "A", "ts_us": T0 + i * DAY} for i in range(6)] + [{"entity_id": "B", "sec": 7200 * i} for i in range(3)]
    events = log(train)
    rows, profile, everybody = features(events)
    scored = profiles.stat_profile_score(rows, profile, everybody)
    densities = {r["entity_id"]: r["density"] for r in scored.collect()}
    assert densities["A"] is None and densities["B"] > 0
    assert [r[0] for r in scored.where("entity_id = 'A'").select(scores.score_time(F.col("density"))).collect()] == [0.5] * 6


def test_density_equals_kernel_sum(log):
    rng = random.Random(2)
    minutes = [rng.choice([rng.randrange(1440), 540 + rng.randrange(60)]) for _ in range(80)]
    events = log([{"entity_id": "A", "ts_us": T0 + i * DAY + m * 60 * SECOND} for i, m in enumerate(minutes)])
    profile, _, everybody = learned(events)
    pairs = events.select(F.lit("A").alias("owner"), clock.minute_of_day(F.col("ts_us")).alias("minute"))
    got = {r["minute"]: r["density"] for r in profiles.hour_density(pairs, profile, everybody).collect()}
    hours = [m / 60 for m in minutes]
    sigma = 0.2 * statistics.stdev(hours)
    for m in set(minutes):
        want = sum(math.exp(-((m / 60 - h) ** 2) / (2 * sigma**2)) for h in hours) / (len(hours) * sigma * math.sqrt(2 * math.pi))
        assert got[m] == pytest.approx(want, rel=1e-9)


def test_profiles_come_from_training_rows_only(spark, log):
    rows = [{"entity_id": "A", "sec": i, "resource_accessed": "old"} for i in range(70)]
    rows += [{"entity_id": "A", "sec": 1000 + i, "resource_accessed": "new"} for i in range(30)]
    learned_ = chain.learn(log(rows))
    assert learned_.everybody["typical_resources"] == ["old"]
    assert learned_.everybody["num_events"] == 70


def test_refresh_equals_refit(log):
    """Every column of the profile, also where an entity is only in one of the logs."""
    rng = random.Random(4)
    rows = [
        {"entity_id": f"E{rng.randint(0, 3)}", "sec": i * 700, "lat": rng.random(), "lon": rng.choice([1.0, 2.0]), "session_duration": rng.randint(0, 90),
         "resource_accessed": rng.choice("abcdefg")}
        for i in range(60)
    ] + [{"entity_id": "new", "sec": 99_999}]
    parts = [profiles.profile_parts(log(part)) for part in (rows[:25], rows[25:40], rows[40:])]
    merged = profiles.merge_parts(profiles.merge_parts(parts[0], parts[1]), parts[2])
    got = {r["entity_id"]: r.asDict(recursive=True) for r in profiles.profile_from_parts(merged).collect()}
    fresh = profiles.entity_profile(log(rows))
    assert set(profiles.profile_from_parts(merged).columns) == set(fresh.columns)
    want = {r["entity_id"]: r.asDict(recursive=True) for r in fresh.collect()}
    assert got.keys() == want.keys()
    for entity, row in want.items():
        for column, value in row.items():
            assert got[entity][column] == (pytest.approx(value) if isinstance(value, float) else value), (entity, column)


def test_moments_do_not_cancel(log):
    """Durations that differ by one, far from zero: squares of the values leave nothing of that in a double."""
    base = 3_000_000_000
    old, new = ([{"session_duration": base + d} for d in part] for part in ([0, 2, 1], [4, 3]))
    merged = profiles.merge_moments(profiles.profile_moments(log(old)), profiles.profile_moments(log(new)))
    row = profiles.profile_from_moments(merged).first()
    assert row["duration_mean"] == base + 2 and row["duration_std"] == pytest.approx(math.sqrt(2), rel=1e-6)


def test_refreshed_profile_scores_like_a_fresh_one(log):
    rng = random.Random(6)
    rows = [
        {"entity_id": rng.choice("ABC"), "sec": i * 900, "lat": rng.random(), "session_duration": rng.randint(1, 90), "resource_accessed": rng.choice("abcdef")}
        for i in range(60)
    ]
    whole = log(rows)
    merged = profiles.merge_parts(profiles.profile_parts(log(rows[:35])), profiles.profile_parts(log(rows[35:])))
    everybody, devices = profiles.global_constants(whole), profiles.owned(whole, "mac")

    def score(profile):
        features = profiles.base_features(whole, profile, devices, everybody)
        return {r["event_id"]: r["score"] for r in profiles.stat_profile_score(features, profile, everybody).collect()}

    assert score(profiles.profile_from_parts(merged)) == pytest.approx(score(profiles.entity_profile(whole)))


def test_vocabulary(log):
    rows = [{"sec": 5, "os": "b"}, {"sec": 1, "os": "c"}, {"sec": 1, "os": "a"}, {"sec": 0, "os": ""}]
    vocab = sequence.vocab_fit(log(rows), "os")
    assert {r["value"]: r["idx"] for r in vocab.collect()} == {"a": 2, "c": 3, "b": 4}
    got = sequence.vocab_encode(log([*rows, {"os": "new"}]), "os", vocab, "i").orderBy("event_id")
    assert [r["i"] for r in got.collect()] == [4, 3, 2, 1, 1]


def test_scaling_falls_back_to_all_rows(log):
    rows = [{"label": "brute_force", "session_duration": d} for d in (1, 3)]
    row = sequence.scaling_fit(log(rows).withColumn("geo_distance", F.lit(2.0))).first()
    assert (row["mean_dur"], round(row["std_dur"], 6), row["std_dist"]) == (2.0, round(math.sqrt(2), 6), 1.0)


@pytest.mark.parametrize(("hot_rows", "most"), [(None, 10_000), (3, 10_000), (None, 0), (3, 2)])
def test_surprise(log, hot_rows, most):
    rng = random.Random(8)
    rows = [{"entity_id": "A", "sec": i, "resource_accessed": rng.choice("xyz"), "session_duration": rng.randint(0, 9)} for i in range(20)]
    events = log(rows)
    x = events.withColumns({"x_duration": F.col("session_duration") * 1.0, "x_hour_sin": F.lit(0.0), "x_hour_cos": F.lit(0.0), "x_geo_dist": F.lit(0.0)})
    x = sequence.with_last_values(x, hot_rows)
    counts = sequence.transition_counts(x)
    got = sequence.sequence_surprise(x, counts, sequence.vocabulary_sizes(counts), 4, hot_rows, most).orderBy("event_id").collect()
    names = ["<PAD>", *[r["resource_accessed"] for r in rows]]
    steps = list(zip(names, names[1:], strict=False))
    size = len(set(names) - {"<PAD>"}) + 2
    for i, row in enumerate(got):
        past = [r["session_duration"] for r in rows[max(0, i - 3) : i]]
        gap = rows[i]["session_duration"] - (sum(past) / len(past) if past else 0.0)
        assert row["rec_err_duration"] == pytest.approx(gap**2)
        prev, cur = steps[i]
        share = (steps.count((prev, cur)) + 1) / (sum(s[0] == prev for s in steps) + size)
        assert row["rec_err_resource"] == pytest.approx(-math.log(share))
        assert row["seq_error"] == pytest.approx(sum(row[c] for c in sequence.ERROR_COLUMNS))


def test_values_never_seen_before_and_the_plan(log):
    train = sequence.transition_counts(sequence.with_last_values(log([{"sec": i, "resource_accessed": r} for i, r in enumerate("aababc")])))
    sizes = sequence.vocabulary_sizes(train)
    later = sequence.with_last_values(log([{"sec": i, "resource_accessed": r} for i, r in enumerate("acaxybz")]))
    few, all_ = (sequence.add_costs(later, train, sizes, most) for most in (1, 100))
    assert {r["event_id"]: r["rec_err_resource"] for r in few.collect()} == {r["event_id"]: r["rec_err_resource"] for r in all_.collect()}
    lookups = [line for line in all_._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line and "prev_" in line]
    assert not any("hashpartitioning" in line for line in lookups)


def test_labels_and_flags(log):
    rows = log([{"label": "normal", "auth_method": "password"}, {"label": "brute_force", "session_duration": 0}, {"label": "low_slow_exfil"}])
    got = rows.select(
        rules.binary_label(F.col("label")), rules.target_class(F.col("label")), rules.failed_auth(F.col("session_duration"), F.col("auth_method"))
    ).collect()
    assert [tuple(r) for r in got] == [(0, "unknown", 1), (1, "brute_force", 1), (1, "low_slow_exfil", 0)]
