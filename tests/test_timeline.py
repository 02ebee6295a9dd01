"""Windows per entity: against brute force, with a hot entity cut into slices or not."""

import random

import pytest
from clock_rows import SECOND, T0
from pyspark.sql import functions as F

from logvigil.operators import attribution, sequence, timeline, trailing

SLICING = [None, 7, 1]


def skewed_rows(seed, n=240):
    """A third of the rows belongs to one entity, many in one burst and in shared seconds."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        sec = rng.choice([rng.randint(0, 40), rng.randint(0, 20_000)]) if hot else rng.randint(0, 20_000)
        rows.append(
            {
                "event_id": i, "entity_id": "HOT" if hot else f"E{rng.randint(0, 9)}", "ts_us": T0 + sec * SECOND + rng.choice([0, 0, 250_000]),
                "source_ip": f"ip{rng.randint(0, 4)}", "resource_accessed": f"r{rng.randint(0, 5)}",
                "auth_method": rng.choice(["password", "token"]), "session_duration": rng.choice([0, 30]),
                "lat": float(rng.randint(-50, 50)), "lon": float(rng.randint(-100, 100)),
            }
        )
    return rows


def by_entity(rows):
    groups = {}
    for row in sorted(rows, key=lambda r: (r["ts_us"], r["event_id"])):
        groups.setdefault(row["entity_id"], []).append(row)
    return groups


def brute_trailing(rows, typical):
    out = {}
    for entity, events in by_entity(rows).items():
        for i, now in enumerate(events):
            sec = now["ts_us"] // SECOND
            past = events[: i + 1]
            five = [e for e in past if e["ts_us"] // SECOND >= sec - 300]
            hour = [e for e in past if e["ts_us"] // SECOND >= sec - 3600]
            out[now["event_id"]] = (
                sum(e["session_duration"] == 0 or e["auth_method"] == "password" for e in five),
                len({e["source_ip"] for e in hour}),
                len({e["resource_accessed"] for e in hour} - typical.get(entity, set())),
            )
    return out


@pytest.mark.parametrize("hot_rows", SLICING)
@pytest.mark.parametrize("seed", [1, 2])
def test_trailing_features_match_brute_force(spark, log, hot_rows, seed):
    rows = skewed_rows(seed)
    typical = {"HOT": {"r1", "r2"}, "E1": {"r0"}}
    pairs = spark.createDataFrame([(e, r) for e, rs in typical.items() for r in rs], "entity_id string, resource_accessed string")
    got = trailing.trailing_features(log(rows), pairs, hot_rows=hot_rows)
    got = {r["event_id"]: (r[1], r[2], r[3]) for r in got.select(
        "event_id", "failed_auth_count_5min", "distinct_ip_count_1h", "new_resource_count_1h").collect()}
    assert got == brute_trailing(rows, typical)


def test_later_peers_of_a_second_do_not_count(log):
    rows = [{"sec": s, "auth_method": "password"} for s in (0, 100, 100, 300, 301)]
    got = trailing.trailing_features(log(rows), addresses=False, travel=False).orderBy("event_id")
    assert [r["failed_auth_count_5min"] for r in got.collect()] == [1, 2, 3, 4, 4]


@pytest.mark.parametrize("hot_rows", SLICING)
def test_velocity(log, hot_rows):
    rows = [
        {"sec": 0, "lat": 0.0, "lon": 0.0},
        {"sec": 0.5, "lat": 18.0, "lon": 0.0},  # same second: distance, but no speed
        {"sec": 3600, "lat": 18.0, "lon": 0.0},
        {"sec": 7200, "lat": 0.0, "lon": 0.0},
    ]
    got = trailing.geo_velocity(log(rows), hot_rows=hot_rows).orderBy("event_id").collect()
    km = 6371.0 * 3.141592653589793 / 10
    assert [round(r["geo_distance_prev_km"], 3) for r in got] == [0.0, round(km, 3), 0.0, round(km, 3)]
    assert [round(r["geo_velocity_kmh"], 3) for r in got] == [0.0, 0.0, 0.0, round(km, 3)]


@pytest.mark.parametrize("hot_rows", SLICING)
def test_previous_event(log, hot_rows):
    rows = skewed_rows(3)
    got = timeline.with_previous(log(rows), "event_id", hot_rows=hot_rows).select("event_id", F.col("prev.event_id").alias("p"))
    want = {}
    for events in by_entity(rows).values():
        want.update({e["event_id"]: (events[i - 1]["event_id"] if i else None) for i, e in enumerate(events)})
    assert {r["event_id"]: r["p"] for r in got.collect()} == want


@pytest.mark.parametrize("hot_rows", SLICING)
@pytest.mark.parametrize("length", [1, 3, 32])
def test_sequence_windows(log, hot_rows, length):
    rows = skewed_rows(4, 150)
    got = sequence.sequence_windows(log(rows), length, hot_rows).collect()
    want = {}
    for events in by_entity(rows).values():
        for i, e in enumerate(events):
            part = events[max(0, i - length + 1) : i + 1]
            want[e["event_id"]] = ([p["event_id"] for p in part], part[0]["ts_us"], e["ts_us"])
    assert {r["event_id"]: (r["log_ids"], r["start_us"], r["end_us"]) for r in got} == want
    assert all(r["event_count"] == len(r["log_ids"]) for r in got)


@pytest.mark.parametrize("hot_rows", SLICING)
def test_history_snippet(log, hot_rows):
    rows = skewed_rows(5, 120)
    got = {r["event_id"]: [h["event_id"] for h in r["history"]] for r in attribution.history_snippet(log(rows), 5, hot_rows).collect()}
    for events in by_entity(rows).values():
        for i, e in enumerate(events):
            assert got[e["event_id"]] == [str(p["event_id"]) for p in events[max(0, i - 4) : i + 1]]


def test_left_pad(spark):
    df = spark.createDataFrame([([7],), (list(range(1, 33)),)], "v array<long>").select(sequence.left_pad(F.col("v")).alias("v"))
    short, full = [r["v"] for r in df.collect()]
    assert short == [0] * 31 + [7] and full == list(range(1, 33))


@pytest.mark.parametrize("hot_rows", SLICING)
def test_monotonic_repair(log, hot_rows):
    rng = random.Random(6)
    rows = [{"event_id": i, "entity_id": f"E{i % 2}", "ts_us": T0 + rng.randint(0, 40) * SECOND} for i in range(80)]
    got = {r["event_id"]: r["fixed_ts_us"] for r in timeline.monotonic_repair(log(rows), SECOND, hot_rows).collect()}
    for events in by_entity(rows).values():
        last = None
        for e in events:
            last = e["ts_us"] if last is None else max(e["ts_us"], last + SECOND)
            assert got[e["event_id"]] == last


def test_entity_tail(log):
    rows = skewed_rows(7)
    got = timeline.entity_tail(log(rows), 3).collect()
    for entity, events in by_entity(rows).items():
        mine = sorted((r["back"], r["event_id"]) for r in got if r["entity_id"] == entity)
        assert mine == [(k + 1, e["event_id"]) for k, e in enumerate(reversed(events[-3:]))]


def test_slices_stay_small(log):
    """No slice of a hot entity holds more rows than asked for."""
    rows = [{"entity_id": "HOT", "sec": i // 2} for i in range(400)]
    sliced = timeline.with_context(timeline.with_width(log(rows), 20), 4).where(~F.col("context"))
    sizes = [r["count"] for r in sliced.groupBy("slice").count().collect()]
    assert sum(sizes) == 400 and max(sizes) <= 20


def test_hot_rows_leave_the_partition_of_their_entity(spark, log):
    """Also rows that come partitioned by entity are exchanged on (entity, slice)."""
    rows = log(skewed_rows(8)).repartition(4, "entity_id")
    for frame in (
        timeline.with_previous(rows, "lat", hot_rows=7),
        sequence.sequence_windows(rows, 4, 7),
        timeline.monotonic_repair(rows, SECOND, 7),
    ):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("hashpartitioning(entity_id") > 1 and ", slice" in plan


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_lookup(spark, log, how):
    rows = log(skewed_rows(9))
    table = spark.createDataFrame([("HOT", 1), ("E1", 2), ("E2", 3), ("NEVER", 4)], "entity_id string, n int")
    hot = timeline.find_hot(rows, 20)
    parts = {r["entity_id"]: r["parts"] for r in hot.collect()}
    assert parts["HOT"] == 80 // 20 + 1
    got = timeline.entity_lookup(rows, table, hot, how).select("event_id", "entity_id", "n")
    want = rows.join(table, "entity_id", how).select("event_id", "entity_id", "n")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_nothing_is_hot_by_default(log):
    assert timeline.find_hot(log(skewed_rows(10))) is None
