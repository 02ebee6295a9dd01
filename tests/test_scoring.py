import random

import pytest
from clock_rows import DAY, SECOND, T0
from pyspark.sql import functions as F

from logvigil.functions import scores
from logvigil.operators import sampling, scoring


def brute_rolling(rows, days):
    rows = sorted(rows, key=lambda r: (r[1], r[0]))
    out = {}
    for i, (event_id, ts, value) in enumerate(rows):
        seen = [v for _, t, v in rows[: i + 1] if t > ts - days * DAY]
        width = (max(seen) - min(seen)) or 1.0
        out[event_id] = min(1.0, max(0.0, (value - min(seen)) / width))
    return out


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("days", [1, 3])
def test_rolling_equals_brute_force(spark, seed, days):
    """Ties, shared seconds, whole-window steps and gaps of several days."""
    rng = random.Random(seed)
    times = [T0 + rng.choice([0, 1, 2, 3, 4, 9]) * DAY + rng.choice([0, 1, 500_000, 7 * SECOND, rng.randrange(DAY)]) for _ in range(160)]
    rows = [(i, t, round(rng.random(), 2)) for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "event_id long, ts_us long, v double").repartition(3)
    got = {r["event_id"]: r["n"] for r in scoring.rolling_minmax(df, "v", "n", days).collect()}
    assert got == pytest.approx(brute_rolling(rows, days))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rolling_moves_no_events(spark):
    """Records go to the events; only a stream with more of them than can be broadcast is joined, with the same result."""
    rng = random.Random(9)
    rows = [(i, T0 + rng.randrange(6 * DAY), rng.choice([None, round(rng.random(), 2)])) for i in range(200)]
    df = spark.createDataFrame(rows, "event_id long, ts_us long, v double")
    near, far = scoring.rolling_extremes(df, "v", 2), scoring.rolling_extremes(df, "v", 2, most_records=0)
    assert "hashpartitioning(ts_us" not in _plan(near)
    seen = [{r["event_id"]: (r["roll_low"], r["roll_high"]) for r in part.collect()} for part in (near, far)]
    assert seen[0] == seen[1] and len(seen[0]) == 200


def test_event_one_window_ago_is_out(spark):
    rows = [(0, T0, 0.0), (1, T0 + 1, 0.4), (2, T0 + 30 * DAY, 0.5), (3, T0 + 30 * DAY + 1, 0.6)]
    df = spark.createDataFrame(rows, "event_id long, ts_us long, v double")
    got = {(r["event_id"]): (r["roll_low"], r["roll_high"]) for r in scoring.rolling_extremes(df, "v").collect()}
    assert got == {0: (0.0, 0.0), 1: (0.0, 0.4), 2: (0.4, 0.5), 3: (0.5, 0.6)}


def test_normalisation(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (9.0,)], "v double")
    clip = [r[0] for r in df.select(scores.minmax_clip(F.col("v"), F.lit(2.0), F.lit(4.0))).collect()]
    flat = [r[0] for r in df.select(scores.minmax_clip(F.col("v"), F.lit(2.0), F.lit(2.0))).collect()]
    assert clip == [0.0, 0.5, 1.0] and flat == [0.0, 1.0, 1.0]


def test_threshold_falls_back_without_benign_rows(spark):
    rows = [("val", "brute_force", i / 100) for i in range(101)] + [("train", "normal", 9.0)]
    df = spark.createDataFrame(rows, "split string, label string, score_ensemble double")
    assert scoring.calibrated_threshold(df) == pytest.approx(0.95)
    benign = df.unionByName(spark.createDataFrame([("val", "normal", 0.2)], df.schema))
    assert scoring.calibrated_threshold(benign) == pytest.approx(0.2)


def test_threshold_is_inclusive(spark):
    df = spark.createDataFrame([(0.5,), (0.4,)], "score double")
    assert [r["is_anomaly"] for r in scoring.add_flag(df, 0.5).collect()] == [True, False]


def test_bands(spark):
    df = spark.createDataFrame([(0.8,), (0.79,), (0.5,), (0.49,)], "r double")
    assert [r[0] for r in df.select(scores.severity_band(F.col("r"))).collect()] == ["critical", "medium", "medium", "low"]


@pytest.mark.parametrize("cap", [1, 40, 199, 500])
def test_downsample(spark, cap):
    df = spark.range(200).withColumnRenamed("id", "event_id")
    first = sorted(r[0] for r in sampling.downsample_cap(df, cap).collect())
    again = sorted(r[0] for r in sampling.downsample_cap(df.repartition(7), cap).collect())
    ranked = sorted(r[1] for r in sorted((r["d"], r["event_id"]) for r in df.select(sampling.digest(42).alias("d"), "event_id").collect())[:cap])
    assert first == again == ranked and len(first) == min(cap, 200)


def test_sample_with_replacement(spark):
    df = spark.range(3).withColumnRenamed("id", "event_id")
    got = sampling.sample_replace(df, 15).collect()
    assert sorted(r["draw"] for r in got) == list(range(15)) and {r["event_id"] for r in got} <= {0, 1, 2}


def test_folds_are_balanced(spark):
    df = spark.range(1003).select(F.col("id").alias("event_id"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("label"))
    folds = sampling.stratified_folds(df, "label")
    sizes = {}
    for r in folds.groupBy("label", "fold").count().collect():
        sizes.setdefault(r["label"], []).append(r["count"])
    assert folds.count() == 1003
    assert all(len(s) == 5 and max(s) - min(s) <= 1 for s in sizes.values())
    other = sampling.stratified_folds(df, "label", seed=7)
    assert folds.exceptAll(other).count() > 0
