import random

import numpy as np
import pytest
from clock_rows import T0
from pyspark.sql import functions as F

from logvigil.operators import metrics, ranks


@pytest.fixture(params=["plain", "tight", "misled"])
def limits(request, monkeypatch):
    """Also with tiny brackets and samples, so that narrowing and misleading samples are exercised."""
    if request.param != "plain":
        monkeypatch.setattr(ranks, "SMALL", 10)
        monkeypatch.setattr(ranks, "GRID", 20)
    if request.param == "misled":
        monkeypatch.setattr(ranks, "SAMPLE", 15)
        monkeypatch.setattr(ranks, "SLACK", 1)


@pytest.mark.parametrize("seed", range(3))
def test_percentile_equals_numpy(spark, limits, seed):
    rng = random.Random(seed)
    values = [rng.choice([0.0, rng.random(), rng.gauss(0, 100)]) for _ in range(900)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    points = (0.0, 0.05, 0.5, 0.95, 0.99, 1.0)
    assert ranks.exact_percentile(df, "v", *points) == pytest.approx(list(np.percentile(values, [p * 100 for p in points])))


def test_percentile_of_few_and_none(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "v double")
    assert ranks.exact_percentile(df, "v", 0.99) == [99.0]
    assert ranks.exact_percentile(df.where("v < 0"), "v", 0.5) == [None]
    assert ranks.exact_percentile(df.where("v = 7"), "v", 0.3) == [7.0]


@pytest.mark.parametrize("ties", [1, 7, 1000])
def test_chrono_split_equals_ranks(spark, limits, ties):
    rng = random.Random(ties)
    rows = [(f"id{i:04d}", T0 + rng.randint(0, 1000) // ties * ties) for i in range(500)]
    rng.shuffle(rows)
    got = ranks.chrono_split(spark.createDataFrame(rows, "event_id string, ts_us long"))
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    want = {r[0]: "train" if i < int(0.7 * 500) else "val" if i < int(0.85 * 500) else "test" for i, r in enumerate(order)}
    assert {r["event_id"]: r["split"] for r in got.collect()} == want


def test_chrono_split_of_one_row(spark):
    got = ranks.chrono_split(spark.createDataFrame([("a", T0)], "event_id string, ts_us long"))
    assert [r["split"] for r in got.collect()] == ["test"]


@pytest.mark.parametrize("per_bin", [1_000_000, 7])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, per_bin, descending):
    values = random.Random(3).sample(range(1000), 60)
    df = spark.createDataFrame([(float(v), v % 5) for v in values], "v double, n long")
    got = ranks.running_totals(df, "v", ("n",), descending, per_bin)
    total, want = 0, {}
    for v in sorted(values, reverse=descending):
        total += v % 5
        want[float(v)] = total
    assert {r["v"]: r["cum_n"] for r in got.collect()} == want


def _areas(pairs):
    """ROC area by pairs, PR area by the trapezoid rule."""
    pos, neg = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    roc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    points = [(0.0, 1.0)]
    for cut in sorted({s for s, _ in pairs}, reverse=True):
        hit = [y for s, y in pairs if s >= cut]
        points.append((sum(hit) / len(pos), sum(hit) / len(hit)))
    return roc, sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:], strict=False))


@pytest.mark.parametrize("per_bin", [1_000_000, 4])
def test_areas(spark, per_bin):
    rng = random.Random(9)
    pairs = [(round(rng.random() ** 2, 1 if rng.random() < 0.3 else 3), int(rng.random() < 0.2)) for _ in range(300)]
    df = spark.createDataFrame(pairs, "score double, y int")
    row = metrics.curve_metrics(metrics.score_curve(df, rows_per_bin=per_bin)).first()
    assert (row["roc_auc"], row["pr_auc"]) == pytest.approx(_areas(pairs))


def test_areas_without_positives(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0)], "score double, y int")
    row = metrics.curve_metrics(metrics.score_curve(df)).first()
    assert row["roc_auc"] is None and row["pr_auc"] is None


def test_top_share(spark):
    df = spark.createDataFrame([(float(i), int(i in (99, 100))) for i in range(101)], "score double, y int")
    assert metrics.fpr_at_top1(df).first()["fpr_at_1"] == 0.0
    assert metrics.precision_at_top1(df).first()["precision_at_1"] == 1.0
    assert metrics.precision_at_top1(df.withColumn("y", F.lit(0))).first()["precision_at_1"] == 0.0


def test_report_and_confusion(spark):
    rows = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("c", "a")] + [("b", "d")]
    df = spark.createDataFrame(rows, "actual string, predicted string")
    report = {r["class"]: r for r in metrics.classification_report(df).collect()}
    assert report["a"]["precision"] == 0.75 and report["a"]["recall"] == 0.75 and report["a"]["support"] == 4
    assert report["d"]["recall"] == 0.0 and report["d"]["support"] == 0
    assert report["accuracy"]["f1"] == pytest.approx(5 / 8)
    assert report["macro avg"]["recall"] == pytest.approx((0.75 + 2 / 3 + 0 + 0) / 4)
    assert report["weighted avg"]["recall"] == pytest.approx(5 / 8)
    matrix = {r["actual"]: r.asDict() for r in metrics.confusion_matrix(df, ["a", "b", "c", "d"]).collect()}
    assert matrix["b"] == {"actual": "b", "a": 0, "b": 2, "c": 0, "d": 1}


def test_balanced_weights(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "label string")
    got = {r["label"]: r["weight"] for r in metrics.balanced_weights(df, "label").collect()}
    assert got == pytest.approx({"a": 4 / 6, "b": 2.0})
