"""Tables laid out for point reads: same rows as a full scan, and less that is read."""

import random

import pytest
from clock_rows import DAY, T0
from pyspark.sql import functions as F

from logvigil.functions.clock import iso_text
from logvigil.operators import triage
from logvigil.sources import readers, stores, writers


def scanned(frame):
    """Files and rows that the scans of a collected frame have read."""
    files = rows = 0
    plan = frame._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if hasattr(plan, "executedPlan") and "Adaptive" in plan.nodeName() else plan
    leaves = plan.collectLeaves()
    for i in range(leaves.size()):
        metrics = leaves.apply(i).metrics()
        if metrics.contains("numFiles"):
            files += metrics.get("numFiles").get().value()
            rows += metrics.get("numOutputRows").get().value()
    return files, rows


@pytest.fixture(scope="module")
def events(log):
    rng = random.Random(9)
    rows = [{"event_id": i, "entity_id": f"E{rng.randrange(40):02d}", "ts_us": T0 + rng.randrange(10) * DAY + rng.randrange(DAY)} for i in range(4000)]
    return log(rows)


@pytest.fixture(scope="module")
def store(events, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store"))
    stores.write_events(events, path, folders=8, file_rows=200, ids_a_row_group=500)
    return path


def test_one_event_reads_one_day(spark, events, store):
    all_files = len(stores.stored_events(spark, store).inputFiles())
    for event_id in (0, 17, 3999):
        found = stores.stored_event(spark, store, event_id, folders=8)
        assert [r.asDict() for r in found.collect()] == [r.asDict() for r in events.where(F.col("event_id") == event_id).collect()]
        files, rows = scanned(found)
        assert files <= 4 < all_files / 4 and rows <= 400
    with pytest.raises(ValueError, match="no event"):
        stores.stored_event(spark, store, 4000, folders=8)


def test_no_task_holds_all_of_a_busy_entity(spark, log, tmp_path):
    busy = log([{"event_id": i, "entity_id": "E", "ts_us": T0 + i} for i in range(2000)])
    stores.write_events(busy, str(tmp_path), folders=2, file_rows=200)
    held = stores.stored_events(spark, str(tmp_path)).groupBy(F.input_file_name()).count().collect()
    assert len(held) > 5 and max(r["count"] for r in held) < 2000 / 3
    assert stores.stored_entity(spark, str(tmp_path), "E").count() == 2000


def test_the_bloom_filter_keeps_row_groups_out(spark, store):
    """An id that no file holds, inside the range of ids of all files: only the filters can tell."""
    missing = stores.stored_events(spark, store).where("event_id = 2000 OR event_id = 2001").collect()
    day = missing[0]["day"]
    others = stores.stored_events(spark, store).where((F.col("day") != day) & (F.col("event_id") == missing[0]["event_id"]))
    assert others.collect() == []
    files, rows = scanned(others)
    assert files > 10 and rows < 4000 / 10


def test_one_entity_is_read_from_its_row_groups(spark, events, store):
    found = stores.stored_entity(spark, store, "E07")
    assert {r["event_id"] for r in found.collect()} == {r["event_id"] for r in events.where("entity_id = 'E07'").collect()}
    first = T0 // DAY + 2
    few = stores.stored_entity(spark, store, "E07", first, first + 1)
    want = events.where("entity_id = 'E07'").where(F.col("ts_us").between(T0 + 2 * DAY, T0 + 4 * DAY - 1))
    assert {r["event_id"] for r in few.collect()} == {r["event_id"] for r in want.collect()}
    assert scanned(few)[0] < len(stores.stored_events(spark, store).inputFiles()) / 3
    assert scanned(few)[1] < events.count() / 5  # two row groups of two days


def test_pages_of_a_stored_queue(spark, log, tmp_path):
    rng = random.Random(2)
    alerts = log([{"event_id": i, "sec": rng.randrange(50)} for i in range(537)]).withColumn("risk_score", (F.col("event_id") * 7 % 13) / 13.0)
    path = str(tmp_path / "queue")
    stores.write_queue(alerts, path, range_rows=40)
    order = [r["event_id"] for r in triage.alert_queue(alerts).collect()]
    assert stores.stored_pages(spark, path, 25) == 22
    read = {}
    for page in (1, 2, 11, 22, 23):
        got = stores.stored_page(spark, path, page, 25)
        assert [r["event_id"] for r in got.collect()] == order[(page - 1) * 25 : page * 25]
        read[page] = scanned(got)[1]
    assert read[22] <= 120 and read[11] <= 120  # two or three ranges, as for the first page
    last, got = alerts.where(F.col("event_id") == order[9]).first(), order[:10]
    while True:
        rows = stores.stored_after(spark, path, last["risk_score"], last["ts_us"], last["event_id"], 30).collect()
        if not rows:
            break
        got, last = got + [r["event_id"] for r in rows], rows[-1]
    assert got == order


def test_cache_follows_its_input(spark, tmp_path):
    source, cache, calls = str(tmp_path / "in"), str(tmp_path / "cache"), []

    def table(columns):
        def compute():
            calls.append(columns)
            return spark.read.parquet(source).select(*columns)

        return writers.cached_table(spark, cache, compute, inputs=[source], columns=columns)

    spark.range(3).withColumn("x", F.lit(1)).write.parquet(source)
    assert table(["id"]).count() == table(["id"]).count() == 3 and len(calls) == 1
    assert table(["id", "x"]).columns == ["id", "x"] and len(calls) == 2
    spark.range(5).withColumn("x", F.lit(1)).write.mode("overwrite").parquet(source)
    assert table(["id"]).count() == 5 and len(calls) == 3
    spark.range(2).withColumn("x", F.lit(1)).write.mode("append").parquet(source)
    assert table(["id"]).count() == 7 and len(calls) == 4


def test_a_repeated_write_adds_no_decision(spark, log, tmp_path):
    path = str(tmp_path / "feedback")
    alerts = log([{"sec": i} for i in range(4)]).withColumns(
        {"timestamp": iso_text(F.col("ts_us")), "predicted_attack_type": F.lit("unknown"), "risk_score": F.lit(0.5), "comments": F.lit(None).cast("string")}
    )
    first = alerts.where("event_id < 3").withColumn("analyst_action", F.lit("False Positive"))
    second = alerts.where("event_id = 1").withColumns({"analyst_action": F.lit("Confirm"), "timestamp": F.lit("2024-02-01T00:00:00.000000Z")})
    for batch in (first, first, second, first, second):
        writers.log_feedback(batch, path)
    feedback = readers.read_feedback(spark, path)
    assert spark.read.parquet(path).count() == feedback.count() == 4
    queue = {r["event_id"]: (r["analyst_action"], r["open"]) for r in triage.with_decisions(alerts, feedback).collect()}
    assert queue == {0: ("False Positive", False), 1: ("Confirm", False), 2: ("False Positive", False), 3: (None, True)}
