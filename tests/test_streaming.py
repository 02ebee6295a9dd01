import json
import random

from clock_rows import SECOND, T0
from pyspark.sql import Row
from pyspark.sql import functions as F

from logvigil.operators import trailing
from logvigil.sources import readers, writers
from logvigil.streaming import feeds, stateful


def test_live_feed_picks_up_new_files_once(spark, tmp_path):
    feed, table, progress = (str(tmp_path / n) for n in ("feed", "table", "progress"))
    (tmp_path / "feed").mkdir()

    def drop(name, ids):
        lines = [json.dumps({"event_id": i, "timestamp": "t", "entity_id": "e", "predicted_attack_type": "unknown", "risk_score": 0.5}) for i in ids]
        (tmp_path / "feed" / name).write_text("\n".join(["", "{bad", *lines]) + "\n")

    def run():
        feeds.to_table(feeds.live_alerts(spark, feed), table, progress, once=True).awaitTermination()
        return sorted(r["event_id"] for r in spark.read.parquet(table).collect())

    drop("a.json", ["1", "2"])
    assert run() == ["1", "2"]
    drop("b.json", ["3"])
    assert run() == ["1", "2", "3"]
    assert run() == ["1", "2", "3"]


def test_the_feed_has_few_files(spark, log, tmp_path):
    """Batches of a reader follow the number of alerts, not of the pieces they were computed in."""
    alerts = log([{"event_id": i, "sec": i} for i in range(60)]).withColumns({"predicted_attack_type": F.lit("unknown"), "risk_score": F.lit(0.5)})
    feed = tmp_path / "feed"
    writers.write_live_alerts(alerts.repartition(30), str(feed))
    assert len(list(feed.glob("*.json"))) <= 2 and readers.read_live_alerts(spark, str(feed)).count() == 60


def test_sink_then_tail(spark, log, tmp_path):
    alerts = log([{}, {"sec": 1}]).withColumns({"predicted_attack_type": F.lit("unknown"), "risk_score": F.lit(0.5)})
    source, feed = str(tmp_path / "alerts"), str(tmp_path / "feed")
    for part in (0, 1):
        writers.write_table(alerts.where(F.col("event_id") == part), source, mode="append")
        stream = spark.readStream.schema(alerts.schema).parquet(source)
        feeds.alert_sink(stream, feed, str(tmp_path / "progress"), once=True).awaitTermination()
    assert sorted(r["event_id"] for r in readers.read_live_alerts(spark, feed).collect()) == ["0", "1"]
    table = str(tmp_path / "table")
    feeds.to_table(feeds.live_alerts(spark, feed), table, str(tmp_path / "tail"), once=True).awaitTermination()
    assert spark.read.parquet(table).count() == 2


def test_failed_auth_windows(spark, log, tmp_path):
    rows = [{"sec": s, "auth_method": "password"} for s in (30, 90, 400)] + [{"sec": 95}, {"sec": 5000, "auth_method": "password"}]
    frame = log(rows).withColumn("ts", F.timestamp_micros("ts_us"))
    writers.write_table(frame, str(tmp_path / "log"))
    events = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "log"))
    table = str(tmp_path / "table")
    feeds.to_table(feeds.failed_auth_windows(events), table, str(tmp_path / "progress"), once=True).awaitTermination()
    got = {(r["start_us"] - T0) // SECOND: r["failed"] for r in spark.read.parquet(table).collect()}
    want = {}
    for sec in (30, 90, 400):
        for start in range(sec // 60 * 60 - 240, sec // 60 * 60 + 1, 60):
            want[start] = want.get(start, 0) + 1
    assert got == want  # windows of the last event are still open


def run_per_event(spark, frames, folder, delay):
    """The per-event count over frames that come one after the other: latest counts, late rows, all rows emitted."""
    source, table = str(folder / "log"), str(folder / "table")
    for frame in frames:
        writers.write_table(frame, source, mode="append")
        events = spark.readStream.schema(frame.schema).parquet(source)
        counts = stateful.failed_auth_per_event(events, delay)
        stateful.start_per_event(counts, table, str(folder / "progress"), once=True).awaitTermination()
    counts = {r["event_id"]: r["failed_auth_count_5min"] for r in stateful.read_counts(spark, table).collect()}
    late = {r["event_id"] for r in stateful.read_late(spark, table).collect()}
    return counts, late, spark.read.option("recursiveFileLookup", True).parquet(table)


def test_each_event_has_the_batch_count(spark, log, tmp_path):
    """In order, in batches that cut windows, with ties, seconds shared by several events and two entities."""
    rng = random.Random(4)
    secs = sorted(rng.randrange(0, 3000) + rng.choice([0.0, 0.25, 0.5]) for _ in range(120))
    rows = [{"sec": s, "entity_id": rng.choice("AB"), "auth_method": rng.choice(["password", "token"])} for s in secs]
    frame = log(rows).withColumn("ts", F.timestamp_micros("ts_us"))
    parts = [frame.where(f"event_id >= {a} AND event_id < {b}") for a, b in ((0, 30), (30, 31), (31, 90), (90, 120))]
    counts, late, emitted = run_per_event(spark, parts, tmp_path, "1 second")
    batch = trailing.trailing_features(frame, addresses=False, travel=False)
    assert counts == {r["event_id"]: r["failed_auth_count_5min"] for r in batch.collect()}
    assert not late and emitted.count() == len(rows)


def test_rows_ahead_of_the_watermark_correct_and_others_are_late(spark, log, tmp_path):
    failed = {"auth_method": "password"}
    first = [{"event_id": i, "sec": s, **failed} for i, s in ((1, 0), (2, 1000), (3, 1100), (4, 1290))]
    second = [{"event_id": 5, "sec": 1050, **failed}, {"event_id": 6, "sec": 100, **failed}, {"event_id": 7, "sec": 1080}]
    frames = [log(rows).withColumn("ts", F.timestamp_micros("ts_us")) for rows in (first, second)]
    counts, late, emitted = run_per_event(spark, frames, tmp_path, "500 seconds")  # the watermark is at 790 seconds
    assert late == {6}
    assert counts == {1: 1, 2: 1, 5: 2, 7: 2, 3: 3, 4: 4}
    again = [r["event_id"] for r in emitted.where("NOT late").collect()]
    assert sorted(again) == [1, 2, 3, 3, 4, 4, 5, 7]


def test_state_goes_once_the_watermark_has_passed_it(spark, log, tmp_path):
    rows = [[{"event_id": i, "sec": s, "entity_id": e, "auth_method": "password"}] for i, s, e in ((1, 0, "A"), (2, 5000, "B"), (3, 9000, "B"))]
    frames = [log(r).withColumn("ts", F.timestamp_micros("ts_us")) for r in rows]
    run_per_event(spark, frames, tmp_path, "10 seconds")
    state = spark.read.format("statestore").option("operatorId", 0).option("stateVarName", "recent").load(str(tmp_path / "progress"))
    assert {r["key"]["entity_id"] for r in state.collect()} == {"B"}


def test_an_entity_without_state_costs_three_calls():
    """One read, one write and one timer, and no table is built for each entity."""
    calls = []

    class Recording:
        def __getattr__(self, name):
            return lambda *args: calls.append((name, *args)) or []

    class Clock:
        getCurrentWatermarkInMs = staticmethod(lambda: 0)

    processor = stateful.FailedLogins("long")
    processor.handle = processor.recent = Recording()
    rows = [Row(ts_us=T0 + sec * SECOND, event_id=i, failed=1) for i, sec in ((2, 400), (1, 0), (3, 700))]
    out = list(processor.handleInputRows(("A",), iter(rows), Clock()))
    assert [(r.event_id, r.failed_auth_count_5min, r.late) for r in out] == [(1, 1, False), (2, 1, False), (3, 2, False)]
    assert [c[0] for c in calls] == ["get", "put", "registerTimer"]
