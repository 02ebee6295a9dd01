import json

import pytest
from pyspark.sql import functions as F

from logvigil.session import scratch_dir
from logvigil.sources import readers, schema, writers

ROW = {
    "event_id": "e1", "entity_id": "USR_0001", "entity_type": "user", "timestamp": "2024-01-01T00:00:01.5Z", "source_ip": "10.0.0.1",
    "geo_location": json.dumps({"lat": 1.5, "lon": -2.5, "country": "US"}), "resource_accessed": "/a,b", "auth_method": "token",
    "session_duration": 5, "bytes_transferred": 7, "command_sequence": json.dumps(["sudo su", 'echo "x"']),
    "device_fingerprint": json.dumps({"os": "o", "firmware": "f", "mac": "m", "protocol": "p"}),
}


def csv_line(row):
    return ",".join('"' + str(v).replace('"', '""') + '"' if v is not None else "" for v in row.values())


def test_access_logs_from_csv(spark, tmp_path):
    broken = {**ROW, "event_id": "e2", "geo_location": "x", "device_fingerprint": None, "command_sequence": None}
    partial = {**ROW, "event_id": "e3", "geo_location": '{"lat": 3.5}'}
    path = tmp_path / "logs.csv"
    path.write_text("\n".join([",".join(ROW), csv_line(ROW), csv_line(broken), csv_line(partial)]) + "\n")
    got = {r["event_id"]: r for r in readers.load_access_logs(spark, str(path)).collect()}
    assert (got["e1"]["lat"], got["e1"]["lon"], got["e1"]["mac"], got["e1"]["os"]) == (1.5, -2.5, "m", "o")
    assert got["e1"]["command_sequence"] == ["sudo su", 'echo "x"'] and got["e1"]["resource_accessed"] == "/a,b"
    assert got["e1"]["ts_us"] == 1_704_067_201_500_000
    assert (got["e2"]["lat"], got["e2"]["lon"], got["e2"]["mac"], got["e2"]["os"], got["e2"]["command_sequence"]) == (0.0, 0.0, "", "", None)
    assert (got["e3"]["lat"], got["e3"]["lon"]) == (3.5, 0.0)


def test_live_feed_skips_blank_and_broken_lines(spark, tmp_path):
    good = {"event_id": "a", "timestamp": "t", "entity_id": "e", "predicted_attack_type": "unknown", "risk_score": 0.5}
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "x.json").write_text("\n" + json.dumps(good) + "\n{broken\n\n" + json.dumps({**good, "event_id": "b"}) + "\n")
    assert sorted(r["event_id"] for r in readers.read_live_alerts(spark, str(tmp_path / "feed")).collect()) == ["a", "b"]


def test_feedback_appends(spark, tmp_path):
    path = str(tmp_path / "feedback")
    row = spark.createDataFrame([("c", "x", 0.5, "False Positive", "t", "unknown", 3)],
                                "comments string, event_id string, risk_score double, analyst_action string, timestamp string, predicted_attack_type string, extra int")
    for event in "xyz":
        writers.log_feedback(row.withColumn("event_id", F.lit(event)), path)
    back = spark.read.schema(schema.FEEDBACK).parquet(path)
    assert back.count() == 3 and back.first()["analyst_action"] == "False Positive"


def test_cached_table_computes_once(spark, tmp_path):
    calls = []

    def compute():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        assert writers.cached_table(spark, str(tmp_path / "cache"), compute).count() == 3
    assert len(calls) == 1


def test_scores_are_pruned_by_the_scan(spark, tmp_path):
    path = str(tmp_path / "scores")
    writers.write_table(spark.range(3).select("id", F.lit(0.5).alias("a"), F.lit(1.0).alias("b")), path)
    plan = readers.read_scores(spark, path, ("id", "a"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint,a:double>" in plan


def test_partitioned_write(spark, tmp_path):
    path = str(tmp_path / "days")
    writers.write_table(spark.range(4).select("id", (F.col("id") % 2).alias("day")), path, partition_by=("day",))
    assert spark.read.parquet(path).where("day = 1").count() == 2


def test_scratch_needs_the_shared_folder(spark):
    first, second = scratch_dir(spark), scratch_dir(spark)
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_label_join(spark, how):
    logs = spark.createDataFrame([("a",), ("b",)], "event_id string")
    labels = spark.createDataFrame([("a", "normal", None), ("z", "normal", None)], schema.LABELS)
    got = {r["event_id"]: r["label"] for r in readers.join_labels(logs, labels, how).collect()}
    assert got == ({"a": "normal"} if how == "inner" else {"a": "normal", "b": None})
