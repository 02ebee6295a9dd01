import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from clock_rows import SECOND, T0  # noqa: E402

from logvigil.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "logvigil-tests", 4, spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")), spark__sql__shuffle__partitions="4"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


DEFAULTS = {
    "event_id": 0, "entity_id": "USR_1", "entity_type": "user", "ts_us": T0, "source_ip": "10.0.0.1", "lat": 10.0, "lon": 20.0,
    "resource_accessed": "r1", "auth_method": "token", "session_duration": 60, "bytes_transferred": 100, "mac": "m1", "os": "o1",
    "label": "normal",
}
SCHEMA = (
    "event_id long, entity_id string, entity_type string, ts_us long, source_ip string, lat double, lon double,"
    " resource_accessed string, auth_method string, session_duration long, bytes_transferred long, mac string, os string,"
    " label string"
)


@pytest.fixture(scope="session")
def log(spark):
    """Build a log from dicts: ids count up, ``sec`` counts from T0, the rest has defaults."""

    def build(rows):
        full = []
        for i, row in enumerate(rows):
            row = dict(row)
            if "sec" in row:
                row["ts_us"] = T0 + round(row.pop("sec") * SECOND)
            full.append(tuple({**DEFAULTS, "event_id": i, **row}[k] for k in DEFAULTS))
        return spark.createDataFrame(full, SCHEMA)

    return build
