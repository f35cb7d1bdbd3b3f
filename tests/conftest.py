from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidelog import USERS, schemas  # noqa: E402
from tidelog.session import build_session  # noqa: E402
from tidelog.sinks import Lake  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        {
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            # Tiny inputs: compiling code costs more than running it.
            "spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1",
            "spark.sql.codegen.wholeStage": "false",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"), USERS, buckets=4, prefix=f"t{id(tmp_path)}_")


class Log:
    """Builds change-log records for the users table."""

    def __init__(self, spark):
        self.spark = spark
        self.offset = 0

    def record(self, op, key, ts, *, name="N", email="e@x.com", lsn=None, before=None, raw=None):
        """One record; ``raw`` replaces the JSON text, and ``op=None`` is a tombstone."""
        image = {"id": key, "name": name, "email": email}
        envelope = {
            "before": image if op == "d" else before,
            "after": None if op == "d" else image,
            "source": {"db": "shop", "schema": "public", "table": "users", "lsn": lsn},
            "op": op,
            "ts_ms": ts,
        }
        text = raw if raw is not None else json.dumps(envelope)
        value = None if op is None else text.encode()
        offset, self.offset = self.offset, self.offset + 1
        return (str(key).encode(), value, USERS.topic, 0, offset, None)

    def frame(self, records):
        return self.spark.createDataFrame(records, schemas.CHANGE_LOG)


@pytest.fixture
def log(spark):
    return Log(spark)
