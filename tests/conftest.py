import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from station_telemetry.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.driver.host": "127.0.0.1",
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def status_rows(spark):
    """Makes STATUS rows from (station, number, humidity) and optional time."""
    from station_telemetry.schemas import STATUS

    def make(*rows):
        full = [
            (station, number, "MID", millis, (humidity, 1.0, 2.0))
            for station, number, humidity, millis in rows
        ]
        return spark.createDataFrame(full, STATUS)

    return make
