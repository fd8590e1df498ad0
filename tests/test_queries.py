"""Every registered query against its SQL in DuckDB, and the fixture's known results."""

import pytest

from __spark_entry__ import entry, queries
from check import compare, tables
from station_telemetry.plans.oracles import ORACLES
from station_telemetry.plans.registry import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return tables(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SMALL, name) is None


def test_entry_has_rows(spark):
    df = entry(spark)
    assert df.columns == ["key", "stationId", "humidity"] and df.count() > 0


def test_known_results(spark):
    sf = "/root/testdata/sf0.01"
    assert queries()["rain_events"](spark, sf).count() == 2_970
    per_station = {r.station_id: r.received for r in queries()["dropped_per_station"](spark, sf).collect()}
    assert per_station[1] == 900 and sum(per_station.values()) == 9_000
    shares = {r.battery_status: r.readings for r in queries()["battery_distribution"](spark, sf).collect()}
    assert shares == {"LOW": 2_972, "MID": 3_969, "HIGH": 3_059}
    epochs = queries()["dropped_per_epoch"](spark, sf).collect()
    assert len(epochs) == 20
    assert sorted(r.received for r in epochs if r.station_id == 1) == [360, 540]
