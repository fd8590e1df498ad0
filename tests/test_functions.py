import datetime

import pytest
from pyspark.sql import functions as F

from station_telemetry import functions as fn


def values(spark, data, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [r.out for r in df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


def test_battery_bounds(spark):
    got = values(spark, [0.1, 0.3, 0.5, 0.7, 0.9, None], "double", fn.battery_from_fraction)
    assert got == ["LOW", "MID", "MID", "HIGH", "HIGH", None]


def test_epoch_seconds_only_above_threshold(spark):
    data = [100_000_000_000, 100_000_000_001, 1_704_068_100_999, None]
    assert values(spark, data, "bigint", fn.epoch_seconds) == [
        100_000_000_000, 100_000_000, 1_704_068_100, None,
    ]


def test_utc_date_edges(spark):
    midnight = 1_704_153_600_000
    got = values(spark, [midnight - 1, midnight, -1], "bigint", fn.utc_date)
    assert got == [
        datetime.date(2024, 1, 1), datetime.date(2024, 1, 2), datetime.date(1969, 12, 31),
    ]


def test_iso_to_millis(spark):
    data = ["2024-01-01T10:15", "2024-01-01T10:15:30", "2024-01-01T10:15:30.5",
            "2024-01-01 10:15", "2024-13-01T10:15", "2024-01-01T10:15Z", "2024-01-01T25:00", None]
    assert values(spark, data, "string", fn.iso_to_millis) == [
        1_704_104_100_000, 1_704_104_130_000, 1_704_104_130_500, None, None, None, None, None,
    ]


def test_file_timestamp(spark):
    data = ["part-17-x.parquet", "foo.parquet", "part-17-x.parquet.tmp", "part-x-1.parquet", None]
    assert values(spark, data, "string", fn.file_timestamp) == [17, None, None, None, None]


def test_printable_text(spark):
    data = [bytearray(b"abc"), bytearray(b"\xff"), bytearray("é".encode()), None]
    assert values(spark, data, "binary", fn.printable_text) == ["abc", "0xFF", "é", None]


def test_document_id_and_key(spark):
    df = spark.createDataFrame([(3, 7), (None, 7), (3, None)], "a long, b long")
    got = [r.id for r in df.select(fn.document_id(F.col("a"), F.col("b")).alias("id")).collect()]
    assert got == ["3-7", None, None]


def test_record_json_keeps_nulls(spark):
    df = spark.createDataFrame([((None, 1),), (None,)], "v struct<a:int,b:int>")
    got = [r.j for r in df.select(fn.record_json(F.col("v")).alias("j")).collect()]
    assert got == ['{"a":null,"b":1}', None]


def test_frame_payload_drops_registry_prefix(spark):
    assert values(spark, [bytearray(b"\x00\x00\x00\x00\x07body")], "binary", fn.frame_payload) == [
        bytearray(b"body")
    ]


def test_framing_adds_magic_and_schema_id(spark):
    got = values(spark, [bytearray(b"body")], "binary", lambda v: fn.framed(v, 258))
    assert got == [bytearray(b"\x00\x00\x00\x01\x02body")]
    assert values(spark, got, "binary", fn.frame_payload) == [bytearray(b"body")]


def test_avro_schemas_are_valid(spark):
    from station_telemetry.schemas import RAIN, RAIN_AVRO, STATUS, STATUS_AVRO

    for text, schema in ((STATUS_AVRO, STATUS), (RAIN_AVRO, RAIN)):
        parsed = spark._jvm.org.apache.avro.Schema.Parser().parse(text)
        assert [f.name() for f in parsed.getFields()] == schema.names


@pytest.mark.parametrize("state,known", [("LOW", True), (None, True), ("FULL", False)])
def test_known_battery(spark, state, known):
    assert values(spark, [state], "string", fn.known_battery) == [known]
