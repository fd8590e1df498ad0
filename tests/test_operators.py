import bisect
import math

import pytest
from pyspark.sql import functions as F

from station_telemetry.operators import analytics, documents, openmeteo, rain, ranks, received, state, wire
from station_telemetry.schemas import STATUS, STREAM

MS = 1_704_067_200_000


def message(key, station, number, humidity, offset, millis=MS):
    return (key, (station, number, "MID", millis, (humidity, 1.5, 2.0)), offset)


# Rain


def test_rain_is_strictly_above_seventy(spark):
    rows = [message("1", 1, i, h, i) for i, h in enumerate((69, 70, 71))] + [("1", None, 9)]
    got = rain.rain_events(spark.createDataFrame(rows, STREAM)).collect()
    assert [tuple(r) for r in got] == [("1", 1, 71)]


def test_rain_keeps_null_station_and_duplicates(spark):
    rows = [message("7", None, 1, 80, 1), message("7", None, 1, 80, 1)]
    got = rain.rain_events(spark.createDataFrame(rows, STREAM)).collect()
    assert [tuple(r) for r in got] == [("7", None, 80)] * 2


# Wire records


def readings(spark, *batteries):
    rows = [(1, i, b, MS, (50, 20, 5)) for i, b in enumerate(batteries)]
    kind = ("stationId long, sequenceNumber long, batteryStatus string, statusTimeStamp long, "
            "weatherStatus struct<humidity:int,temperature:int,windSpeed:int>")
    return spark.createDataFrame(rows, kind)


def test_to_wire_widens_whole_numbers(spark):
    row = wire.to_wire(readings(spark, "LOW", None)).select("value.*").first()
    assert row.weatherStatus.temperature == 20.0 and isinstance(row.weatherStatus.windSpeed, float)


def test_unknown_battery_fails_or_is_rejected(spark):
    frame = readings(spark, "LOW", "FULL")
    with pytest.raises(Exception):
        wire.to_wire(frame).collect()
    good, bad = wire.to_wire_split(frame)
    assert [r.batteryStatus for r in good.collect()] == ["LOW"]
    assert [r.batteryStatus for r in bad.collect()] == ["FULL"]


def test_json_strict_and_split(spark):
    texts = ['{"stationId":1,"statusTimeStamp":5}', "bad", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "json string")
    good, bad = wire.decode_json_split(df)
    assert [r.value.stationId for r in good.collect()] == [1]
    assert [r.json for r in bad.collect()] == ["bad", None, ""]
    with pytest.raises(Exception):
        wire.decode_json(df).collect()


def test_json_null_record_stays_null(spark):
    df = spark.createDataFrame([(None,)], f"value {STATUS.simpleString()}")
    encoded = wire.encode_json(df)
    assert encoded.first().json is None
    assert wire.decode_json(encoded.select("json")).first().value is None


def test_publish_frame_key_is_station(spark):
    frame = wire.publish_frame(spark.createDataFrame([message("x", 12, 1, 5, 0)], STREAM))
    row = frame.first()
    assert row.key == "12"
    assert row.value.startswith('{"stationId":12,"sequenceNumber":1,"batteryStatus":"MID"')


# Third-party payloads


def payloads(spark, *texts):
    rows = [(100, i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "stationId long, id long, payload string")


def test_payload_mapping(spark):
    text = ('{"latitude":1.0,"current_units":{"time":"iso8601"},"current":{"time":'
            '"2024-01-01T10:15","interval":900,"temperature_2m":8.5,"relative_humidity_2m":71,'
            '"wind_speed_10m":3.25}}')
    parsed, rejected = openmeteo.parse_payloads(payloads(spark, text))
    good, bad = openmeteo.to_readings(openmeteo.assign_sequence(parsed, ["id"]))
    row = good.first()
    assert (row.stationId, row.sequenceNumber, row.batteryStatus) == (100, 1, "NOT_AVAILABLE")
    assert row.statusTimeStamp == 1_704_104_100_000
    assert tuple(row.weatherStatus) == (71, 8.5, 3.25)
    assert rejected.count() == 0 and bad.count() == 0


def test_unparsed_payloads_take_no_number_but_unmapped_do(spark):
    good_text = '{"current":{"time":"2024-01-01T10:15"}}'
    frame = payloads(spark, good_text, "bad", '{"current":{"time":"noon"}}', '{}', good_text)
    parsed, rejected = openmeteo.parse_payloads(frame)
    good, bad = openmeteo.to_readings(openmeteo.assign_sequence(parsed, ["id"]))
    assert sorted((r.id, r.sequenceNumber) for r in good.collect()) == [(0, 1), (4, 4)]
    assert sorted(r.id for r in bad.collect()) == [2, 3]
    assert [r.id for r in rejected.collect()] == [1]
    assert tuple(good.first().weatherStatus) == (0, 0.0, 0.0)


# Documents


def test_normalize_camel_case(spark):
    rows = [(3, 8, "HIGH", 1_704_068_100_999, (40, 1.5, 2.5)), (3, 9, None, 5, None)]
    first, second = documents.normalize(spark.createDataFrame(rows, STATUS)).orderBy("s_no").collect()
    assert first.doc_id == "3-8" and first.status_timestamp == 1_704_068_100
    assert first.event_time.microsecond == 999_000
    assert tuple(first.weather) == (40, 1.5, 2.5)
    assert second.status_timestamp == 5 and tuple(second.weather) == (None, None, None)


def test_ids_fall_back_on_null_but_other_fields_only_when_absent(spark):
    frame = spark.createDataFrame(
        [(None, 3, 4, None, "LOW")],
        "station_id long, stationId long, sequenceNumber long, battery_status string, batteryStatus string",
    )
    row = documents.normalize(frame).first()
    assert (row.station_id, row.s_no, row.battery_status) == (3, 4, None)
    assert row.status_timestamp is None and tuple(row.weather) == (None, None, None)


def test_snake_case_weather_and_bytes(spark):
    frame = spark.createDataFrame(
        [(1, 2, bytearray(b"LOW"), (9, 8.0))],
        "station_id long, s_no long, battery_status binary, weather struct<humidity:int,wind_speed:double>",
    )
    row = documents.normalize(frame).first()
    assert row.battery_status == "LOW" and tuple(row.weather) == (9, None, 8.0)


def test_required_fields(spark):
    frame = spark.createDataFrame([(1, 1), (None, 2), (3, None)], "station_id long, s_no long")
    good, rejected = documents.required_fields(frame)
    assert good.count() == 1 and rejected.count() == 2
    assert documents.normalize(frame).count() == 1


def test_replacement_keeps_the_last_whole_document(spark):
    frame = spark.createDataFrame([("a", 1, "old"), ("a", 2, None), ("b", 1, "x")], "doc_id string, o long, v string")
    assert sorted(tuple(r) for r in documents.replace_by_id(frame, "o").collect()) == [("a", 2, None), ("b", 1, "x")]


# Keyed state


def test_latest_goes_by_arrival_not_by_time(spark):
    rows = [message("1", 1, 5, 10, 1, MS + 1000), message("1", 1, 4, 11, 2, MS), (None, None, 3)]
    row = state.latest_status(spark.createDataFrame(rows, STREAM)).collect()
    assert len(row) == 1 and row[0].offset == 2 and '"sequenceNumber":4' in row[0].value


def test_lookups(spark):
    snapshot = spark.createDataFrame([("1", "a"), ("2", None)], "key string, value string")
    assert [r.value for r in state.get_status(snapshot, "1").collect()] == ["a"]
    assert state.get_status(snapshot, "9").count() == 0
    assert [tuple(r) for r in state.view_all(snapshot).collect()] == [("1", "a")]
    asked = spark.createDataFrame([("1",), ("2",), ("9",)], "key string")
    got = sorted(tuple(r) for r in state.get_many(asked, snapshot).collect())
    assert got == [("1", True, "a"), ("2", False, None), ("9", False, None)]


def test_overwrite_stats(spark):
    rows = [("k1", "aaaa", 1), ("k1", "bb", 2), ("k1", "c", 3), ("k2", "zz", 1)]
    frame = spark.createDataFrame(rows, "key string, value string, offset long")
    got = {r.key: (r.overwrites, r.superseded_bytes) for r in state.overwrite_stats(frame, F.col("value")).collect()}
    assert got == {"k1": (2, (8 + 2 + 4) + (8 + 2 + 2)), "k2": (0, 0)}


def test_many_overwrites_reconcile_after_compaction(spark):
    log = spark.range(50_000).select(
        F.concat(F.lit("station-"), F.col("id") % 1000 + 1).alias("key"),
        F.concat(F.lit("v"), "id").alias("value"),
        F.col("id").alias("offset"),
    )
    expected = log.where("offset >= 49000").select("key", "value")
    assert tuple(state.reconcile(expected, state.compact(log)).first()) == (1000, 0, 0)
    halfway = state.compact(log.where("offset < 49500 and key <> 'station-1'"))
    assert tuple(state.reconcile(expected, halfway).first()) == (1000, 1, 500)


def test_reconcile_joins_only_what_differs(spark):
    """Of 20,000 entries one is changed, one is gone and one is there too many: few rows meet."""
    expected = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").cast("string").alias("value"))
    changed = F.when(F.col("key") != "k7", F.col("value")).alias("value")
    actual = expected.select("key", changed).where("key <> 'k9'").union(spark.sql("select 'more', 'x'"))
    left, right = state.in_unequal_ranges(expected, actual)
    assert 2 <= left.count() < 20 and 2 <= right.count() < 20
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(key" not in plan
    assert tuple(state.reconcile(expected, actual).first()) == (20_000, 1, 1)
    assert [side.count() for side in state.in_unequal_ranges(expected, expected)] == [0, 0]


def test_reconcile_odd_entries(spark):
    def side(*rows):
        return spark.createDataFrame(rows, "key string, value string")

    nothing = side()
    assert tuple(state.reconcile(nothing, nothing).first()) == (0, 0, 0)
    assert tuple(state.reconcile(nothing, side(("a", "1"), (None, "2"))).first()) == (0, 0, 0)
    assert tuple(state.reconcile(side(("a", "1"), ("b", None), (None, "2")), nothing).first()) == (3, 3, 0)
    full = side(("a", None), ("b", ""), ("c", "x"), (None, "n"))
    assert tuple(state.reconcile(full, full).first()) == (4, 1, 0)
    assert tuple(state.reconcile(full, side(("a", ""), ("b", None), ("c", "x"))).first()) == (4, 1, 2)
    # One range and part: all entries are joined, the result is the same.
    assert tuple(state.reconcile(full, side(("a", ""), ("c", "x")), ranges=1, parts=1).first()) == (4, 2, 1)


# Analyses


def test_battery_distribution(spark):
    frame = spark.createDataFrame([(b,) for b in ["LOW"] * 3 + ["MID"] * 4 + ["HIGH"] * 3 + ["NOT_AVAILABLE"] * 10], "battery_status string")
    shares = {r.battery_status: r.share_pct for r in analytics.battery_distribution(frame, True).collect()}
    assert shares == {"LOW": 30.0, "MID": 40.0, "HIGH": 30.0}
    assert {r.battery_status: r.share_pct for r in analytics.battery_distribution(frame).collect()}["NOT_AVAILABLE"] == 50.0


def test_total_drop_rate(spark):
    frame = spark.createDataFrame([(1, 1), (1, 4), (2, 2)], "station_id long, s_no long")
    row = analytics.drop_rate_total(analytics.dropped_per_station(frame)).first()
    assert (row.expected, row.received, row.dropped) == (6, 3, 3) and row.drop_rate == 0.5


@pytest.mark.parametrize("exact", [True, False])
def test_percentiles_are_nearest_rank(spark, exact):
    frame = spark.createDataFrame([("a", float(v)) for v in range(1, 11)] + [("b", 5.0), (None, 2.0)], "s string, v double")
    got = {r.s: (r["count"], r.mean, r.p50, r.p95, r.p99, r.max) for r in analytics.measurement_summary(frame, "s", "v", exact).collect()}
    assert got["a"] == (10, 5.5, 5.0, 10.0, 10.0, 10.0)
    assert got["b"] == (1, 5.0, 5.0, 5.0, 5.0, 5.0)
    assert got[None] == (1, 2.0, 2.0, 2.0, 2.0, 2.0)


def test_percentiles_with_many_copies(spark):
    frame = spark.range(30_000).select(F.lit("s").alias("s"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1009).cast("long").alias("v"))
    data = sorted(r.v for r in frame.collect())
    row = analytics.measurement_summary(frame, "s", "v").first()
    for name, p in analytics.PERCENTILES.items():
        assert row[name] == data[math.ceil(p / 100 * len(data)) - 1]


def test_ranks_of_infinite_missing_and_extreme_values(spark):
    inf, nan = float("inf"), float("nan")
    groups = {
        "ends": [-inf] * 30 + [0.0] * 40 + [inf] * 30,
        "tail": [10.0**k for k in range(-300, 300, 2)],
        "close": [1.0 + k * 2.3e-16 for k in range(300)],
        "nans": [1.0] * 60 + [nan] * 40,
        "same": [2.5] * 7,
    }
    rows = [(s, v) for s, vs in groups.items() for v in vs] + [("none", None), (None, 4.0)]
    frame = spark.createDataFrame(rows, "s string, v double")
    got = {r.s: r for r in analytics.measurement_summary(frame, "s", "v").collect()}
    assert set(got) == {*groups, None} and got[None].p99 == 4.0
    for name, values in groups.items():
        order = sorted(values, key=lambda v: (math.isnan(v), v))
        for column, p in analytics.PERCENTILES.items():
            want = order[math.ceil(p / 100 * len(order)) - 1]
            assert got[name][column] == want or math.isnan(want) and math.isnan(got[name][column])


def test_ranks_of_whole_numbers_beyond_doubles(spark):
    values = [(1 << 60) + k for k in range(100)] + [-(1 << 62), (1 << 62)]
    frame = spark.createDataFrame([("s", v) for v in values], "s string, v long")
    row = analytics.measurement_summary(frame, "s", "v").first()
    assert [row.p50, row.p95] == [sorted(values)[50], sorted(values)[96]]


def test_sketches_of_batches_merge(spark):
    frame = spark.range(30_000).selectExpr("if(id % 3 = 0, 'a', 'b') s", "cast(id * 7919 % 30011 as double) v", "id % 4 batch")
    kept = [ranks.sketches(frame.where(F.col("batch") == k), "s", "v", k=512) for k in range(4)]
    whole = kept[0].unionByName(kept[1]).unionByName(kept[2]).unionByName(kept[3])
    for r in ranks.summary_of(ranks.merged(whole, "s"), "s", analytics.PERCENTILES).collect():
        values = sorted(x.v for x in frame.where(F.col("s") == r.s).collect())
        assert (r["count"], r.max) == (len(values), values[-1]) and abs(r.mean - sum(values) / len(values)) < 1e-6
        for name, p in analytics.PERCENTILES.items():
            assert abs(bisect.bisect(values, r[name]) / len(values) - p / 100) < 0.02
    assert ranks.sketches(frame.where("false"), "s", "v").count() == 0


def test_bitmaps_of_batches_merge(spark):
    rows = spark.range(1, 100_001).selectExpr("id % 2 station_id", "id s_no").where("s_no % 32768 not in (0, 1, 5) and s_no not between 40000 and 80000")
    batches = [rows.where(F.col("s_no") % 3 != k) for k in range(3)]
    kept = received.merged(*[received.bitmaps(b) for b in batches])
    assert sorted(map(tuple, received.totals(kept).collect())) == sorted(map(tuple, received.totals(received.bitmaps(rows)).collect()))
    want = sorted(map(tuple, analytics.sequence_gaps(rows).collect()))
    assert sorted(map(tuple, received.gaps(kept).collect())) == want
    known = {0: set(), 1: set()}
    for r in rows.collect():
        known[r.station_id].add(r.s_no)
    for k, have in known.items():
        missing = sorted(n for f, t in ((g[1], g[2]) for g in want if g[0] == k) for n in range(f, t + 1))
        assert missing == [n for n in range(1, max(have)) if n not in have]


def test_numbers_below_one_are_received_but_leave_no_gap(spark):
    frame = spark.createDataFrame([(1, -3), (1, 0), (1, 2), (1, None), (None, 4)], "station_id long, s_no long")
    assert [tuple(r) for r in analytics.sequence_gaps(frame).collect()] == [(1, 1, 1, 1)]
    got = {r.station_id: (r.expected, r.received) for r in analytics.dropped_per_station(frame).collect()}
    assert got == {1: (2, 3), None: (4, 1)}


def test_rate_per_window(spark):
    frame = spark.createDataFrame([(0, 1.0), (999, 3.0), (1000, 5.0)], "ms long, v double").withColumn("t", F.timestamp_millis("ms"))
    one = analytics.rate_per_window(frame, "t", "v").orderBy("window_start").collect()
    assert [(r.ops, r.ops_per_sec, r.avg_value, r.max_value) for r in one] == [(2, 2.0, 2.0, 3.0), (1, 1.0, 5.0, 5.0)]
    both = analytics.rate_per_window(frame, "t", "v", "2 seconds").first()
    assert (both.ops, both.ops_per_sec) == (3, 1.5)
