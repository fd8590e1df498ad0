import time

import pytest
from pyspark.sql import functions as F

from station_telemetry.operators.documents import drop_replays, normalize
from station_telemetry.operators.rain import rain_events
from station_telemetry.operators.state import latest_status
from station_telemetry.schemas import STREAM
from station_telemetry.sinks.archive import write_archive
from station_telemetry.sinks.documents import document_table
from station_telemetry.sinks.topics import file_writer, read_files
from station_telemetry.sources.archive import archive_scan, archive_stream
from station_telemetry.sources.status import landed_messages, landed_payloads
from station_telemetry.streaming import feeds
from station_telemetry.streaming.runs import Central, run_once, start, watch

MS = 1_704_067_200_000


def make_messages(spark, low, high):
    return spark.range(low, high).select(
        (F.col("id") % 3 + 1).cast("string").alias("key"),
        F.struct(
            (F.col("id") % 3 + 1).alias("stationId"),
            F.col("id").alias("sequenceNumber"),
            F.lit("MID").alias("batteryStatus"),
            (F.lit(MS) + F.col("id") * 60_000).alias("statusTimeStamp"),
            F.struct(
                (F.col("id") % 101).cast("int").alias("humidity"),
                F.lit(1.5).alias("temperature"),
                F.lit(2.5).alias("windSpeed"),
            ).alias("weatherStatus"),
        ).alias("value"),
        F.col("id").alias("offset"),
    )


@pytest.fixture
def landed(spark, tmp_path):
    path = str(tmp_path / "landed")
    for low in range(0, 400, 100):
        make_messages(spark, low, low + 100).coalesce(1).write.mode("append").parquet(path)
    return path


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_rain_stream_equals_batch_over_several_batches(spark, landed, tmp_path):
    out, checkpoint = str(tmp_path / "rain"), str(tmp_path / "checkpoint")
    stream = landed_messages(spark, landed, streaming=True, files_per_batch=1)
    query = start(file_writer(feeds.rain_feed(stream), out, checkpoint), "rain", once=True)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p.numInputRows]) == 4
    got = read_files(spark, out)
    want = feeds.rain_feed(spark.read.schema(STREAM).parquet(landed))
    assert rows(got) == rows(want) and got.count() > 0


def test_rain_is_stateless_and_pushed_to_the_scan(spark, landed):
    plan = rain_events(landed_messages(spark, landed))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(value.weatherStatus.humidity,70)" in plan and "Exchange" not in plan
    assert "ReadSchema: struct<key:string,value:struct<stationId:bigint,weatherStatus:struct<humidity:int>>>" in plan


def test_restart_continues_without_loss_or_copies(spark, landed, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def one_pass():
        run_once(file_writer(landed_messages(spark, landed, streaming=True), out, checkpoint), "copy")

    one_pass()
    make_messages(spark, 400, 450).coalesce(1).write.mode("append").parquet(landed)
    one_pass()
    one_pass()
    assert sorted(r.offset for r in read_files(spark, out).collect()) == list(range(450))


def test_latest_stream_and_table_equal_batch(spark, landed, tmp_path):
    want = rows(latest_status(landed_messages(spark, landed)).select("key", "value", "offset"))
    table = feeds.latest_table(spark, str(tmp_path / "latest"))
    stream = landed_messages(spark, landed, streaming=True, files_per_batch=1)
    run_once(feeds.latest_table_feed(stream, table, str(tmp_path / "c1")), "latest")
    assert rows(table.current().select("key", "value", "offset")) == want
    table.compact()
    assert rows(table.current().select("key", "value", "offset")) == want
    writer = (
        feeds.latest_feed(stream).writeStream.outputMode("complete").format("memory")
        .option("checkpointLocation", str(tmp_path / "c2"))
    )
    run_once(writer, "latest_in_memory")
    assert rows(spark.table("latest_in_memory")) == want


def test_archive_stream_equals_batch_archive(spark, landed, tmp_path):
    batch, streamed = str(tmp_path / "batch"), str(tmp_path / "streamed")
    write_archive(landed_messages(spark, landed).select("value.*"), batch)
    stream = landed_messages(spark, landed, streaming=True, files_per_batch=2)
    run_once(feeds.archive_feed(stream, streamed, str(tmp_path / "c")), "archive")
    assert rows(archive_scan(spark, streamed)) == rows(archive_scan(spark, batch))


def foreign_file(spark, folder, name, *records):
    """One Parquet file with a given name, as a foreign archive writer leaves it."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder.mkdir(parents=True, exist_ok=True)
    table = pa.Table.from_pylist(
        [
            {"stationId": s, "sequenceNumber": n, "batteryStatus": "LOW", "statusTimeStamp": MS,
             "weatherStatus": {"humidity": h, "temperature": 1.0, "windSpeed": 2.0}}
            for s, n, h in records
        ],
        schema=pa.schema([
            ("stationId", pa.int64()), ("sequenceNumber", pa.int64()), ("batteryStatus", pa.string()),
            ("statusTimeStamp", pa.int64()),
            ("weatherStatus", pa.struct([("humidity", pa.int32()), ("temperature", pa.float64()), ("windSpeed", pa.float64())])),
        ]),
    )
    pq.write_table(table, folder / name)


def test_ingest_of_a_foreign_archive(spark, tmp_path):
    root, checkpoint = tmp_path / "archive", str(tmp_path / "c")
    table = document_table(spark, str(tmp_path / "docs"))

    def one_pass(checkpoint=checkpoint):
        stream = archive_stream(spark, str(root), time_in_name=True)
        run_once(feeds.ingest_feed(stream, table, checkpoint), "ingest")

    def humidity():
        return {r.doc_id: r.weather.humidity for r in table.current().collect()}

    one_pass()  # the root does not exist yet
    assert humidity() == {}
    day = root / "station_id=1" / "date=2024-01-01"
    # The later stamp wins although that file is written first; an unfinished and a foreign
    # file are skipped; a row without a number is rejected.
    foreign_file(spark, day, "part-2000-b.parquet", (1, 1, 20), (1, 2, 20))
    foreign_file(spark, day, "part-1000-a.parquet", (1, 1, 10), (1, None, 10))
    foreign_file(spark, day, "part-3000-c.parquet.tmp", (1, 9, 30))
    foreign_file(spark, day, "other-1.parquet", (1, 8, 30))
    foreign_file(spark, day, "part-x-1.parquet", (1, 7, 30))
    one_pass()
    assert humidity() == {"1-1": 20, "1-2": 20}
    rejects = spark.read.option("recursiveFileLookup", True).parquet(f"{table.root}/rejects")
    assert rejects.count() == 1
    # Two more files share a stamp that was already seen: both come in, once.
    foreign_file(spark, day, "part-2000-d.parquet", (1, 3, 40))
    foreign_file(spark, day, "part-1500-e.parquet", (1, 4, 50))
    one_pass()
    one_pass()
    want = {"1-1": 20, "1-2": 20, "1-3": 40, "1-4": 50}
    assert humidity() == want and table.current().count() == 4
    # A new checkpoint ingests everything again and ends with the same documents.
    one_pass(checkpoint=str(tmp_path / "c-new"))
    assert humidity() == want and table.current().count() == 4


def test_a_bad_file_stops_the_run_and_progress_stays(spark, tmp_path):
    root, checkpoint = tmp_path / "archive", str(tmp_path / "c")
    table = document_table(spark, str(tmp_path / "docs"))
    day = root / "station_id=1" / "date=2024-01-01"

    def one_pass():
        run_once(feeds.ingest_feed(archive_stream(spark, str(root)), table, checkpoint), "ingest")

    foreign_file(spark, day, "part-1-a.parquet", (1, 1, 10))
    one_pass()
    (day / "part-2-b.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        one_pass()
    foreign_file(spark, day, "part-2-b.parquet", (1, 2, 10))
    one_pass()
    assert sorted(r.doc_id for r in table.current().collect()) == ["1-1", "1-2"]


def test_streaming_replay_dedup(spark, tmp_path):
    root = str(tmp_path / "archive")
    status = make_messages(spark, 0, 60).select("value.*")
    write_archive(status, root)
    write_archive(status, root)
    stream = normalize(archive_stream(spark, root, files_per_batch=2))
    out = str(tmp_path / "out")
    run_once(file_writer(drop_replays(stream, "1 day"), out, str(tmp_path / "c")), "dedup")
    assert sorted(r.s_no for r in read_files(spark, out).collect()) == list(range(60))


def test_central_runs_all_queries_and_each_sees_everything(spark, landed, tmp_path):
    central = Central(spark)
    for name in ("first", "second", "third"):
        stream = landed_messages(spark, landed, streaming=True)
        writer = file_writer(stream, str(tmp_path / name), str(tmp_path / f"c-{name}"))
        central.add(start(writer, name, once=True))
    central.finish()
    assert all(read_files(spark, str(tmp_path / n)).count() == 400 for n in ("first", "second", "third"))
    assert spark.streams.active == []


def test_central_stops_running_queries(spark, landed, tmp_path):
    central = Central(spark)
    stream = landed_messages(spark, landed, streaming=True)
    query = central.add(start(file_writer(stream, str(tmp_path / "o"), str(tmp_path / "c")), "q", interval=1))
    query.processAllAvailable()
    central.stop()
    assert not query.isActive and central.queries == []


def test_failures_are_logged(spark, tmp_path, caplog):
    source = tmp_path / "source"
    source.mkdir()
    (source / "part-1-a.parquet").write_bytes(b"not parquet")
    central = Central(spark)
    with caplog.at_level("INFO", logger="station_telemetry"):
        stream = landed_messages(spark, str(source), streaming=True)
        central.add(start(file_writer(stream, str(tmp_path / "o"), str(tmp_path / "c")), "failing", once=True))
        with pytest.raises(Exception):
            central.finish()
        deadline = time.time() + 20
        while "failed" not in caplog.text and time.time() < deadline:
            time.sleep(0.2)
    assert "query failing started" in caplog.text and "failed" in caplog.text


def test_watch_retries_after_a_failure(spark, landed, tmp_path):
    tries = []

    def make_writer():
        tries.append(1)
        source = str(tmp_path / "missing") if len(tries) == 1 else landed
        stream = landed_messages(spark, source, streaming=True)
        return file_writer(stream, str(tmp_path / "o"), str(tmp_path / "c"))

    def copied():
        try:
            return spark.read.parquet(str(tmp_path / "o")).count() == 400
        except Exception:
            return False

    watch(make_writer, "watched", interval=1, stop=copied)
    assert len(tries) >= 2 and copied()


def test_payload_numbers_go_on_across_batches(spark, tmp_path):
    landed, root, checkpoint = tmp_path / "landed", str(tmp_path / "root"), str(tmp_path / "c")
    landed.mkdir()

    def land(name, *times):
        lines = [t if t == "bad" else '{"current":{"time":"%s","temperature_2m":1.5}}' % t for t in times]
        (landed / name).write_text("\n".join(lines) + "\n")

    def one_pass(at=checkpoint):
        stream = landed_payloads(spark, str(landed), 100, streaming=True)
        run_once(feeds.payload_feed(stream, root, at), "payloads")

    def numbers():
        got = feeds.payload_readings(spark, root)
        return sorted((r.statusTimeStamp - MS, r.sequenceNumber) for r in got.collect())

    land("a.txt", "2024-01-01T00:00", "bad", "noon", "2024-01-01T00:01")
    one_pass()
    assert numbers() == [(0, 1), (60_000, 3)]
    land("b.txt", "2024-01-01T00:02", "2024-01-01T00:03")
    one_pass()
    one_pass()
    want = [(0, 1), (60_000, 3), (120_000, 4), (180_000, 5)]
    assert numbers() == want
    rejects = feeds.payload_readings(spark, root, "rejects")
    assert sorted(r.payload for r in rejects.collect())[0] == "bad" and rejects.count() == 2
    # A batch that failed after writing is run again: same start, same numbers.
    for mark in ("1", ".1.crc"):
        (tmp_path / "c" / "commits" / mark).unlink()
    one_pass()
    assert numbers() == want
    # A new checkpoint numbers everything again, and nothing appears twice.
    one_pass(str(tmp_path / "c-new"))
    assert numbers() == want
    messages = landed_messages(spark, f"{root}/messages").where("offset >= 1L << 44")
    assert sorted(r.value.sequenceNumber for r in messages.collect()) == [1, 3, 4, 5]


def test_latest_survives_a_new_checkpoint_after_compaction(spark, tmp_path):
    landed, table = str(tmp_path / "landed"), feeds.latest_table(spark, str(tmp_path / "latest"))

    def one_pass(checkpoint):
        stream = landed_messages(spark, landed, streaming=True)
        run_once(feeds.latest_table_feed(stream, table, str(tmp_path / checkpoint)), "latest")

    make_messages(spark, 0, 30).coalesce(1).write.mode("append").parquet(landed)
    one_pass("c1")
    table.compact()
    make_messages(spark, 30, 40).coalesce(1).write.mode("append").parquet(landed)
    one_pass("c2")
    assert sorted(r.offset for r in table.current().collect()) == [37, 38, 39]
    table.compact()
    table.vacuum()
    assert sorted(r.offset for r in table.current().collect()) == [37, 38, 39]


def test_files_with_old_times_are_read(spark, tmp_path):
    import os

    landed, out = tmp_path / "landed", str(tmp_path / "out")
    make_messages(spark, 0, 10).coalesce(1).write.parquet(str(landed))

    def one_pass():
        stream = landed_messages(spark, str(landed), streaming=True)
        run_once(file_writer(stream, out, str(tmp_path / "c")), "copy")

    one_pass()
    before = set(landed.glob("part-*"))
    make_messages(spark, 10, 20).coalesce(1).write.mode("append").parquet(str(landed))
    for f in set(landed.glob("part-*")) - before:
        os.utime(f, (1_500_000_000, 1_500_000_000))
    one_pass()
    assert sorted(r.offset for r in read_files(spark, out).collect()) == list(range(20))


def test_archive_after_a_retry_a_batch_write_and_a_new_checkpoint(spark, tmp_path):
    landed, root = str(tmp_path / "landed"), str(tmp_path / "archive")

    def one_pass(checkpoint):
        stream = landed_messages(spark, landed, streaming=True)
        run_once(feeds.archive_feed(stream, root, str(tmp_path / checkpoint)), "archive")

    def numbers():
        return sorted(r.sequenceNumber for r in archive_scan(spark, root).collect())

    make_messages(spark, 0, 30).coalesce(1).write.mode("append").parquet(landed)
    one_pass("c")
    for mark in ("0", ".0.crc"):
        (tmp_path / "c" / "commits" / mark).unlink()
    one_pass("c")
    assert numbers() == list(range(30))
    write_archive(make_messages(spark, 30, 40).select("value.*"), root)
    assert numbers() == list(range(40))
    make_messages(spark, 40, 50).coalesce(1).write.mode("append").parquet(landed)
    one_pass("c")
    assert numbers() == list(range(50))
    # A new checkpoint reads everything again and loses nothing: what was there comes twice.
    one_pass("c-new")
    assert numbers() == sorted([*range(50), *range(30), *range(40, 50)])
    per_folder = {}
    for f in (tmp_path / "archive").glob("*/*/*/*.parquet"):
        per_folder[f.parent] = per_folder.get(f.parent, 0) + 1
    assert max(per_folder.values()) == 1


def test_bad_text_reaches_neither_latest_nor_archive(spark, tmp_path):
    from station_telemetry.sources.status import decode_texts, landed_texts

    landed, data = str(tmp_path / "landed"), str(tmp_path)
    good = make_messages(spark, 0, 1).select("key", F.to_json("value").alias("value"), "offset")
    bad = spark.createDataFrame([("1", "bad", 5), (None, '{"stationId":1}', 6)], good.schema)
    good.unionByName(bad).coalesce(1).write.parquet(landed)
    messages, rejected = decode_texts(landed_texts(spark, landed, streaming=True))
    table = feeds.latest_table(spark, f"{data}/latest")
    run_once(feeds.latest_table_feed(messages, table, f"{data}/c1"), "latest")
    run_once(feeds.archive_feed(messages, f"{data}/archive", f"{data}/c2"), "archive")
    run_once(feeds.rejects_feed(rejected, messages, f"{data}/rejects", f"{data}/c3"), "rejects")
    assert [(r.key, r.offset) for r in table.current().collect()] == [("1", 0)]
    assert [r.sequenceNumber for r in archive_scan(spark, f"{data}/archive").collect()] == [0]
    assert sorted(r.offset for r in read_files(spark, f"{data}/rejects").collect()) == [5, 6]


def test_ingest_of_both_spellings(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from station_telemetry.schemas import ARCHIVE_MIXED

    root, table = tmp_path / "archive", document_table(spark, str(tmp_path / "docs"))
    day = root / "station_id=1" / "date=2024-01-01"
    foreign_file(spark, day, "part-1-a.parquet", (1, 1, 10))
    weather = {"humidity": 20, "temperature": 1.0, "wind_speed": 3.0}
    rows = [
        {"s_no": 2, "battery_status": "MID", "batteryStatus": "LOW", "status_timestamp": MS // 1000, "weather": weather},
        {"s_no": 3, "battery_status": None, "batteryStatus": "LOW", "status_timestamp": MS // 1000, "weather": None},
    ]
    pq.write_table(
        pa.Table.from_pylist(
            rows,
            schema=pa.schema(
                [
                    ("s_no", pa.int64()), ("battery_status", pa.string()), ("batteryStatus", pa.string()),
                    ("status_timestamp", pa.int64()),
                    ("weather", pa.struct([("humidity", pa.int32()), ("temperature", pa.float64()), ("wind_speed", pa.float64())])),
                ]
            ),
        ),
        day / "part-2-b.parquet",
    )
    stream = archive_stream(spark, str(root), ARCHIVE_MIXED)
    run_once(feeds.ingest_feed(stream, table, str(tmp_path / "c"), mixed=True), "ingest")
    got = {r.doc_id: (r.battery_status, r.weather.humidity, r.weather.wind_speed) for r in table.current().collect()}
    assert got == {"1-1": ("LOW", 10, 2.0), "1-2": ("MID", 20, 3.0), "1-3": (None, None, None)}


def test_a_column_of_nulls_is_there(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from station_telemetry.operators.documents import normalize, one_spelling
    from station_telemetry.schemas import ARCHIVE_MIXED
    from station_telemetry.sources.archive import archive_scan

    root = tmp_path / "archive"
    day = root / "station_id=1" / "date=2024-01-01"
    foreign_file(spark, day, "part-1-a.parquet", (1, 1, 10))
    snake = pa.struct([("humidity", pa.int32()), ("temperature", pa.float64()), ("wind_speed", pa.float64())])
    camel = pa.struct([("humidity", pa.int32()), ("temperature", pa.float64()), ("windSpeed", pa.float64())])
    both = pa.schema(
        [
            ("s_no", pa.int64()), ("battery_status", pa.string()), ("batteryStatus", pa.string()),
            ("status_timestamp", pa.int64()), ("statusTimeStamp", pa.int64()),
            ("weather", snake), ("weatherStatus", camel),
        ]
    )
    one = {"batteryStatus": "LOW", "statusTimeStamp": MS, "weatherStatus": {"humidity": 9, "temperature": 9.0, "windSpeed": 9.0}}
    nothing = {"humidity": None, "temperature": None, "wind_speed": None}
    pq.write_table(pa.Table.from_pylist([{"s_no": 2, **one}, {"s_no": 3, **one, "weather": nothing}], schema=both), day / "part-2-b.parquet")
    only_weather = pa.schema([f for f in both if f.name not in ("battery_status", "status_timestamp")])
    pq.write_table(pa.Table.from_pylist([{"s_no": 4, **one}, {"s_no": None, **one}], schema=only_weather), day / "part-3-c.parquet")
    pq.write_table(pa.Table.from_pylist([], schema=both), day / "part-4-d.parquet")

    documents = normalize(one_spelling(archive_scan(spark, str(root), ARCHIVE_MIXED)))
    got = {r.doc_id: (r.battery_status, r.status_timestamp, r.weather.humidity) for r in documents.collect()}
    seconds = MS // 1000
    assert got["1-2"] == got["1-3"] == (None, None, None)  # all its rows are null there, and stay null
    assert got["1-4"] == ("LOW", seconds, None)  # each column by itself
    assert got["1-1"][0] is not None and got["1-1"][2] == 10
    assert "Exchange" not in documents._jdf.queryExecution().toString()

    table = document_table(spark, str(tmp_path / "docs"))
    stream = archive_stream(spark, str(root), ARCHIVE_MIXED)
    run_once(feeds.ingest_feed(stream, table, str(tmp_path / "c"), mixed=True), "ingest")
    assert {r.doc_id: (r.battery_status, r.status_timestamp, r.weather.humidity) for r in table.current().collect()} == got
    rejected = read_files(spark, f"{table.root}/rejects").collect()
    assert [(r.battery_status, r.status_timestamp) for r in rejected] == [("LOW", MS)]
