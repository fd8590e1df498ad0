import csv
import glob
import random

import pytest
from pyspark.sql import functions as F

from station_telemetry.schemas import DOCUMENT
from station_telemetry.sinks import topics
from station_telemetry.sinks.archive import archive_rows, write_archive
from station_telemetry.sinks.documents import ensure_target
from station_telemetry.sinks.export import export_csv, read_csv
from station_telemetry.sinks.keyed import KeyedTable
from station_telemetry.sources import status
from station_telemetry.sources.archive import archive_scan
from station_telemetry.session import new_folder, shared_dir, sized_for
from pyspark.sql import types as T

MS = 1_704_153_599_999  # one millisecond before 2024-01-02


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_archive_layout_and_types(spark, status_rows, tmp_path):
    root = str(tmp_path / "archive")
    write_archive(status_rows((7, 1, 50, MS), (7, 2, 80, MS + 1), (None, 3, 5, MS)), root)
    folders = sorted(p[len(root) + 1:] for p in glob.glob(f"{root}/*/*"))
    assert folders == ["station_id=7/date=2024-01-01", "station_id=7/date=2024-01-02"]
    written = glob.glob(f"{root}/*/*/*/*")
    assert written and all(p.endswith(".snappy.parquet") for p in written)
    assert spark.read.parquet(f"{root}-rejects").count() == 1
    rows = archive_scan(spark, root)
    assert dict(rows.dtypes)["station_id"] == "bigint"
    assert sorted((r.stationId, r.station_id, str(r.date)) for r in rows.collect()) == [
        (7, 7, "2024-01-01"), (7, 7, "2024-01-02"),
    ]
    _, rejected = archive_rows(status_rows((None, 3, 5, MS)))
    assert rejected.count() == 1


def test_archive_scan_reads_only_what_is_asked(spark, status_rows, tmp_path):
    root = str(tmp_path / "archive")
    write_archive(status_rows((7, 1, 50, MS), (8, 2, 80, MS + 1)), root)
    asked = archive_scan(spark, root).where(
        "station_id = 7 and date = '2024-01-01' and weatherStatus.humidity > 70"
    ).select("weatherStatus.humidity")
    plan = plan_of(asked)
    assert "GreaterThan(weatherStatus.humidity,70)" in plan
    assert "ReadSchema: struct<weatherStatus:struct<humidity:int>>" in plan
    assert "PartitionFilters: [isnotnull(station_id" in plan and "date" in plan.split("PartitionFilters")[1]


def test_archive_splits_a_hot_folder(spark, tmp_path):
    """With a small target size, one folder's rows are written by several tasks."""
    rows = spark.range(400_000).select(
        F.lit(1).cast("long").alias("stationId"), F.col("id").alias("sequenceNumber"),
        F.lit("LOW").alias("batteryStatus"), F.lit(MS).alias("statusTimeStamp"),
        F.struct(F.lit(1).alias("humidity"), F.rand(1).alias("temperature"), F.rand(2).alias("windSpeed")).alias("weatherStatus"),
    )
    root = str(tmp_path / "hot")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_archive(rows.repartition(8), root)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(f"{root}/*/*/*/*.parquet")) > 1
    assert archive_scan(spark, root).count() == 400_000


def test_csv_quotes_and_bytes(spark, tmp_path):
    frame = spark.createDataFrame(
        [(bytearray(b"1"), bytearray(b'a,"b"')), (bytearray(b"2"), bytearray(b"\xff")), (bytearray(b"3"), bytearray(b"x\ny"))],
        "key binary, value binary",
    )
    path = export_csv(frame, str(tmp_path))
    want = {"1": 'a,"b"', "2": "0xFF", "3": "x\ny"}
    assert {r.key: r.value for r in read_csv(spark, path).collect()} == want
    plain = {}
    for part in glob.glob(f"{path}/*.csv"):
        with open(part, newline="") as f:
            plain |= {row["key"]: row["value"] for row in csv.DictReader(f)}
    assert plain == want


COLUMNS = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType()), T.StructField("o", T.LongType())])


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "table"), COLUMNS, "k", "o")


def live(table):
    return {r.k: r.v for r in table.current().collect()}


def test_keyed_table_upserts_and_compacts(spark, table):
    def batch(*rows):
        return spark.createDataFrame(rows, COLUMNS)

    assert live(table) == {} and table.compact() == -1
    table.upsert(batch(("a", 1, 9), ("b", 1, 1), ("b", 2, 2)), table.position(0))
    assert live(table) == {"a": 1, "b": 2}
    assert table.compact() == 0 and live(table) == {"a": 1, "b": 2}
    table.upsert(batch(("a", 3, 1), ("c", 3, 1)), table.position(1))
    table.upsert(batch(("a", 4, 1), ("c", 4, 1)), table.position(1))  # retry of the same batch
    assert live(table) == {"a": 4, "b": 2, "c": 4}
    assert table.compact() == 1 and table.compact() == 1
    assert live(table) == {"a": 4, "b": 2, "c": 4}
    table.upsert(batch(("b", 7, 1)), table.position(0, generation=1))
    assert live(table) == {"a": 4, "b": 7, "c": 4}


def test_keyed_table_equals_a_dictionary(spark, table):
    rng, want = random.Random(5), {}
    for position in range(6):
        rows = [(rng.choice("abcdef"), rng.randint(0, 99), order) for order in range(rng.randint(1, 6))]
        table.upsert(spark.createDataFrame(rows, COLUMNS), position)
        want.update({k: v for k, v, _ in rows})
        if rng.random() < 0.5:
            table.compact()
        if rng.random() < 0.3:
            table.vacuum()
        assert live(table) == want


def test_unfinished_writes_do_not_count(spark, table, tmp_path):
    table.upsert(spark.createDataFrame([("a", 1, 1)], COLUMNS), 0)
    table.compact()
    (tmp_path / "table" / "changes" / "position=1").mkdir(parents=True)
    (tmp_path / "table" / "snapshot" / "through=5").mkdir(parents=True)
    assert live(table) == {"a": 1} and table.compact() == 0


def test_few_changes_leave_the_snapshot_unshuffled(spark, table):
    table.upsert(spark.range(50_000).selectExpr("cast(id as string) k", "id v", "id o"), 0)
    table.compact()
    table.upsert(spark.createDataFrame([("1", -1, 0)], COLUMNS), 1)
    current = table.current()
    plan = plan_of(current)  # before AQE: planned so from the start
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    snapshot_side = plan.split("BroadcastHashJoin")[1].split("BroadcastExchange")[0]
    assert "FileScan" in snapshot_side and "Exchange" not in snapshot_side
    assert len(current.collect()) == 50_000


def test_many_changes_are_joined_by_shuffle(spark, table):
    table.upsert(spark.range(5_000).selectExpr("cast(id as string) k", "id v", "id o"), 0)
    table.compact()
    table.upsert(spark.range(4_000).selectExpr("cast(id as string) k", "-id v", "id o"), 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        current = table.current()
        assert "SortMergeJoin" in plan_of(current)
        rows = {r.k: r.v for r in current.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(rows) == 5_000 and rows["3999"] == -3_999 and rows["4000"] == 4_000


@pytest.mark.parametrize("by_order", [False, True])
def test_many_changes_are_sorted_in_small_tasks(spark, tmp_path, monkeypatch, by_order):
    """One file and a hot key, yet no task gets many more rows than it may sort."""
    monkeypatch.setattr("station_telemetry.sinks.keyed.TASK_ROWS", 500)
    table = KeyedTable(spark, str(tmp_path / "t"), COLUMNS, "k", "o", by_order=by_order)
    key = F.when(F.col("id") < 2_000, "hot").otherwise(F.col("id").cast("string"))
    rows = spark.range(0, 6_000, 1, 1).select(key.alias("k"), F.col("id").alias("v"), F.col("id").alias("o"))
    want = {"hot": 1_999, **{str(n): n for n in range(2_000, 6_000)}}
    for position in (0, 1):
        table.upsert(rows, position)
        parts = table.current().select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        assert len(parts) >= 8 and max(r["count"] for r in parts) < 1_000
        assert live(table) == want and table.current().count() == len(want)
        table.compact()
        assert live(table) == want
    assert table.lookup("hot").first().v == 1_999


def snapshots(tmp_path):
    found = glob.glob(str(tmp_path / "table" / "snapshot" / "*" / "bucket=*"))
    return sorted(tuple(p.split("/")[-2:]) for p in found)


def test_vacuum_keeps_the_live_rows(spark, table, tmp_path):
    for position in range(3):
        table.upsert(spark.createDataFrame([("a", position, 1), (str(position), 0, 1)], COLUMNS), position)
        table.compact()
    before, buckets = live(table), [b for _, b in snapshots(tmp_path)]
    assert len(buckets) > len(set(buckets))
    table.vacuum()
    assert live(table) == before
    buckets = [b for _, b in snapshots(tmp_path)]
    assert len(buckets) == len(set(buckets))  # one snapshot of each bucket is left
    assert glob.glob(str(tmp_path / "table" / "changes" / "*")) == []
    table.upsert(spark.createDataFrame([("a", 9, 1)], COLUMNS), 3)
    assert live(table) == {**before, "a": 9}


def test_compaction_rewrites_touched_buckets_only(spark, table, tmp_path):
    table.upsert(spark.range(500).selectExpr("cast(id as string) k", "id v", "id o"), 0)
    table.compact()
    first = set(snapshots(tmp_path))
    assert len(first) == 32
    table.upsert(spark.createDataFrame([("7", -7, 0)], COLUMNS), 1)
    table.compact()
    assert len(set(snapshots(tmp_path)) - first) == 1
    assert live(table) == {**{str(i): i for i in range(500)}, "7": -7}


def test_a_lookup_opens_one_bucket(spark, table):
    table.upsert(spark.range(500).selectExpr("cast(id as string) k", "id v", "id o"), 0)
    table.compact()
    table.upsert(spark.createDataFrame([("8", -8, 0)], COLUMNS), 1)
    assert [tuple(r) for r in table.lookup("7").collect()] == [("7", 7, 7)]
    assert [tuple(r) for r in table.lookup("8").collect()] == [("8", -8, 0)]
    assert table.lookup("none").collect() == []
    folders = {f.split("/")[-2] for f in table.lookup("7").inputFiles() if "snapshot" in f}
    assert len(folders) == 1


def test_old_snapshots_can_be_kept(spark, table):
    for position in range(3):
        table.upsert(spark.createDataFrame([("a", position, 1)], COLUMNS), position)
        table.compact()
    table.vacuum(keep=1)
    assert live(table) == {"a": 2}


def test_ensure_target_leaves_existing_rows(spark, tmp_path):
    path = str(tmp_path / "target")
    ensure_target(spark, "ensured", path)
    assert spark.table("ensured").schema.simpleString() == DOCUMENT.simpleString()
    spark.createDataFrame([("1-1", 1, 1, "LOW", 5, None, (1, 1.0, 1.0))], DOCUMENT).write.insertInto("ensured")
    ensure_target(spark, "ensured", path)
    assert spark.table("ensured").count() == 1


def test_topic_settings():
    assert status.kafka_options("broker:9092", flush_policy=True) == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "stations-status",
        "startingOffsets": "earliest", "minOffsetsPerTrigger": "10000", "maxTriggerDelay": "30s",
    }
    assert topics.topic_options("b", "t", **topics.PUBLISH_OPTIONS) == {
        "kafka.bootstrap.servers": "b", "topic": "t", "kafka.acks": "0", "kafka.retries": "0",
    }


def test_decode_of_raw_records(spark):
    raw = spark.createDataFrame(
        [
            (bytearray(b"1"), bytearray(b'{"stationId":1,"weatherStatus":{"humidity":71}}'), 5),
            (bytearray(b"1"), bytearray(b"bad"), 6),
            (bytearray(b"2"), None, 7),
        ],
        "key binary, value binary, offset long",
    )
    good, bad = status.decode_texts(raw)
    rows = {r.offset: r for r in good.collect()}
    assert sorted(rows) == [5, 7] and rows[7].value is None
    assert (rows[5].key, rows[5].value.stationId, rows[5].value.weatherStatus.humidity) == ("1", 1, 71)
    assert [tuple(r) for r in bad.collect()] == [("1", "bad", 6)]


def test_order_across_partitions(spark):
    """Time, then partition, then offset, also where 2**20 offsets share a millisecond."""
    rows = [("a", 10, 0, 1 << 20), ("b", 10, 0, (1 << 20) - 1), ("c", 10, 1, 3), ("d", 11, 0, 0), ("e", 9, 5, 1 << 40)]
    raw = spark.createDataFrame(rows, "value string, ms long, partition int, offset long").withColumn("timestamp", F.timestamp_millis("ms"))
    messages = status.decode(status.timed(raw.withColumn("key", F.lit("k"))), F.col("value"))
    placed = messages.orderBy("millis", "partition", "offset").collect()
    assert [r.value for r in placed] == ["e", "b", "a", "c", "d"]
    assert "millis" not in status.decode(raw.withColumn("key", F.lit("k")), F.col("value")).columns


def test_a_late_batch_of_older_rows_changes_nothing(spark, tmp_path):
    """By order, whichever batch or snapshot the newest row is in."""
    columns = T.StructType([T.StructField("key", T.StringType()), T.StructField("v", T.StringType()), T.StructField("t", T.LongType()), T.StructField("o", T.LongType())])
    table = KeyedTable(spark, str(tmp_path / "t"), columns, "key", ("t", "o"), by_order=True)
    table.upsert(spark.createDataFrame([("a", "new", 5, 1), ("b", "old", 1, 1), ("c", "only", None, 7)], columns), 0)
    table.compact()
    table.upsert(spark.createDataFrame([("a", "late", 4, 9), ("b", "new", 1, 2), ("c", "timed", 0, 0)], columns), 1)
    want = {"a": "new", "b": "new", "c": "timed"}
    assert {r.key: r.v for r in table.current().collect()} == want
    assert table.lookup("a").first().v == "new"
    table.compact()
    assert {r.key: r.v for r in table.current().collect()} == want


def test_rain_can_be_encoded(spark):
    """Avro needs its module, so the plan with another encoding stands for it."""
    from station_telemetry.streaming import feeds

    messages = spark.createDataFrame([], "key string, value struct<stationId:long,weatherStatus:struct<humidity:int>>")
    encoded = feeds.rain_feed(messages, F.concat(F.unhex(F.lit("0000000001")), F.encode(F.col("stationId").cast("string"), "UTF-8")))
    assert encoded.schema["value"].dataType == T.BinaryType()


def test_csv_keeps_blanks_nothing_and_null(spark, tmp_path):
    rows = [("1", " a b "), ("2", ""), ("3", None), ("4", "x"), ("5", "\t")]
    path = export_csv(spark.createDataFrame(rows, "key string, value string"), str(tmp_path))
    assert sorted(map(tuple, read_csv(spark, path).collect())) == rows


def test_archive_batch_is_replaced_by_its_retry(spark, status_rows, tmp_path):
    root = str(tmp_path / "archive")
    write_archive(status_rows((7, 1, 50, MS), (7, 2, 80, MS)), root, batch="b")
    write_archive(status_rows((7, 1, 50, MS), (7, 2, 80, MS)), root, batch="b")
    write_archive(status_rows((7, 3, 50, MS)), root)
    assert sorted(r.sequenceNumber for r in archive_scan(spark, root).collect()) == [1, 2, 3]


def test_sizing_grows_with_the_input():
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert [sized_for(n * 2**40)[name] for n in (0, 1, 100, 10_000)] == ["200", "1024", "102400", "10240000"]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_new_numbers_touch_their_ranges_only(spark, tmp_path):
    from station_telemetry.sinks.documents import RANGE_NUMBERS, document_table

    root = str(tmp_path / "docs")
    table = document_table(spark, root)

    def add(position, *numbers, battery="LOW"):
        rows = [
            (f"{station}-{n}", station, n, battery, 0, None, None, (position, "f", n)) for station, n in numbers
        ]
        table.upsert(spark.createDataFrame(rows, table.columns), position)

    def folders():
        found = glob.glob(f"{root}/snapshot/*/bucket=*")
        return {tuple(f.split("/")[-2:]) for f in found}

    add(0, *[(station, n) for station in (1, 2) for n in (-1, 0, 5, RANGE_NUMBERS - 1, RANGE_NUMBERS)])
    table.compact()
    first = folders()
    assert {b for _, b in first} == {f"bucket={s}-{r}" for s in (1, 2) for r in (-1, 0, 1)}
    add(1, *[(1, RANGE_NUMBERS + n) for n in range(300)])
    table.compact()
    assert {b for _, b in folders() - first} == {"bucket=1-1"}
    second = folders()
    add(2, (2, 5), battery="HIGH")  # an old number goes to its own range
    table.compact()
    assert {b for _, b in folders() - second} == {"bucket=2-0"}
    table.vacuum()
    assert len(folders()) == 6
    live_rows = {r.doc_id: r.battery_status for r in document_table(spark, root).current().collect()}
    assert len(live_rows) == 10 + 299 and live_rows["2-5"] == "HIGH" and live_rows["1-5"] == "LOW"
    found = table.lookup(f"1-{RANGE_NUMBERS + 7}")
    assert found.count() == 1 and len({f.split("/")[-2] for f in found.inputFiles()}) == 1
    assert table.lookup("elsewhere").count() == 0


def test_a_table_keeps_its_way_of_dealing_keys(spark, tmp_path):
    from station_telemetry.sinks.documents import document_table, number_range

    rows = spark.createDataFrame([("1-1", 1, 1, "LOW", 0, None, None, (0, "f", 0))], document_table(spark, "x").columns)
    old = KeyedTable(spark, str(tmp_path / "old"), rows.schema, "doc_id", "arrived")
    old.upsert(rows, 0)
    old.compact()
    again = document_table(spark, str(tmp_path / "old"))
    again.upsert(rows.withColumn("battery_status", F.lit("HIGH")), 1)
    again.compact()
    assert [r.battery_status for r in again.current().collect()] == ["HIGH"]
    new = document_table(spark, str(tmp_path / "new"))
    new.upsert(rows, 0)
    new.compact()
    with pytest.raises(ValueError, match="range_of"):
        KeyedTable(spark, str(tmp_path / "new"), rows.schema, "doc_id", "arrived").lookup("1-1")
    odd = spark.createDataFrame([("1-1",), ("a-b",), (None,), ("1-99999999999999999999",)], "k string")
    assert [r[0] for r in odd.select(number_range(F.col("k"))).collect()] == ["1-0", "other", "other", "other"]
