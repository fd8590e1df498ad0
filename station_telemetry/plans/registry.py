"""The named queries: each takes (spark, sf_dir) and returns a flat DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from station_telemetry import functions as fn
from station_telemetry.files import age_folder
from station_telemetry.operators import analytics, openmeteo, rain, ranks, received, state, wire
from station_telemetry.operators.documents import (
    decode_battery,
    normalize,
    replace_by_id,
    required_fields,
)
from station_telemetry.plans import readings as r
from station_telemetry.schemas import ARCHIVE_EPOCHS, ARCHIVE_MIXED, STATUS
from station_telemetry.session import new_folder, written
from station_telemetry.sinks.archive import archive_rows, write_archive
from station_telemetry.sinks.documents import document_table, ensure_target as create_target
from station_telemetry.sinks.export import export_csv, read_csv
from station_telemetry.sinks.topics import file_writer, read_files
from station_telemetry.sources.archive import archive_scan as scan, archive_stream as stream_archive
from station_telemetry.sources.status import (
    ANY_AGE,
    decode_texts,
    landed_messages,
    landed_payloads,
    landed_texts,
    timed,
)
from station_telemetry.streaming import feeds, intervals
from station_telemetry.streaming.runs import run_once

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        return build

    return register


def flat_status(df: DataFrame, *first: str, record: str | None = None) -> DataFrame:
    """STATUS columns with the weather fields side by side."""
    at = f"{record}." if record else ""
    return df.select(
        *first,
        *[F.col(f"{at}{n}").alias(n) for n in STATUS.names[:4]],
        *[F.col(f"{at}weatherStatus.{n}").alias(n) for n in STATUS["weatherStatus"].dataType.names],
    )


def flat_documents(df: DataFrame) -> DataFrame:
    return df.select(
        "doc_id",
        "station_id",
        "s_no",
        "battery_status",
        "status_timestamp",
        F.unix_millis("event_time").alias("event_millis"),
        "weather.humidity",
        "weather.temperature",
        "weather.wind_speed",
    )


# Sources


@query("status_stream")
def status_stream(spark, sf_dir):
    """Landed messages through the streaming source."""
    landed = r.land(r.messages(spark, sf_dir), "messages")
    out, checkpoint = new_folder(spark, "status"), new_folder(spark, "checkpoint")
    run_once(file_writer(landed_messages(spark, landed, streaming=True), out, checkpoint), "status")
    return flat_status(read_files(spark, out), "key", "offset", record="value")


@query("json_roundtrip")
def json_roundtrip(spark, sf_dir):
    encoded = wire.encode_json(r.messages(spark, sf_dir)).select("offset", "json")
    return flat_status(wire.decode_json(encoded), "offset", "json", record="value")


@query("archive_scan")
def archive_scan(spark, sf_dir):
    root = new_folder(spark, "archive")
    write_archive(r.readings(spark, sf_dir), root)
    return flat_status(scan(spark, root), "station_id", F.col("date").cast("string").alias("date"))


@query("incremental_ingest")
def incremental_ingest(spark, sf_dir):
    """The archive grows between passes, once by copies that carry an old time.

    After a compaction a new checkpoint takes everything again, and ends with the same documents.
    """
    rows = r.readings(spark, sf_dir)
    middle, late = 1_705_363_200_000, 1_706_400_000_000  # 2024-01-16 and 2024-01-28, in a month of events
    stamp = F.col("statusTimeStamp")
    root, checkpoint = new_folder(spark, "archive"), new_folder(spark, "checkpoint")
    table = document_table(spark, new_folder(spark, "documents"))

    def one_pass(at=checkpoint):
        run_once(feeds.ingest_feed(stream_archive(spark, root), table, at), "ingest")

    write_archive(rows.where(stamp < middle), root)
    one_pass()
    write_archive(rows.where((stamp >= middle) & (stamp < late)), root)
    one_pass()
    write_archive(rows.where(stamp >= late), root, batch="restored")
    age_folder(spark, root, "batch=restored", days=30)
    one_pass()
    table.compact()
    one_pass(new_folder(spark, "checkpoint"))
    return flat_documents(table.current())


@query("mixed_ingest")
def mixed_ingest(spark, sf_dir):
    """An archive whose files of view and error events are spelled in snake case.

    Those of error events hold both spellings, and nothing but nulls in the snake_case battery and
    weather: a column that is there counts, whatever it says.
    """
    rows = r.readings(spark, sf_dir)
    root, checkpoint = new_folder(spark, "archive"), new_folder(spark, "checkpoint")
    table = document_table(spark, new_folder(spark, "documents"))
    write_archive(rows.where("event_type NOT IN ('view', 'error')"), root)
    weather = F.col("weatherStatus")
    snake = [
        F.col("sequenceNumber").alias("s_no"),
        F.col("batteryStatus").alias("battery_status"),
        F.col("statusTimeStamp").alias("status_timestamp"),
        F.struct(
            weather["humidity"].alias("humidity"),
            weather["temperature"].alias("temperature"),
            weather["windSpeed"].alias("wind_speed"),
        ).alias("weather"),
    ]
    empty = [
        snake[0],
        F.lit(None).cast("string").alias("battery_status"),
        snake[2],
        F.when(F.lit(False), snake[3]).alias("weather"),
        "batteryStatus",
        "weatherStatus",
    ]
    for event, columns in (("view", snake), ("error", empty)):
        found, _ = archive_rows(rows.where(F.col("event_type") == event))
        (
            found.select(*columns, "station_id", "date", F.lit(f"snake-{event}").alias("batch"))
            .hint("rebalance", "station_id", "date")
            .write.mode("append")
            .partitionBy("station_id", "date", "batch")
            .parquet(root)
        )
    stream = stream_archive(spark, root, ARCHIVE_MIXED)
    run_once(feeds.ingest_feed(stream, table, checkpoint, mixed=True), "ingest")
    return flat_documents(table.current())


@query("file_timestamp")
def file_timestamp(spark, sf_dir):
    """Names as a foreign archive writer gives them, beside unfinished and foreign files."""
    millis, number = F.col("millis").cast("string"), F.col("event_id").cast("string")
    name = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("part-"), millis, F.lit("-"), number, F.lit(".parquet.tmp")))
        .when(F.col("event_type") == "view", F.concat(F.lit("other-"), number, F.lit(".parquet")))
        .otherwise(F.concat(F.lit("part-"), millis, F.lit("-"), number, F.lit(".parquet")))
    )
    return r.events(spark, sf_dir).select(name.alias("file_name")).withColumn(
        "file_millis", fn.file_timestamp(F.col("file_name"))
    )


# Sinks


@query("archive_write")
def archive_write(spark, sf_dir):
    """What a batch write left in each folder, from reading it back."""
    root = new_folder(spark, "archive")
    write_archive(r.readings(spark, sf_dir), root)
    return scan(spark, root).groupBy("station_id", F.col("date").cast("string").alias("date")).agg(
        F.count(F.lit(1)).alias("records"),
        F.sum("sequenceNumber").alias("number_sum"),
        F.sum("weatherStatus.humidity").alias("humidity_sum"),
    )


@query("archive_stream")
def archive_stream(spark, sf_dir):
    """Two streamed parts, the second with a new checkpoint, and one written by a batch job."""
    rows = r.messages(spark, sf_dir)
    root, part = new_folder(spark, "archive"), F.col("offset") % 3

    for k in (0, 1):
        landed = r.land(rows.where(part == k), "messages")
        stream = landed_messages(spark, landed, streaming=True)
        run_once(feeds.archive_feed(stream, root, new_folder(spark, "checkpoint")), "archive")
    write_archive(rows.where(part == 2).select("value.*"), root)
    return flat_status(scan(spark, root), "station_id", F.col("date").cast("string").alias("date"))


@query("doc_upsert")
def doc_upsert(spark, sf_dir):
    """A second batch corrects the documents of click events; a retry of it changes nothing."""
    table = document_table(spark, new_folder(spark, "documents"))
    arrived = F.struct(
        F.col("event_time").cast("bigint").alias("millis"),
        F.lit("events").alias("file"),
        F.col("offset").alias("row"),
    )
    docs = normalize(r.readings(spark, sf_dir), keep=("offset", "event_type")).withColumn("arrived", arrived)
    corrected = docs.where(F.col("event_type") == "click").withColumn(
        "weather", F.col("weather").withField("temperature", F.col("weather.temperature") + 1)
    )
    table.upsert(docs, table.position(0))
    table.compact()
    table.upsert(corrected, table.position(1))
    table.upsert(corrected, table.position(1))
    return flat_documents(table.current())


@query("ensure_target")
def ensure_target(spark, sf_dir):
    """A table created twice keeps the rows that were added in between."""
    path = new_folder(spark, "target")
    name = f"documents_{path.rsplit('-', 1)[1]}"
    create_target(spark, name, path)
    r.documents(spark, sf_dir).drop("offset").write.insertInto(name)
    create_target(spark, name, path)
    counted = written(spark.table(name).groupBy("station_id").agg(F.count(F.lit(1)).alias("documents")), "counted")
    spark.sql(f"DROP TABLE {name}")
    return counted


@query("snapshot_csv")
def snapshot_csv(spark, sf_dir):
    """Snapshot values among texts with blanks at their ends, quotes, line ends, nothing, and null."""
    live = state.view_all(state.latest_status(r.messages(spark, sf_dir, key="user_id")))
    kind = F.col("key").cast("int") % 5
    odd = (
        F.when(kind == 0, F.concat(F.lit("  a,"), F.col("key"), F.lit('"b" ')))
        .when(kind == 1, F.concat(F.col("key"), F.lit("\n second line")))
        .when(kind == 2, F.lit(""))
        .when(kind == 3, F.lit(None).cast("string"))
        .otherwise(F.col("value"))
    )
    path = export_csv(live.select("key", odd.alias("value")), new_folder(spark, "export"))
    return read_csv(spark, path)


@query("publish_frame")
def publish_frame(spark, sf_dir):
    return wire.publish_frame(r.messages(spark, sf_dir))


# Projections and filters


@query("rain_events")
def rain_events(spark, sf_dir):
    return rain.rain_events(r.messages(spark, sf_dir))


@query("rain_stream")
def rain_stream(spark, sf_dir):
    """Rain events as topic frames through the streaming query."""
    landed = r.land(r.messages(spark, sf_dir), "messages")
    out, checkpoint = new_folder(spark, "rain"), new_folder(spark, "checkpoint")
    stream = feeds.rain_feed(landed_messages(spark, landed, streaming=True))
    run_once(file_writer(stream, out, checkpoint), "rain")
    return read_files(spark, out)


@query("to_wire")
def to_wire(spark, sf_dir):
    """Producer-side readings carry whole numbers for temperature and wind."""
    weather = F.col("weatherStatus")
    whole = weather.withField("temperature", weather["temperature"].cast("int")).withField(
        "windSpeed", weather["windSpeed"].cast("int")
    )
    produced = r.readings(spark, sf_dir).withColumn("weatherStatus", whole)
    return flat_status(wire.to_wire(produced), "offset", record="value")


@query("openmeteo_to_status")
def openmeteo_to_status(spark, sf_dir):
    parsed, _ = openmeteo.parse_payloads(r.payloads(spark, sf_dir))
    mapped, _ = openmeteo.to_readings(openmeteo.assign_sequence(parsed, ["payload_id"], dense=True))
    return flat_status(mapped, "payload_id")


@query("assign_sequence")
def assign_sequence(spark, sf_dir):
    """Numbers by time, then payload: an order that is not one whole number."""
    parsed, _ = openmeteo.parse_payloads(r.payloads(spark, sf_dir))
    timed = parsed.select("stationId", "payload_id", F.col("message.current.time").alias("time"))
    return openmeteo.assign_sequence(timed, ["time", "payload_id"])


@query("normalize_status")
def normalize_status(spark, sf_dir):
    return flat_documents(r.documents(spark, sf_dir))


@query("required_fields")
def required_fields_query(spark, sf_dir):
    """Error events lose their station, view events their number."""
    kind = F.col("event_type")
    holed = r.readings(spark, sf_dir).select(
        "offset",
        F.when(kind != "error", F.col("stationId")).alias("stationId"),
        F.when(kind != "view", F.col("sequenceNumber")).alias("sequenceNumber"),
    )
    good, rejected = required_fields(holed)
    return good.withColumn("kept", F.lit(True)).unionByName(rejected.withColumn("kept", F.lit(False)))


@query("decode_battery")
def decode_battery_query(spark, sf_dir):
    stored = r.readings(spark, sf_dir).select(
        "offset", F.encode("batteryStatus", "UTF-8").alias("batteryStatus")
    )
    return stored.select("offset", decode_battery(stored, "batteryStatus").alias("battery_status"))


@query("classify_battery")
def classify_battery(spark, sf_dir):
    return r.events(spark, sf_dir).select(
        "event_id", fn.battery_from_fraction(F.col("k") / 100).alias("battery_status")
    )


# Keyed state


@query("latest_status")
def latest_status(spark, sf_dir):
    return state.latest_status(r.messages(spark, sf_dir)).select("key", "value", "offset")


@query("latest_status_stream")
def latest_status_stream(spark, sf_dir):
    """Continuously maintained snapshot, read from its table."""
    landed = r.land(r.messages(spark, sf_dir), "messages")
    table = feeds.latest_table(spark, new_folder(spark, "latest"))
    stream = landed_messages(spark, landed, streaming=True)
    run_once(feeds.latest_table_feed(stream, table, new_folder(spark, "checkpoint")), "latest")
    return table.current().select("key", "value", "offset")


def _texts(spark, sf_dir):
    """The feed as raw text; error events carry text that is cut short."""
    whole = wire.publish_frame(r.messages(spark, sf_dir)).columns
    rows = r.readings(spark, sf_dir)
    text = fn.record_json(F.struct(*STATUS.names))
    value = F.when(F.col("event_type") == "error", F.substring(text, 1, 20)).otherwise(text)
    return rows.select(F.col("stationId").cast("string").alias(whole[0]), value.alias(whole[1]), "offset")


@query("feed_rejects")
def feed_rejects(spark, sf_dir):
    """Broken texts of the feed, kept apart by the streaming query."""
    landed = r.land(_texts(spark, sf_dir), "texts")
    good, bad = decode_texts(landed_texts(spark, landed, streaming=True))
    out = new_folder(spark, "rejects")
    run_once(feeds.rejects_feed(bad, good, out, new_folder(spark, "checkpoint")), "rejects")
    return read_files(spark, out)


@query("feed_rejects_landed")
def feed_rejects_landed(spark, sf_dir):
    """Landed messages, clicks without a key and views without a reading; errors lack both."""
    rows = r.readings(spark, sf_dir)
    kind, whole = F.col("event_type"), F.struct(*STATUS.names)
    holed = rows.select(
        F.when(~kind.isin("click", "error"), F.col("stationId").cast("string")).alias("key"),
        F.when(~kind.isin("view", "error"), whole).alias("value"),
        "offset",
    )
    landed, out = r.land(holed, "messages"), new_folder(spark, "rejects")
    messages = landed_messages(spark, landed, streaming=True)
    run_once(feeds.rejects_feed(None, messages, out, new_folder(spark, "checkpoint")), "rejects")
    return read_files(spark, out)


@query("latest_of_texts")
def latest_of_texts(spark, sf_dir):
    """The latest readings of the same feed: a broken text never replaces a reading."""
    landed = r.land(_texts(spark, sf_dir), "texts")
    good, _ = decode_texts(landed_texts(spark, landed, streaming=True))
    table = feeds.latest_table(spark, new_folder(spark, "latest"))
    run_once(feeds.latest_table_feed(good, table, new_folder(spark, "checkpoint")), "latest")
    return table.current().select("key", "value", "offset")


@query("latest_over_partitions")
def latest_over_partitions(spark, sf_dir):
    """A topic whose partitions have changed: times tie, offsets lie around 2**20, batches come late.

    The second pass brings older messages of every key too, and one compaction lies in between.
    """
    rows, place = _texts(spark, sf_dir), F.call_function("div", F.col("offset"), F.lit(2))
    raw = rows.select(
        *rows.columns[:2],
        F.timestamp_millis(F.call_function("div", F.col("offset"), F.lit(64)) * 1000).alias("timestamp"),
        (F.col("offset") % 2).cast("int").alias("partition"),
        ((1 << 20) - 300 + place).alias("offset"),
        (F.col("offset") % 3 == 0).alias("late"),
    )
    landed, checkpoint = new_folder(spark, "records"), new_folder(spark, "checkpoint")
    table = feeds.latest_table(spark, new_folder(spark, "latest"), timed=True)
    for late in (False, True):
        raw.where(F.col("late") == late).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(raw.schema).option("maxFileAge", ANY_AGE).parquet(landed)
        good, _ = decode_texts(timed(stream))
        run_once(feeds.latest_table_feed(good, table, checkpoint), "latest")
        if not late:
            table.compact()
    return table.current().select("key", "value", "offset", "partition", "millis")


def _numbered_payloads(spark, sf_dir) -> str:
    """Payloads landed in three parts, each followed by a pass of the feed, which starts again each time.

    A part is range-sorted into several files, whose names follow the order of the events.
    """
    landed, root, checkpoint = new_folder(spark, "payloads"), new_folder(spark, "openmeteo"), new_folder(spark, "checkpoint")
    sent, number = r.payloads(spark, sf_dir), F.col("payload_id")
    for least, most in ((0, 3_000), (3_000, 7_000), (7_000, 1 << 62)):
        part = sent.where((number >= least) & (number < most))
        part.repartitionByRange("payload_id").sortWithinPartitions("payload_id").select("payload").write.mode(
            "append"
        ).text(landed)
        stream = landed_payloads(spark, landed, 100, streaming=True, by_name=True)
        run_once(feeds.payload_feed(stream, root, checkpoint), "payloads")
    return root


@query("payload_stream")
def payload_stream(spark, sf_dir):
    """From landed payload texts to the latest reading of their station, through both feeds."""
    root = _numbered_payloads(spark, sf_dir)
    table = feeds.latest_table(spark, new_folder(spark, "latest"))
    messages = landed_messages(spark, f"{root}/messages", streaming=True)
    run_once(feeds.latest_table_feed(messages, table, new_folder(spark, "checkpoint")), "latest")
    return table.current().select("key", "value", "offset")


@query("payload_numbers")
def payload_numbers(spark, sf_dir):
    """Every reading of the same feed: numbers go on over the passes, without gaps or copies."""
    return flat_status(feeds.payload_readings(spark, _numbered_payloads(spark, sf_dir)))


@query("get_status")
def get_status(spark, sf_dir):
    """Asks for fifteen station keys, ten of which exist."""
    asked = r.events(spark, sf_dir).select((F.col("user_id") % 15 + 1).cast("string").alias("key"))
    return state.get_many(asked.distinct(), state.latest_status(r.messages(spark, sf_dir)))


@query("get_one_status")
def get_one_status(spark, sf_dir):
    return state.get_status(state.latest_status(r.messages(spark, sf_dir)), "3")


@query("view_all")
def view_all(spark, sf_dir):
    return state.view_all(state.latest_status(r.messages(spark, sf_dir, key="user_id")))


@query("compact_latest")
def compact_latest(spark, sf_dir):
    live = state.compact(r.messages(spark, sf_dir, key="user_id"))
    return flat_status(live, "key", "offset", record="value")


@query("overwrite_stats")
def overwrite_stats(spark, sf_dir):
    log = r.messages(spark, sf_dir)
    return state.overwrite_stats(log, fn.record_json(F.col("value")))


@query("reconcile_snapshot")
def reconcile_snapshot(spark, sf_dir):
    """A snapshot that never saw error events, against the full one, per user."""
    rows = r.readings(spark, sf_dir)
    expected = written(state.latest_status(r.as_messages(rows, "user_id")), "expected")
    seen = rows.where(F.col("event_type") != "error")
    return state.reconcile(expected, written(state.latest_status(r.as_messages(seen, "user_id")), "actual"))


# Analyses


@query("archive_manifest")
def archive_manifest(spark, sf_dir):
    rows, _ = archive_rows(r.readings(spark, sf_dir))
    return analytics.archive_manifest(rows).withColumn("date", F.col("date").cast("string"))


@query("battery_distribution")
def battery_distribution(spark, sf_dir):
    docs = r.readings(spark, sf_dir).withColumnRenamed("batteryStatus", "battery_status")
    return analytics.battery_distribution(docs)


@query("dropped_per_station")
def dropped_per_station(spark, sf_dir):
    return analytics.dropped_per_station(r.documents(spark, sf_dir, lossy=True))


@query("dropped_per_epoch")
def dropped_per_epoch(spark, sf_dir):
    docs = r.restarted(r.documents(spark, sf_dir, lossy=True))
    return analytics.dropped_per_station(analytics.with_epoch(docs), by=("station_id", "epoch"))


@query("dropped_per_epoch_archive")
def dropped_per_epoch_archive(spark, sf_dir):
    """The same from an archive: counters restart in the second of three streamed passes."""
    rows = r.readings(spark, sf_dir, lossy=True)
    number = F.col("sequenceNumber")
    again = rows.withColumn("sequenceNumber", F.when(number > 400, number - 400).otherwise(number))
    sent = r.as_messages(again)
    landed, root, checkpoint = new_folder(spark, "messages"), new_folder(spark, "archive"), new_folder(spark, "checkpoint")
    for least, most in ((0, 3_000), (3_000, 7_000), (7_000, 1 << 62)):
        sent.where((F.col("offset") >= least) & (F.col("offset") < most)).write.mode("append").parquet(landed)
        stream = landed_messages(spark, landed, streaming=True)
        run_once(feeds.epoch_feed(stream, root, checkpoint), "epochs")
    docs = normalize(scan(spark, root, ARCHIVE_EPOCHS), keep=("epoch",))
    return analytics.dropped_per_station(docs, by=("station_id", "epoch"))


@query("sequence_gaps")
def sequence_gaps(spark, sf_dir):
    return analytics.sequence_gaps(r.documents(spark, sf_dir, lossy=True))


@query("gaps_of_batches")
def gaps_of_batches(spark, sf_dir):
    """Gaps from the bitmaps of four batches, kept apart and merged; the batches share numbers."""
    docs, kept = r.documents(spark, sf_dir, lossy=True), new_folder(spark, "bitmaps")
    for k in range(4):
        batch = docs.where((F.col("offset") % 4 == k) | (F.col("offset") % 5 == k))
        received.bitmaps(batch).write.parquet(f"{kept}/batch={k}")
    return received.gaps(received.merged(spark.read.parquet(kept).drop("batch")))


@query("gap_stream")
def gap_stream(spark, sf_dir):
    """Maintained gaps after three passes: late numbers, repeated ones, a restart before each pass.

    The first pass has even numbers only, so the second closes gaps and splits none; the third
    repeats numbers of both.
    """
    docs = r.documents(spark, sf_dir, lossy=True).select("station_id", "s_no")
    landed, checkpoint = new_folder(spark, "numbers"), new_folder(spark, "checkpoint")
    table = intervals.runs_table(spark, new_folder(spark, "ranges"))
    even = F.col("s_no") % 2 == 0
    for rows in (docs.where(even), docs.where(~even & (F.col("s_no") % 5 != 0)), docs.where((F.col("s_no") % 5 == 0) | (F.col("s_no") % 3 == 0))):
        rows.write.mode("append").parquet(landed)
        stream = spark.readStream.schema(docs.schema).option("maxFileAge", ANY_AGE).parquet(landed)
        run_once(intervals.gap_feed(stream, table, checkpoint, bits=10), "gaps")
    return intervals.gaps_of(table.current())


@query("missing_numbers")
def missing_numbers(spark, sf_dir):
    return analytics.missing_numbers(analytics.sequence_gaps(r.documents(spark, sf_dir, lossy=True)))


@query("drop_rate_total")
def drop_rate_total(spark, sf_dir):
    return analytics.drop_rate_total(analytics.dropped_per_station(r.documents(spark, sf_dir, lossy=True)))


@query("measurement_summary")
def measurement_summary(spark, sf_dir):
    summary = analytics.measurement_summary(r.events(spark, sf_dir), "event_type", "value")
    return summary.withColumn("mean", F.round("mean", 6))


@query("sketched_summary")
def sketched_summary(spark, sf_dir):
    """Percentiles from sketches of three batches, kept and merged, held against the rows themselves."""
    rows, kept = r.events(spark, sf_dir), new_folder(spark, "sketches")
    for k in range(3):
        ranks.sketches(rows.where(F.col("event_id") % 3 == k), "event_type", "value").write.parquet(f"{kept}/batch={k}")
    merged = written(ranks.merged(spark.read.parquet(kept), "event_type"), "merged")
    summary = ranks.summary_of(merged, "event_type", analytics.PERCENTILES)
    placed = rows.join(summary.withColumnRenamed("event_type", "of"), F.col("event_type") == F.col("of"))
    within = []
    for name, p in analytics.PERCENTILES.items():
        below, upto = F.avg((F.col("value") < F.col(name)).cast("int")), F.avg((F.col("value") <= F.col(name)).cast("int"))
        share = p / 100
        within.append(((below <= share + ranks.RANK_ERROR) & (upto >= share - ranks.RANK_ERROR)).alias(f"{name}_within"))
    held = placed.groupBy("event_type").agg(
        F.first("count").alias("count"), F.round(F.first("mean"), 6).alias("mean"), F.first("max").alias("max"), *within
    )
    return held


@query("rate_per_window")
def rate_per_window(spark, sf_dir):
    timed = r.events(spark, sf_dir).withColumn("event_time", F.col("ts").cast("timestamp"))
    return analytics.rate_per_window(timed, "event_time", "value").select(
        F.unix_millis("window_start").alias("window_start_millis"),
        "ops",
        "ops_per_sec",
        F.round("avg_value", 6).alias("avg_value"),
        "max_value",
    )


@query("dedup_documents")
def dedup_documents(spark, sf_dir):
    """Every file is delivered twice."""
    docs = r.documents(spark, sf_dir)
    again = docs.withColumn("offset", F.col("offset") + r.REPLAY_SHIFT)
    return flat_documents(replace_by_id(docs.unionByName(again), "offset"))


@query("dedup_stream")
def dedup_stream(spark, sf_dir):
    """Replays inside the bound and long after it, and readings that come too late for the first time.

    Errors of the first half month are held back until the last pass, when the newest reading is days
    past them.
    """
    docs = normalize(r.readings(spark, sf_dir), keep=("event_type",))
    middle = F.timestamp_millis(F.lit(1_705_363_200_000))
    early = F.col("event_time") < middle
    held = early & (F.col("event_type") == "error")
    landed, out, checkpoint = new_folder(spark, "delivered"), new_folder(spark, "documents"), new_folder(spark, "checkpoint")
    for rows in (docs.where(early & ~held), docs.where(~early).unionByName(docs.where(early & ~held)), docs):
        rows.write.mode("append").parquet(landed)
        stream = spark.readStream.schema(docs.schema).option("maxFileAge", ANY_AGE).parquet(landed)
        run_once(feeds.dedup_feed(stream, out, checkpoint), "dedup")
    return flat_documents(read_files(spark, out))
