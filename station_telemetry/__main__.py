"""Command line.

    python -m station_telemetry central  --messages DIR | --servers HOST:PORT  --data DIR [--once]
    python -m station_telemetry ingest   --archive DIR --documents DIR --checkpoint DIR [--mixed] (--once | --watch)
    python -m station_telemetry payloads --payloads DIR --data DIR (--once | --watch)
    python -m station_telemetry compact  (--data DIR | --documents DIR) [--vacuum]
    python -m station_telemetry view     --data DIR --key KEY
    python -m station_telemetry view-all --data DIR --out DIR
"""

from __future__ import annotations

import argparse
import logging
import signal
import sys

from pyspark.sql import functions as F

from station_telemetry.files import exists
from station_telemetry.operators.openmeteo import OPENMETEO_STATION
from station_telemetry.operators.state import view_all
from station_telemetry.schemas import ARCHIVE, ARCHIVE_MIXED
from station_telemetry.session import build_session, sized_for
from station_telemetry.sinks.documents import document_table
from station_telemetry.sinks.export import export_csv
from station_telemetry.sinks.topics import file_writer, rain_avro, topic_writer
from station_telemetry.sources import status
from station_telemetry.sources.archive import archive_stream, unexpected_files
from station_telemetry.streaming import feeds
from station_telemetry.streaming.runs import (
    DEFAULT_INTERVAL_SECONDS,
    Central,
    run_once,
    start,
    watch,
)

POLL_SECONDS = 600  # fixed value: how often third-party payloads come in
COMPACT_EVERY = 100

log = logging.getLogger("station_telemetry")


def central(spark, args) -> int:
    """Rain events, latest readings, archive and rejects, each with its own checkpoint."""
    if args.messages and args.avro:
        raise SystemExit("landed messages hold decoded records: --avro goes with --servers")

    def stream(flush_policy: bool = False):
        """(messages, rejected texts or None): only texts can be undecodable; such Avro ends the query."""
        if args.messages:
            return status.landed_messages(spark, args.messages, streaming=True), None
        raw = status.subscribe(spark, status.kafka_options(args.servers, flush_policy=flush_policy))
        raw = status.timed(raw) if args.order_by_time else raw
        if args.avro:
            return status.decode(raw, status.avro_value(F.col("value"))), None
        return status.decode_texts(raw)

    def checkpoint(name: str) -> str:
        return f"{args.data}/checkpoints/{name}"

    rain = feeds.rain_feed(stream()[0], rain_avro(args.rain_schema_id) if args.avro else None)
    rain_writer = (
        topic_writer(rain, args.servers, checkpoint("rain"))
        if args.servers
        else file_writer(rain, f"{args.data}/rain", checkpoint("rain"))
    )
    table = feeds.latest_table(spark, f"{args.data}/latest", timed=args.order_by_time)
    interval = DEFAULT_INTERVAL_SECONDS if args.messages else None
    latest = feeds.latest_table_feed(stream()[0], table, checkpoint("latest"), args.compact_every)
    archive = feeds.archive_feed(stream(flush_policy=True)[0], f"{args.data}/archive", checkpoint("archive"))
    runs = Central(spark)
    runs.add(start(rain_writer, "rain", args.once, interval))
    # A batch leaves a folder of changes, so batches follow an interval whatever the source.
    runs.add(start(latest, "latest", args.once, DEFAULT_INTERVAL_SECONDS))
    runs.add(start(archive, "archive", args.once, interval))
    messages, rejected = stream()
    rejects = feeds.rejects_feed(rejected, messages, f"{args.data}/rejects", checkpoint("rejects"))
    runs.add(start(rejects, "rejects", args.once, DEFAULT_INTERVAL_SECONDS))
    runs.finish() if args.once else runs.run()
    return 0


def ingest(spark, args) -> int:
    """New archive files into the document table."""
    table = document_table(spark, args.documents)

    def writer():
        rows = archive_stream(
            spark,
            args.archive,
            ARCHIVE_MIXED if args.mixed else ARCHIVE,
            files_per_batch=args.files_per_batch,
            time_in_name=args.time_in_name,
        )
        return feeds.ingest_feed(rows, table, args.checkpoint, args.mixed, args.compact_every)

    if exists(spark, args.archive):
        for row in unexpected_files(spark, args.archive).take(20):
            log.warning("not an archive file, passed over: %s", row.file)
    run_once(writer(), "ingest") if args.once else watch(writer, "ingest", args.interval)
    return 0


def payloads(spark, args) -> int:
    """Landed third-party payloads as numbered readings."""

    def writer():
        landed = status.landed_payloads(spark, args.payloads, args.station, streaming=True)
        return feeds.payload_feed(landed, args.data, f"{args.data}/checkpoint")

    run_once(writer(), "payloads") if args.once else watch(writer, "payloads", args.interval)
    return 0


def compact(spark, args) -> int:
    """Rewrites a table as one row per key; --vacuum then removes what that replaces."""
    table = (
        document_table(spark, args.documents)
        if args.documents
        else feeds.latest_table(spark, f"{args.data}/latest")
    )
    table.compact()
    if args.vacuum:
        table.vacuum()
    return 0


def view(spark, args) -> int:
    """The latest reading of one station."""
    found = feeds.latest_table(spark, f"{args.data}/latest").lookup(args.key).first()
    if found is None or found.value is None:
        print(f"no station {args.key} has reported yet", file=sys.stderr)
        return 1
    print(found.value)
    return 0


def export(spark, args) -> int:
    """The latest reading of every station as CSV."""
    snapshot = view_all(feeds.latest_table(spark, f"{args.data}/latest").current())
    path = export_csv(snapshot, args.out)
    print(f"{snapshot.count()} stations exported: {path}")
    return 0


def parse(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="station_telemetry")
    parser.add_argument("--input-gb", type=int, default=0, help="expected size of a batch, to size shuffles")
    commands = parser.add_subparsers(required=True)

    def command(name: str, run, *paths: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=run.__doc__)
        sub.set_defaults(run=run)
        for path in paths:
            sub.add_argument(f"--{path}", required=True)
        return sub

    sub = command("central", central, "data")
    source = sub.add_mutually_exclusive_group(required=True)
    source.add_argument("--messages", help="folder of landed messages")
    source.add_argument("--servers", help="Kafka servers")
    sub.add_argument("--avro", action="store_true", help="messages are registry-framed Avro")
    sub.add_argument("--rain-schema-id", type=int, default=1, help="registry id of rain events, with --avro")
    sub.add_argument("--order-by-time", action="store_true", help="the topic's partitions have changed")
    sub.add_argument("--compact-every", type=int, default=COMPACT_EVERY, help="batches between compactions")
    sub.add_argument("--once", action="store_true")

    def once_or_watch(sub: argparse.ArgumentParser, interval: int) -> None:
        mode = sub.add_mutually_exclusive_group(required=True)
        mode.add_argument("--once", action="store_true")
        mode.add_argument("--watch", action="store_true")
        sub.add_argument("--interval", type=int, default=interval)

    sub = command("payloads", payloads, "payloads", "data")
    sub.add_argument("--station", type=int, default=OPENMETEO_STATION)
    once_or_watch(sub, POLL_SECONDS)

    sub = command("ingest", ingest, "archive", "documents", "checkpoint")
    once_or_watch(sub, DEFAULT_INTERVAL_SECONDS)
    sub.add_argument("--mixed", action="store_true", help="files may spell columns in snake case")
    sub.add_argument("--compact-every", type=int, default=COMPACT_EVERY, help="batches between compactions")
    sub.add_argument("--files-per-batch", type=int, help="1: progress stops at the bad file")
    sub.add_argument("--time-in-name", action="store_true", help="files carry their flush time")

    sub = command("compact", compact)
    which = sub.add_mutually_exclusive_group(required=True)
    which.add_argument("--data", help="data folder of central, for its latest readings")
    which.add_argument("--documents", help="document table")
    sub.add_argument("--vacuum", action="store_true")

    command("view", view, "data", "key")
    command("view-all", export, "data", "out")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = parse(argv)
    logging.basicConfig(level=logging.INFO, format="%(levelname)s %(asctime)s %(name)s: %(message)s")
    signal.signal(signal.SIGTERM, lambda *_: sys.exit(0))  # unwinds, so queries are stopped
    return args.run(build_session(**sized_for(args.input_gb << 30)), args)


if __name__ == "__main__":
    sys.exit(main())
