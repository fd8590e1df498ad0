"""Streams with state: maintained gaps, replay dedup, epochs in the archive."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from station_telemetry.operators import analytics
from station_telemetry.schemas import ARCHIVE_EPOCHS, STREAM
from station_telemetry.sources.archive import archive_scan
from station_telemetry.sources.status import ANY_AGE, landed_messages
from station_telemetry.streaming import feeds, intervals
from station_telemetry.streaming.runs import run_once, start

MS = 1_704_067_200_000
NUMBERS = "station_id long, s_no long"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 60), st.integers(0, 9)), min_size=1, max_size=20))
def test_joined_runs_cover_the_same_numbers(runs):
    firsts = np.array([f for f, _ in runs])
    lasts = np.array([f + n for f, n in runs])
    got = list(zip(*(a.tolist() for a in intervals.joined_runs(firsts, lasts))))
    assert {n for f, t in got for n in range(f, t + 1)} == {n for f, k in runs for n in range(f, f + k + 1)}
    assert all(b > t + 1 for (_, t), (b, _) in zip(got, got[1:]))


def passes(spark, tmp_path, schema, writer, *batches):
    """Lands each batch, then runs the query from its checkpoint."""
    landed = str(tmp_path / "landed")
    for rows in batches:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(schema).option("maxFileAge", ANY_AGE).parquet(landed)
        run_once(writer(stream), "pass")
        yield


def gaps_in(table):
    return sorted(tuple(r) for r in intervals.gaps_of(table.current()).collect())


def test_late_numbers_split_and_close_gaps(spark, tmp_path):
    table = intervals.runs_table(spark, str(tmp_path / "ranges"))
    batches = [
        [(1, 1), (1, 10), (1, 21), (2, 3), (None, 5), (1, None), (1, 0), (1, -4)],
        [(1, 5), (1, 10), (1, 20), (1, 40), (2, 1), (2, 2)],
        [(1, n) for n in range(2, 5)] + [(1, 6), (1, 7), (1, 8), (1, 9), (1, 21)],
    ]
    run = passes(spark, tmp_path, NUMBERS, lambda s: intervals.gap_feed(s, table, str(tmp_path / "c"), bits=4), *batches)
    next(run)
    assert gaps_in(table) == [(1, 2, 9, 8), (1, 11, 20, 10), (2, 1, 2, 2)]
    next(run)
    assert gaps_in(table) == [(1, 2, 4, 3), (1, 6, 9, 4), (1, 11, 19, 9), (1, 22, 39, 18)]
    next(run)
    assert gaps_in(table) == [(1, 11, 19, 9), (1, 22, 39, 18)]


def test_maintained_gaps_are_those_of_the_rows(spark, tmp_path):
    """Random arrivals over many ranges, and a new checkpoint that reads everything again."""
    rng = np.random.default_rng(3)
    rows = [(int(k), int(n)) for k, n in zip(rng.integers(1, 3, 900), rng.integers(1, 2_000, 900))]
    table = intervals.runs_table(spark, str(tmp_path / "ranges"))
    for _ in passes(spark, tmp_path, NUMBERS, lambda s: intervals.gap_feed(s, table, str(tmp_path / "c"), bits=5), rows[:500], rows[400:]):
        pass
    want = sorted(tuple(r) for r in analytics.sequence_gaps(spark.createDataFrame(rows, NUMBERS)).collect())
    assert gaps_in(table) == want
    stream = spark.readStream.schema(NUMBERS).option("maxFileAge", ANY_AGE).parquet(str(tmp_path / "landed"))
    run_once(intervals.gap_feed(stream, table, str(tmp_path / "new"), bits=5), "again")
    assert gaps_in(table) == want


def test_replays_pass_once_and_state_is_bounded(spark, tmp_path):
    schema, out = "station_id long, s_no long, event_time timestamp", str(tmp_path / "out")
    landed, checkpoint = str(tmp_path / "landed"), str(tmp_path / "c")

    def deliver(*rows):
        at = [(k, n, MS // 1000 + minute * 60) for k, n, minute in rows]
        frame = spark.createDataFrame(at, "station_id long, s_no long, s long").select("station_id", "s_no", F.timestamp_seconds("s").alias("event_time"))
        frame.coalesce(1).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(schema).option("maxFileAge", ANY_AGE).parquet(landed)
        query = start(feeds.dedup_feed(stream, out, checkpoint), "dedup", once=True)
        query.awaitTermination()
        states = [p.stateOperators[0] for p in query.recentProgress if p.stateOperators]
        return states[-1].numRowsTotal, sum(s.numRowsDroppedByWatermark for s in states)

    assert deliver((1, 1, 0), (1, 2, 10), (1, 1, 0), (2, 1, 10)) == (3, 0)
    assert deliver((1, 1, 0), (1, 2, 10), (1, 3, 30))[1] == 0
    state, late = deliver((1, 9, 600))
    assert late == 0 and state == 1  # what the newest reading has left behind is forgotten
    assert deliver((1, 1, 0), (1, 4, 500), (1, 9, 600), (1, 8, 545)) == (2, 2)
    kept = sorted((r.station_id, r.s_no) for r in spark.read.parquet(out).collect())
    assert kept == [(1, 1), (1, 2), (1, 3), (1, 8), (1, 9), (2, 1)]


def test_epochs_go_on_from_batch_to_batch(spark, tmp_path):
    """Resets inside a batch, between batches, of one station only; and a lost checkpoint."""

    def message(station, number, offset):
        reading = None if number is None and station is None else (station, number, "LOW", MS, (1, 1.0, 1.0))
        return (str(station), reading, offset)

    batches = [
        [message(1, 1, 0), message(1, 2, 1), message(1, 1, 2), message(2, 5, 3), message(3, None, 4), message(None, None, 5)],
        [message(1, 2, 6), message(1, 3, 7), message(2, 1, 8), message(2, 2, 9)],
        [],
        [("9", None, 99)],
        [message(1, 1, 10), message(1, 1, 11), message(2, 3, 12)],
    ]
    root, landed = str(tmp_path / "archive"), str(tmp_path / "landed")

    def epochs():
        rows = archive_scan(spark, root, ARCHIVE_EPOCHS).select("stationId", "offset", "epoch").distinct().collect()
        return {(r.stationId, r.offset): r.epoch for r in rows}

    want = {(1, 0): 0, (1, 1): 0, (1, 2): 1, (2, 3): 0, (3, 4): None, (1, 6): 1, (1, 7): 1, (2, 8): 1, (2, 9): 1}
    want |= {(1, 10): 2, (1, 11): 2, (2, 12): 1}
    for rows in batches:
        spark.createDataFrame(rows, STREAM).write.mode("append").parquet(landed)
        run_once(feeds.epoch_feed(landed_messages(spark, landed, streaming=True), root, str(tmp_path / "c")), "epochs")
    assert epochs() == want
    run_once(feeds.epoch_feed(landed_messages(spark, landed, streaming=True), root, str(tmp_path / "new")), "epochs")
    assert epochs() == want
