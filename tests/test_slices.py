"""Two-level ordering against plain Python, with slices small enough to be crossed often."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from station_telemetry.operators import analytics, ordered, slices
from station_telemetry.operators.openmeteo import assign_sequence

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
NUMBERS = st.lists(st.tuples(st.integers(1, 3), st.integers(1, 60)), min_size=1, max_size=80)


def expected_numbers(rows):
    counts, out = {}, {}
    for key, order in sorted(rows):
        counts[key] = counts.get(key, 0) + 1
        out[(key, order)] = counts[key]
    return out


@FEW
@given(NUMBERS)
def test_number_rows_in_slices(spark, rows):
    rows = sorted(set(rows))
    df = spark.createDataFrame(rows, "k long, o long")
    got = slices.number_rows(df, ["k"], "o", "n", bits=3)
    assert {(r.k, r.o): r.n for r in got.collect()} == expected_numbers(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_number_rows_by_ranges(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([1, 1, 1, 2, None]), rng.randint(0, 5), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k long, t long, id long")
    got = ordered.number_rows(df, ["k"], ["t", "id"], "n", partitions=7)
    counts, want = {}, {}
    for k, t, i in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        counts[k] = counts.get(k, 0) + 1
        want[i] = counts[k]
    assert {r.id: r.n for r in got.collect()} == want


def test_running_sum_by_ranges(spark):
    rng = random.Random(3)
    rows = [(rng.choice("aab"), i, rng.randint(1, 9)) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, o long, w long")
    summed = ordered.running_sum(df, ["k"], ["o"], "w", "s", "all", partitions=6)
    got = {(r.k, r.o): r.s for r in summed.collect()}
    sums, want = {}, {}
    for k, o, w in rows:
        sums[k] = sums.get(k, 0) + w
        want[(k, o)] = sums[k]
    assert got == want
    assert {(r.k, r["all"]) for r in summed.collect()} == set(sums.items())


@FEW
@given(NUMBERS)
def test_gaps_match_missing_numbers(spark, rows):
    df = spark.createDataFrame(rows, "station_id long, s_no long")
    gaps = analytics.sequence_gaps(df)
    want = set()
    for station in {k for k, _ in rows}:
        have = {n for k, n in rows if k == station}
        want |= {(station, n) for n in range(1, max(have)) if n not in have}
    got = [(r.station_id, r.s_no) for r in analytics.missing_numbers(gaps).collect()]
    assert len(got) == len(want) and set(got) == want
    dropped = analytics.dropped_per_station(df).agg(F.sum("dropped")).first()[0]
    assert dropped == len(want)
    once = spark.createDataFrame(sorted(set(rows)), df.schema)
    assert analytics.dropped_per_station(once, unique=True).agg(F.sum("dropped")).first()[0] == len(want)
    assert analytics.sequence_gaps(once).agg(F.sum("missing")).first()[0] in (None, len(want))


def test_gap_example(spark):
    df = spark.createDataFrame([(1, 2), (1, 3), (1, 6), (1, 6)], "station_id long, s_no long")
    gaps = analytics.sequence_gaps(df).orderBy("missing_from").collect()
    assert [(g.missing_from, g.missing_to, g.missing) for g in gaps] == [(1, 1, 1), (4, 5, 2)]
    row = analytics.dropped_per_station(df).first()
    assert (row.expected, row.received, row.dropped, row.drop_rate) == (6, 3, 3, 0.5)


def test_long_gap_is_cut_into_steps(spark):
    df = spark.createDataFrame([(1, 1), (1, 200_000)], "station_id long, s_no long")
    missing = analytics.missing_numbers(analytics.sequence_gaps(df))
    row = missing.agg(F.count("*"), F.min("s_no"), F.max("s_no"), F.count_distinct("s_no")).first()
    assert tuple(row) == (199_998, 2, 199_999, 199_998)


@FEW
@given(st.lists(st.tuples(st.integers(1, 2), st.integers(1, 6)), min_size=1, max_size=60))
def test_epochs(spark, rows):
    df = spark.createDataFrame(
        [(k, n, i) for i, (k, n) in enumerate(rows)], "station_id long, s_no long, offset long"
    )
    last, epoch, want = {}, {}, {}
    for i, (k, n) in enumerate(rows):
        epoch[k] = epoch.get(k, 0) + (1 if n < last.get(k, 0) else 0)
        last[k] = n
        want[i] = epoch[k]
    got = analytics.with_epoch(df, bits=2)
    assert {r.offset: r.epoch for r in got.collect()} == want


def test_both_sequence_orders_agree(spark):
    df = spark.createDataFrame([(100, i, f"2024-01-01T00:{i:02d}") for i in range(40)],
                               "stationId long, id long, time string")
    by_id = {r.id: r.sequenceNumber for r in assign_sequence(df, ["id"], dense=True).collect()}
    by_time = {r.id: r.sequenceNumber for r in assign_sequence(df, ["time", "id"]).collect()}
    assert by_id == by_time == {i: i + 1 for i in range(40)}


def test_scratch_removes_written_tables(spark):
    from station_telemetry.files import child_names
    from station_telemetry.session import scratch, work_dir

    before = set(child_names(spark, work_dir(spark)))
    df = spark.range(20).selectExpr("id % 2 k", "id o")
    with scratch(spark):
        assert ordered.number_rows(df, ["k"], ["o"], "n").count() == 20
        assert set(child_names(spark, work_dir(spark))) != before
    assert set(child_names(spark, work_dir(spark))) == before


def test_a_sparse_order_is_spread_by_ranges(spark):
    """Times in milliseconds, far apart, are numbered by ranges: no window holds the station."""
    df = spark.range(3_000).selectExpr("100 stationId", "id * 600000 at")
    numbered = assign_sequence(df, ["at"])
    assert "_slice" not in numbered._jdf.queryExecution().analyzed().toString()
    assert numbered.where("sequenceNumber = at div 600000 + 1").count() == 3_000


def test_a_corrupt_number_far_ahead(spark):
    df = spark.createDataFrame([(1, 1), (1, 10**15)], "station_id long, s_no long")
    assert [g.missing for g in analytics.sequence_gaps(df).collect()] == [10**15 - 2]


def test_gaps_are_cut_level_by_level(spark, monkeypatch):
    monkeypatch.setattr(analytics, "EXPLODE_STEP", 4)
    df = spark.createDataFrame([(1, 1), (1, 200)], "station_id long, s_no long")
    missing = analytics.missing_numbers(analytics.sequence_gaps(df))
    assert sorted(r.s_no for r in missing.collect()) == list(range(2, 200))
