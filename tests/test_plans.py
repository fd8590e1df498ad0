"""Plans that must hold for hot keys: work is reduced or spread before any shuffle by key."""

from pyspark.sql import functions as F

from station_telemetry.operators import analytics, ranks, received, slices, state
from station_telemetry.session import written


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return [line.strip() for line in plan_of(df).splitlines() if "Exchange hashpartitioning" in line]


def test_latest_is_limited_before_the_shuffle(spark):
    log = spark.range(10).selectExpr("cast(id % 3 as string) key", "id value", "id offset")
    below_the_shuffle = plan_of(state.latest(log, "key", "offset")).split("Exchange")[1]
    assert "WindowGroupLimit" in below_the_shuffle and "Partial" in below_the_shuffle


def rows_shuffled(df):
    """Rows written to each shuffle of a query that has run."""
    plan = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        inner = node.getClass().getSimpleName()
        if inner == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if inner.endswith("QueryStageExec"):
            return walk(node.plan())
        if inner == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        for k in range(children.size()):
            walk(children.apply(k))

    walk(plan)
    return found


def test_no_shuffle_has_a_row_for_each_number(spark):
    """A hot station, copies and losses: bitmaps are combined in tasks before the shuffle."""
    rows = spark.range(0, 200_000, 1, 4).selectExpr("if(id % 3 = 0, id % 7, 1) station_id", "id div 2 + 1 s_no").where("s_no % 11 <> 4")
    for df in (analytics.dropped_per_station(rows), received.bitmaps(rows)):
        df.collect()
        assert rows_shuffled(df) and max(rows_shuffled(df)) <= 7 * 4 * 4
    gaps = analytics.sequence_gaps(rows)
    assert gaps.count() > 9_000
    gaps.collect()
    assert max(rows_shuffled(gaps), default=0) <= 7 * 4
    unique = analytics.dropped_per_station(rows, unique=True)
    assert len(exchanges(unique)) == 1 and "partial_count" in plan_of(unique)


def test_exact_ranks_neither_sort_nor_copy_the_values(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(ranks, "written", lambda df, label: kept.append(df) or written(df, label))
    rows = spark.range(0, 100_000, 1, 4).selectExpr("'s' series", "hash(id) / 7.0D v")
    summary = analytics.measurement_summary(rows, "series", "v")
    summary.collect()
    assert len(kept) < 6 and all(df.count() <= 3 for df in kept)
    assert all("rangepartitioning" not in plan_of(df) for df in [*kept, summary])


def test_aggregates_combine_before_the_shuffle(spark):
    documents = spark.range(10).selectExpr("cast(id % 3 as string) battery_status", "timestamp_millis(id) t", "id v")
    for df in (
        analytics.battery_distribution(documents),
        analytics.rate_per_window(documents, "t", "v"),
    ):
        assert "partial_count" in plan_of(df).split("Exchange hashpartitioning")[1]


def test_windows_over_rows_run_within_slices(spark):
    rows = spark.range(100).selectExpr("id % 1 k", "id o")
    numbered = plan_of(slices.number_rows(rows, ["k"], "o", "n", bits=4))
    for line in numbered.splitlines():
        if "row_number" in line and "Window" in line:
            assert "_slice" in line
    sizes = slices.cut(rows, "o", 4).groupBy("k", slices.SLICE).count()
    assert sizes.agg(F.max("count")).first()[0] == 16


def test_battery_shares_scan_one_column(spark, tmp_path):
    path = str(tmp_path / "documents")
    spark.range(10).selectExpr("'LOW' battery_status", "id s_no", "id v").write.parquet(path)
    plan = plan_of(analytics.battery_distribution(spark.read.parquet(path)))
    assert "ReadSchema: struct<battery_status:string>" in plan
