"""Session defaults and the shared folder for data that must outlive a task."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from station_telemetry import files

# UTC makes timestamps and calendar dates independent of the machine. AQE sizes partitions at
# run time and splits skewed ones; the state store keeps large keyed state off the heap.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "station-telemetry", **extra: str) -> SparkSession:
    """A session with the defaults above; master and sizing come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def sized_for(input_bytes: int) -> dict[str, str]:
    """Batch settings for an input of this size: `build_session(**sized_for(100 * 2**40))`.

    One shuffle partition per GiB of input: shuffles carry a few narrow columns, so that is a
    fraction of it per task. AQE merges what turns out small. Streaming state keeps
    `spark.sql.shuffle.partitions`, which a checkpoint fixes.
    """
    partitions = max(input_bytes // 2**30, 200)
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.files.maxPartitionBytes": "256m",
    }


def prepare_state(spark: SparkSession) -> None:
    """What queries with keyed state of their own expect of a session that `build_session` did not make.

    State in RocksDB, and Python workers that find this package where the driver runs from a checkout.
    """
    provider = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(provider, DEFAULTS[provider])
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).parents[1]))


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor reaches: `spark.checkpoint.dir`, or the context's checkpoint folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return found.rstrip("/")


def work_dir(spark: SparkSession) -> str:
    """This application's own part of the shared folder, which goes when the driver ends."""
    path = f"{shared_dir(spark)}/station-telemetry-{spark.sparkContext.applicationId}"
    if not files.exists(spark, path):
        files.make_folder(spark, path)
        files.remove_at_exit(spark, path)
    return path


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing path for intermediate tables."""
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"


_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows of `df` as a written table.

    Cuts the lineage at a durable copy: values that depend on how rows were spread, such as
    positions, stay the same when an executor is lost, and later reads prune columns.
    The copy goes when the driver ends, or at the end of the `scratch` block it is made in.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    open_scratch = _scratch.get()
    if open_scratch is not None:
        open_scratch.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession):
    """Removes the tables that `written` makes inside the block when the block ends."""
    paths: list[str] = []
    token = _scratch.set(paths)
    try:
        yield
    finally:
        _scratch.reset(token)
        for path in paths:
            files.remove_folder(spark, path)
