"""Batch numbers that stay unique when a checkpoint is lost.

A streaming query numbers its batches from 0 for every new checkpoint. The checkpoint has an id of
its own, which a restart keeps, so each id gets a generation number, recorded beside what the query
writes: batches of a newer checkpoint come after all batches of older ones, whatever their numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from station_telemetry import files

GENERATION_SIZE = 1_000_000_000


def run_of(batch: DataFrame) -> str:
    """Id of the checkpoint whose query handed out this micro-batch."""
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise ValueError("not inside a streaming micro-batch")
    return found


def generation(spark: SparkSession, folder: str, run: str) -> int:
    """Number of a checkpoint, the next free one when it is new. One query at a time may ask."""
    known = [n.removeprefix("generation=").split(".", 1) for n in files.child_names(spark, folder)]
    numbers = {name: int(number) for number, name in known}
    if run not in numbers:
        numbers[run] = max(numbers.values(), default=-1) + 1
        files.make_folder(spark, f"{folder}/generation={numbers[run]}.{run}")
    return numbers[run]


def position(batch_id: int, generation: int = 0) -> int:
    """Place of a batch among those of all generations."""
    return generation * GENERATION_SIZE + batch_id


def position_of(batch: DataFrame, batch_id: int, folder: str) -> int:
    """Place of this micro-batch; generations are recorded in `folder`."""
    return position(batch_id, generation(batch.sparkSession, folder, run_of(batch)))
