"""Writing (key, value) frames to topics or, in the same shape, to files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from station_telemetry.functions import framed, record_json
from station_telemetry.schemas import RAIN, RAIN_AVRO, RAIN_TOPIC, STATUS_TOPIC
from station_telemetry.sinks.generations import position_of

# The publisher does not wait for brokers and does not retry.
PUBLISH_OPTIONS = {"kafka.acks": "0", "kafka.retries": "0"}


def rain_frame(rain: DataFrame, encoded: Column | None = None) -> DataFrame:
    """Rain events keyed as their readings were."""
    record = F.struct(*RAIN.names)
    return rain.select("key", (record_json(record) if encoded is None else encoded).alias("value"))


def avro_encoded(record: Column, avro_schema: str, schema_id: int) -> Column:
    """A record as registry-framed Avro. Needs the spark-avro module on the class path."""
    from pyspark.sql.avro.functions import to_avro

    return framed(to_avro(record, avro_schema), schema_id)


def rain_avro(schema_id: int) -> Column:
    """A rain event as registry-framed Avro."""
    return avro_encoded(F.struct(*RAIN.names), RAIN_AVRO, schema_id)


def topic_options(servers: str, topic: str, **options: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, **options}


def publish(frame: DataFrame, servers: str, topic: str = STATUS_TOPIC) -> None:
    """Batch write of a publish frame. Needs the Kafka connector on the class path."""
    options = topic_options(servers, topic, **PUBLISH_OPTIONS)
    frame.write.format("kafka").options(**options).save()


def topic_writer(
    frame: DataFrame, servers: str, checkpoint: str, topic: str = RAIN_TOPIC
) -> DataStreamWriter:
    return (
        frame.writeStream.format("kafka")
        .options(**topic_options(servers, topic))
        .option("checkpointLocation", checkpoint)
    )


def file_writer(frame: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Each micro-batch as a folder `batch=…` of its own, which a retry replaces.

    A new checkpoint writes new folders, so nothing it reads is skipped.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        place = position_of(batch, batch_id, f"{path.rstrip('/')}-generations")
        batch.write.mode("overwrite").parquet(f"{path}/batch={place}")

    return frame.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """What `file_writer` has written."""
    return spark.read.parquet(path).drop("batch")
