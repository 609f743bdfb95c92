"""Kafka source and publisher.

The Kafka connector jar is not bundled here; these functions only build the
reader/writer options, and the encode/decode halves are plain DataFrame
functions tested on files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.schema import DEFAULT_TOPIC, READING_FIELDS

# arrival order of a Kafka record: first-seen meter uses it (see rollup)
KAFKA_ARRIVAL = ["kafka_timestamp", "partition", "offset"]


def kafka_options(servers: str, group_id: str, topic: str = DEFAULT_TOPIC, starting: str = "latest",
                  max_offsets_per_trigger: int | None = None, fail_on_data_loss: bool = True) -> dict[str, str]:
    """Source options; ``starting`` is 'latest' or 'earliest'.

    Expired offsets fail the job unless ``fail_on_data_loss`` is off.  The
    starting position only applies to a fresh checkpoint.
    """
    if starting not in ("latest", "earliest"):
        raise ValueError("starting must be 'latest' or 'earliest'")
    out = {"kafka.bootstrap.servers": servers, "subscribe": topic, "kafka.group.id": group_id,
           "startingOffsets": starting, "failOnDataLoss": str(fail_on_data_loss).lower()}
    if max_offsets_per_trigger:
        out["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return out


def kafka_reader(spark: SparkSession, servers: str, group_id: str, **options):
    """Streaming reader with :func:`kafka_options`; call ``.load()`` and then :func:`kafka_values`."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, group_id, **options))


def kafka_values(raw: DataFrame) -> DataFrame:
    """Keep the payload, the arrival key and the arrival time (epoch ms) of Kafka records."""
    return raw.select("value", F.col("timestamp").alias("kafka_timestamp"), "partition", "offset",
                      F.unix_millis("timestamp").alias("ingestMs"))


def encode_readings(readings: DataFrame, key_col: str = "meterId",
                    keep: list[str] | None = None) -> DataFrame:
    """Kafka records of readings: key = meter id, value = the reading as JSON."""
    return readings.select(
        *(keep or []),
        F.col(key_col).cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(f) for f in READING_FIELDS])).alias("value"))


def publish(records: DataFrame, servers: str, topic: str = DEFAULT_TOPIC) -> None:
    """Batch write to Kafka with all-replica acknowledgement."""
    (records.write.format("kafka")
     .option("kafka.bootstrap.servers", servers)
     .option("kafka.acks", "all")
     .option("topic", topic)
     .save())
