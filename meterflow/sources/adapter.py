"""Readings derived from the shared ``events`` table (the test adapter).

``events(event_id, ts, user_id, event_type, value, props)`` becomes a stream
of meter readings with a fixed, documented mapping so that every operator
can be checked against an independent SQL engine on the same parquet files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.functions.expressions import epoch_ms_to_ts, ntz_to_epoch_ms, once

READING_COLUMNS = ["meterId", "siteId", "timestamp", "usageKw", "voltage", "current", "pf",
                   "event_id", "ingestMs"]


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def readings_from_events(events: DataFrame, with_ts: bool = True, electrical: bool = True) -> DataFrame:
    """Map ``events`` rows to readings.

    meterId ``MTR-`` + user id padded to 4; site ``SITE-`` + user_id mod 5;
    epoch-ms timestamp; ``value`` is usageKw; voltage, pf and current follow
    the ``k`` property (nulls on multiples of 10, 7 and 5; one high-voltage
    value; a 20 % current error on multiples of 11); arrival time
    ``ingestMs = timestamp + k * 10 s`` drives the lateness rules.  The
    property is parsed once a row; without ``electrical`` it is not read, and
    the fields that follow from it are null.
    """
    base = events.select("event_id", "ts", "user_id", "value", *(["props"] if electrical else []))
    parsed = once(base, F.get_json_object("props", "$.k").cast("int"), "k") if electrical else base.withColumn("k", F.lit(None).cast("int"))
    k = F.col("k")
    base = parsed.select(
        F.concat(F.lit("MTR-"), F.lpad(F.col("user_id").cast("string"), 4, "0")).alias("meterId"),
        F.concat(F.lit("SITE-"), (F.col("user_id") % 5).cast("string")).alias("siteId"),
        ntz_to_epoch_ms("ts").alias("timestamp"),
        F.col("value").alias("usageKw"),
        F.when(k % 10 == 0, F.lit(None)).when(k == 99, F.lit(240))
         .otherwise(F.lit(214) + k % 13).cast("double").alias("voltage"),
        F.when(k % 7 == 0, F.lit(None).cast("double"))
         .otherwise(F.lit(0.88) + (k % 8) * F.lit(0.01)).alias("pf"),
        F.col("event_id"),
        k.alias("k"),
    )
    power = F.col("usageKw") * 1000 / (F.col("voltage") * F.col("pf"))
    current = (F.when(F.col("k") % 5 == 0, F.lit(None).cast("double"))
                .when(F.col("k") % 11 == 0, F.lit(1.2) * F.col("usageKw") * 1000
                      / (F.col("voltage") * F.col("pf")))
                .otherwise(power))
    out = base.select(
        "meterId", "siteId", "timestamp", "usageKw", "voltage", current.alias("current"), "pf",
        "event_id", (F.col("timestamp") + F.col("k") * 10000).alias("ingestMs"))
    if with_ts:
        out = out.withColumn("ts", epoch_ms_to_ts("timestamp"))
    return out


def load_readings(spark: SparkSession, sf_dir: str, with_ts: bool = True, electrical: bool = True) -> DataFrame:
    return readings_from_events(load_table(spark, sf_dir, "events"), with_ts=with_ts, electrical=electrical)
