"""Day-partitioned stores for raw readings, rollups and alerts.

A daily index becomes a ``index_date=`` partition; the per-size rollup
indices share one table partitioned by ``windowSizeMinutes`` first, so an
alias over "all 1-minute indices" is a partition filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.functions.expressions import alert_index_name, epoch_ms_to_date, raw_index_name, scaled_float
from meterflow.schema import ALERT, READING


def typed(df: DataFrame, schema) -> DataFrame:
    """Cast to the fixed mapping of a store (S17); extra columns are kept."""
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    rest = [c for c in df.columns if c not in set(schema.fieldNames())]
    return df.select(*cols, *rest)


def raw_documents(readings: DataFrame) -> DataFrame:
    return typed(readings, READING).withColumns({
        "index_name": raw_index_name("timestamp"),
        "index_date": epoch_ms_to_date("timestamp")})


ALERT_KEY = ["index_date", "alert_id"]


def alert_documents(alerts: DataFrame) -> DataFrame:
    """Alerts with their index, their id (rule, site, meter, time) and the usage as the index stores it."""
    return typed(alerts, ALERT).withColumns({
        "alert_id": F.concat_ws("-", "alertType", F.coalesce("siteId", F.lit("")), F.coalesce("meterId", F.lit("")), F.col("timestamp").cast("string")),
        "usageScaled": scaled_float(F.round(F.col("usageKw") + F.lit(3e-8), 6)),  # the last bits of a mean must not decide
        "index_name": alert_index_name("timestamp"),
        "index_date": epoch_ms_to_date("timestamp")})


def write_daily(docs: DataFrame, path: str, extra_partitions: list[str] | None = None,
                mode: str = "append") -> None:
    (docs.write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy(*(extra_partitions or []), "index_date").parquet(path))


def alias_view(spark: SparkSession, path: str, window_size_minutes: int, name: str | None = None) -> DataFrame:
    """All documents of one rollup size as one view (partition-pruned read)."""
    df = spark.read.parquet(path).where(F.col("windowSizeMinutes") == window_size_minutes)
    df.createOrReplaceTempView(name or f"power_usage_agg_{window_size_minutes}m")
    return df
