"""Retention and index inventory.

Retention works on daily partitions: a partition older than ``days`` (age
strictly greater, as the original cleanup script) is dropped.  The plan is a
filter over the store's partitions; :func:`apply_retention` deletes the day
folders of a store, :func:`drop_expired` the partitions of a catalog table.
The inventory counts rows from the files' footers: its scan reads no column.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.functions.expressions import index_date_from_name
from meterflow.sinks.commits import Store

# fixed values: retention in days by store (raw 7-14, aggregates and alerts 30-90)
RETENTION_DAYS = {"raw": 14, "agg": 90, "alerts": 90}


def index_partitions(docs: DataFrame) -> DataFrame:
    """Distinct (index_name, index_date) of a document frame."""
    return docs.select("index_name").distinct().withColumn("index_date", index_date_from_name("index_name"))


def with_age(parts: DataFrame, as_of: str) -> DataFrame:
    return parts.withColumn("ageDays", F.datediff(F.lit(as_of).cast("date"), F.col("index_date")))


def retention_keep(parts: DataFrame, as_of: str, days: int) -> DataFrame:
    return with_age(parts, as_of).where(F.col("ageDays") <= days)


def retention_drop(parts: DataFrame, as_of: str, days: int) -> DataFrame:
    return with_age(parts, as_of).where(F.col("ageDays") > days)


def drop_expired(spark: SparkSession, table: str, as_of: str, days: int) -> list[str]:
    """Drop expired ``index_date`` partitions of a partitioned catalog table.

    The partition list has one row per day, so it is small by construction.
    """
    parts = spark.sql(f"SHOW PARTITIONS {table}")
    dates = (parts.select(F.regexp_extract("partition", r"index_date=([0-9-]+)", 1).alias("d"))
             .where(F.datediff(F.lit(as_of).cast("date"), F.col("d").cast("date")) > days)
             .distinct().collect())
    dropped = [r.d for r in dates]
    for d in dropped:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (index_date = '{d}')")
    return dropped


def apply_retention(store: Store, as_of: str, retention: dict[str, int] | None = None) -> dict[str, list[date]]:
    """Delete the expired days of a store's outputs; returns them by output.  Outputs without a rule are kept."""
    return {output: store.expire(output, date.fromisoformat(as_of), days) for output, days in (retention or RETENTION_DAYS).items()}


def calendar_inventory(store: Store, output: str, first: str, last: str, size: int | None = None) -> DataFrame:
    """Stored rows per day beside the expected calendar ``first`` .. ``last``.

    ``status`` is ``present``, ``missing`` (expected, no rows) or
    ``unexpected`` (rows on a day outside the calendar).  ``size`` narrows
    document stores to one window size.  Counts come from partition names and
    file footers.
    """
    rows = store.read(output)
    rows = rows.where(F.col("windowSizeMinutes") == size) if size is not None else rows
    counts = rows.groupBy("index_date").agg(F.count(F.lit(1)).alias("docCount"))
    expected = store.spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("index_date"), F.lit(True).alias("_e"))
    both = counts.join(expected, "index_date", "full_outer")
    status = F.when(F.col("_e").isNull(), "unexpected").when(F.col("docCount").isNull(), "missing").otherwise("present")
    return both.select("index_date", F.coalesce("docCount", F.lit(0)).alias("docCount"), status.alias("status"))


def inventory(docs: DataFrame) -> DataFrame:
    """Document count per index."""
    return docs.groupBy("index_name").agg(F.count(F.lit(1)).alias("docCount"))


def missing_days(docs: DataFrame, group: str = "siteId") -> DataFrame:
    """Days inside each group's first..last index day that hold no document."""
    d = docs.select(group, "index_date").distinct()
    span = d.groupBy(group).agg(F.min("index_date").alias("_f"), F.max("index_date").alias("_l"))
    expected = span.select(group, F.explode(F.sequence("_f", "_l", F.expr("INTERVAL 1 DAY")))
                           .alias("index_date"))
    return expected.join(d, [group, "index_date"], "left_anti")
