"""Row-level lateness routing.

Each reading is classed by its own lag ``arrival - event time``: within the
allowed lateness it is ``on_time``, within the exception bucket it is
``late_exception``, beyond that ``too_late``; an event time more than
``ahead_ms`` after the arrival is ``ahead`` (a wrong clock).  The rule is stateless, so it
scales with the data and gives the same answer however batches are cut
(unlike watermark drops, which depend on batch boundaries).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALLOWED_LATENESS_MS = 120_000     # 120 s
EXCEPTION_BUCKET_MS = 600_000     # up to 10 min
AHEAD_MS = 120_000                # clocks may run ahead of the arrival by 120 s


def route_lateness(readings: DataFrame, arrival_col: str = "ingestMs", event_col: str = "timestamp",
                   allowed_ms: int = ALLOWED_LATENESS_MS,
                   exception_ms: int = EXCEPTION_BUCKET_MS, ahead_ms: int = AHEAD_MS) -> DataFrame:
    lag = F.col(arrival_col) - F.col(event_col)
    return readings.withColumn("lagMs", lag).withColumn(
        "lateness",
        F.when(F.col("lagMs") < -ahead_ms, F.lit("ahead"))
         .when(F.col("lagMs") <= allowed_ms, F.lit("on_time"))
         .when(F.col("lagMs") <= exception_ms, F.lit("late_exception"))
         .otherwise(F.lit("too_late")))
