"""Derived window metrics (M1-M4).

Definitions (``a_t`` = avgUsageKw of a site's window ``t`` of size ``n``):

* Δ% (M1): ``(a_t - a_{t-1}) / a_{t-1} * 100`` where ``t-1`` is the
  calendar-adjacent window; null when it is absent or zero.
* moving average (M2): mean of ``a`` over the windows of the trailing
  ``k * n`` range ending at ``t`` (missing windows are skipped).
* σ (M3): within-window ``stddev_samp(usageKw)`` (see the audit rollup), and
  the trailing ``stddev_samp(a)`` over the ``k`` preceding windows.
* profile deviation (M4): ``a_t / (site mean × expected load factor)``.

Batch forms avoid row windows partitioned by site (a hot site would be one
task): each window row is *shifted* to the slots it contributes to and the
slots are aggregated, a bounded fan-out of ``k`` rows followed by one
hash-partitioned aggregation on (site, slot).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.schema import MINUTE_MS

WINDOW_KEYS = ["siteId", "windowStart"]


def _shifted(rollup: DataFrame, minutes: int, lags: list[int], value: str = "avgUsageKw", keep: list[str] = ()) -> DataFrame:
    """One row per (window, lag j): the window's value placed at slot start + j*n."""
    size = minutes * MINUTE_MS
    return rollup.select(
        "siteId", F.col(value).alias("_v"),
        F.explode(F.array(*[F.lit(j) for j in lags])).alias("_j"),
        "windowStart", *keep,
    ).withColumn("_slot", F.col("windowStart") + F.col("_j") * F.lit(size))


def delta_pct(rollup: DataFrame, minutes: int, keep: list[str] | None = None) -> DataFrame:
    """Δ% of every window against its calendar-adjacent predecessor; ``keep``: columns of the window's own row."""
    s = _shifted(rollup, minutes, [0, 1], keep=keep or [])
    g = s.groupBy("siteId", F.col("_slot").alias("windowStart")).agg(
        F.max(F.when(F.col("_j") == 0, F.col("_v"))).alias("avgUsageKw"),
        F.max(F.when(F.col("_j") == 1, F.col("_v"))).alias("prevAvgUsageKw"),
        *[F.max(F.when(F.col("_j") == 0, F.col(c))).alias(c) for c in keep or []],
        F.count_if(F.col("_j") == 0).alias("_self"))
    size = minutes * MINUTE_MS
    return g.where("_self > 0").select(
        "siteId", "windowStart", (F.col("windowStart") + F.lit(size)).alias("windowEnd"),
        F.lit(minutes).cast("int").alias("windowSizeMinutes"),
        *(keep or []), "avgUsageKw", "prevAvgUsageKw",
        (F.try_divide(F.col("avgUsageKw") - F.col("prevAvgUsageKw"), F.col("prevAvgUsageKw"))
         * F.lit(100)).alias("deltaPct"))


def moving_avg(rollup: DataFrame, minutes: int, k: int) -> DataFrame:
    """Trailing moving average over the calendar range of ``k`` windows."""
    s = _shifted(rollup, minutes, list(range(k)))
    g = s.groupBy("siteId", F.col("_slot").alias("windowStart")).agg(
        F.max(F.when(F.col("_j") == 0, F.col("_v"))).alias("avgUsageKw"),
        F.avg("_v").alias("movingAvgUsageKw"),
        F.count(F.lit(1)).alias("maWindows"),
        F.count_if(F.col("_j") == 0).alias("_self"))
    size = minutes * MINUTE_MS
    return g.where("_self > 0").select(
        "siteId", "windowStart", (F.col("windowStart") + F.lit(size)).alias("windowEnd"),
        F.lit(minutes).cast("int").alias("windowSizeMinutes"),
        "avgUsageKw", "movingAvgUsageKw", "maWindows")


def trailing_sigma(rollup: DataFrame, minutes: int, k: int, keep: list[str] | None = None) -> DataFrame:
    """Mean and sample σ of ``a`` over the ``k`` preceding windows (not the current); ``keep``: columns of the window's own row."""
    s = _shifted(rollup, minutes, list(range(k + 1)), keep=keep or [])
    prior = F.when(F.col("_j") > 0, F.col("_v"))
    g = s.groupBy("siteId", F.col("_slot").alias("windowStart")).agg(
        F.max(F.when(F.col("_j") == 0, F.col("_v"))).alias("avgUsageKw"),
        F.avg(prior).alias("trailingMean"),
        F.stddev_samp(prior).alias("trailingSigma"),
        F.count(prior).alias("trailingWindows"),
        *[F.max(F.when(F.col("_j") == 0, F.col(c))).alias(c) for c in keep or []],
        F.count_if(F.col("_j") == 0).alias("_self"))
    return g.where("_self > 0").drop("_self")


def site_mean(readings: DataFrame) -> DataFrame:
    return readings.groupBy("siteId").agg(F.avg("usageKw").alias("siteMeanKw"))


def profile_deviation(rollup: DataFrame, readings: DataFrame, factor: Column) -> DataFrame:
    """Ratio of a window's mean to the site mean scaled by ``factor``, the expected load of the window.

    The per-site means are one row per site; adaptive execution broadcasts
    them when the runtime size is small and keeps a shuffle join otherwise.
    """
    means = site_mean(readings)
    return rollup.join(means, "siteId").select(
        "siteId", "windowStart", "windowSizeMinutes", "avgUsageKw", "siteMeanKw",
        factor.alias("expectedFactor"),
        F.try_divide(F.col("avgUsageKw"), F.col("siteMeanKw") * factor).alias("profileDeviation"))
