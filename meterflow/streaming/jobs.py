"""Streaming forms of the operators.

Streams keep event time in ``ts`` with a 120 s watermark; windowed results
are emitted in append mode when a window closes.  Row-window metrics, which
Structured Streaming does not allow, are rewritten as window aggregations:

* Δ%: a sliding window of 2n every n; the newer half is the current window,
  the older half the calendar-adjacent predecessor.
* moving average: a second, chained window aggregation over the closed
  rollup rows (``window_time`` of the inner window as its event time).
* silence: a ``session_window`` per meter with gap T; every closed session
  is one silence alert, due at the last reading + T.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.functions.expressions import console_line, ts_to_epoch_ms
from meterflow.operators import rollup as R
from meterflow.operators.detect import silence_text
from meterflow.operators.skew import SKETCH_ACCURACY, sketch_quantiles
from meterflow.schema import MINUTE_MS

WATERMARK = "120 seconds"


def with_event_time(readings: DataFrame, delay: str = WATERMARK) -> DataFrame:
    return readings.withWatermark("ts", delay)


def with_processing_time(readings: DataFrame, clock: Column | None = None) -> DataFrame:
    """Processing-time mode: the arrival clock is the window time.

    ``clock`` is the wall clock unless given; a replay passes its recorded
    arrival time, so that the same windows come out of every run.
    """
    pt = clock if clock is not None else F.current_timestamp()
    return readings.withColumn("pt", pt).withWatermark("pt", "0 seconds")


def stream_rollup(readings: DataFrame, minutes: int, slide_minutes: int | None = None,
                  time_col: str = "ts", carry: bool = False, keep_window: bool = False,
                  arrival: str | list[str] = "event_id", audit: bool = False) -> DataFrame:
    return R.site_rollup(readings, minutes, slide_minutes, arrival=arrival, time_col=time_col, carry=carry,
                         keep_window=keep_window, audit=audit)


def stream_cascade(readings: DataFrame, sizes: list[float], arrival: str | list[str] = "event_id", keep_window: bool = False) -> DataFrame:
    """Closed windows of the last of ``sizes``, each level aggregated from the closed windows of the one before.

    The source is read once and the state of a level is one row per site and
    open window of it; sums and counts are carried (A9), so the result equals
    the direct rollup.  Sizes are minutes, each a multiple of the one before.
    """
    level = stream_rollup(readings, sizes[0], carry=True, keep_window=True, arrival=arrival)
    for m in sizes[1:]:
        level = R.merge_windows(level, m)
    return level if keep_window else level.drop("window")


def stream_sigma(readings: DataFrame, minutes: int, k: int, base_minutes: int, arrival: str | list[str] = "event_id") -> DataFrame:
    """σ inside each closed window, and mean and σ of the ``k`` window means before it.

    Windows of ``base_minutes`` close with (n, mean, sum of squared
    deviations); these merge exactly into the windows of ``minutes``, whose
    means feed a sliding window of ``k + 1`` of them.
    """
    level = R.merge_windows(stream_rollup(readings, base_minutes, carry=True, keep_window=True, arrival=arrival), minutes)
    span = F.window(F.window_time("window"), f"{(k + 1) * minutes * 60} seconds", f"{minutes * 60} seconds").alias("ow")
    end = ts_to_epoch_ms(F.col("ow.end"))
    rows = level.select("siteId", "windowStart", "windowEnd", "count", "avgUsageKw", R.stddev_of_moments().alias("stddevUsageKw"), "window")
    current = F.col("windowEnd") == F.col("_end")
    prior = F.when(~current, F.col("avgUsageKw"))
    rows = rows.select(span, "*").withColumn("_end", end)
    g = rows.groupBy("ow", "siteId").agg(
        F.max(F.when(current, F.col("windowStart"))).alias("windowStart"), F.max(F.when(current, F.col("count"))).alias("count"),
        F.max(F.when(current, F.col("stddevUsageKw"))).alias("stddevUsageKw"), F.max(F.when(current, F.col("avgUsageKw"))).alias("avgUsageKw"),
        F.avg(prior).alias("trailingMean"), F.stddev_samp(prior).alias("trailingSigma"), F.count(prior).alias("trailingWindows"))
    return g.where("windowStart IS NOT NULL").drop("ow")


def with_clock(readings: DataFrame, clock: DataFrame) -> DataFrame:
    """Readings and clock ticks as one stream with one event time, before the watermark.

    ``clock`` has ``ts``, ``timestamp`` and ``siteId`` (null for a bare
    tick).  Ticks make time pass when no reading arrives; they must run
    behind the arrival by the lag that readings may have.
    """
    return readings.withColumn("tick", F.lit(False)).unionByName(clock.withColumn("tick", F.lit(True)), allowMissingColumns=True)


def after_watermark(df: DataFrame, condition: Column) -> DataFrame:
    """A filter that stays above the watermark, so that the rows it drops have moved it."""
    return df.where(F.when(F.col("ts").isNotNull(), condition))


def stream_absent(ticked: DataFrame, minutes: int) -> DataFrame:
    """Closed windows in which an expected site has no reading.

    ``ticked``: :func:`with_clock` under a watermark, with one tick for each
    expected site and window.  A site's expectation and its readings meet in
    one state row per window, which says at its close whether any came.
    """
    g = after_watermark(ticked, F.col("siteId").isNotNull()).groupBy(R.window_column("ts", minutes).alias("window"), "siteId").agg(
        F.count_if(~F.col("tick")).alias("_n"), F.count_if("tick").alias("_expected"))
    return g.where("_n = 0 AND _expected > 0").select(
        "siteId", ts_to_epoch_ms(F.col("window.start")).alias("windowStart"), ts_to_epoch_ms(F.col("window.end")).alias("windowEnd"),
        F.lit(minutes).cast("int").alias("windowSizeMinutes"))


def stream_delta_pct(readings: DataFrame, minutes: int) -> DataFrame:
    """Δ% per closed window from one sliding aggregation of 2n every n."""
    n = minutes * MINUTE_MS
    w = R.window_column("ts", 2 * minutes, minutes).alias("window")
    tagged = readings.select("siteId", "timestamp", "usageKw", w).withColumn(
        "_recent", F.col("timestamp") >= ts_to_epoch_ms(F.col("window.end")) - F.lit(n))
    recent = F.col("_recent")
    g = tagged.groupBy("window", "siteId").agg(
        F.avg(F.when(recent, F.col("usageKw"))).alias("avgUsageKw"),
        F.avg(F.when(~recent, F.col("usageKw"))).alias("prevAvgUsageKw"),
        F.count_if(recent).alias("_cur"))
    g = g.where(F.col("_cur") > 0).withColumn("windowEnd", ts_to_epoch_ms(F.col("window.end")))
    return g.select(
        "siteId", (F.col("windowEnd") - F.lit(n)).alias("windowStart"), "windowEnd",
        F.lit(minutes).cast("int").alias("windowSizeMinutes"), "avgUsageKw", "prevAvgUsageKw",
        (F.try_divide(F.col("avgUsageKw") - F.col("prevAvgUsageKw"), F.col("prevAvgUsageKw"))
         * F.lit(100)).alias("deltaPct"))


def stream_moving_avg(readings: DataFrame, minutes: int, k: int) -> DataFrame:
    """Moving average of the last k window means, chained on the closed rollup."""
    inner = stream_rollup(readings, minutes, keep_window=True)
    outer = F.window(F.window_time("window"), f"{k * minutes * 60} seconds",
                     f"{minutes * 60} seconds").alias("ow")
    g = inner.groupBy(outer, "siteId").agg(
        F.avg("avgUsageKw").alias("movingAvgUsageKw"),
        F.count(F.lit(1)).alias("maWindows"),
        F.max_by("avgUsageKw", "windowEnd").alias("avgUsageKw"),
        F.max("windowEnd").alias("_lastEnd"))
    oend = ts_to_epoch_ms(F.col("ow.end"))
    return g.where(F.col("_lastEnd") == oend).select(
        "siteId", (oend - F.lit(minutes * MINUTE_MS)).alias("windowStart"),
        oend.alias("windowEnd"), F.lit(minutes).cast("int").alias("windowSizeMinutes"),
        "avgUsageKw", "movingAvgUsageKw", "maWindows")


def stream_silence(readings: DataFrame, silence_ms: int, arrival: str = "event_id") -> DataFrame:
    """One alert per closed session of a meter (gap > T closes it)."""
    s = F.session_window("ts", f"{silence_ms // 1000} seconds").alias("session")
    g = readings.groupBy(s, "meterId").agg(
        F.max("timestamp").alias("lastSeen"), F.min("timestamp").alias("firstSeen"),
        F.count(F.lit(1)).alias("readings"),
        F.max_by(F.struct("siteId", "usageKw"), F.struct("timestamp", arrival)).alias("_l"))
    g = g.select("*", "_l.siteId", "_l.usageKw")
    return g.select(
        (F.col("lastSeen") + F.lit(silence_ms)).alias("timestamp"), "meterId", "siteId", "usageKw",
        F.lit("SILENCE").alias("alertType"), F.lit("WARNING").alias("alertLevel"), silence_text(silence_ms).alias("explain"),
        "firstSeen", "lastSeen", "readings")


def console_lines(rollup: DataFrame, job_name: str) -> DataFrame:
    return rollup.select(console_line(job_name).alias("value"))


def closed_day_stats(readings: DataFrame, size_ms: int, probs: list[float], accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """Statistics of each closed (site, window): ``n``, ``mu``, ``sigma`` and the bracket of each percentile.

    State is one row per site and open window: moments and a quantile sketch
    of bounded size, whatever the number of readings.
    """
    g = readings.groupBy(F.window("ts", f"{size_ms // 1000} seconds").alias("w"), "siteId").agg(
        F.count("usageKw").alias("n"), F.avg("usageKw").alias("mu"), F.stddev_samp("usageKw").alias("sigma"),
        sketch_quantiles("usageKw", probs, accuracy).alias("bracket"))
    return g.select("siteId", ts_to_epoch_ms(F.col("w.start")).alias("windowStart"), "n", "mu", "sigma", "bracket")
