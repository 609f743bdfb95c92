"""Anomaly rules (D1-D6); every threshold is a parameter.

All rules emit the alert document shape ``timestamp, meterId, siteId,
usageKw, alertType, alertLevel, explain`` (plus rule-specific columns that
:func:`to_alerts` drops).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.functions.expressions import figure
from meterflow.operators import metrics as M
from meterflow.operators import rollup as R
from meterflow.operators.skew import exact_percentiles, ranked_percentiles, salted_join, sketch_quantiles
from meterflow.schema import ALERT_FIELDS, DAY_MS, MINUTE_MS

SPIKE_WARNING_PCT = 100.0
SPIKE_CRITICAL_PCT = 200.0
SUSTAINED_KW = 40.0
SUSTAINED_MIN_COUNT = 3
SILENCE_MS = 24 * 3_600_000
ZSCORE_LIMIT = 3.0
IQR_FACTOR = 1.5
QUARTILES = [0.25, 0.75]
# window of the rollup that the hourly and sliding rules are merged from
BASE_MINUTES = 15
# row identity used to spread a hot site-window over tasks
SALT_COLS = ["meterId", "timestamp", "usageKw"]


def spike_level(critical: float) -> Column:
    return F.when(F.col("deltaPct") >= critical, F.lit("CRITICAL")).otherwise(F.lit("WARNING"))


def spike_text() -> Column:
    return F.format_string("avg %s kW vs %s kW in the previous %d-minute window (%s%%)", figure("avgUsageKw"), figure("prevAvgUsageKw"),
                           "windowSizeMinutes", figure("deltaPct", 1, sign=True))


def sustained_text(threshold_kw: float) -> Column:
    return F.format_string("%d readings in %d minutes all >= %.1f kW (min %s kW)", "count", "windowSizeMinutes", F.lit(float(threshold_kw)),
                           figure("minUsageKw"))


def silence_text(silence_ms: int) -> Column:
    return F.format_string("no reading for more than %d s", F.lit(silence_ms // 1000))


def zscore_text() -> Column:
    return F.format_string("z = %s (mean %s kW, sigma %s kW, n = %d)", figure("zScore"), figure("mu"), figure("sigma"), "n")


def iqr_text() -> Column:
    return F.format_string("outside [%s, %s] kW (q1 %s, q3 %s)", figure("lowerFence"), figure("upperFence"), figure("q1"), figure("q3"))


def detect_spike(deltas: DataFrame, warning: float = SPIKE_WARNING_PCT,
                 critical: float = SPIKE_CRITICAL_PCT) -> DataFrame:
    """Windows whose Δ% reaches the warning / critical level."""
    d = F.col("deltaPct")
    return deltas.where(d >= warning).select(
        F.col("windowStart").alias("timestamp"), F.lit(None).cast("string").alias("meterId"),
        "siteId", F.col("avgUsageKw").alias("usageKw"), F.lit("SPIKE").alias("alertType"),
        spike_level(critical).alias("alertLevel"),
        spike_text().alias("explain"),
        "windowSizeMinutes", "deltaPct")


def sustained_windows(readings: DataFrame, minutes: int = 60, slide_minutes: int = 15,
                      threshold_kw: float = SUSTAINED_KW, min_count: int = SUSTAINED_MIN_COUNT,
                      time_col: str = "ts") -> DataFrame:
    """Sliding windows in which every reading is at or above the threshold."""
    return sustained_of(R.site_rollup(readings, minutes, slide_minutes, time_col=time_col), threshold_kw, min_count)


def sustained_of(rollup: DataFrame, threshold_kw: float = SUSTAINED_KW, min_count: int = SUSTAINED_MIN_COUNT) -> DataFrame:
    return rollup.where((F.col("minUsageKw") >= threshold_kw) & (F.col("count") >= min_count))


def detect_sustained(windows: DataFrame, threshold_kw: float = SUSTAINED_KW) -> DataFrame:
    return windows.select(
        F.col("windowStart").alias("timestamp"), F.lit(None).cast("string").alias("meterId"),
        "siteId", F.col("avgUsageKw").alias("usageKw"), F.lit("SUSTAINED").alias("alertType"),
        F.lit("WARNING").alias("alertLevel"),
        sustained_text(threshold_kw).alias("explain"),
        "windowEnd", "count", "minUsageKw")


def meter_gaps(readings: DataFrame, silence_ms: int = SILENCE_MS, arrival: str = "event_id", as_of_ms: int | None = None) -> DataFrame:
    """Consecutive readings of a meter more than ``silence_ms`` apart, and with ``as_of_ms`` the silences still open then.

    Readings are first reduced to (meter, time bucket of width T) -> first
    and last reading, a partial aggregate that is bounded by the time span,
    not by the reading rate.  A gap longer than T cannot fall inside one
    bucket, so it always runs from the last reading of a bucket to the
    first reading of the meter's next non-empty bucket; the ``lead`` over
    the compact bucket table finds it.  Readings of one millisecond are
    ordered by ``arrival``.
    """
    b = F.floor(F.col("timestamp") / F.lit(silence_ms)).cast("bigint")
    buckets = readings.groupBy("meterId", b.alias("_b")).agg(
        F.min("timestamp").alias("_first"), F.max("timestamp").alias("_last"),
        F.max_by(F.struct("siteId", "usageKw"), F.struct("timestamp", arrival)).alias("_l"))
    w = Window.partitionBy("meterId").orderBy("_b")
    nxt = buckets.withColumn("_next", F.lead("_first").over(w))
    gap = F.coalesce("_next", F.lit(as_of_ms).cast("bigint")) - F.col("_last")
    return nxt.where(gap > silence_ms).select(
        "meterId", F.col("_l.siteId").alias("siteId"), F.col("_last").alias("lastSeen"),
        F.col("_next").alias("nextSeen"), gap.alias("gapMs"), F.col("_l.usageKw").alias("lastUsageKw"))


def open_silences(readings: DataFrame, as_of_ms: int, silence_ms: int = SILENCE_MS,
                  arrival: str = "event_id") -> DataFrame:
    """Meters whose last reading is more than T before ``as_of_ms`` (open tail)."""
    last = readings.groupBy("meterId").agg(
        F.max("timestamp").alias("lastSeen"),
        F.max_by(F.struct("siteId", "usageKw"), F.struct("timestamp", arrival)).alias("_l"))
    last = last.select("meterId", "lastSeen", F.col("_l.siteId").alias("siteId"),
                       F.col("_l.usageKw").alias("lastUsageKw"))
    return last.where(F.lit(as_of_ms) - F.col("lastSeen") > silence_ms).select(
        "meterId", "siteId", "lastSeen", F.lit(None).cast("bigint").alias("nextSeen"),
        (F.lit(as_of_ms) - F.col("lastSeen")).alias("gapMs"), "lastUsageKw")


def detect_silence(gaps: DataFrame, silence_ms: int = SILENCE_MS) -> DataFrame:
    """Silence alerts; the alert's event time is the last reading + T."""
    return gaps.select(
        (F.col("lastSeen") + F.lit(silence_ms)).alias("timestamp"), "meterId", "siteId",
        F.col("lastUsageKw").alias("usageKw"), F.lit("SILENCE").alias("alertType"),
        F.lit("WARNING").alias("alertLevel"),
        silence_text(silence_ms).alias("explain"),
        "lastSeen", "nextSeen", "gapMs")


def window_stats(readings: DataFrame, size_ms: int) -> DataFrame:
    start = F.col("timestamp") - F.pmod(F.col("timestamp"), F.lit(size_ms))
    return readings.groupBy("siteId", start.alias("windowStart")).agg(
        F.avg("usageKw").alias("mu"), F.stddev_samp("usageKw").alias("sigma"),
        F.count(F.lit(1)).alias("n"))


def detect_zscore(readings: DataFrame, size_ms: int = DAY_MS, limit: float = ZSCORE_LIMIT) -> DataFrame:
    """Readings with |z| >= limit against their own site-window mean and σ.

    Window statistics are joined back to the readings; adaptive execution
    broadcasts them or splits a hot site-window over several tasks.
    """
    stats = window_stats(readings, size_ms)
    r = readings.withColumn("windowStart",
                            F.col("timestamp") - F.pmod(F.col("timestamp"), F.lit(size_ms)))
    j = salted_join(r, stats, ["siteId", "windowStart"], SALT_COLS)
    z = F.try_divide(F.col("usageKw") - F.col("mu"), F.col("sigma"))
    return j.withColumn("zScore", z).where(
        F.col("sigma").isNotNull() & (F.col("sigma") > 0) & (F.abs("zScore") >= limit)).select(
        "timestamp", "meterId", "siteId", "usageKw", F.lit("ZSCORE").alias("alertType"),
        F.when(F.abs("zScore") >= 2 * limit, F.lit("CRITICAL")).otherwise(F.lit("WARNING"))
         .alias("alertLevel"),
        zscore_text().alias("explain"),
        "windowStart", "mu", "sigma", "zScore")


def iqr_bounds(readings: DataFrame, size_ms: int = DAY_MS, factor: float = IQR_FACTOR) -> DataFrame:
    """Exact quartiles and fences per site-window (default site-day)."""
    r = readings.withColumn("windowStart",
                            F.col("timestamp") - F.pmod(F.col("timestamp"), F.lit(size_ms)))
    q = exact_percentiles(r, ["siteId", "windowStart"], "usageKw", [0.25, 0.75],
                          salt_cols=SALT_COLS, prefix="_q")
    iqr = F.col("q3") - F.col("q1")
    return q.select("siteId", "windowStart", "n", F.col("_q0").alias("q1"), F.col("_q1").alias("q3")) \
            .withColumns({"lowerFence": F.col("q1") - F.lit(factor) * (F.col("q3") - F.col("q1")),
                          "upperFence": F.col("q3") + F.lit(factor) * iqr})


def detect_iqr(readings: DataFrame, size_ms: int = DAY_MS, factor: float = IQR_FACTOR) -> DataFrame:
    bounds = iqr_bounds(readings, size_ms, factor)
    r = readings.withColumn("windowStart",
                            F.col("timestamp") - F.pmod(F.col("timestamp"), F.lit(size_ms)))
    j = salted_join(r, bounds, ["siteId", "windowStart"], SALT_COLS)
    out = (F.col("usageKw") < F.col("lowerFence")) | (F.col("usageKw") > F.col("upperFence"))
    return j.where(out).select(
        "timestamp", "meterId", "siteId", "usageKw", F.lit("IQR").alias("alertType"),
        F.lit("WARNING").alias("alertLevel"),
        iqr_text().alias("explain"),
        "windowStart", "q1", "q3")


def to_alerts(df: DataFrame) -> DataFrame:
    return df.select(*ALERT_FIELDS)


def all_alerts(frames: list[DataFrame]) -> DataFrame:
    """Union of rule outputs in the one alert schema."""
    return reduce(lambda a, b: a.unionByName(b), [to_alerts(f) for f in frames])


def day_stats(readings: DataFrame, size_ms: int = DAY_MS) -> DataFrame:
    """Moments and quartile brackets of each site-window in one pass: ``n``, ``mu``, ``sigma``, ``bracket``."""
    start = F.col("timestamp") - F.pmod(F.col("timestamp"), F.lit(size_ms))
    return readings.groupBy("siteId", start.alias("windowStart")).agg(
        F.count("usageKw").alias("n"), F.avg("usageKw").alias("mu"), F.stddev_samp("usageKw").alias("sigma"),
        sketch_quantiles("usageKw", QUARTILES).alias("bracket"))


def day_outliers(readings: DataFrame, stats: DataFrame, size_ms: int = DAY_MS, limit: float = ZSCORE_LIMIT,
                 factor: float = IQR_FACTOR) -> DataFrame:
    """Z-score and IQR alerts of the site-windows in ``stats`` (:func:`day_stats`), with their rule columns.

    ``readings`` may be the stored history of closed windows.  One scan ranks
    the values inside the brackets, one judges every reading by both rules.
    """
    keys = ["siteId", "windowStart"]
    r = readings.withColumn("windowStart", F.col("timestamp") - F.pmod(F.col("timestamp"), F.lit(size_ms)))
    q = ranked_percentiles(r, stats, keys, "usageKw", QUARTILES, SALT_COLS, prefix="_q", carry=["mu", "sigma"])
    iqr = F.col("_q1") - F.col("_q0")
    facts = q.select(
        *keys, "n", "mu", "sigma", F.col("_q0").alias("q1"), F.col("_q1").alias("q3"),
        (F.col("_q0") - F.lit(factor) * iqr).alias("lowerFence"), (F.col("_q1") + F.lit(factor) * iqr).alias("upperFence"))
    j = salted_join(r, facts, keys, SALT_COLS).withColumn("zScore", F.when(F.col("sigma") > 0, F.try_divide(F.col("usageKw") - F.col("mu"), F.col("sigma"))))
    far = F.abs("zScore")
    level = F.when(far >= 2 * limit, F.lit("CRITICAL")).otherwise(F.lit("WARNING"))

    def found(kind, grade, text):
        return F.struct(F.lit(kind).alias("alertType"), grade.alias("alertLevel"), text.alias("explain"))
    out = (F.col("usageKw") < F.col("lowerFence")) | (F.col("usageKw") > F.col("upperFence"))
    rules = F.array(F.when(far >= limit, found("ZSCORE", level, zscore_text())), F.when(out, found("IQR", F.lit("WARNING"), iqr_text())))
    hits = j.where((far >= limit) | out).select("timestamp", "meterId", "siteId", "usageKw", "windowStart", "mu", "sigma", "zScore", "q1", "q3",
                                                F.explode(F.filter(rules, lambda x: x.isNotNull())).alias("_a"))
    return hits.select("timestamp", "meterId", "siteId", "usageKw", "_a.*", "windowStart", "mu", "sigma", "zScore", "q1", "q3")


def window_alerts(sliding: DataFrame, minutes: int, threshold_kw: float = SUSTAINED_KW, min_count: int = SUSTAINED_MIN_COUNT,
                  warning: float = SPIKE_WARNING_PCT, critical: float = SPIKE_CRITICAL_PCT) -> DataFrame:
    """Sustained alerts of sliding windows and spike alerts of those on the grid of ``minutes``, in one pass over the rollup."""
    rows = M.delta_pct(sliding, minutes, keep=["count", "minUsageKw"])
    on_grid = F.pmod("windowStart", F.lit(minutes * MINUTE_MS)) == 0
    spike = F.when(on_grid & (F.col("deltaPct") >= warning),
                   F.struct(F.lit("SPIKE").alias("alertType"), spike_level(critical).alias("alertLevel"), spike_text().alias("explain")))
    sustained = F.when((F.col("minUsageKw") >= threshold_kw) & (F.col("count") >= min_count),
                       F.struct(F.lit("SUSTAINED").alias("alertType"), F.lit("WARNING").alias("alertLevel"), sustained_text(threshold_kw).alias("explain")))
    return rows.select(F.col("windowStart").alias("timestamp"), F.lit(None).cast("string").alias("meterId"), "siteId", F.col("avgUsageKw").alias("usageKw"),
                       F.explode(F.filter(F.array(spike, sustained), lambda x: x.isNotNull())).alias("_a")) \
        .select("timestamp", "meterId", "siteId", "usageKw", "_a.*")


def standard_alerts(readings: DataFrame, minutes: int = 60, as_of_ms: int | None = None) -> DataFrame:
    """Every rule with its default parameters on one readings frame.

    With ``as_of_ms``, meters that are still silent then give an alert too.
    Windows slide by 15 minutes, merged from one rollup, and the hourly ones
    are those on the hour; z-score and IQR share statistics and join.
    """
    base = R.site_rollup(readings, BASE_MINUTES, carry=True)
    return all_alerts([
        window_alerts(R.merge_rollup(base, minutes, BASE_MINUTES), minutes),
        detect_silence(meter_gaps(readings, as_of_ms=as_of_ms)),
        day_outliers(readings, day_stats(readings)),
    ])
