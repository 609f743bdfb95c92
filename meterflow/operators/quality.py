"""Data-quality checks and the ``ops`` / ``audit`` side outputs (Q1-Q7, O2, O3).

Row checks are plain predicates (no join, no shuffle).  Window checks work
on rollup rows.  Absent site-windows are generated per site and day from
the site's own active range, so no site × window cross product is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.operators import rollup as R
from meterflow.schema import DAY_MS, LIMITS, MINUTE_MS

READING_KEYS = ["meterId", "siteId", "timestamp", "usageKw"]


def value_range(readings: DataFrame, min_kw: float = LIMITS["usage_min_kw"],
                max_kw: float = LIMITS["usage_max_kw"]) -> DataFrame:
    """Q1: negative or excessive power readings."""
    kw = F.col("usageKw")
    return readings.where((kw < min_kw) | (kw > max_kw)).withColumn(
        "reason", F.when(kw < min_kw, F.lit("usage_below_min")).otherwise(F.lit("usage_above_max")))


def window_range(rollup: DataFrame, size_ms: int | None = None, slide_ms: int | None = None) -> DataFrame:
    """Q2: window sanity flags (start < end, length = size, start on the slide's grid).

    The size is the row's ``windowSizeMinutes`` unless given (as it must be
    below a minute); the slide is the size unless given.
    """
    size = F.lit(size_ms) if size_ms else F.col("windowSizeMinutes").cast("bigint") * F.lit(MINUTE_MS)
    return rollup.select(
        "siteId", "windowStart", "windowEnd", "windowSizeMinutes",
        (F.col("windowStart") < F.col("windowEnd")).alias("startBeforeEnd"),
        ((F.col("windowEnd") - F.col("windowStart")) == size).alias("lengthMatches"),
        (F.pmod(F.col("windowStart"), F.lit(slide_ms) if slide_ms else size) == 0).alias("aligned"),
    ).withColumn("windowValid", F.col("startBeforeEnd") & F.col("lengthMatches") & F.col("aligned"))


def missing_site(readings: DataFrame) -> DataFrame:
    """Q3: readings without a usable site id."""
    s = F.col("siteId")
    return readings.where(s.isNull() | (F.trim(s) == F.lit(""))).withColumn("reason", F.lit("missing_site"))


def electrical_limits(readings: DataFrame, v_min: float = LIMITS["voltage_min"],
                      v_max: float = LIMITS["voltage_max"], pf_min: float = LIMITS["pf_min"],
                      pf_max: float = LIMITS["pf_max"]) -> DataFrame:
    """Q4: voltage or power factor outside the normal band (nulls are not checked)."""
    v, pf = F.col("voltage"), F.col("pf")
    v_bad = (v < v_min) | (v > v_max)
    pf_bad = (pf < pf_min) | (pf > pf_max)
    return readings.where(F.coalesce(v_bad, F.lit(False)) | F.coalesce(pf_bad, F.lit(False))) \
        .withColumn("reason", F.concat_ws(",", F.when(v_bad, F.lit("voltage_out_of_range")),
                                          F.when(pf_bad, F.lit("pf_out_of_range"))))


def power_identity(readings: DataFrame, tolerance: float = LIMITS["identity_tolerance"]) -> DataFrame:
    """Q5: current deviates from kW*1000/(V*pf) by more than ``tolerance`` (relative)."""
    expected = F.col("usageKw") * 1000 / (F.col("voltage") * F.col("pf"))
    err = F.try_divide(F.abs(F.col("current") - expected), F.abs(expected))
    return readings.withColumn("expectedCurrent", expected).withColumn("identityError", err) \
        .where(F.col("identityError") > tolerance).withColumn("reason", F.lit("power_identity"))


def absent_site_windows(readings: DataFrame, minutes: int, sites: DataFrame | None = None,
                        from_ms: int | None = None, as_of_ms: int | None = None) -> DataFrame:
    """Q6: windows of a site's range with no reading.

    The range runs from a site's first to its last reading unless ``from_ms``
    or ``as_of_ms`` say otherwise; readings outside them are left out, so one
    bad timestamp can't stretch it.  ``sites`` (``siteId``) lists the expected
    sites, which may never have reported; it needs both bounds.

    Expected windows are generated per (site, day), a bounded fan-out of at
    most one day of windows per row; the present windows are removed with a
    left anti join on (site, window start).
    """
    size = minutes * MINUTE_MS
    if DAY_MS % size:
        raise ValueError("window size must divide a day")
    if sites is not None and (from_ms is None or as_of_ms is None):
        raise ValueError("a list of sites needs from_ms and as_of_ms")
    t = F.col("timestamp")
    if from_ms is not None:
        readings = readings.where(t >= from_ms)
    if as_of_ms is not None:
        readings = readings.where(t <= as_of_ms)
    present = readings.select("siteId", (t - F.pmod(t, F.lit(size))).alias("windowStart")).distinct()
    span = present.groupBy("siteId").agg(F.min("windowStart").alias("_first"), F.max("windowStart").alias("_last"))
    if sites is not None:
        span = sites.select("siteId").distinct().join(span, "siteId", "left")
    if from_ms is not None:
        span = span.withColumn("_first", F.lit(from_ms - from_ms % size))
    if as_of_ms is not None:
        span = span.withColumn("_last", F.lit(as_of_ms - as_of_ms % size))
    day0 = F.col("_first") - F.pmod(F.col("_first"), F.lit(DAY_MS))
    days = span.select("siteId", "_first", "_last",
                       F.explode(F.sequence(day0, F.col("_last"), F.lit(DAY_MS))).alias("_day"))
    per_day = DAY_MS // size
    expected = days.select(
        "siteId", "_first", "_last", "_day",
        F.explode(F.sequence(F.lit(0), F.lit(per_day - 1))).alias("_i")) \
        .withColumn("windowStart", F.col("_day") + F.col("_i") * F.lit(size)) \
        .where((F.col("windowStart") >= F.col("_first")) & (F.col("windowStart") <= F.col("_last")))
    return expected.join(present, ["siteId", "windowStart"], "left_anti").select(
        "siteId", "windowStart", (F.col("windowStart") + F.lit(size)).alias("windowEnd"),
        F.lit(minutes).cast("int").alias("windowSizeMinutes"))


def ops_output(readings: DataFrame, limits: dict | None = None) -> DataFrame:
    """O2: one row per reading with any quality finding; reasons joined by ','."""
    lim = dict(LIMITS, **(limits or {}))
    kw, v, pf, s = F.col("usageKw"), F.col("voltage"), F.col("pf"), F.col("siteId")
    expected = F.col("usageKw") * 1000 / (v * pf)
    ident = F.try_divide(F.abs(F.col("current") - expected), F.abs(expected))
    checks = [
        (s.isNull() | (F.trim(s) == F.lit("")), "missing_site"),
        (kw < lim["usage_min_kw"], "usage_below_min"),
        (kw > lim["usage_max_kw"], "usage_above_max"),
        ((v < lim["voltage_min"]) | (v > lim["voltage_max"]), "voltage_out_of_range"),
        ((pf < lim["pf_min"]) | (pf > lim["pf_max"]), "pf_out_of_range"),
        (ident > lim["identity_tolerance"], "power_identity"),
    ]
    reasons = F.concat_ws(",", *[F.when(c, F.lit(name)) for c, name in checks])
    return readings.withColumn("reasons", reasons).where(F.col("reasons") != F.lit(""))


def window_findings(rollup: DataFrame, size_ms: int | None = None, slide_ms: int | None = None) -> DataFrame:
    """Q2 in the ops schema: windows that fail a check, under their start."""
    bad = window_range(rollup, size_ms, slide_ms).where("NOT windowValid")
    none = F.lit(None)
    return bad.select(none.cast("bigint").alias("event_id"), none.cast("string").alias("meterId"), "siteId", F.col("windowStart").alias("timestamp"),
                      F.lit("window_range").alias("reasons"))


def absence_findings(absent: DataFrame) -> DataFrame:
    """Q6 in the ops schema: windows of a site without a reading, under their start."""
    none = F.lit(None)
    return absent.select(none.cast("bigint").alias("event_id"), none.cast("string").alias("meterId"), "siteId", F.col("windowStart").alias("timestamp"),
                         F.lit("absent_window").alias("reasons"))


def audit_snapshot(readings: DataFrame, minutes: int, slide_minutes: int | None = None) -> DataFrame:
    """O3: window statistics snapshot (A1-A6, σ, null counts) per site-window."""
    return R.site_rollup(readings, minutes, slide_minutes, audit=True)
