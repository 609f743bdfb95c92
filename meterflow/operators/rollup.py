"""Per-site window rollups.

``site_rollup`` is a single ``groupBy(window, siteId)`` whose aggregates are
all algebraic (count, sum, min, max, min_by), so Spark runs a partial
aggregate before the shuffle: a hot site costs one small buffer per task,
not one task.  The same function serves static and streaming frames.

Averages are ``sum / count`` of the carried sums, which is exactly what
``avg`` computes, and lets a finer rollup be merged into a coarser one
(``merge_rollup``) without averaging averages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.functions.expressions import agg_index_name, doc_id, ts_to_epoch_ms
from meterflow.schema import MINUTE_MS, SITE_WINDOW_FIELDS

OPTIONAL_METRICS = ["voltage", "current", "pf"]
_AVG_NAME = {"voltage": "avgVoltage", "current": "avgCurrent", "pf": "avgPf"}
CARRY_COLUMNS = ["sumVoltage", "voltageCount", "sumCurrent", "currentCount", "sumPf", "pfCount",
                 "firstArrival", "m2UsageKw"]


def _arrival_key(arrival: str | list[str]) -> Column:
    if isinstance(arrival, str):
        return F.col(arrival)
    return F.struct(*[F.col(a) for a in arrival])


def size_seconds(minutes: float) -> int:
    """Window size in seconds: whole minutes, or whole seconds below one minute."""
    s = round(minutes * 60, 6)
    if s <= 0 or s != int(s) or s > 60 and s % 60:
        raise ValueError(f"a window of {s} s has no index name: use whole minutes, or whole seconds below a minute")
    return int(s)


def _duration(minutes: int | float) -> str:
    return f"{int(round(minutes * 60))} seconds"


def window_column(time_col: str, minutes: float, slide_minutes: float | None = None) -> Column:
    if slide_minutes is None or slide_minutes == minutes:
        return F.window(time_col, _duration(minutes))
    return F.window(time_col, _duration(minutes), _duration(slide_minutes))


def _base_aggs(arrival) -> list[Column]:
    aggs = [
        F.count(F.lit(1)).alias("count"),
        F.sum("usageKw").alias("sumUsageKw"),
        F.max("usageKw").alias("maxUsageKw"),
        F.min("usageKw").alias("minUsageKw"),
    ]
    for m in OPTIONAL_METRICS:
        cap = m[0].upper() + m[1:]
        aggs += [F.sum(m).alias(f"sum{cap}"), F.count(m).alias(f"{m}Count")]
    key = _arrival_key(arrival)
    aggs += [F.min_by("meterId", key).alias("meterId"), F.min(key).alias("firstArrival")]
    return aggs


def _finish(df: DataFrame, minutes: float, carry: bool, extra: list[str]) -> DataFrame:
    cols = {
        "avgUsageKw": F.col("sumUsageKw") / F.col("count"),
        "avgVoltage": F.try_divide("sumVoltage", "voltageCount"),
        "avgCurrent": F.try_divide("sumCurrent", "currentCount"),
        "avgPf": F.try_divide("sumPf", "pfCount"),
    }
    out = df.withColumns(cols).withColumn("windowSizeMinutes", F.lit(size_seconds(minutes) // 60).cast("int"))
    keep = list(SITE_WINDOW_FIELDS) + extra
    if carry:
        keep += CARRY_COLUMNS
    return out.select(*keep)


def site_rollup(readings: DataFrame, minutes: float, slide_minutes: float | None = None,
                arrival: str | list[str] = "event_id", time_col: str = "ts",
                carry: bool = False, audit: bool = False, keep_window: bool = False) -> DataFrame:
    """SITE_WINDOW rows for every (site, window) that holds readings.

    ``arrival`` orders readings by arrival for the first-seen meter (Kafka:
    timestamp, partition, offset).  ``carry`` keeps the sums, non-null counts
    and first arrival for re-rollup.  ``audit`` adds the within-window sample
    standard deviation and null counts.  ``keep_window`` keeps the window
    struct (needed to chain a streaming aggregation).
    """
    w = window_column(time_col, minutes, slide_minutes).alias("window")
    aggs = _base_aggs(arrival)
    extra = []
    if carry:  # sum of squared deviations from the mean
        aggs += [(F.var_pop("usageKw") * F.count("usageKw")).alias("m2UsageKw")]
    if audit:
        aggs += [F.stddev_samp("usageKw").alias("stddevUsageKw")]
        aggs += [F.count_if(F.col(m).isNull()).alias(f"{m}Nulls") for m in OPTIONAL_METRICS]
        extra = ["stddevUsageKw"] + [f"{m}Nulls" for m in OPTIONAL_METRICS]
    g = readings.groupBy(w, F.col("siteId")).agg(*aggs)
    g = g.withColumns({"windowStart": ts_to_epoch_ms(F.col("window.start")),
                       "windowEnd": ts_to_epoch_ms(F.col("window.end"))})
    if keep_window:
        extra = extra + ["window"]
    return _finish(g, minutes, carry, extra)


def stddev_of_moments() -> Column:
    """Sample standard deviation of a carried row (n, mean, sum of squared deviations); null for one reading."""
    return F.when(F.col("count") > 1, F.sqrt(F.col("m2UsageKw") / (F.col("count") - 1)))


def _merged(rollup: DataFrame, *keys) -> DataFrame:
    """Combine carried rows: sums and counts add, min/max combine, the first-seen meter has the smallest arrival key.

    Squared deviations merge pairwise by (n, mean, M2), which loses no digits
    where means are far from 0; a group holds as many rows as small windows
    fit into a large one.
    """
    moments = F.struct(F.col("count").cast("double").alias("n"), F.col("avgUsageKw").alias("m"), F.col("m2UsageKw").alias("s"))

    def merge(a, b):
        n, d = a["n"] + b["n"], b["m"] - a["m"]
        return F.struct(n.alias("n"), (a["m"] + d * b["n"] / n).alias("m"), (a["s"] + b["s"] + d * d * a["n"] * b["n"] / n).alias("s"))

    g = rollup.groupBy(*keys).agg(
        F.sum("count").alias("count"),
        F.sum("sumUsageKw").alias("sumUsageKw"),
        F.max("maxUsageKw").alias("maxUsageKw"),
        F.min("minUsageKw").alias("minUsageKw"),
        *[F.sum(c).alias(c) for c in CARRY_COLUMNS if c not in ("firstArrival", "m2UsageKw")],
        F.min_by("meterId", "firstArrival").alias("meterId"),
        F.min("firstArrival").alias("firstArrival"),
        F.collect_list(moments).alias("_m"))
    zero = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("m"), F.lit(0.0).alias("s"))
    return g.withColumn("m2UsageKw", F.aggregate("_m", zero, merge)["s"]).drop("_m")


def merge_rollup(rollup: DataFrame, to_minutes: int, slide_minutes: int | None = None) -> DataFrame:
    """Roll carried rollup rows up to a coarser size (A9); equals a direct rollup at ``to_minutes``.

    With ``slide_minutes`` (a multiple of the rows' size), windows slide: each
    row goes to the ``to_minutes / slide_minutes`` windows it lies in.
    """
    size, step = to_minutes * MINUTE_MS, (slide_minutes or to_minutes) * MINUTE_MS
    last = F.col("windowStart") - F.pmod(F.col("windowStart"), F.lit(step))
    starts = F.explode(F.array(*[last - F.lit(j * step) for j in range(size // step)])) if size > step else last
    rows = rollup.select(*[c for c in rollup.columns if c not in ("windowStart", "windowEnd")], starts.alias("windowStart"))
    g = _merged(rows, "siteId", "windowStart").withColumn("windowEnd", F.col("windowStart") + F.lit(size))
    return _finish(g, to_minutes, True, [])


def merge_windows(rollup: DataFrame, to_minutes: float, slide_minutes: float | None = None) -> DataFrame:
    """A9 for streams: closed, carried rows (with their ``window``) into coarser windows, by the inner windows' time."""
    g = _merged(rollup, window_column(F.window_time("window"), to_minutes, slide_minutes).alias("window"), F.col("siteId"))
    g = g.withColumns({"windowStart": ts_to_epoch_ms(F.col("window.start")), "windowEnd": ts_to_epoch_ms(F.col("window.end"))})
    return _finish(g, to_minutes, True, ["window"])


def size_label() -> Column:
    """``5m`` for whole minutes; below a minute the size field is 0 and the label is like ``15s``."""
    seconds = ((F.col("windowEnd") - F.col("windowStart")) / 1000).cast("int").cast("string")
    return F.when(F.col("windowSizeMinutes") > 0, F.concat(F.col("windowSizeMinutes").cast("string"), F.lit("m"))) \
        .otherwise(F.concat(seconds, F.lit("s")))


def with_document_keys(rollup: DataFrame) -> DataFrame:
    """Add the daily index name (by window end, UTC) and document id."""
    return rollup.withColumns({
        "index_name": agg_index_name("windowEnd", size_label()),
        "doc_id": doc_id("siteId", "windowStart"),
    })
