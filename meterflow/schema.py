"""Record schemas, fixed names and default limits.

Names, formats and field orders below are fixed values: they must equal the
original job's document and index layout for stored results to line up.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: JSON field names of a reading, in record order -----------
READING_FIELDS = ["meterId", "siteId", "timestamp", "usageKw", "voltage", "current", "pf"]
# --- fixed values: output document fields, in record order ------------------
SITE_WINDOW_FIELDS = [
    "siteId", "meterId", "windowStart", "windowEnd", "windowSizeMinutes", "count",
    "avgUsageKw", "maxUsageKw", "minUsageKw", "sumUsageKw", "avgVoltage", "avgCurrent", "avgPf",
]
# --- fixed values: alert document fields -------------------------------------
ALERT_FIELDS = ["timestamp", "meterId", "siteId", "usageKw", "alertType", "alertLevel", "explain"]
# --- fixed values: index names and formats -----------------------------------
AGG_INDEX_PREFIX = "power-usage-agg"      # + "-{n}m-" + yyyy.MM.dd of window end (UTC)
RAW_INDEX_PREFIX = "power-usage-raw"      # + "-" + yyyy.MM.dd of event time
ALERT_INDEX_PREFIX = "power-alerts"       # + "-" + yyyy.MM.dd of alert time
INDEX_DATE_FORMAT = "yyyy.MM.dd"
INDEX_DATE_REGEX = r"\d{4}\.\d{2}\.\d{2}"
DEFAULT_TOPIC = "power-usage-metrics"
CONSOLE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# scaled_float factor of usageKw in the alert mapping
USAGE_SCALING_FACTOR = 100

READING = T.StructType([
    T.StructField("meterId", T.StringType(), True),
    T.StructField("siteId", T.StringType(), True),
    T.StructField("timestamp", T.LongType(), False),
    T.StructField("usageKw", T.DoubleType(), False),
    T.StructField("voltage", T.DoubleType(), True),
    T.StructField("current", T.DoubleType(), True),
    T.StructField("pf", T.DoubleType(), True),
])

SITE_WINDOW = T.StructType([
    T.StructField("siteId", T.StringType(), True),
    T.StructField("meterId", T.StringType(), True),
    T.StructField("windowStart", T.LongType(), False),
    T.StructField("windowEnd", T.LongType(), False),
    T.StructField("windowSizeMinutes", T.IntegerType(), False),
    T.StructField("count", T.LongType(), False),
    T.StructField("avgUsageKw", T.DoubleType(), False),
    T.StructField("maxUsageKw", T.DoubleType(), False),
    T.StructField("minUsageKw", T.DoubleType(), False),
    T.StructField("sumUsageKw", T.DoubleType(), False),
    T.StructField("avgVoltage", T.DoubleType(), True),
    T.StructField("avgCurrent", T.DoubleType(), True),
    T.StructField("avgPf", T.DoubleType(), True),
])

ALERT = T.StructType([
    T.StructField("timestamp", T.LongType(), False),
    T.StructField("meterId", T.StringType(), True),
    T.StructField("siteId", T.StringType(), True),
    T.StructField("usageKw", T.DoubleType(), True),
    T.StructField("alertType", T.StringType(), False),
    T.StructField("alertLevel", T.StringType(), False),
    T.StructField("explain", T.StringType(), True),
])

# Default limits (ours unless noted). Thresholds are parameters of every rule.
LIMITS = {
    "usage_min_kw": 0.0,
    "usage_max_kw": 700.0,      # 3.5 x 200 kW, the largest spike the generator can emit
    "voltage_min": 209.0,       # normal band of the generator's comment
    "voltage_max": 231.0,
    "pf_min": 0.88,
    "pf_max": 0.95,
    "identity_tolerance": 0.01,  # relative error of I = kW*1000/(V*pf)
}

DAY_MS = 86_400_000
MINUTE_MS = 60_000
