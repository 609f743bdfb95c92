"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the driver's parquet tables (through the readings adapter)
and ends with :func:`present`.  Its SQL twin lives in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.functions import expressions as X
from meterflow.operators import detect as D
from meterflow.operators import lateness as L
from meterflow.operators import metrics as M
from meterflow.operators import quality as Q
from meterflow.operators import rollup as R
from meterflow.schema import READING, SITE_WINDOW, SITE_WINDOW_FIELDS
from meterflow.sources import json_decode as J
from meterflow.sources import kafka as K
from meterflow.fixtures import payloads as P
from meterflow.fixtures.load_profile import load_profile_factor
from meterflow.plans.present import present
from meterflow.sources.adapter import load_readings

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _rollup_doc(spark, sf_dir, minutes, slide=None) -> DataFrame:
    rows = R.site_rollup(load_readings(spark, sf_dir), minutes, slide)
    return present(R.with_document_keys(rows))


@register("site_rollup_1m")
def q_site_rollup_1m(spark, sf_dir):
    return _rollup_doc(spark, sf_dir, 1)


@register("site_rollup_5m")
def q_site_rollup_5m(spark, sf_dir):
    return _rollup_doc(spark, sf_dir, 5)


@register("site_rollup_15m")
def q_site_rollup_15m(spark, sf_dir):
    return _rollup_doc(spark, sf_dir, 15)


@register("sliding_rollup")
def q_sliding_rollup(spark, sf_dir):
    """1-hour windows sliding every 15 minutes."""
    return _rollup_doc(spark, sf_dir, 60, 15)


@register("sliding_15s")
def q_sliding_15s(spark, sf_dir):
    """15-second windows sliding every 5 seconds, under an index name of their own."""
    return _rollup_doc(spark, sf_dir, 0.25, 5 / 60)


@register("rollup_merge")
def q_rollup_merge(spark, sf_dir):
    """1-minute rollup merged up to 15 minutes; must equal the direct rollup."""
    one = R.site_rollup(load_readings(spark, sf_dir), 1, carry=True)
    merged = R.merge_rollup(one, 15).select(*R.SITE_WINDOW_FIELDS)
    return present(R.with_document_keys(merged))


# --- fixture parameters (FIXTURES.md: 1 h windows for metrics, site-day for statistics)
METRIC_MINUTES = 60
MA_WINDOWS = 3
SIGMA_WINDOWS = 4
FIXTURE_MAX_KW = 350.0


def _readings(spark, sf_dir):
    return load_readings(spark, sf_dir)


def _usage(spark, sf_dir):
    """Readings for queries on usage alone: the electrical fields are not read."""
    return load_readings(spark, sf_dir, electrical=False)


def _hourly(spark, sf_dir):
    return R.site_rollup(_usage(spark, sf_dir), METRIC_MINUTES)


@register("late_routing")
def q_late_routing(spark, sf_dir):
    r = L.route_lateness(_readings(spark, sf_dir))
    return present(r.select("event_id", "meterId", "siteId", "timestamp", "ingestMs", "lagMs", "lateness"))


@register("delta_pct")
def q_delta_pct(spark, sf_dir):
    return present(M.delta_pct(_hourly(spark, sf_dir), METRIC_MINUTES))


@register("moving_avg")
def q_moving_avg(spark, sf_dir):
    return present(M.moving_avg(_hourly(spark, sf_dir), METRIC_MINUTES, MA_WINDOWS))


@register("sigma")
def q_sigma(spark, sf_dir):
    """Within-window σ of readings and trailing σ of the 4 preceding hourly means, from one rollup."""
    audit = R.site_rollup(_usage(spark, sf_dir), METRIC_MINUTES, audit=True)
    trail = M.trailing_sigma(audit, METRIC_MINUTES, SIGMA_WINDOWS, keep=["count", "stddevUsageKw"])
    return present(trail.select("siteId", "windowStart", "count", "stddevUsageKw", "avgUsageKw", "trailingMean", "trailingSigma", "trailingWindows"))


@register("profile_deviation")
def q_profile_deviation(spark, sf_dir):
    r = _usage(spark, sf_dir)
    return present(M.profile_deviation(R.site_rollup(r, METRIC_MINUTES), r, load_profile_factor("windowStart")))


@register("detect_spike")
def q_detect_spike(spark, sf_dir):
    d = D.detect_spike(M.delta_pct(_hourly(spark, sf_dir), METRIC_MINUTES))
    return present(d.drop("explain"))


@register("detect_sustained")
def q_detect_sustained(spark, sf_dir):
    return present(D.detect_sustained(D.sustained_windows(_usage(spark, sf_dir))).drop("explain"))


@register("detect_silence")
def q_detect_silence(spark, sf_dir):
    return present(D.detect_silence(D.meter_gaps(_usage(spark, sf_dir))).drop("explain"))


@register("detect_zscore")
def q_detect_zscore(spark, sf_dir):
    return present(D.detect_zscore(_usage(spark, sf_dir)).drop("explain"))


@register("detect_iqr")
def q_detect_iqr(spark, sf_dir):
    return present(D.detect_iqr(_usage(spark, sf_dir)).drop("explain"))


def _alerts(spark, sf_dir):
    """All rules as of the last reading, so that meters silent until then are included."""
    r = _usage(spark, sf_dir)
    return D.standard_alerts(r, METRIC_MINUTES, r.agg(F.max("timestamp")).first()[0])


@register("alerts_all")
def q_alerts_all(spark, sf_dir):
    return present(_alerts(spark, sf_dir))


@register("alerts_index_routing")
def q_alerts_index_routing(spark, sf_dir):
    a = _alerts(spark, sf_dir)
    return present(a.select("timestamp", "meterId", "siteId", "alertType",
                            X.alert_index_name("timestamp").alias("index_name")))


@register("scaled_usage")
def q_scaled_usage(spark, sf_dir):
    r = _usage(spark, sf_dir)
    scaled = X.scaled_float("usageKw")
    return present(r.select("event_id", "usageKw", scaled.alias("usageScaled"),
                            (scaled / F.lit(100.0)).alias("usageStored")))


@register("load_profile")
def q_load_profile(spark, sf_dir):
    r = _usage(spark, sf_dir)
    return present(r.select("event_id", "timestamp", X.utc_hour("timestamp").alias("hourUtc"),
                            F.weekday(X.epoch_ms_to_date("timestamp")).alias("weekday"),
                            load_profile_factor("timestamp").alias("expectedFactor")))


@register("index_routing")
def q_index_routing(spark, sf_dir):
    ro = R.with_document_keys(R.site_rollup(_usage(spark, sf_dir), 15))
    return present(ro.select("siteId", "windowStart", "windowEnd", "index_name",
                             X.epoch_ms_to_date("windowEnd").alias("index_date")))


@register("doc_id")
def q_doc_id(spark, sf_dir):
    ro = R.with_document_keys(R.site_rollup(_usage(spark, sf_dir), 1))
    return present(ro.select("siteId", "windowStart", "windowSizeMinutes", "doc_id"))


@register("raw_index_routing")
def q_raw_index_routing(spark, sf_dir):
    r = _usage(spark, sf_dir)
    return present(r.select("event_id", "meterId", "siteId", "timestamp",
                            X.raw_index_name("timestamp").alias("index_name")))


@register("index_date_parse")
def q_index_date_parse(spark, sf_dir):
    ro = R.with_document_keys(R.site_rollup(_usage(spark, sf_dir), 15))
    names = ro.select("index_name").distinct()
    return present(names.select("index_name", X.index_date_from_name("index_name").alias("index_date")))


@register("index_inventory")
def q_index_inventory(spark, sf_dir):
    ro = R.with_document_keys(R.site_rollup(_usage(spark, sf_dir), 15))
    return present(ro.groupBy("index_name").agg(F.count(F.lit(1)).alias("docCount")))


@register("dq_value_range")
def q_dq_value_range(spark, sf_dir):
    q = Q.value_range(_usage(spark, sf_dir), max_kw=FIXTURE_MAX_KW)
    return present(q.select("event_id", "meterId", "siteId", "usageKw", "reason"))


@register("dq_window_range")
def q_dq_window_range(spark, sf_dir):
    return present(Q.window_range(_damaged_windows(spark, sf_dir), slide_ms=900_000))


@register("dq_missing_site")
def q_dq_missing_site(spark, sf_dir):
    dec = _decoded(spark, sf_dir)
    q = Q.missing_site(dec.where(~F.col("dead")))
    return present(q.select("event_id", "meterId", "timestamp", "reason"))


@register("dq_electrical_limits")
def q_dq_electrical_limits(spark, sf_dir):
    q = Q.electrical_limits(_readings(spark, sf_dir))
    return present(q.select("event_id", "meterId", "siteId", "voltage", "pf", "reason"))


@register("dq_power_identity")
def q_dq_power_identity(spark, sf_dir):
    q = Q.power_identity(_readings(spark, sf_dir))
    return present(q.select("event_id", "meterId", "siteId", "current", "expectedCurrent",
                            "identityError", "reason"))


@register("dq_absent_site_windows")
def q_dq_absent_site_windows(spark, sf_dir):
    return present(Q.absent_site_windows(_usage(spark, sf_dir), 15))


@register("dq_absent_sites")
def q_dq_absent_sites(spark, sf_dir):
    """Hourly windows without a reading for a list of sites, two of which never report, over the table's whole range."""
    r = _usage(spark, sf_dir)
    sites = r.select(F.concat(F.lit("SITE-"), (F.substring("meterId", 5, 10).cast("int") % 7).cast("string")).alias("siteId")).distinct()
    lo, hi = r.agg(F.min("timestamp"), F.max("timestamp")).first()
    return present(Q.absent_site_windows(r, METRIC_MINUTES, sites, lo, hi))


@register("ops_output")
def q_ops_output(spark, sf_dir):
    q = Q.ops_output(_readings(spark, sf_dir), {"usage_max_kw": FIXTURE_MAX_KW})
    return present(q.select("event_id", "meterId", "siteId", "timestamp", "reasons"))


def _damaged_windows(spark, sf_dir):
    """Sliding windows, some of which are damaged by rule: a start off the grid, or an end before the start."""
    ro = R.site_rollup(_usage(spark, sf_dir), 60, 15)
    slot = F.pmod(F.col("windowStart") / 900_000, F.lit(11)).cast("int")
    return ro.withColumns({
        "windowEnd": F.when(slot == 3, F.col("windowStart") - 60_000).otherwise(F.col("windowEnd")),
        "windowStart": F.when(slot == 7, F.col("windowStart") + 1000).otherwise(F.col("windowStart"))})


@register("ops_all")
def q_ops_all(spark, sf_dir):
    """Every finding in one schema: readings (Q1, Q3-Q5), damaged windows (Q2) and absent hourly windows (Q6)."""
    rows = Q.ops_output(_readings(spark, sf_dir), {"usage_max_kw": FIXTURE_MAX_KW}).select("event_id", "meterId", "siteId", "timestamp", "reasons")
    windows = Q.window_findings(_damaged_windows(spark, sf_dir), slide_ms=900_000)
    absent = Q.absence_findings(Q.absent_site_windows(_usage(spark, sf_dir), METRIC_MINUTES))
    return present(rows.unionByName(windows).unionByName(absent))


@register("audit_snapshot")
def q_audit_snapshot(spark, sf_dir):
    return present(Q.audit_snapshot(_readings(spark, sf_dir), METRIC_MINUTES))


@register("console_line")
def q_console_line(spark, sf_dir):
    """The console text taken apart again: everything before the numbers, and the numbers."""
    ro = R.site_rollup(_readings(spark, sf_dir), 1)
    line = ro.select("*", X.console_line("1m").alias("line"))
    shown = {n: F.regexp_extract("line", f"{n}: ([-0-9.]+) kW", 1).cast("double") for n in ("Avg", "Max", "Min", "Sum")}
    close = {n: F.abs(shown[n] - F.col(c)) < 0.006 for n, c in (("Avg", "avgUsageKw"), ("Sum", "sumUsageKw"))}
    return present(line.select("siteId", "windowStart", F.substring_index("line", ", Avg", 1).alias("head"),
                               shown["Max"].alias("maxKw"), shown["Min"].alias("minKw"),
                               close["Avg"].alias("avgShown"), close["Sum"].alias("sumShown")))


@register("agg_document_json")
def q_agg_document_json(spark, sf_dir):
    """The document text read back: its key list, in order, and its typed fields."""
    ro = R.with_document_keys(R.site_rollup(_readings(spark, sf_dir), 1))
    doc = ro.select("index_name", "doc_id", X.document_json(SITE_WINDOW_FIELDS).alias("document"))
    back = doc.select("index_name", "doc_id", F.concat_ws(",", F.json_object_keys("document")).alias("keys"),
                      F.from_json("document", SITE_WINDOW).alias("d"))
    return present(back.select("index_name", "doc_id", "keys", "d.*"))


def _decoded(spark, sf_dir, mode="lenient"):
    pay = P.payloads_from_readings(_readings(spark, sf_dir))
    return J.decode_payloads(pay, "value", mode=mode, keep=["event_id"])


@register("decode_json")
def q_decode_json(spark, sf_dir):
    """Readings decoded from table-derived JSON payloads (lenient mode)."""
    dec = _decoded(spark, sf_dir)
    return present(J.readings_of(dec, keep=["event_id"]))


@register("decode_ops")
def q_decode_ops(spark, sf_dir):
    ops = J.ops_of(_decoded(spark, sf_dir), keep=["event_id"])
    return present(ops.select("event_id", "siteId", "timestamp", "voltage",
                              F.concat_ws(",", "reasons").alias("reasons"), "emit"))


@register("decode_dead_letter")
def q_decode_dead_letter(spark, sf_dir):
    dead = J.dead_letter_of(_decoded(spark, sf_dir), keep=["event_id"])
    return present(dead.select("event_id"))


@register("decode_strict")
def q_decode_strict(spark, sf_dir):
    """Strict mode: unknown keys and failed casts are dead letters, missing fields go to ops."""
    dec = _decoded(spark, sf_dir, mode="strict")
    return present(dec.select("event_id", "dead", "emit",
                              F.concat_ws(",", "reasons").alias("reasons")))


@register("encode_kafka")
def q_encode_kafka(spark, sf_dir):
    """Kafka records (key = meterId, JSON value) read back into typed fields."""
    rec = K.encode_readings(_readings(spark, sf_dir), keep=["event_id"])
    back = F.from_json("value", READING)
    return present(rec.select("event_id", "key", back.alias("v")).select("event_id", "key", "v.*"))


# streaming and storage queries register themselves on import
from meterflow.plans import stream_catalog as _stream_catalog  # noqa: E402,F401
