"""DuckDB SQL twins of the registered queries (same column names and types)."""

from __future__ import annotations

from meterflow.plans.present import ROUND_SHIFT
from meterflow.plans.oracle_base import (READINGS, SITE_WINDOW_SELECT, agg_index_name, date_text,
                                         day_date, doc_id, index_date, rollup_cte)

ORACLE: dict[str, str] = {}


def _rollup_doc(minutes: int, slide: int | None = None) -> str:
    return f"""WITH {READINGS}, {rollup_cte('ro', minutes, slide=slide)}
SELECT {SITE_WINDOW_SELECT}, {agg_index_name()} AS index_name, {doc_id()} AS doc_id FROM ro"""


ORACLE["site_rollup_1m"] = _rollup_doc(1)
ORACLE["site_rollup_5m"] = _rollup_doc(5)
ORACLE["site_rollup_15m"] = _rollup_doc(15)
ORACLE["sliding_rollup"] = _rollup_doc(60, 15)
ORACLE["sliding_15s"] = f"""WITH {READINGS}, {rollup_cte('ro', 0.25, slide=5 / 60)}
SELECT {SITE_WINDOW_SELECT}, {agg_index_name(size='15', unit='s')} AS index_name, {doc_id()} AS doc_id FROM ro"""
ORACLE["rollup_merge"] = _rollup_doc(15)


HOUR = 3_600_000
DAY = 86_400_000


def _defect_case(eid: str = "event_id") -> str:
    from meterflow.fixtures.payloads import DEFECT_RULES
    whens = " ".join(f"WHEN {eid} % {m} = {r} THEN '{name}'" for m, r, name in DEFECT_RULES)
    return f"CASE {whens} END"


def _factor(ms: str) -> str:
    away = f"abs(CAST((({ms}) % {DAY}) // {HOUR} AS INTEGER) - 14)"
    day = f"(CAST(1 AS DOUBLE) - CAST(0.05 AS DOUBLE) * least({away}, 24 - {away}))"
    return f"(CASE WHEN isodow({day_date(ms)}) >= 6 THEN {day} * CAST(0.8 AS DOUBLE) ELSE {day} END)"


HOURLY = f"{READINGS}, {rollup_cte('ro', 60)}"

DELTA_CTE = f"""delta AS (
  SELECT c.siteId, c.windowStart, c.windowEnd, c.windowSizeMinutes, c.avgUsageKw,
         p.avgUsageKw AS prevAvgUsageKw,
         CASE WHEN p.avgUsageKw = 0 THEN NULL
              ELSE (c.avgUsageKw - p.avgUsageKw) / p.avgUsageKw * 100 END AS deltaPct
  FROM ro c LEFT JOIN ro p ON p.siteId = c.siteId AND p.windowStart = c.windowStart - {HOUR})"""

ORACLE["late_routing"] = f"""WITH {READINGS}
SELECT event_id, meterId, siteId, "timestamp", ingestMs, ingestMs - "timestamp" AS lagMs,
  CASE WHEN ingestMs - "timestamp" <= 120000 THEN 'on_time'
       WHEN ingestMs - "timestamp" <= 600000 THEN 'late_exception' ELSE 'too_late' END AS lateness
FROM readings"""

ORACLE["delta_pct"] = f"""WITH {HOURLY}, {DELTA_CTE}
SELECT siteId, windowStart, windowEnd, windowSizeMinutes, round(avgUsageKw, 6) AS avgUsageKw,
  round(prevAvgUsageKw, 6) AS prevAvgUsageKw, round(deltaPct, 6) AS deltaPct FROM delta"""

ORACLE["moving_avg"] = f"""WITH {HOURLY}
SELECT c.siteId, c.windowStart, c.windowEnd, c.windowSizeMinutes, round(c.avgUsageKw, 6) AS avgUsageKw,
  round(avg(p.avgUsageKw), 6) AS movingAvgUsageKw, count(*) AS maWindows
FROM ro c JOIN ro p ON p.siteId = c.siteId
  AND p.windowStart BETWEEN c.windowStart - {2 * HOUR} AND c.windowStart
GROUP BY c.siteId, c.windowStart, c.windowEnd, c.windowSizeMinutes, c.avgUsageKw"""

ORACLE["sigma"] = f"""WITH {READINGS}, {rollup_cte('ro', 60, extra=', stddev_samp(usageKw) AS stddevUsageKw')}
SELECT c.siteId, c.windowStart, c."count", round(c.stddevUsageKw, 6) AS stddevUsageKw,
  round(c.avgUsageKw, 6) AS avgUsageKw, round(avg(p.avgUsageKw), 6) AS trailingMean,
  round(stddev_samp(p.avgUsageKw), 6) AS trailingSigma, count(p.avgUsageKw) AS trailingWindows
FROM ro c LEFT JOIN ro p ON p.siteId = c.siteId
  AND p.windowStart BETWEEN c.windowStart - {4 * HOUR} AND c.windowStart - {HOUR}
GROUP BY c.siteId, c.windowStart, c."count", c.stddevUsageKw, c.avgUsageKw"""

ORACLE["profile_deviation"] = f"""WITH {HOURLY},
  m AS (SELECT siteId, avg(usageKw) AS siteMeanKw FROM readings GROUP BY siteId)
SELECT ro.siteId, ro.windowStart, ro.windowSizeMinutes, round(ro.avgUsageKw, 6) AS avgUsageKw,
  round(m.siteMeanKw, 6) AS siteMeanKw, {_factor('ro.windowStart')} AS expectedFactor,
  round(ro.avgUsageKw / (m.siteMeanKw * {_factor('ro.windowStart')}), 6) AS profileDeviation
FROM ro JOIN m USING (siteId)"""

SPIKE_SELECT = f"""SELECT windowStart AS "timestamp", CAST(NULL AS VARCHAR) AS meterId, siteId,
  avgUsageKw AS usageKw, 'SPIKE' AS alertType,
  CASE WHEN deltaPct >= 200 THEN 'CRITICAL' ELSE 'WARNING' END AS alertLevel,
  windowSizeMinutes, deltaPct FROM delta WHERE deltaPct >= 100"""

SUSTAINED_CTE = f"""{rollup_cte('sl', 60, slide=15)},
  sustained AS (SELECT windowStart AS "timestamp", CAST(NULL AS VARCHAR) AS meterId, siteId,
    avgUsageKw AS usageKw, 'SUSTAINED' AS alertType, 'WARNING' AS alertLevel, windowEnd, "count",
    minUsageKw FROM sl WHERE minUsageKw >= 40 AND "count" >= 3)"""

SILENCE_CTE = f"""g AS (SELECT meterId, siteId, "timestamp" AS lastSeen, usageKw,
    lead("timestamp") OVER (PARTITION BY meterId ORDER BY "timestamp", event_id) AS nextSeen FROM readings),
  silence AS (SELECT lastSeen + {DAY} AS "timestamp", meterId, siteId, usageKw, 'SILENCE' AS alertType,
    'WARNING' AS alertLevel, lastSeen, nextSeen, nextSeen - lastSeen AS gapMs
    FROM g WHERE nextSeen - lastSeen > {DAY})"""

DAYWIN_CTE = f"""r2 AS (SELECT *, "timestamp" - "timestamp" % {DAY} AS windowStart FROM readings),
  st AS (SELECT siteId, windowStart, avg(usageKw) AS mu, stddev_samp(usageKw) AS sigma, count(*) AS n
         FROM r2 GROUP BY siteId, windowStart),
  zs AS (SELECT r2."timestamp", r2.meterId, r2.siteId, r2.usageKw, n, 'ZSCORE' AS alertType,
    CASE WHEN abs((usageKw - mu) / sigma) >= 6 THEN 'CRITICAL' ELSE 'WARNING' END AS alertLevel,
    r2.windowStart, mu, sigma, (usageKw - mu) / sigma AS zScore
    FROM r2 JOIN st USING (siteId, windowStart) WHERE sigma > 0 AND abs((usageKw - mu) / sigma) >= 3),
  qt AS (SELECT siteId, windowStart, quantile_cont(usageKw, 0.25) AS q1, quantile_cont(usageKw, 0.75) AS q3
         FROM r2 GROUP BY siteId, windowStart),
  iq AS (SELECT r2."timestamp", r2.meterId, r2.siteId, r2.usageKw, 'IQR' AS alertType,
    'WARNING' AS alertLevel, r2.windowStart, q1, q3
    FROM r2 JOIN qt USING (siteId, windowStart)
    WHERE usageKw < q1 - 1.5 * (q3 - q1) OR usageKw > q3 + 1.5 * (q3 - q1))"""

ORACLE["detect_spike"] = f"""WITH {HOURLY}, {DELTA_CTE}, s AS ({SPIKE_SELECT})
SELECT "timestamp", meterId, siteId, round(usageKw, 6) AS usageKw, alertType, alertLevel,
  windowSizeMinutes, round(deltaPct, 6) AS deltaPct FROM s"""

ORACLE["detect_sustained"] = f"""WITH {READINGS}, {SUSTAINED_CTE}
SELECT "timestamp", meterId, siteId, round(usageKw, 6) AS usageKw, alertType, alertLevel, windowEnd,
  "count", round(minUsageKw, 6) AS minUsageKw FROM sustained"""

ORACLE["detect_silence"] = f"""WITH {READINGS}, {SILENCE_CTE}
SELECT "timestamp", meterId, siteId, round(usageKw, 6) AS usageKw, alertType, alertLevel,
  lastSeen, nextSeen, gapMs FROM silence"""

ORACLE["detect_zscore"] = f"""WITH {READINGS}, {DAYWIN_CTE}
SELECT "timestamp", meterId, siteId, round(usageKw, 6) AS usageKw, alertType, alertLevel, windowStart,
  round(mu, 6) AS mu, round(sigma, 6) AS sigma, round(zScore, 6) AS zScore FROM zs"""

ORACLE["detect_iqr"] = f"""WITH {READINGS}, {DAYWIN_CTE}
SELECT "timestamp", meterId, siteId, round(usageKw, 6) AS usageKw, alertType, alertLevel, windowStart,
  round(q1, 6) AS q1, round(q3, 6) AS q3 FROM iq"""

def _fig(x: str, digits: int = 2) -> str:
    return f"CAST(CAST(CAST({x} + {ROUND_SHIFT!r} AS DECIMAL(38,6)) AS DECIMAL(38,{digits})) AS VARCHAR)"


_IQR = "1.5 * (q3 - q1)"
_SILENT = "'no reading for more than 86400 s'"


def _alerts_cte(spike: str = "true", sustained: str = "true", tail: str = "true", day: str = "true") -> str:
    """All rules in the alert schema; the arguments limit them to closed windows."""
    cols = '"timestamp", meterId, siteId, usageKw, alertType, alertLevel'
    return f"""{HOURLY}, {DELTA_CTE}, {SUSTAINED_CTE}, {SILENCE_CTE}, {DAYWIN_CTE},
  alerts AS (
    SELECT windowStart AS "timestamp", CAST(NULL AS VARCHAR) AS meterId, siteId, avgUsageKw AS usageKw, 'SPIKE' AS alertType,
      CASE WHEN deltaPct >= 200 THEN 'CRITICAL' ELSE 'WARNING' END AS alertLevel,
      concat('avg ', {_fig('avgUsageKw')}, ' kW vs ', {_fig('prevAvgUsageKw')}, ' kW in the previous 60-minute window (+',
             {_fig('deltaPct', 1)}, '%)') AS "explain" FROM delta WHERE deltaPct >= 100 AND ({spike})
    UNION ALL SELECT {cols}, concat("count", ' readings in 60 minutes all >= 40.0 kW (min ', {_fig('minUsageKw')}, ' kW)') FROM sustained WHERE {sustained}
    UNION ALL SELECT {cols}, {_SILENT} FROM silence
    UNION ALL SELECT lastSeen + {DAY}, meterId, siteId, usageKw, 'SILENCE', 'WARNING', {_SILENT} FROM g
      WHERE nextSeen IS NULL AND ({tail})
    UNION ALL SELECT {cols}, concat('z = ', {_fig('zScore')}, ' (mean ', {_fig('mu')}, ' kW, sigma ', {_fig('sigma')}, ' kW, n = ', n, ')') FROM zs WHERE {day}
    UNION ALL SELECT {cols}, concat('outside [', {_fig(f'q1 - {_IQR}')}, ', ', {_fig(f'q3 + {_IQR}')}, '] kW (q1 ', {_fig('q1')}, ', q3 ', {_fig('q3')}, ')')
      FROM iq WHERE {day})"""


ALERTS_CTE = _alerts_cte(tail=f'(SELECT max("timestamp") FROM readings) - lastSeen > {DAY}')

ORACLE["alerts_all"] = f"""WITH {ALERTS_CTE}
SELECT "timestamp", meterId, siteId, round(usageKw, 6) AS usageKw, alertType, alertLevel, "explain" FROM alerts"""

ORACLE["alerts_index_routing"] = f"""WITH {ALERTS_CTE}
SELECT "timestamp", meterId, siteId, alertType,
  concat('power-alerts-', {index_date('"timestamp"')}) AS index_name FROM alerts"""

ORACLE["scaled_usage"] = f"""WITH {READINGS}
SELECT event_id, round(usageKw, 6) AS usageKw, CAST(floor(usageKw * 100 + 0.5) AS BIGINT) AS usageScaled,
  round(CAST(floor(usageKw * 100 + 0.5) AS BIGINT) / 100.0, 6) AS usageStored FROM readings"""

ORACLE["load_profile"] = f"""WITH {READINGS}
SELECT event_id, "timestamp", CAST(("timestamp" % {DAY}) // {HOUR} AS INTEGER) AS hourUtc,
  CAST(isodow({day_date('"timestamp"')}) - 1 AS INTEGER) AS weekday,
  {_factor('"timestamp"')} AS expectedFactor FROM readings"""

ORACLE["index_routing"] = f"""WITH {READINGS}, {rollup_cte('ro', 15)}
SELECT siteId, windowStart, windowEnd, {agg_index_name()} AS index_name,
  {date_text('windowEnd')} AS index_date FROM ro"""

ORACLE["doc_id"] = f"""WITH {READINGS}, {rollup_cte('ro', 1)}
SELECT siteId, windowStart, windowSizeMinutes, {doc_id()} AS doc_id FROM ro"""

ORACLE["raw_index_routing"] = f"""WITH {READINGS}
SELECT event_id, meterId, siteId, "timestamp",
  concat('power-usage-raw-', {index_date('"timestamp"')}) AS index_name FROM readings"""

ORACLE["index_date_parse"] = f"""WITH {READINGS}, {rollup_cte('ro', 15)}
SELECT DISTINCT {agg_index_name()} AS index_name, {date_text('windowEnd')} AS index_date FROM ro"""

ORACLE["index_inventory"] = f"""WITH {READINGS}, {rollup_cte('ro', 15)}
SELECT {agg_index_name()} AS index_name, count(*) AS docCount FROM ro GROUP BY 1"""

ORACLE["dq_value_range"] = f"""WITH {READINGS}
SELECT event_id, meterId, siteId, round(usageKw, 6) AS usageKw,
  CASE WHEN usageKw < 0 THEN 'usage_below_min' ELSE 'usage_above_max' END AS reason
FROM readings WHERE usageKw < 0 OR usageKw > 350"""

ORACLE["dq_window_range"] = f"""WITH {READINGS}, {rollup_cte('ro', 60, slide=15)},
  b AS (SELECT siteId, windowSizeMinutes,
    CASE WHEN (windowStart // 900000) % 11 = 7 THEN windowStart + 1000 ELSE windowStart END AS windowStart,
    CASE WHEN (windowStart // 900000) % 11 = 3 THEN windowStart - 60000 ELSE windowEnd END AS windowEnd FROM ro),
  f AS (SELECT *, windowStart < windowEnd AS startBeforeEnd, windowEnd - windowStart = 3600000 AS lengthMatches,
    windowStart % 900000 = 0 AS aligned FROM b)
SELECT *, startBeforeEnd AND lengthMatches AND aligned AS windowValid FROM f"""

_CLOCK = "strftime(make_timestamp({} * 1000), '%Y-%m-%d %H:%M:%S')"
ORACLE["console_line"] = f"""WITH {READINGS}, {rollup_cte('ro', 1)}
SELECT siteId, windowStart, concat('[1m] SiteId: ', siteId, ', Window: ', {_CLOCK.format('windowStart')}, ' ~ ',
    {_CLOCK.format('windowEnd')}, ', Count: ', CAST("count" AS VARCHAR)) AS head,
  round(maxUsageKw, 6) AS maxKw, round(minUsageKw, 6) AS minKw, true AS avgShown, true AS sumShown FROM ro"""

ORACLE["agg_document_json"] = f"""WITH {READINGS}, {rollup_cte('ro', 1)}
SELECT {SITE_WINDOW_SELECT}, {agg_index_name()} AS index_name, {doc_id()} AS doc_id,
  'siteId,meterId,windowStart,windowEnd,windowSizeMinutes,count,avgUsageKw,maxUsageKw,minUsageKw,sumUsageKw,'
  || 'avgVoltage,avgCurrent,avgPf' AS keys FROM ro"""

DECODED_CTE = f"""d AS (SELECT *, {_defect_case()} AS defect FROM readings)"""

ORACLE["dq_missing_site"] = f"""WITH {READINGS}, {DECODED_CTE}
SELECT event_id, meterId, "timestamp", 'missing_site' AS reason FROM d WHERE defect = 'no_site'"""

ORACLE["dq_electrical_limits"] = f"""WITH {READINGS}
SELECT event_id, meterId, siteId, round(voltage, 6) AS voltage, round(pf, 6) AS pf,
  concat_ws(',', CASE WHEN voltage < 209 OR voltage > 231 THEN 'voltage_out_of_range' END,
                 CASE WHEN pf < 0.88 OR pf > 0.95 THEN 'pf_out_of_range' END) AS reason
FROM readings WHERE coalesce(voltage < 209 OR voltage > 231, false) OR coalesce(pf < 0.88 OR pf > 0.95, false)"""

ORACLE["dq_power_identity"] = f"""WITH {READINGS},
  e AS (SELECT *, usageKw * 1000 / (voltage * pf) AS expectedCurrent FROM readings)
SELECT event_id, meterId, siteId, round("current", 6) AS "current", round(expectedCurrent, 6) AS expectedCurrent,
  round(abs("current" - expectedCurrent) / abs(expectedCurrent), 6) AS identityError,
  'power_identity' AS reason
FROM e WHERE abs("current" - expectedCurrent) / abs(expectedCurrent) > 0.01"""

ORACLE["dq_absent_site_windows"] = f"""WITH {READINGS},
  p AS (SELECT DISTINCT siteId, "timestamp" - "timestamp" % 900000 AS windowStart FROM readings),
  span AS (SELECT siteId, min(windowStart) AS f, max(windowStart) AS l FROM p GROUP BY siteId),
  e AS (SELECT siteId, unnest(range(f, l + 1, 900000)) AS windowStart FROM span)
SELECT siteId, windowStart, windowStart + 900000 AS windowEnd, CAST(15 AS INTEGER) AS windowSizeMinutes
FROM e WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.siteId = e.siteId AND p.windowStart = e.windowStart)"""

ORACLE["dq_absent_sites"] = f"""WITH {READINGS},
  p AS (SELECT DISTINCT siteId, "timestamp" - "timestamp" % {HOUR} AS windowStart FROM readings),
  s AS (SELECT DISTINCT concat('SITE-', CAST(CAST(substr(meterId, 5) AS INTEGER) % 7 AS VARCHAR)) AS siteId FROM readings),
  e AS (SELECT siteId, unnest(range((SELECT min(windowStart) FROM p), (SELECT max(windowStart) FROM p) + 1, {HOUR})) AS windowStart FROM s)
SELECT siteId, windowStart, windowStart + {HOUR} AS windowEnd, CAST(60 AS INTEGER) AS windowSizeMinutes
FROM e WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.siteId = e.siteId AND p.windowStart = e.windowStart)"""

ORACLE["ops_output"] = f"""WITH {READINGS},
  o AS (SELECT event_id, meterId, siteId, "timestamp", concat_ws(',',
    CASE WHEN siteId IS NULL OR trim(siteId) = '' THEN 'missing_site' END,
    CASE WHEN usageKw < 0 THEN 'usage_below_min' END,
    CASE WHEN usageKw > 350 THEN 'usage_above_max' END,
    CASE WHEN voltage < 209 OR voltage > 231 THEN 'voltage_out_of_range' END,
    CASE WHEN pf < 0.88 OR pf > 0.95 THEN 'pf_out_of_range' END,
    CASE WHEN abs("current" - usageKw * 1000 / (voltage * pf)) / abs(usageKw * 1000 / (voltage * pf)) > 0.01
         THEN 'power_identity' END) AS reasons FROM readings)
SELECT * FROM o WHERE reasons <> ''"""

ORACLE["ops_all"] = f"""SELECT event_id, meterId, siteId, "timestamp", reasons FROM ({ORACLE['ops_output']}) o
UNION ALL SELECT CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), siteId, windowStart, 'window_range' FROM ({ORACLE['dq_window_range']}) w WHERE NOT windowValid
UNION ALL SELECT CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), siteId, windowStart, 'absent_window'
  FROM ({ORACLE['dq_absent_site_windows'].replace('900000', str(HOUR))}) a"""

ORACLE["audit_snapshot"] = f"""WITH {READINGS}, {rollup_cte('ro', 60, extra=''', stddev_samp(usageKw) AS stddevUsageKw,
    count(*) FILTER (WHERE voltage IS NULL) AS voltageNulls,
    count(*) FILTER (WHERE "current" IS NULL) AS currentNulls,
    count(*) FILTER (WHERE pf IS NULL) AS pfNulls''')}
SELECT {SITE_WINDOW_SELECT}, round(stddevUsageKw, 6) AS stddevUsageKw, voltageNulls, currentNulls, pfNulls
FROM ro"""

ORACLE["decode_json"] = f"""WITH {READINGS}, {DECODED_CTE}
SELECT meterId, siteId, CASE WHEN defect = 'no_timestamp' THEN CAST(0 AS BIGINT) ELSE "timestamp" END AS "timestamp",
  round(usageKw, 6) AS usageKw, CASE WHEN defect = 'bad_voltage' THEN NULL ELSE round(voltage, 6) END AS voltage,
  round("current", 6) AS "current", round(pf, 6) AS pf, event_id
FROM d WHERE defect IS NULL OR defect NOT IN ('tombstone', 'no_site', 'truncated')"""

ORACLE["decode_ops"] = f"""WITH {READINGS}, {DECODED_CTE}
SELECT event_id, CASE WHEN defect = 'no_site' THEN NULL ELSE siteId END AS siteId,
  CASE WHEN defect = 'no_timestamp' THEN CAST(0 AS BIGINT) ELSE "timestamp" END AS "timestamp",
  CASE WHEN defect = 'bad_voltage' THEN NULL ELSE round(voltage, 6) END AS voltage,
  CASE defect WHEN 'no_site' THEN 'missing_site' WHEN 'unknown_key' THEN 'unknown_keys'
    WHEN 'bad_voltage' THEN 'bad_voltage' WHEN 'no_timestamp' THEN 'missing_timestamp' END AS reasons,
  defect <> 'no_site' AS emit
FROM d WHERE defect IN ('no_site', 'unknown_key', 'bad_voltage', 'no_timestamp')"""

ORACLE["decode_dead_letter"] = f"""WITH {READINGS}, {DECODED_CTE}
SELECT event_id FROM d WHERE defect = 'truncated'"""

ORACLE["decode_strict"] = f"""WITH {READINGS}, {DECODED_CTE}
SELECT event_id, coalesce(defect IN ('unknown_key', 'bad_voltage', 'truncated'), false) AS dead,
  defect IS NULL OR defect IN ('quoted_usage', 'decimal_timestamp') AS emit,
  CASE WHEN defect IN ('unknown_key', 'bad_voltage', 'truncated') THEN 'dead_letter'
       WHEN defect = 'no_site' THEN 'missing_site' WHEN defect = 'no_timestamp' THEN 'missing_timestamp'
       ELSE '' END AS reasons
FROM d WHERE defect IS NULL OR defect <> 'tombstone'"""

ORACLE["encode_kafka"] = f"""WITH {READINGS}
SELECT event_id, meterId AS "key", meterId, siteId, "timestamp", round(usageKw, 6) AS usageKw,
  round(voltage, 6) AS voltage, round("current", 6) AS "current", round(pf, 6) AS pf FROM readings"""


# --- streaming (windows closed by the final watermark) and storage -----------------
CLOSED = '(SELECT max("timestamp") FROM readings) - 120000'


def _closed(sql: str, end: str = "windowEnd") -> str:
    return f"SELECT * FROM ({sql}) c WHERE {end} <= {CLOSED}"


ORACLE["stream_tumbling"] = f"""WITH {READINGS}, {rollup_cte('ro', 60)}
SELECT {SITE_WINDOW_SELECT}, {agg_index_name()} AS index_name, {doc_id()} AS doc_id FROM ro
WHERE windowEnd <= {CLOSED}"""

ORACLE["stream_sliding"] = f"""WITH {READINGS}, {rollup_cte('ro', 60, slide=15)}
SELECT {SITE_WINDOW_SELECT}, {agg_index_name()} AS index_name, {doc_id()} AS doc_id FROM ro
WHERE windowEnd <= {CLOSED}"""

ORACLE["stream_delta_pct"] = f"""WITH {HOURLY}, {DELTA_CTE}
SELECT siteId, windowStart, windowEnd, windowSizeMinutes, round(avgUsageKw, 6) AS avgUsageKw,
  round(prevAvgUsageKw, 6) AS prevAvgUsageKw, round(deltaPct, 6) AS deltaPct FROM delta
WHERE windowEnd <= {CLOSED}"""

ORACLE["stream_moving_avg"] = f"""WITH {HOURLY}
SELECT c.siteId, c.windowStart, c.windowEnd, c.windowSizeMinutes, round(c.avgUsageKw, 6) AS avgUsageKw,
  round(avg(p.avgUsageKw), 6) AS movingAvgUsageKw, count(*) AS maWindows
FROM ro c JOIN ro p ON p.siteId = c.siteId
  AND p.windowStart BETWEEN c.windowStart - {2 * HOUR} AND c.windowStart
WHERE c.windowEnd <= {CLOSED}
GROUP BY c.siteId, c.windowStart, c.windowEnd, c.windowSizeMinutes, c.avgUsageKw"""

ORACLE["stream_sustained"] = f"""WITH {READINGS}, {SUSTAINED_CTE}
SELECT "timestamp", meterId, siteId, round(usageKw, 6) AS usageKw, alertType, alertLevel, windowEnd,
  "count", round(minUsageKw, 6) AS minUsageKw FROM sustained WHERE windowEnd <= {CLOSED}"""

ORACLE["stream_silence"] = f"""WITH {READINGS},
  g AS (SELECT meterId, siteId, "timestamp" AS lastSeen, usageKw,
    lead("timestamp") OVER (PARTITION BY meterId ORDER BY "timestamp", event_id) AS nextSeen FROM readings)
SELECT lastSeen + {DAY} AS "timestamp", meterId, siteId, round(usageKw, 6) AS usageKw,
  'SILENCE' AS alertType, 'WARNING' AS alertLevel, lastSeen
FROM g WHERE nextSeen - lastSeen > {DAY} OR (nextSeen IS NULL AND lastSeen + {DAY} <= {CLOSED})"""

ORACLE["stream_processing_time"] = f"""WITH {READINGS}, arrived AS (SELECT * REPLACE (ingestMs AS "timestamp") FROM readings),
  {rollup_cte('ro', 1, source='arrived')}
SELECT {SITE_WINDOW_SELECT} FROM ro WHERE windowEnd <= (SELECT max(ingestMs) FROM readings)"""

ORACLE["stream_upsert"] = ORACLE["stream_tumbling"]
ORACLE["stream_fanout"] = ORACLE["decode_json"]
ORACLE["sink_latest_wins"] = ORACLE["site_rollup_15m"]
ORACLE["sink_restart"] = ORACLE["site_rollup_15m"]
ORACLE["alias_view"] = ORACLE["site_rollup_1m"]

_PARTS = f"""WITH {READINGS}, {rollup_cte('ro', 15)},
  p AS (SELECT DISTINCT {agg_index_name()} AS index_name, {day_date('windowEnd')} AS d FROM ro)
SELECT index_name, strftime(d, '%Y-%m-%d') AS index_date,
  CAST(date_diff('day', d, DATE '2024-02-15') AS INTEGER) AS ageDays FROM p"""

ORACLE["retention_keep"] = f"SELECT * FROM ({_PARTS}) x WHERE ageDays <= 30"
ORACLE["retention_drop"] = f"SELECT * FROM ({_PARTS}) x WHERE ageDays > 30"

ORACLE["index_missing_days"] = f"""WITH {READINGS}, {rollup_cte('ro', 15)},
  p AS (SELECT DISTINCT siteId, {day_date('windowEnd')} AS d FROM ro
        WHERE ({day_date('windowEnd')} - DATE '1970-01-01') % 5 <> 3),
  s AS (SELECT siteId, min(d) AS f, max(d) AS l FROM p GROUP BY siteId),
  e AS (SELECT siteId, CAST(unnest(generate_series(f, l, INTERVAL 1 DAY)) AS DATE) AS d FROM s)
SELECT siteId, strftime(d, '%Y-%m-%d') AS index_date FROM e
WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.siteId = e.siteId AND p.d = e.d)"""


ORACLE["stream_spike"] = f"""WITH {HOURLY}, {DELTA_CTE}, s AS ({SPIKE_SELECT})
SELECT "timestamp", meterId, siteId, round(usageKw, 6) AS usageKw, alertType, alertLevel,
  windowSizeMinutes, round(deltaPct, 6) AS deltaPct FROM s WHERE "timestamp" + {HOUR} <= {CLOSED}"""

# strict decode keeps readings whose payload has no defect or a harmless one
_STRICT_OK = f"""ok AS (SELECT * FROM readings
  WHERE {_defect_case()} IS NULL OR {_defect_case()} IN ('quoted_usage', 'decimal_timestamp'))"""
# the routing job's four outputs hold every payload but the tombstones
ORACLE["stream_raw"] = f"""WITH {READINGS}, {_STRICT_OK}
SELECT event_id, meterId, siteId, "timestamp", round(usageKw, 6) AS usageKw, round(voltage, 6) AS voltage,
  round("current", 6) AS "current", round(pf, 6) AS pf,
  concat('power-usage-raw-', {index_date('"timestamp"')}) AS index_name FROM ok WHERE ingestMs - "timestamp" <= 120000"""
ORACLE["stream_late"] = f"""WITH {READINGS}, {_STRICT_OK}
SELECT event_id, meterId, siteId, "timestamp", round(usageKw, 6) AS usageKw, ingestMs - "timestamp" AS lagMs,
  CASE WHEN ingestMs - "timestamp" <= 600000 THEN 'late_exception' ELSE 'too_late' END AS lateness
FROM ok WHERE ingestMs - "timestamp" > 120000"""
ORACLE["stream_ops"] = f"""WITH {READINGS}, {DECODED_CTE}
SELECT event_id, meterId, CASE WHEN defect = 'no_site' THEN NULL ELSE siteId END AS siteId,
  CASE defect WHEN 'no_site' THEN 'missing_site' ELSE 'missing_timestamp' END AS reasons, false AS emit
FROM d WHERE defect IN ('no_site', 'no_timestamp')"""
ORACLE["stream_dead"] = f"""WITH {READINGS}, {DECODED_CTE}
SELECT event_id FROM d WHERE defect IN ('unknown_key', 'bad_voltage', 'truncated')"""

ORACLE["pipeline_end_to_end"] = f"""WITH {READINGS}, {_STRICT_OK}, {rollup_cte('ro', 1, source='ok')}
SELECT {SITE_WINDOW_SELECT}, {agg_index_name()} AS index_name, {doc_id()} AS doc_id FROM ro
WHERE windowEnd <= (SELECT max("timestamp") FROM ok) - 120000"""


ORACLE["stream_zscore"] = f"""WITH {READINGS}, {DAYWIN_CTE}
SELECT "timestamp", meterId, siteId, round(usageKw, 6) AS usageKw, alertType, alertLevel, windowStart,
  round(mu, 6) AS mu, round(sigma, 6) AS sigma, round(zScore, 6) AS zScore FROM zs
WHERE windowStart + {DAY} <= {CLOSED}"""


ORACLE["stream_iqr"] = f"""WITH {READINGS}, {DAYWIN_CTE}
SELECT "timestamp", meterId, siteId, round(usageKw, 6) AS usageKw, alertType, alertLevel, windowStart,
  round(q1, 6) AS q1, round(q3, 6) AS q3 FROM iq WHERE windowStart + {DAY} <= {CLOSED}"""

ORACLE["stream_alerts"] = f"""WITH {_alerts_cte(f'windowEnd <= {CLOSED}', f'windowEnd <= {CLOSED}', f'lastSeen + {DAY} <= {CLOSED}', f'windowStart + {DAY} <= {CLOSED}')}
SELECT concat_ws('-', alertType, siteId, coalesce(meterId, ''), CAST("timestamp" AS VARCHAR)) AS alert_id, "timestamp", meterId, siteId,
  round(usageKw, 6) AS usageKw, CAST(floor(round(usageKw, 6) * 100 + 0.5) AS BIGINT) AS usageScaled, alertType, alertLevel, "explain",
  concat('power-alerts-', {index_date('"timestamp"')}) AS index_name FROM alerts"""

ORACLE["stream_sigma"] = f"""WITH {READINGS} SELECT * FROM ({ORACLE['sigma']}) s WHERE windowStart + {HOUR} <= {CLOSED}"""
ORACLE["stream_audit"] = f"""WITH {READINGS} SELECT * FROM ({ORACLE['audit_snapshot']}) s WHERE windowEnd <= {CLOSED}"""
ORACLE["stream_cascade"] = f"""WITH {READINGS} SELECT * FROM ({ORACLE['site_rollup_5m']}) s WHERE windowEnd <= {CLOSED}"""
ORACLE["stream_absent_sites"] = f"""WITH {READINGS} SELECT * FROM ({ORACLE['dq_absent_sites']}) s WHERE windowEnd <= {CLOSED}"""
ORACLE["stream_silence_total"] = f"""WITH {READINGS}, {SILENCE_CTE}
SELECT lastSeen + {DAY} AS "timestamp", meterId, siteId, round(usageKw, 6) AS usageKw, 'SILENCE' AS alertType, 'WARNING' AS alertLevel,
  {_SILENT} AS "explain", lastSeen FROM g WHERE nextSeen - lastSeen > {DAY} OR nextSeen IS NULL"""

ORACLE["stream_restart"] = f"""WITH {READINGS}, {DECODED_CTE}
SELECT event_id, CASE WHEN defect IN ('unknown_key', 'bad_voltage', 'truncated') THEN 'dead'
  WHEN defect IN ('no_site', 'no_timestamp') THEN 'ops'
  WHEN ingestMs - "timestamp" <= 120000 THEN 'raw' ELSE 'late' END AS output,
  CAST(event_id % 3 // 2 AS BIGINT) AS run FROM d WHERE defect IS NULL OR defect <> 'tombstone'"""

ORACLE["stream_future_time"] = f"""WITH {READINGS}, ok AS (SELECT * FROM readings WHERE event_id % 1009 <> 5), {rollup_cte('ro', 60, source='ok')}
SELECT {SITE_WINDOW_SELECT}, {agg_index_name()} AS index_name, {doc_id()} AS doc_id FROM ro
WHERE windowEnd <= (SELECT max("timestamp") FROM ok) - 120000"""

ORACLE["store_compacted"] = ORACLE["site_rollup_15m"]

ORACLE["retention_applied"] = f"""WITH {READINGS}
SELECT event_id, meterId, "timestamp", {date_text('"timestamp"')} AS index_date FROM readings
WHERE date_diff('day', {day_date('"timestamp"')}, DATE '2024-01-20') <= 14"""

ORACLE["index_unexpected_days"] = f"""WITH {READINGS}, {rollup_cte('ro', 15)},
  c AS (SELECT {day_date('windowEnd')} AS d, count(*) AS n FROM ro WHERE ({day_date('windowEnd')} - DATE '1970-01-01') % 5 <> 3 GROUP BY 1),
  e AS (SELECT CAST(unnest(generate_series(DATE '2024-01-04', DATE '2024-02-03', INTERVAL 1 DAY)) AS DATE) AS d)
SELECT strftime(coalesce(c.d, e.d), '%Y-%m-%d') AS index_date, coalesce(n, 0) AS docCount,
  CASE WHEN e.d IS NULL THEN 'unexpected' WHEN c.d IS NULL THEN 'missing' ELSE 'present' END AS status
FROM c FULL OUTER JOIN e ON c.d = e.d"""


# Same shifted half-up rounding as ``plans.present`` (every ``round(x, 6)`` above).
ORACLE = {k: v.replace(", 6)", f" + {ROUND_SHIFT!r}, 6)") for k, v in ORACLE.items()}
