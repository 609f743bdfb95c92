"""Building blocks of the DuckDB oracle SQL.

The oracle states each query independently in plain SQL over the same
parquet tables; ``READINGS`` is the events-to-readings mapping written in
DuckDB's dialect.  Epoch ms comes from ``epoch_us(ts) // 1000`` because
``epoch_ms`` rounds where Spark floors.
"""

from __future__ import annotations

READINGS = """readings AS (
  SELECT *,
         CASE WHEN k % 5 = 0 THEN NULL
              WHEN k % 11 = 0 THEN 1.2 * usageKw * 1000 / (voltage * pf)
              ELSE usageKw * 1000 / (voltage * pf) END AS "current",
         "timestamp" + k * 10000 AS ingestMs
  FROM (SELECT concat('MTR-', lpad(CAST(user_id AS VARCHAR), 4, '0')) AS meterId,
               concat('SITE-', CAST(user_id % 5 AS VARCHAR)) AS siteId,
               epoch_us(ts) // 1000 AS "timestamp",
               value AS usageKw,
               CAST(CASE WHEN k % 10 = 0 THEN NULL WHEN k = 99 THEN 240 ELSE 214 + k % 13 END AS DOUBLE) AS voltage,
               CASE WHEN k % 7 = 0 THEN NULL
                    ELSE CAST(0.88 AS DOUBLE) + (k % 8) * CAST(0.01 AS DOUBLE) END AS pf,
               event_id, k
        FROM (SELECT *, CAST(props ->> 'k' AS INTEGER) AS k FROM events) e) r
)"""


def day_date(ms: str) -> str:
    """UTC date of an epoch-ms expression."""
    return f"(DATE '1970-01-01' + CAST(floor(({ms}) / 86400000) AS INTEGER))"


def index_date(ms: str) -> str:
    return f"strftime({day_date(ms)}, '%Y.%m.%d')"


def date_text(ms: str) -> str:
    return f"strftime({day_date(ms)}, '%Y-%m-%d')"


def r6(x: str) -> str:
    return f"round({x}, 6)"


def rollup_cte(name: str, minutes: float, source: str = "readings", slide: float | None = None,
               extra: str = "") -> str:
    """Site rollup as a CTE: tumbling, or sliding via an explicit slot list."""
    size = round(minutes * 60000)
    if slide is None:
        win = f"""SELECT *, "timestamp" - "timestamp" % {size} AS windowStart FROM {source}"""
    else:
        step = round(slide * 60000)
        n = -(-size // step)
        win = (f"""SELECT s.*, ("timestamp" - "timestamp" % {step}) - j * {step} AS windowStart
                   FROM {source} s, range(0, {n}) t(j)
                   WHERE ("timestamp" - "timestamp" % {step}) - j * {step} + {size} > "timestamp" """)
    return f"""{name} AS (
  SELECT siteId, arg_min(meterId, event_id) AS meterId, windowStart,
         windowStart + {size} AS windowEnd, CAST({size // 60000} AS INTEGER) AS windowSizeMinutes,
         count(*) AS "count", sum(usageKw) / count(*) AS avgUsageKw,
         max(usageKw) AS maxUsageKw, min(usageKw) AS minUsageKw, sum(usageKw) AS sumUsageKw,
         avg(voltage) AS avgVoltage, avg("current") AS avgCurrent, avg(pf) AS avgPf{extra}
  FROM ({win}) w GROUP BY siteId, windowStart
)"""


SITE_WINDOW_SELECT = """siteId, meterId, windowStart, windowEnd, windowSizeMinutes, "count",
  round(avgUsageKw, 6) AS avgUsageKw, round(maxUsageKw, 6) AS maxUsageKw,
  round(minUsageKw, 6) AS minUsageKw, round(sumUsageKw, 6) AS sumUsageKw,
  round(avgVoltage, 6) AS avgVoltage, round(avgCurrent, 6) AS avgCurrent, round(avgPf, 6) AS avgPf"""


def agg_index_name(end: str = "windowEnd", size: str = "windowSizeMinutes", unit: str = "m") -> str:
    return f"concat('power-usage-agg-', CAST({size} AS VARCHAR), '{unit}-', {index_date(end)})"


def doc_id(site: str = "siteId", start: str = "windowStart") -> str:
    return f"concat({site}, '-', CAST({start} AS VARCHAR))"
