"""The alert job: every rule in one query, upserted by alert key.

One stateful query emits, when windows close, the alerts of the rules that
need no single readings (spike, sustained, silence) and the statistics of
closed site-days (moments and a quantile sketch).  In ``foreachBatch`` the
closed days are joined with the readings that the routing job has stored, one
day folder each, and judged by z-score and IQR.  State is bounded by sites,
meters and open windows, not by readings.  All alerts of a batch are one
commit under their alert id; a repeated alert replaces the one before.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.functions.expressions import epoch_ms_to_date
from meterflow.operators import detect as D
from meterflow.schema import ALERT_FIELDS, DAY_MS
from meterflow.sinks import documents as S
from meterflow.sinks import stores as ST
from meterflow.sinks.commits import Store
from meterflow.streaming import jobs as SJ

OUTPUT = "alerts"
_DAY = "DAY"  # rows that carry a closed day's statistics, not an alert
_STATS = ["windowStart", "n", "mu", "sigma", "bracket"]


def alert_events(readings: DataFrame, minutes: int = 60, silence_ms: int = D.SILENCE_MS, arrival: str = "event_id") -> DataFrame:
    """Alerts of closed windows and sessions, and one row per closed site-day, as one stream."""
    rules = D.all_alerts([
        D.detect_spike(SJ.stream_delta_pct(readings, minutes)),
        D.detect_sustained(D.sustained_windows(readings)),
        SJ.stream_silence(readings, silence_ms, arrival)])
    days = SJ.closed_day_stats(readings, DAY_MS, D.QUARTILES).withColumn("alertType", F.lit(_DAY))
    return rules.unionByName(days, allowMissingColumns=True).select(*ALERT_FIELDS, *_STATS)


def stored_readings(history: Store, days: DataFrame, outputs: tuple[str, ...] = ("raw", "late"), patience_s: float = 600) -> DataFrame:
    """The stored readings of the closed days in ``days``; waits while the store holds fewer than these have seen."""
    dates = [r.d for r in days.select(epoch_ms_to_date("windowStart").alias("d")).distinct().collect()]  # open days, a few
    cols = ["timestamp", "meterId", "siteId", "usageKw", "index_date"]
    until = time.monotonic() + patience_s
    while True:
        rows = None
        for o in outputs:
            part = history.read(o, "timestamp bigint, meterId string, siteId string, usageKw double, index_date date").select(*cols)
            rows = part if rows is None else rows.unionByName(part)
        rows = rows.where(F.col("index_date").isin(dates))
        held = rows.groupBy("siteId", (F.col("timestamp") - F.pmod("timestamp", F.lit(DAY_MS))).alias("windowStart")).agg(F.count("usageKw").alias("held"))
        behind = days.select("siteId", "windowStart", "n").join(held, ["siteId", "windowStart"], "left").where(F.coalesce("held", F.lit(0)) < F.col("n"))
        if not behind.limit(1).count():
            return rows.drop("index_date")
        if time.monotonic() > until:
            raise RuntimeError("the stored readings are behind the alert job")
        time.sleep(5)


def alerts_of_batch(batch: DataFrame, history: Store) -> DataFrame:
    """All alerts of one micro-batch of :func:`alert_events`, with the rule columns of z-score and IQR."""
    days = batch.where(F.col("alertType") == _DAY).select("siteId", *_STATS)
    direct = batch.where(F.col("alertType") != _DAY).select(*ALERT_FIELDS)
    if not days.limit(1).count():
        return direct.withColumns({c: F.lit(None).cast("double") for c in ("mu", "sigma", "zScore", "q1", "q3")}).withColumn("windowStart", F.lit(None).cast("bigint"))
    return direct.unionByName(D.day_outliers(stored_readings(history, days), days), allowMissingColumns=True)


def alert_sink(alerts: Store, history: Store, run: int):
    """The ``foreachBatch`` function: judge, then upsert as one commit; nothing if the batch is committed already."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if alerts.done(run, batch_id):
            return
        batch.persist()
        try:
            found = alerts_of_batch(batch, history)
            commit = alerts.begin(run, batch_id)
            alerts.write(OUTPUT, ST.alert_documents(found), commit, run, batch_id)
            alerts.commit(commit, run, batch_id)
        finally:
            batch.unpersist()
    return write


def current_alerts(alerts: Store) -> DataFrame:
    """The newest version of every alert."""
    return S.newest(alerts.read(OUTPUT).drop("commit"), ST.ALERT_KEY)
