"""Registered streaming and storage queries.

Streaming queries replay the readings derived from ``events`` as a file
stream (5 micro-batches in event order), run to completion with
``availableNow`` and return the committed output.  Windowed outputs hold
the windows closed by the final watermark (max event time - 120 s).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from meterflow.functions.expressions import epoch_ms_to_date, epoch_ms_to_ts
from meterflow.operators import detect as D
from meterflow.operators import lateness as L
from meterflow.operators import rollup as R
from meterflow.plans.catalog import METRIC_MINUTES, MA_WINDOWS, SIGMA_WINDOWS, register
from meterflow.plans.present import present
from meterflow.schema import DAY_MS, SITE_WINDOW_FIELDS
from meterflow.session import scratch_path
from meterflow.sinks import documents as S
from meterflow.sinks import retention as RT
from meterflow.sinks import stores as ST
from meterflow.sinks.commits import Store
from meterflow.sources import json_decode as J
from meterflow.sources import kafka as K
from meterflow.fixtures import payloads as P
from meterflow.sources.adapter import load_readings
from meterflow.streaming import alerts as AL
from meterflow.streaming import jobs as SJ
from meterflow.streaming.pipeline import OUTPUTS, decoded_readings, start_aggregation, start_routing
from meterflow.fixtures import replay as RP

REPLAY_BATCHES = 5
# the jobs that join with stored readings run two queries over the replay
HISTORY_BATCHES = 2
SILENCE_MS = 24 * 3_600_000
HOUR_MS = 3_600_000
# storage fixture parameters: retention checked as of this day
RETENTION_AS_OF = "2024-02-15"
RETENTION_DAYS = 30

DOC_COLUMNS = SITE_WINDOW_FIELDS + ["index_name", "doc_id"]


# state partitions of the replayed queries: these tables are small, a production job sets its own
STATE_PARTITIONS = 4


def replayed_readings(spark, sf_dir, batches: int = REPLAY_BATCHES, event_time: bool = True,
                      order_col: str = "event_id"):
    src = scratch_path(spark, "replay-src")
    RP.write_replay(load_readings(spark, sf_dir, with_ts=False), src, batches, order_col)
    schema = spark.read.parquet(src).schema
    s = RP.replay_stream(spark, src, schema)
    s = s.withColumn("ts", epoch_ms_to_ts("timestamp"))
    return SJ.with_event_time(s) if event_time else s


@register("stream_tumbling")
def q_stream_tumbling(spark, sf_dir):
    s = R.with_document_keys(SJ.stream_rollup(replayed_readings(spark, sf_dir), METRIC_MINUTES))
    return present(RP.run_available_now(s, "stream_tumbling", partitions=STATE_PARTITIONS).select(*DOC_COLUMNS))


@register("stream_sliding")
def q_stream_sliding(spark, sf_dir):
    s = R.with_document_keys(SJ.stream_rollup(replayed_readings(spark, sf_dir), 60, 15))
    return present(RP.run_available_now(s, "stream_sliding", partitions=STATE_PARTITIONS).select(*DOC_COLUMNS))


@register("stream_delta_pct")
def q_stream_delta_pct(spark, sf_dir):
    s = SJ.stream_delta_pct(replayed_readings(spark, sf_dir), METRIC_MINUTES)
    return present(RP.run_available_now(s, "stream_delta_pct", partitions=STATE_PARTITIONS))


@register("stream_moving_avg")
def q_stream_moving_avg(spark, sf_dir):
    s = SJ.stream_moving_avg(replayed_readings(spark, sf_dir), METRIC_MINUTES, MA_WINDOWS)
    return present(RP.run_available_now(s, "stream_moving_avg", partitions=STATE_PARTITIONS))


@register("stream_sustained")
def q_stream_sustained(spark, sf_dir):
    s = D.detect_sustained(D.sustained_windows(replayed_readings(spark, sf_dir)))
    return present(RP.run_available_now(s, "stream_sustained", partitions=STATE_PARTITIONS).drop("explain"))


@register("stream_silence")
def q_stream_silence(spark, sf_dir):
    s = SJ.stream_silence(replayed_readings(spark, sf_dir), SILENCE_MS)
    return present(RP.run_available_now(s, "stream_silence", partitions=STATE_PARTITIONS).select(
        "timestamp", "meterId", "siteId", "usageKw", "alertType", "alertLevel", "lastSeen"))


@register("stream_processing_time")
def q_stream_processing_time(spark, sf_dir):
    """1-minute windows by arrival (the original job's active mode), replayed in order of arrival."""
    r = replayed_readings(spark, sf_dir, event_time=False, order_col="ingestMs")
    s = SJ.with_processing_time(r, epoch_ms_to_ts("ingestMs"))
    ro = SJ.stream_rollup(s, 1, time_col="pt")
    return present(RP.run_available_now(ro, "stream_processing_time", partitions=STATE_PARTITIONS))


@register("stream_upsert")
def q_stream_upsert(spark, sf_dir):
    """Closed windows upserted per micro-batch into the document log, read latest-wins."""
    path = scratch_path(spark, "doc-log")
    ro = SJ.stream_rollup(replayed_readings(spark, sf_dir), METRIC_MINUTES)

    def sink(batch, batch_id):
        S.write_batch(S.to_documents(batch), path, batch_id)

    RP.run_foreach_batch(ro, "stream_upsert", sink, partitions=STATE_PARTITIONS)
    return present(S.latest_wins(spark, path).select(*DOC_COLUMNS))


@register("stream_fanout")
def q_stream_fanout(spark, sf_dir):
    """One decode stream fanned out to the raw store, ops and dead letters per batch."""
    src = scratch_path(spark, "payload-src")
    RP.write_replay(P.payloads_from_readings(load_readings(spark, sf_dir)), src, REPLAY_BATCHES)
    payloads = RP.replay_stream(spark, src, spark.read.parquet(src).schema)
    decoded = J.decode_payloads(payloads, "value", keep=["event_id"])
    raw_path, ops_path, dead_path = (scratch_path(spark, n) for n in ("raw", "ops", "dead"))

    def fan_out(batch, batch_id):
        batch.persist()
        try:
            tag = F.lit(batch_id).cast("bigint").alias("batch_id")
            ST.write_daily(ST.raw_documents(J.readings_of(batch, keep=["event_id"])).select("*", tag),
                           raw_path, ["batch_id"], mode="overwrite")
            J.ops_of(batch, keep=["event_id"]).select("*", tag).write.mode("overwrite") \
                .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(ops_path)
            J.dead_letter_of(batch, keep=["event_id"]).select("*", tag).write.mode("overwrite") \
                .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(dead_path)
        finally:
            batch.unpersist()

    RP.run_foreach_batch(decoded, "stream_fanout", fan_out)
    raw = spark.read.parquet(raw_path)
    return present(raw.select("meterId", "siteId", "timestamp", "usageKw", "voltage", "current", "pf",
                              "event_id"))


def _docs(spark, sf_dir, minutes):
    return S.to_documents(R.site_rollup(load_readings(spark, sf_dir), minutes))


@register("sink_latest_wins")
def q_sink_latest_wins(spark, sf_dir):
    """Batch 0 holds on-time readings only; batch 1 (all readings) is written twice."""
    r = load_readings(spark, sf_dir)
    path = scratch_path(spark, "doc-log")
    on_time = L.route_lateness(r).where(F.col("lateness") == "on_time")
    S.write_batch(S.to_documents(R.site_rollup(on_time, 15)), path, 0)
    full = S.to_documents(R.site_rollup(r, 15))
    S.write_batch(full, path, 1)
    S.write_batch(full, path, 1)
    return present(S.latest_wins(spark, path).select(*DOC_COLUMNS))


@register("sink_restart")
def q_sink_restart(spark, sf_dir):
    """A first run's batches 0-5 hold partial results; a new checkpoint starts at batch 0 with the full ones."""
    r = load_readings(spark, sf_dir)
    path = scratch_path(spark, "doc-log")
    on_time = S.to_documents(R.site_rollup(L.route_lateness(r).where(F.col("lateness") == "on_time"), 15))
    first = S.open_run(spark, path, "checkpoint-a")
    for batch in (0, 5):
        S.write_batch(on_time, path, batch, first)
    S.write_batch(S.to_documents(R.site_rollup(r, 15)), path, 0, S.open_run(spark, path, "checkpoint-b"))
    return present(S.latest_wins(spark, path).select(*DOC_COLUMNS))


@register("alias_view")
def q_alias_view(spark, sf_dir):
    path = scratch_path(spark, "agg-store")
    for m in (1, 15):
        ST.write_daily(_docs(spark, sf_dir, m), path, ["windowSizeMinutes"])
    return present(ST.alias_view(spark, path, 1).select(*DOC_COLUMNS))


def _parts(spark, sf_dir):
    return RT.index_partitions(_docs(spark, sf_dir, 15))


@register("retention_keep")
def q_retention_keep(spark, sf_dir):
    return present(RT.retention_keep(_parts(spark, sf_dir), RETENTION_AS_OF, RETENTION_DAYS))


@register("retention_drop")
def q_retention_drop(spark, sf_dir):
    return present(RT.retention_drop(_parts(spark, sf_dir), RETENTION_AS_OF, RETENTION_DAYS))


# every day whose number leaves 3 by this modulus is left out, so that there are gaps to find
GAP_DAYS = 5


@register("index_missing_days")
def q_index_missing_days(spark, sf_dir):
    docs = _docs(spark, sf_dir, 15)
    return present(RT.missing_days(docs.where(F.unix_date("index_date") % GAP_DAYS != 3)))


@register("stream_spike")
def q_stream_spike(spark, sf_dir):
    s = D.detect_spike(SJ.stream_delta_pct(replayed_readings(spark, sf_dir), METRIC_MINUTES))
    return present(RP.run_available_now(s, "stream_spike", partitions=STATE_PARTITIONS).drop("explain"))


def _replayed_payloads(spark, payloads, name: str, batches: int = REPLAY_BATCHES):
    src = scratch_path(spark, name)
    RP.write_replay(payloads, src, batches)
    return RP.replay_stream(spark, src, spark.read.parquet(src).schema)


def _routed(spark, sf_dir):
    """The routing job over damaged payloads: the store of its four outputs."""
    out = scratch_path(spark, "routed")
    pay = P.payloads_from_readings(load_readings(spark, sf_dir, with_ts=False), ("ingestMs",))
    start_routing(spark, _replayed_payloads(spark, pay, "route-src"), out, scratch_path(spark, "route-ckpt"), ["event_id"], trigger=None).awaitTermination()
    return Store(spark, out)


@register("stream_raw")
def q_stream_raw(spark, sf_dir):
    raw = _routed(spark, sf_dir).read("raw")
    return present(raw.select("event_id", "meterId", "siteId", "timestamp", "usageKw", "voltage", "current", "pf", "index_name"))


@register("stream_late")
def q_stream_late(spark, sf_dir):
    late = _routed(spark, sf_dir).read("late")
    return present(late.select("event_id", "meterId", "siteId", "timestamp", "usageKw", "lagMs", "lateness"))


@register("stream_ops")
def q_stream_ops(spark, sf_dir):
    ops = _routed(spark, sf_dir).read("ops")
    return present(ops.select("event_id", "meterId", "siteId", F.concat_ws(",", "reasons").alias("reasons"), "emit"))


@register("stream_dead")
def q_stream_dead(spark, sf_dir):
    dead = _routed(spark, sf_dir).read("dead")
    return present(dead.select("event_id"))


@register("pipeline_end_to_end")
def q_pipeline_end_to_end(spark, sf_dir):
    """Payload files -> strict decode -> 1-minute site rollup -> document log (latest wins)."""
    pay = P.payloads_from_readings(load_readings(spark, sf_dir), ("ingestMs",))
    docs = scratch_path(spark, "pipeline-docs")
    q = start_aggregation(spark, _replayed_payloads(spark, pay, "pipeline-src"), 1, docs, scratch_path(spark, "pipeline-ckpt"), trigger=None,
                          lines_path=scratch_path(spark, "pipeline-console"))
    q.awaitTermination()
    return present(S.latest_wins(spark, docs).select(*DOC_COLUMNS))


@register("stream_restart")
def q_stream_restart(spark, sf_dir):
    """The routing job stopped and started again: from its checkpoint, then with a new one on further input."""
    pay = P.payloads_from_readings(load_readings(spark, sf_dir, with_ts=False), ("ingestMs",))
    first, other, out = (scratch_path(spark, n) for n in ("restart-src", "restart-src2", "restarted"))
    for third, src, checkpoint in ((0, first, "a"), (1, first, "a"), (2, other, "b")):
        pay.where(F.pmod("event_id", F.lit(3)) == third).write.mode("append").parquet(src)
        stream = RP.replay_stream(spark, src, spark.read.parquet(src).schema)
        start_routing(spark, stream, out, f"{out}-ckpt-{checkpoint}", ["event_id"], trigger=None).awaitTermination()
    store = Store(spark, out)
    parts = [store.read(o) for o in OUTPUTS]
    parts = [p.where("NOT emit") if o == "ops" else p for o, p in zip(OUTPUTS, parts)]
    return present(reduce(lambda a, b: a.unionByName(b), [p.select("event_id", F.lit(o).alias("output"), "run") for o, p in zip(OUTPUTS, parts)]))


# every 1009th reading gets a timestamp in the year 9998
FUTURE_EVERY, FUTURE_REST, FUTURE_MS = 1009, 5, 253_340_000_000_000


@register("stream_future_time")
def q_stream_future_time(spark, sf_dir):
    """Hourly documents of a stream in which some meters' clocks are thousands of years ahead."""
    r = load_readings(spark, sf_dir)
    r = r.withColumn("timestamp", F.when(F.pmod("event_id", F.lit(FUTURE_EVERY)) == FUTURE_REST, F.lit(FUTURE_MS)).otherwise(F.col("timestamp")))
    docs = scratch_path(spark, "future-docs")
    stream = _replayed_payloads(spark, K.encode_readings(r, keep=["event_id", "ingestMs"]), "future-src")
    start_aggregation(spark, stream, METRIC_MINUTES, docs, scratch_path(spark, "future-ckpt"), trigger=None).awaitTermination()
    return present(S.latest_wins(spark, docs).select(*DOC_COLUMNS))


def _history(spark, sf_dir):
    """All readings routed into a store, and the same payloads as a stream of readings."""
    pay = K.encode_readings(load_readings(spark, sf_dir), keep=["event_id", "ingestMs"])
    out, src = scratch_path(spark, "history"), scratch_path(spark, "history-src")
    RP.write_replay(pay, src, HISTORY_BATCHES)

    def stream():
        return RP.replay_stream(spark, src, spark.read.parquet(src).schema)
    start_routing(spark, stream(), out, f"{out}-ckpt", ["event_id"], trigger=None).awaitTermination()
    return Store(spark, out), decoded_readings(stream(), arrival=["event_id"])


def _outliers(spark, sf_dir, rule):
    """Alerts of one rule on closed days, with its columns: statistics from the stream's state, readings from the store."""
    history, readings = _history(spark, sf_dir)
    found = Store(spark, scratch_path(spark, "outliers"))

    def sink(batch, batch_id):
        commit = found.begin(0, batch_id)
        rows = D.day_outliers(AL.stored_readings(history, batch), batch).where(F.col("alertType") == rule)
        found.write("alerts", rows.withColumn("index_date", epoch_ms_to_date("timestamp")), commit, 0, batch_id)
        found.commit(commit, 0, batch_id)

    RP.run_foreach_batch(SJ.closed_day_stats(readings, DAY_MS, D.QUARTILES), "outliers", sink, partitions=STATE_PARTITIONS)
    return found.read("alerts")


@register("stream_iqr")
def q_stream_iqr(spark, sf_dir):
    return present(_outliers(spark, sf_dir, "IQR").select("timestamp", "meterId", "siteId", "usageKw", "alertType", "alertLevel", "windowStart", "q1", "q3"))


@register("stream_alerts")
def q_stream_alerts(spark, sf_dir):
    """Every rule on closed windows and sessions, upserted by alert id; the last batch is written twice."""
    history, readings = _history(spark, sf_dir)
    alerts = Store(spark, scratch_path(spark, "alerts"))
    write = AL.alert_sink(alerts, history, alerts.open_run("a"))
    RP.run_foreach_batch(AL.alert_events(readings, METRIC_MINUTES, SILENCE_MS), "stream_alerts", write, partitions=STATE_PARTITIONS)
    again = AL.current_alerts(alerts).drop("run", "batch_id")
    commit = alerts.begin(1, 0)
    alerts.write(AL.OUTPUT, again, commit, 1, 0)
    alerts.commit(commit, 1, 0)
    return present(AL.current_alerts(alerts).select("alert_id", "timestamp", "meterId", "siteId", "usageKw", "usageScaled", "alertType", "alertLevel", "explain", "index_name"))


@register("stream_sigma")
def q_stream_sigma(spark, sf_dir):
    s = SJ.stream_sigma(replayed_readings(spark, sf_dir), METRIC_MINUTES, SIGMA_WINDOWS, D.BASE_MINUTES)
    return present(RP.run_available_now(s, "stream_sigma", partitions=STATE_PARTITIONS))


@register("stream_audit")
def q_stream_audit(spark, sf_dir):
    s = SJ.stream_rollup(replayed_readings(spark, sf_dir), METRIC_MINUTES, audit=True)
    return present(RP.run_available_now(s, "stream_audit", partitions=STATE_PARTITIONS))


@register("stream_cascade")
def q_stream_cascade(spark, sf_dir):
    """5-minute documents from 15-second windows by way of 1-minute ones."""
    s = R.with_document_keys(SJ.stream_cascade(replayed_readings(spark, sf_dir), [0.25, 1, 5]).drop(*R.CARRY_COLUMNS))
    return present(RP.run_available_now(s, "stream_cascade", partitions=STATE_PARTITIONS).select(*DOC_COLUMNS))


def _ticked(spark, sf_dir, ticks, name):
    """Readings and ticks (``siteId``, ``timestamp``) replayed as one stream in order of time."""
    r = load_readings(spark, sf_dir, with_ts=False)
    src = scratch_path(spark, name)
    RP.write_replay(SJ.with_clock(r, ticks), src, REPLAY_BATCHES, "timestamp")
    return SJ.with_event_time(RP.replay_stream(spark, src, spark.read.parquet(src).schema).withColumn("ts", epoch_ms_to_ts("timestamp")))


@register("stream_absent_sites")
def q_stream_absent_sites(spark, sf_dir):
    """Closed hourly windows without a reading for a list of sites, two of which never report."""
    r = load_readings(spark, sf_dir, electrical=False)
    lo, hi = r.agg(F.min("timestamp"), F.max("timestamp")).first()
    sites = r.select(F.concat(F.lit("SITE-"), (F.substring("meterId", 5, 10).cast("int") % 7).cast("string")).alias("siteId")).distinct()
    ticks = sites.select("siteId", F.explode(F.sequence(F.lit(lo - lo % HOUR_MS), F.lit(hi), F.lit(HOUR_MS))).alias("timestamp"))
    s = SJ.stream_absent(_ticked(spark, sf_dir, ticks, "absent-src"), METRIC_MINUTES)
    return present(RP.run_available_now(s, "stream_absent_sites", partitions=STATE_PARTITIONS))


@register("stream_silence_total")
def q_stream_silence_total(spark, sf_dir):
    """Silence when every meter stops: a clock goes on for two days after the last reading."""
    hi = load_readings(spark, sf_dir, electrical=False).agg(F.max("timestamp")).first()[0]
    ticks = spark.range(1, 49).select(F.lit(None).cast("string").alias("siteId"), (F.lit(hi) + F.col("id") * HOUR_MS).alias("timestamp"))
    readings = SJ.after_watermark(_ticked(spark, sf_dir, ticks, "silent-src"), ~F.col("tick"))
    s = SJ.stream_silence(readings, SILENCE_MS)
    return present(RP.run_available_now(s, "stream_silence_total", partitions=STATE_PARTITIONS).select(
        "timestamp", "meterId", "siteId", "usageKw", "alertType", "alertLevel", "explain", "lastSeen"))


@register("store_compacted")
def q_store_compacted(spark, sf_dir):
    """Partial documents, compacted in place and swept; then a new run's two batches bring the full ones."""
    r = load_readings(spark, sf_dir)
    path = scratch_path(spark, "doc-log")
    some = S.to_documents(R.site_rollup(L.route_lateness(r).where(F.col("lateness") == "on_time"), 15))
    run = S.open_run(spark, path, "checkpoint-a")
    for batch in (0, 7):
        S.write_batch(some, path, batch, run)
    S.compact(spark, path)
    Store(spark, path).sweep(S.OUTPUT)
    full = S.to_documents(R.site_rollup(r, 15))
    run = S.open_run(spark, path, "checkpoint-b")
    S.write_batch(full.where("siteId = 'SITE-1'"), path, 0, run)
    S.write_batch(full.where("siteId <> 'SITE-1'"), path, 1, run)
    return present(S.latest_wins(spark, path).select(*DOC_COLUMNS))


# the stores are cleaned as of this day
APPLIED_AS_OF, APPLIED_DAYS = "2024-01-20", 14


@register("retention_applied")
def q_retention_applied(spark, sf_dir):
    """What is left of a raw store after its expired day folders are deleted."""
    store = Store(spark, scratch_path(spark, "raw-store"))
    raw = ST.raw_documents(load_readings(spark, sf_dir, with_ts=False))
    for batch in (0, 1):
        commit = store.begin(0, batch)
        store.write("raw", raw.where(F.pmod("event_id", F.lit(2)) == batch), commit, 0, batch)
        store.commit(commit, 0, batch)
    RT.apply_retention(store, APPLIED_AS_OF, {"raw": APPLIED_DAYS})
    return present(store.read("raw").select("event_id", "meterId", "timestamp", "index_date"))


CALENDAR = ("2024-01-04", "2024-02-03")


@register("index_unexpected_days")
def q_index_unexpected_days(spark, sf_dir):
    """Stored documents per day beside a calendar that starts late and ends late; some days have gaps."""
    path = scratch_path(spark, "doc-log")
    S.write_batch(_docs(spark, sf_dir, 15).where(F.unix_date("index_date") % GAP_DAYS != 3), path, 0)
    return present(RT.calendar_inventory(Store(spark, path), S.OUTPUT, *CALENDAR, size=15))


@register("stream_zscore")
def q_stream_zscore(spark, sf_dir):
    return present(_outliers(spark, sf_dir, "ZSCORE").select(
        "timestamp", "meterId", "siteId", "usageKw", "alertType", "alertLevel", "windowStart", "mu", "sigma", "zScore"))
