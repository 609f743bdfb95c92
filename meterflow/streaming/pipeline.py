"""The jobs: payload stream -> decode -> outputs.

:func:`start_routing` decodes each micro-batch once and writes every payload
to exactly one of: ``raw`` (on-time readings), ``late`` (late exception and
too late), ``dead`` (dead letters) or, blocked by a finding, ``ops``; readings
with a harmless finding are in ``ops`` as well.  Nothing is dropped but
tombstones.  All outputs of a batch are one commit of the store.

:func:`start_aggregation` mirrors the original topology (source -> key by site
-> window -> print and index) as one Structured Streaming query per window
size: each closed window is upserted into the document log and optionally
rendered as console text (written by the executors).  Its event time is
guarded: a reading whose timestamp lies after its arrival is no reading but an
``ops`` row of the routing job, so it can't move the watermark.  What the
watermark drops all the same is counted, see :func:`row_account`.

Every job needs its checkpoint.  A restart from it goes on where the job
stopped, under the same run number; batches that are already committed are
not written again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.functions.expressions import epoch_ms_to_date, epoch_ms_to_ts
from meterflow.operators import lateness as L
from meterflow.session import scratch_path
from meterflow.sinks import documents as S
from meterflow.sinks import stores as ST
from meterflow.sinks.commits import Store
from meterflow.sources import json_decode as J
from meterflow.sources import kafka as K
from meterflow.streaming import jobs as SJ

CHECKPOINT_INTERVAL = "60 seconds"
OUTPUTS = ("raw", "late", "ops", "dead")


def decode_stream(payloads: DataFrame, mode: str, arrival: list[str], ingest_col: str | None) -> DataFrame:
    keep = [*arrival, *([ingest_col] if ingest_col and ingest_col not in arrival else [])]
    return J.decode_payloads(payloads, "value", mode=mode, keep=keep, arrival_ms=ingest_col)


def decoded_readings(payloads: DataFrame, mode: str = "strict", arrival: list[str] | None = None,
                     watermark: str = SJ.WATERMARK, ingest_col: str | None = "ingestMs") -> DataFrame:
    """Readings with event time; their number and what was held back are observed as ``decoded``."""
    arrival = arrival or []
    dec = decode_stream(payloads, mode, arrival, ingest_col).observe(
        "decoded", F.count(F.lit(1)).alias("payloads"), F.count_if("dead").alias("dead"),
        F.count_if(~F.col("dead") & ~F.col("emit")).alias("blocked"), F.count_if("emit").alias("readings"))
    r = J.readings_of(dec, keep=arrival).withColumn("ts", epoch_ms_to_ts("timestamp"))
    return SJ.with_event_time(r, watermark)


def row_account(progress: list) -> dict[str, int]:
    """Sums over a query's progress reports: payloads, dead, blocked, readings, rows the watermark dropped.

    ``dropped`` counts partial groups (site and window of one task), the unit that Spark reports.
    """
    total = dict.fromkeys(("payloads", "dead", "blocked", "readings", "dropped"), 0)
    for p in progress:
        seen = (p.observedMetrics or {}).get("decoded")
        if seen is not None:
            for k in ("payloads", "dead", "blocked", "readings"):
                total[k] += seen[k] or 0
        total["dropped"] += sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
    return total


def start_jobs(spark: SparkSession, servers: str, group_id: str, path: str, minutes: list[int], checkpoints: str,
               trigger: str | None = CHECKPOINT_INTERVAL, **options) -> list:
    """The whole topology on Kafka: the routing query and one aggregation query per window size.

    Stores lie under ``path``, the checkpoint of each query in a folder of
    its own under ``checkpoints``.  The starting position only holds for
    queries that have no checkpoint there.
    """
    def source(name: str) -> DataFrame:
        return K.kafka_values(K.kafka_reader(spark, servers, f"{group_id}-{name}", **options).load())
    at = checkpoints.rstrip("/")
    jobs = [start_routing(spark, source("route"), path, f"{at}/route", K.KAFKA_ARRIVAL, trigger=trigger)]
    for m in minutes:
        jobs.append(start_aggregation(spark, source(f"{m}m"), m, f"{path.rstrip('/')}/documents-{m}m", f"{at}/{m}m",
                                      arrival=K.KAFKA_ARRIVAL, trigger=trigger))
    return jobs


def route_batch(batch: DataFrame, store: Store, run: int, batch_id: int, arrival: list[str], ingest_col: str = "ingestMs") -> None:
    """Write one decoded micro-batch to the four outputs as one commit; nothing if it is committed already.

    Readings lie under the day of their event time, dead letters and findings under that of their arrival.
    """
    if store.done(run, batch_id):
        return
    keep = [*arrival, ingest_col]
    arrived = epoch_ms_to_date(ingest_col)
    batch.persist()
    try:
        readings = L.route_lateness(J.readings_of(batch, keep=keep))
        on_time = F.col("lateness") == "on_time"
        parts = {"raw": ST.raw_documents(readings.where(on_time)), "late": ST.raw_documents(readings.where(~on_time)),
                 "ops": J.ops_of(batch, keep=keep).withColumn("index_date", arrived),
                 "dead": J.dead_letter_of(batch, keep=keep).withColumn("index_date", arrived)}
        commit = store.begin(run, batch_id)
        for name in OUTPUTS:
            store.write(name, parts[name], commit, run, batch_id)
        store.commit(commit, run, batch_id)
    finally:
        batch.unpersist()


def _started(w, checkpoint: str, name: str, trigger: str | None):
    w = w.option("checkpointLocation", checkpoint).queryName(name)
    return (w.trigger(processingTime=trigger) if trigger else w.trigger(availableNow=True)).start()


def start_routing(spark: SparkSession, payloads: DataFrame, path: str, checkpoint: str, arrival: list[str],
                  ingest_col: str = "ingestMs", mode: str = "strict", trigger: str | None = CHECKPOINT_INTERVAL):
    """Start the routing query; ``ingest_col`` is the arrival time in epoch ms.

    ``trigger=None`` drains the available input (``availableNow``) and stops.
    """
    store = Store(spark, path)
    run = store.open_run(checkpoint)
    w = decode_stream(payloads, mode, arrival, ingest_col).writeStream.foreachBatch(
        lambda b, i: route_batch(b, store, run, i, arrival, ingest_col))
    return _started(w, checkpoint, f"power_usage_route_{scratch_path(spark, 'q')[-8:]}", trigger)


def start_aggregation(spark: SparkSession, payloads: DataFrame, minutes: int, doc_path: str, checkpoint: str,
                      job_name: str | None = None, arrival: str | list[str] = "event_id",
                      mode: str = "strict", trigger: str | None = CHECKPOINT_INTERVAL,
                      lines_path: str | None = None, ingest_col: str | None = "ingestMs"):
    """Start the rollup query for one window size; returns the StreamingQuery.

    ``ingest_col`` guards the event time; None only where payloads have no
    arrival time.  ``trigger=None`` drains the available input
    (``availableNow``) and stops.
    """
    keys = [arrival] if isinstance(arrival, str) else list(arrival)
    rollup = SJ.stream_rollup(decoded_readings(payloads, mode=mode, arrival=keys, ingest_col=ingest_col), minutes, arrival=keys)
    name = job_name or f"{minutes}m"
    store = Store(spark, doc_path)
    run = store.open_run(checkpoint)

    def sink(batch: DataFrame, batch_id: int) -> None:
        if store.done(run, batch_id):
            return
        batch.persist()
        try:
            if lines_path:  # the console text, written by the executors
                SJ.console_lines(batch, name).write.mode("overwrite").text(f"{lines_path}/run={run}/batch_id={batch_id}")
            S.write_batch(S.to_documents(batch), doc_path, batch_id, run)
        finally:
            batch.unpersist()

    return _started(rollup.writeStream.foreachBatch(sink), checkpoint, f"power_usage_agg_{name}_{scratch_path(spark, 'q')[-8:]}", trigger)
