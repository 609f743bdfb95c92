"""Pipeline wiring, connector option builders and partition retention."""
from datetime import date

import pytest
from pyspark.sql import functions as F

from testdata_paths import SF_SMALL
from meterflow.operators import rollup as R
from meterflow.session import scratch_path
from meterflow.sinks import documents as S
from meterflow.sinks import retention as RT
from meterflow.sinks.commits import Store
from meterflow.sources import kafka as K
from meterflow.fixtures import payloads as P
from meterflow.sources.adapter import load_readings
from meterflow.fixtures import replay as RP
from meterflow.streaming import alerts as AL
from meterflow.streaming.pipeline import row_account, start_aggregation


def test_pipeline_console_text_and_docs(spark):
    src = scratch_path(spark, "t-src")
    pay = P.payloads_from_readings(load_readings(spark, SF_SMALL), ("ingestMs",))
    ahead = [(10**6, '{"meterId":"m","siteId":"s","timestamp":253340000000000,"usageKw":1}', 1_700_000_000_000)]
    pay = pay.select("event_id", "value", "ingestMs").unionByName(spark.createDataFrame(ahead, "event_id long, value string, ingestMs long"))
    RP.write_replay(pay, src, 3)
    payloads = RP.replay_stream(spark, src, spark.read.parquet(src).schema)
    docs, lines = scratch_path(spark, "t-docs"), scratch_path(spark, "t-lines")
    q = start_aggregation(spark, payloads, 15, docs, scratch_path(spark, "t-ckpt"), trigger=None, lines_path=lines)
    q.awaitTermination()
    seen = row_account(q.recentProgress)
    assert seen["payloads"] == pay.where("value IS NOT NULL").count() and seen["dropped"] == 0
    assert seen["dead"] + seen["blocked"] + seen["readings"] == seen["payloads"] and seen["blocked"] > 0
    out = S.latest_wins(spark, docs)
    text = spark.read.text(lines)
    assert out.count() == text.count() > 0
    first = text.first().value
    assert first.startswith("[15m] SiteId: SITE-") and " kW, Sum: " in first


def test_kafka_options():
    o = K.kafka_options("broker:9092", "my-group", starting="earliest", max_offsets_per_trigger=1000)
    assert o == {"kafka.bootstrap.servers": "broker:9092", "subscribe": K.DEFAULT_TOPIC, "kafka.group.id": "my-group",
                 "startingOffsets": "earliest", "failOnDataLoss": "true", "maxOffsetsPerTrigger": "1000"}
    assert K.kafka_options("b", "g", fail_on_data_loss=False)["failOnDataLoss"] == "false"
    with pytest.raises(ValueError):
        K.kafka_options("broker:9092", "g", starting="middle")


def test_batch_repeat_replaces_exactly(spark):
    docs = S.to_documents(R.site_rollup(load_readings(spark, SF_SMALL), 60))
    path = scratch_path(spark, "t-log")
    S.write_batch(docs, path, 0)
    some = docs.where("siteId = 'SITE-1'")
    S.write_batch(some, path, 0)
    assert S.latest_wins(spark, path).count() == some.count() < docs.count()


def test_new_checkpoint_outranks_old_batches_and_compaction_goes_on(spark):
    docs = S.to_documents(R.site_rollup(load_readings(spark, SF_SMALL), 60)).where("siteId IN ('SITE-1', 'SITE-2')")
    path = scratch_path(spark, "t-log")
    a, b = S.open_run(spark, path, "ckpt-a"), S.open_run(spark, path, "ckpt-b")
    assert (a, b) == (0, 1) and S.open_run(spark, path, "ckpt-a") == 0
    S.write_batch(docs.withColumn("count", F.lit(-1).cast("bigint")), path, 5, a)
    S.write_batch(docs, path, 0, b)
    assert S.latest_wins(spark, path).where("count = -1").count() == 0
    store = Store(spark, path)
    S.compact(spark, path)
    assert S.latest_wins(spark, path).count() == docs.count() == store.read(S.OUTPUT).count()
    assert store.sweep(S.OUTPUT) > 0 and store.read(S.OUTPUT).count() == docs.count()
    c = S.open_run(spark, path, "ckpt-c")  # a new run after the compaction replaces nothing but its own keys
    S.write_batch(docs.where("siteId = 'SITE-1'").withColumn("count", F.lit(-2).cast("bigint")), path, 0, c)
    assert c == 2 and S.latest_wins(spark, path).where("count <> -2").count() == docs.where("siteId = 'SITE-2'").count() > 0
    S.compact(spark, path)
    assert store.live().count() == 1 and S.latest_wins(spark, path).count() == docs.count()


def test_a_batch_counts_as_a_whole_or_not_at_all(spark):
    store = Store(spark, scratch_path(spark, "t-store"))
    rows = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "id int, index_date string")
    run = store.open_run("a")
    half = store.begin(run, 0)
    store.write("raw", rows, half, run, 0)  # the job fails here: no entry is written
    assert not store.done(run, 0) and store.read("raw").count() == 0
    again = store.begin(run, 0)
    store.write("raw", rows, again, run, 0)
    store.commit(again, run, 0)
    assert store.done(run, 0) and sorted(r.id for r in store.read("raw").collect()) == [1, 2]
    assert store.read("late", "id int").count() == 0
    assert [str(d) for d in store.expire("raw", date(2024, 1, 10), 8)] == ["2024-01-01"]
    assert [r.id for r in store.read("raw").collect()] == [2]


def test_alert_job_repeats_nothing_and_waits_for_the_history(spark):
    alerts, history = Store(spark, scratch_path(spark, "t-alerts")), Store(spark, scratch_path(spark, "t-history"))
    batch = AL.alert_events(load_readings(spark, SF_SMALL).limit(0))
    write = AL.alert_sink(alerts, history, alerts.open_run("a"))
    one = spark.createDataFrame([(5, None, "SITE-1", 3.0, "SPIKE", "WARNING", "x")], "timestamp long, meterId string, siteId string, usageKw double, alertType string, alertLevel string, explain string")
    write(batch.unionByName(one, allowMissingColumns=True), 0)
    write(batch.unionByName(one, allowMissingColumns=True), 0)
    assert [(r.alert_id, r.usageScaled) for r in alerts.read("alerts").collect()] == [("SPIKE-SITE-1--5", 300)]
    days = spark.createDataFrame([("SITE-1", 0, 5)], "siteId string, windowStart long, n long")
    with pytest.raises(RuntimeError):
        AL.stored_readings(history, days, patience_s=0)


def test_replay_batches_have_several_files(spark):
    src = scratch_path(spark, "t-src")
    RP.write_replay(load_readings(spark, SF_SMALL, with_ts=False), src, 3, files_per_batch=4)
    assert len(spark.read.parquet(src).inputFiles()) == 12
    out = RP.run_available_now(RP.replay_stream(spark, src, spark.read.parquet(src).schema).select(
        "event_id", F.col("_metadata.file_path").alias("f")), "t_files", partitions=2)
    assert out.select("f").distinct().count() == 12 and out.count() == load_readings(spark, SF_SMALL).count()


def test_routing_outputs_hold_every_payload(spark):
    from meterflow.streaming.pipeline import OUTPUTS, start_routing
    r = load_readings(spark, SF_SMALL, with_ts=False)
    edge = [(10**6 + i, v, 1_700_000_000_000) for i, v in enumerate([
        '{"meterId":"m","siteId":"s","timestamp":9223372036854775807,"usageKw":1}',
        '{"meterId":"m","siteId":"s","timestamp":1700000000000,"usageKw":"Infinity"}',
        '{"meterId":"m","siteId":"s","timestamp":1700000000000,"usageKw":""}', '{bad'])]
    pay = P.payloads_from_readings(r, ("ingestMs",)).select("event_id", "value", "ingestMs")
    pay = pay.unionByName(spark.createDataFrame(edge, "event_id long, value string, ingestMs long"))
    src, out = scratch_path(spark, "t-route"), scratch_path(spark, "t-routed")
    RP.write_replay(pay, src, 2)
    start_routing(spark, RP.replay_stream(spark, src, spark.read.parquet(src).schema), out, f"{out}-ckpt", ["event_id"], trigger=None).awaitTermination()
    parts = {n: Store(spark, out).read(n) for n in OUTPUTS}
    n = {k: v.count() for k, v in parts.items()}
    blocked = parts["ops"].where("NOT emit").count()
    assert n["raw"] + n["late"] + n["dead"] + blocked == pay.where("value IS NOT NULL").count()
    why = {x.event_id: x.reasons for x in parts["ops"].where("event_id >= 1000000").collect()}
    assert why[10**6] == ["timestamp_out_of_range"] and why[10**6 + 2] == ["missing_usage"]
    assert 10**6 + 3 in {x.event_id for x in parts["dead"].collect()}


def test_encode_key_is_meter(spark):
    rec = K.encode_readings(load_readings(spark, SF_SMALL))
    row = rec.first()
    assert row.key.startswith("MTR-") and f'"meterId":"{row.key}"' in row.value


def test_drop_expired_partitions(spark):
    docs = S.to_documents(R.site_rollup(load_readings(spark, SF_SMALL), 60))
    name = "t_agg_" + scratch_path(spark, "x")[-8:]
    docs.write.partitionBy("index_date").option("path", scratch_path(spark, "t-table")).saveAsTable(name)
    days = docs.select("index_date").distinct().count()
    dropped = RT.drop_expired(spark, name, "2024-02-15", 30)
    assert 0 < len(dropped) < days
    left = spark.table(name).agg(F.min("index_date")).first()[0]
    assert str(left) >= "2024-01-16"
    spark.sql(f"DROP TABLE {name}")
