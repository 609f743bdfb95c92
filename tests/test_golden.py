"""Hand-worked 1-minute window (FIXTURES §3)."""
import pytest
from pyspark.sql import functions as F

from meterflow.functions.expressions import epoch_ms_to_ts
from meterflow.operators.rollup import site_rollup, with_document_keys

B = 1705363140000  # 2024-01-15 23:59:00 UTC
ROWS = [  # event_id, meterId, siteId, timestamp, usageKw, voltage, current, pf
    (1, "MTR-002", "SITE-A", B, 100.0, 220.0, None, 0.90),
    (2, "MTR-001", "SITE-A", B + 10000, 50.0, None, None, None),
    (3, "MTR-003", "SITE-A", B + 59999, 150.0, 222.0, None, 0.92),
    (4, "MTR-001", "SITE-A", B + 60000, 70.0, 221.0, 1.5, 0.90),
    (5, "MTR-009", "SITE-B", B + 1, 5.0, None, 2.0, None),
]
SCHEMA = ("event_id long, meterId string, siteId string, timestamp long, usageKw double, "
          "voltage double, current double, pf double")


@pytest.fixture(scope="module")
def result(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumn("ts", epoch_ms_to_ts("timestamp"))
    out = with_document_keys(site_rollup(df, 1)).orderBy("siteId", "windowStart").collect()
    return {(r.siteId, r.windowStart): r for r in out}


def test_windows(result):
    assert set(result) == {("SITE-A", B), ("SITE-A", B + 60000), ("SITE-B", B)}


def test_first_window(result):
    r = result[("SITE-A", B)]
    assert r.meterId == "MTR-002"          # first seen by arrival
    assert (r["count"], r.avgUsageKw, r.maxUsageKw, r.minUsageKw, r.sumUsageKw) == (3, 100.0, 150.0, 50.0, 300.0)
    assert r.avgVoltage == pytest.approx(221.0)   # nulls skipped
    assert r.avgCurrent is None                   # all null
    assert r.avgPf == pytest.approx(0.91)
    assert r.windowEnd == B + 60000 and r.windowSizeMinutes == 1
    assert r.index_name == "power-usage-agg-1m-2024.01.16"   # routed by window end
    assert r.doc_id == f"SITE-A-{B}"


def test_exclusive_end(result):
    r = result[("SITE-A", B + 60000)]
    assert (r["count"], r.meterId, r.avgCurrent, r.avgPf) == (1, "MTR-001", 1.5, 0.9)


def test_other_site(result):
    r = result[("SITE-B", B)]
    assert (r["count"], r.meterId, r.avgVoltage, r.avgCurrent, r.avgPf) == (1, "MTR-009", None, 2.0, None)
