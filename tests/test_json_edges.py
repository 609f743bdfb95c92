"""JSON edge rows (FIXTURES §4), lenient and strict."""
import pytest

from meterflow.sources.json_decode import decode_payloads

BASE = '"meterId":"M","siteId":"S","timestamp":1'
CASES = [
    # id, payload, lenient (dead, emit, fields), strict (dead, emit)
    ("ok", '{%s,"usageKw":1.5}' % BASE, (False, True, {"usageKw": 1.5, "voltage": None}), (False, True)),
    ("quoted", '{%s,"usageKw":"12.5"}' % BASE, (False, True, {"usageKw": 12.5}), (False, True)),
    ("decimal_ts", '{"meterId":"M","siteId":"S","timestamp":1.7,"usageKw":1}', (False, True, {"timestamp": 1}), (False, True)),
    ("missing", '{"meterId":"M","siteId":"S"}', (False, True, {"timestamp": 0, "usageKw": 0.0}), (False, False)),
    ("extra", '{%s,"usageKw":1,"extra":1}' % BASE, (False, True, {}), (True, False)),
    ("bad_voltage", '{%s,"usageKw":1,"voltage":"x"}' % BASE, (False, True, {"voltage": None}), (True, False)),
    ("nan", '{%s,"usageKw":"NaN"}' % BASE, (False, False, {}), (True, False)),
    ("infinite", '{%s,"usageKw":"Infinity"}' % BASE, (False, False, {}), (False, False)),
    ("overflow", '{%s,"usageKw":1e999}' % BASE, (True, False, {}), (True, False)),
    ("inf_voltage", '{%s,"usageKw":1,"voltage":"Infinity"}' % BASE, (False, True, {"voltage": None}), (True, False)),
    ("java_suffix", '{%s,"usageKw":"5d"}' % BASE, (True, False, {}), (True, False)),
    ("far_timestamp", '{"meterId":"M","siteId":"S","timestamp":9223372036854775807,"usageKw":1}', (False, False, {}), (False, False)),
    ("negative_timestamp", '{"meterId":"M","siteId":"S","timestamp":-5,"usageKw":1}', (False, False, {}), (False, False)),
    ("empty_number", '{%s,"usageKw":"","voltage":" "}' % BASE, (False, True, {"usageKw": 0.0, "voltage": None}), (False, False)),
    ("dup", '{"siteId":"a","siteId":"b","timestamp":1,"usageKw":1}', (False, True, {"siteId": "b"}), (False, True)),
    ("case", '{"SITEID":"y","timestamp":1,"usageKw":1}', (False, False, {}), (True, False)),
    ("nested", '{"siteId":{"a":1},"timestamp":1}', (True, False, {}), (True, False)),
    ("empty", '', (True, False, {}), (True, False)),
    ("bad", '{bad', (True, False, {}), (True, False)),
    ("array", '[{"siteId":"S"}]', (True, False, {}), (True, False)),
    ("truncated", '{"siteId":"S","timestamp":1', (True, False, {}), (True, False)),
    ("bare_num", '1', (True, False, {}), (True, False)),
    ("bare_str", '"str"', (True, False, {}), (True, False)),
    ("unquoted_nan", '{%s,"usageKw":NaN}' % BASE, (True, False, {}), (True, False)),
]


def _decode(spark, mode):
    rows = [(i, p) for i, (_, p, _, _) in enumerate(CASES)] + [(100, None), (101, "null")]
    df = spark.createDataFrame(rows, "id int, value string")
    return {r.id: r for r in decode_payloads(df, "value", mode=mode, keep=["id"]).collect()}


def test_no_row_for_null_payloads(spark):
    out = _decode(spark, "lenient")
    assert 100 not in out and 101 not in out


@pytest.mark.parametrize("mode", ["lenient", "strict"])
def test_edge_rows(spark, mode):
    out = _decode(spark, mode)
    for i, (name, _, lenient, strict) in enumerate(CASES):
        r = out[i]
        exp = lenient if mode == "lenient" else strict
        assert (r.dead, r.emit) == (exp[0], exp[1]), name
        if mode == "lenient":
            for k, v in exp[2].items():
                assert r[k] == v, (name, k)


def test_ops_reasons(spark):
    out = _decode(spark, "lenient")
    names = [c[0] for c in CASES]
    assert "bad_voltage" in out[names.index("bad_voltage")].reasons
    assert "missing_site" in out[names.index("case")].reasons
    assert "unknown_keys" in out[names.index("extra")].reasons
    assert "nan_usage" in out[names.index("nan")].reasons
