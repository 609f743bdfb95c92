"""Plan checks: partial aggregation, pruning, pushdown, no Python UDF."""
from testdata_paths import SF_SMALL
from meterflow.operators import rollup as R
from meterflow.plans.catalog import QUERIES
from meterflow.session import scratch_path
from meterflow.sinks import stores as ST
from meterflow.sinks import documents as S
from meterflow.sources.adapter import load_readings


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rollup_has_partial_aggregate(spark):
    p = _plan(R.site_rollup(load_readings(spark, SF_SMALL), 15))
    assert "partial_" in p and "Exchange hashpartitioning" in p


def test_scan_reads_only_needed_columns(spark):
    p = _plan(R.site_rollup(load_readings(spark, SF_SMALL), 15))
    read = [line for line in p.splitlines() if "ReadSchema" in line or "FileScan" in line]
    assert read and all("event_type" not in line for line in read)


UNPARSED = ["delta_pct", "moving_avg", "detect_spike", "detect_sustained", "detect_silence", "detect_zscore",
            "detect_iqr", "alerts_all", "scaled_usage", "load_profile", "raw_index_routing", "dq_value_range",
            "dq_absent_site_windows"]


def test_properties_are_not_read_where_nothing_uses_them(spark):
    for name in UNPARSED:
        p = _plan(QUERIES[name](spark, SF_SMALL))
        assert "ReadSchema" in p and "props" not in p, name


def test_texts_are_parsed_once(spark):
    for name in ("ops_output", "dq_power_identity", "dq_electrical_limits", "site_rollup_15m", "decode_json", "decode_strict"):
        p = _plan(QUERIES[name](spark, SF_SMALL)).split("== Initial Plan ==")[0]
        assert p.count("get_json_object") <= 1 and p.count("RLIKE") <= 5 and p.count("from_json") <= 1, name


def test_alerts_scan_the_readings_five_times_at_most(spark):
    df = QUERIES["alerts_all"](spark, SF_SMALL)
    df.collect()
    p = _plan(df).split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in p and p.count("FileScan") <= 5  # rollup, statistics, ranks, judgement, silence


def test_one_day_of_the_document_log_prunes_folders(spark):
    path = scratch_path(spark, "test-log")
    S.write_batch(S.to_documents(R.site_rollup(load_readings(spark, SF_SMALL), 60)), path, 0)
    p = _plan(S.latest_wins(spark, path).where("index_date = date'2024-01-05'"))
    assert "PartitionFilters: [isnotnull(index_date" in p


def test_no_python_udf_anywhere(spark):
    for name in ["site_rollup_15m", "delta_pct", "detect_iqr", "detect_zscore", "detect_silence",
                 "decode_json", "ops_output", "dq_absent_site_windows"]:
        p = _plan(QUERIES[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_alias_view_prunes_partitions(spark):
    path = scratch_path(spark, "test-store")
    r = load_readings(spark, SF_SMALL)
    for m in (1, 15):
        ST.write_daily(S.to_documents(R.site_rollup(r, m)), path, ["windowSizeMinutes"])
    p = _plan(ST.alias_view(spark, path, 1))
    assert "PartitionFilters: [isnotnull(windowSizeMinutes" in p


def test_value_filter_pushed_to_scan(spark):
    from meterflow.operators.quality import value_range
    p = _plan(value_range(load_readings(spark, SF_SMALL), max_kw=350.0))
    assert "PushedFilters: [Or(LessThan(value,0.0),GreaterThan(value,350.0))]" in p
