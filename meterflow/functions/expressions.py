"""Column expressions shared by batch and streaming code.

Every helper returns a built-in Spark expression (no Python UDF), so it
stays inside whole-stage codegen.  Time values travel as epoch milliseconds
(``bigint``); calendar fields are derived by integer arithmetic so results do
not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterflow.schema import (AGG_INDEX_PREFIX, ALERT_INDEX_PREFIX, CONSOLE_TIME_FORMAT, DAY_MS,
                              INDEX_DATE_FORMAT, INDEX_DATE_REGEX, RAW_INDEX_PREFIX,
                              USAGE_SCALING_FACTOR)

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def once(df, expr: Column, name: str):
    """Add ``expr`` as column ``name``, evaluated exactly once per row.

    Filters above a projection are rewritten in terms of the projected
    expressions, so a predicate over several fields of one expensive parse
    (``from_json``, ``get_json_object``) would repeat the parse per field.
    A one-element ``explode`` makes the value a generator output, which
    predicates cannot be pushed beneath.
    """
    return df.select("*", F.explode(F.array(expr)).alias(name))


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_to_epoch_ms(c) -> Column:
    """TIMESTAMP_NTZ (read as UTC wall time) -> epoch ms, floored like ``unix_millis``."""
    micros = F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), col(c))
    # exact: the floored value is a multiple of 1000 well below 2^53
    return ((micros - F.pmod(micros, F.lit(1000))) / 1000).cast("bigint")


def epoch_ms_to_ts(c) -> Column:
    return F.timestamp_millis(col(c))


def ts_to_epoch_ms(c) -> Column:
    return F.unix_millis(col(c))


def epoch_day(c) -> Column:
    """Whole days since 1970-01-01 UTC (floor)."""
    return F.floor(col(c) / F.lit(DAY_MS)).cast("bigint")


def epoch_ms_to_date(c) -> Column:
    """UTC calendar date of an epoch-ms value, without the session zone."""
    return F.date_add(F.lit("1970-01-01").cast("date"), epoch_day(c).cast("int"))


def utc_hour(c) -> Column:
    return (F.pmod(col(c), F.lit(DAY_MS)) / F.lit(3_600_000)).cast("int")


def index_date_text(c) -> Column:
    """``yyyy.MM.dd`` of an epoch-ms instant in UTC."""
    return F.date_format(epoch_ms_to_date(c), INDEX_DATE_FORMAT)


def agg_index_name(window_end_ms, size_label, prefix: str = AGG_INDEX_PREFIX) -> Column:
    """Daily index of a window document: its size label and the day of the window **end** (UTC)."""
    return F.concat(F.lit(prefix + "-"), col(size_label), F.lit("-"), index_date_text(window_end_ms))


def raw_index_name(event_ms, prefix: str = RAW_INDEX_PREFIX) -> Column:
    return F.concat(F.lit(prefix + "-"), index_date_text(event_ms))


def alert_index_name(alert_ms, prefix: str = ALERT_INDEX_PREFIX) -> Column:
    return F.concat(F.lit(prefix + "-"), index_date_text(alert_ms))


def doc_id(site_id, window_start_ms) -> Column:
    """Document id ``{siteId}-{windowStart}``; unique within one index."""
    return F.concat(col(site_id), F.lit("-"), col(window_start_ms).cast("string"))


def index_date_from_name(index_name) -> Column:
    """Date embedded in an index name (``...-yyyy.MM.dd``)."""
    return F.to_date(F.regexp_extract(col(index_name), INDEX_DATE_REGEX, 0), INDEX_DATE_FORMAT)


def scaled_float(c, factor: int = USAGE_SCALING_FACTOR) -> Column:
    """Value as stored by a ``scaled_float`` field: round half up to 1/factor."""
    return F.floor(col(c) * F.lit(factor) + F.lit(0.5)).cast("bigint")


def figure(c, digits: int = 2, sign: bool = False) -> Column:
    """Text of a number, rounded half up from its sixth decimal, so that the last bits of a sum don't show."""
    d = F.round((col(c) + F.lit(3e-8)).try_cast("decimal(38,6)"), digits)
    text = d.cast("string")
    return F.when(d >= 0, F.concat(F.lit("+"), text)).otherwise(text) if sign else text


def console_time(ms) -> Column:
    return F.date_format(epoch_ms_to_ts(ms), CONSOLE_TIME_FORMAT)


def console_line(job_name: str) -> Column:
    """The console text printed per window result (fixed values: its wording and order)."""
    return F.format_string(
        "[%s] SiteId: %s, Window: %s ~ %s, Count: %d, Avg: %.2f kW, Max: %.2f kW, Min: %.2f kW, Sum: %.2f kW",
        F.lit(job_name), F.col("siteId"), console_time("windowStart"), console_time("windowEnd"),
        F.col("count"), F.col("avgUsageKw"), F.col("maxUsageKw"), F.col("minUsageKw"),
        F.col("sumUsageKw"))


def document_json(fields: list[str]) -> Column:
    """JSON text of a document, null fields written out as ``null``."""
    return F.to_json(F.struct(*[F.col(f) for f in fields]), {"ignoreNullFields": "false"})
