"""JSON reading decode.

One pass over the payload column yields a *decoded* frame: reading fields,
the raw text, quality ``reasons`` and two flags.  Readings, the ``ops`` side
output and the dead-letter output are plain filters of that frame, so a
stream writes all three from one ``foreachBatch`` without re-reading Kafka.

Lenient mode follows the original deserializer where it is well defined
(numeric strings coerce, ``1.7`` truncates into a long, duplicate keys keep
the last value, unknown keys are ignored, missing ``timestamp``/``usageKw``
default to 0) and turns its job-killing exceptions into dead letters.
Strict mode additionally dead-letters unknown keys and failed casts and
sends missing required fields to ``ops`` instead of defaulting them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow.functions.expressions import once
from meterflow.operators.lateness import AHEAD_MS
from meterflow.schema import READING_FIELDS

CORRUPT = "_corrupt"
_TEXT_SCHEMA = T.StructType([T.StructField(f, T.StringType(), True) for f in READING_FIELDS]
                            + [T.StructField(CORRUPT, T.StringType(), True)])
_OPTIONAL = ["voltage", "current", "pf"]


def _is_nested(text: Column) -> Column:
    """An object or array where a scalar belongs (all-string parse keeps it as text)."""
    t = F.ltrim(text)
    return t.startswith("{") | t.startswith("[")


def _reason(cond: Column, label: str) -> Column:
    return F.when(cond, F.lit(label))


# a JSON number, or the names a text may give to the special doubles
_NUMBER = r"^\s*([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|NaN|[+-]?Infinity)\s*$"
# timestamps that calendar functions can handle: 1970 up to the end of year 9999
MIN_TIMESTAMP_MS, MAX_TIMESTAMP_MS = 0, 253_402_300_799_999


def _number(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def _infinite(value: Column) -> Column:
    return value.isNotNull() & (F.abs(value) == F.lit(float("inf")))


def decode_payloads(df: DataFrame, value_col: str = "value", mode: str = "lenient",
                    keep: list[str] | None = None, min_ms: int = MIN_TIMESTAMP_MS,
                    max_ms: int = MAX_TIMESTAMP_MS, arrival_ms: str | None = None,
                    ahead_ms: int = AHEAD_MS) -> DataFrame:
    """Parse JSON readings; returns fields + ``_raw``, ``reasons``, ``dead``, ``emit``.

    ``keep`` lists pass-through columns (arrival keys such as Kafka offsets or
    ``event_id``). Null payloads and the JSON literal ``null`` yield no row.
    An empty text in a number field counts as missing.  Infinite usage and
    timestamps outside ``[min_ms, max_ms]`` give no reading, only ops rows.
    Where ``arrival_ms`` names the arrival time (one of ``keep``), so do
    timestamps more than ``ahead_ms`` after it: one wrong clock must not move
    a stream's watermark past all other readings.
    """
    if mode not in ("lenient", "strict"):
        raise ValueError("mode must be 'lenient' or 'strict'")
    keep = keep or []
    raw = F.col(value_col).cast("string")
    base = (df.select(raw.alias("_raw"), *keep)
              .where(F.col("_raw").isNotNull() & (F.trim(F.col("_raw")) != F.lit("null"))))
    p = F.from_json("_raw", _TEXT_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    parsed = once(base, p, "p")

    txt = {f: F.col(f"p.{f}") for f in READING_FIELDS}
    for f in ["timestamp", "usageKw", *_OPTIONAL]:
        txt[f] = F.when(F.trim(txt[f]) != F.lit(""), txt[f])
    ts_num = F.coalesce(txt["timestamp"].try_cast("bigint"), _number(txt["timestamp"]).try_cast("bigint"))
    # the numbers are used in many conditions: each text is tested and cast once
    parsed = once(parsed, F.struct(ts_num.alias("timestamp"), *[_number(txt[f]).alias(f) for f in ["usageKw", *_OPTIONAL]]), "v")
    ts_val, kw_val = F.col("v.timestamp"), F.col("v.usageKw")
    opt_val = {f: F.col(f"v.{f}") for f in _OPTIONAL}

    unknown = F.array_except(F.coalesce(F.json_object_keys("_raw"), F.array().cast("array<string>")),
                             F.array(*[F.lit(f) for f in READING_FIELDS]))
    syntax_bad = F.col("p").isNull() | F.col(f"p.{CORRUPT}").isNotNull()
    nested_bad = F.lit(False)
    for f in READING_FIELDS:
        nested_bad = nested_bad | F.coalesce(_is_nested(txt[f]), F.lit(False))
    ts_bad = txt["timestamp"].isNotNull() & ts_val.isNull()
    kw_bad = txt["usageKw"].isNotNull() & kw_val.isNull()
    ts_far = ts_val.isNotNull() & ((ts_val < min_ms) | (ts_val > max_ms))
    ts_ahead = F.coalesce(ts_val > F.col(arrival_ms) + F.lit(ahead_ms), F.lit(False)) & ~ts_far if arrival_ms else F.lit(False)
    opt_bad = {f: txt[f].isNotNull() & (opt_val[f].isNull() | F.isnan(opt_val[f]) | _infinite(opt_val[f]))
               for f in _OPTIONAL}
    any_opt_bad = opt_bad["voltage"] | opt_bad["current"] | opt_bad["pf"]
    kw_nan = kw_val.isNotNull() & F.isnan(kw_val)
    kw_inf = _infinite(kw_val)
    site_missing = txt["siteId"].isNull() | (F.trim(txt["siteId"]) == F.lit(""))
    ts_missing = txt["timestamp"].isNull()
    kw_missing = txt["usageKw"].isNull()
    has_unknown = F.size(unknown) > 0

    # a malformed required number is an exception in the original: dead letter
    dead = syntax_bad | nested_bad | ts_bad | kw_bad
    if mode == "strict":
        dead = dead | has_unknown | any_opt_bad | kw_nan

    reasons = F.filter(F.array(
        _reason(site_missing, "missing_site"),
        _reason(ts_missing, "missing_timestamp"),
        _reason(kw_missing, "missing_usage"),
        _reason(kw_nan, "nan_usage"),
        _reason(kw_inf, "infinite_usage"),
        _reason(ts_far, "timestamp_out_of_range"),
        _reason(ts_ahead, "timestamp_ahead"),
        _reason(opt_bad["voltage"], "bad_voltage"),
        _reason(opt_bad["current"], "bad_current"),
        _reason(opt_bad["pf"], "bad_pf"),
        _reason(has_unknown, "unknown_keys"),
    ), lambda x: x.isNotNull())

    blocked = site_missing | kw_nan | kw_inf | ts_far | ts_ahead
    if mode == "strict":
        blocked = blocked | ts_missing | kw_missing

    out = parsed.select(
        txt["meterId"].alias("meterId"),
        txt["siteId"].alias("siteId"),
        F.coalesce(ts_val, F.lit(0).cast("bigint")).alias("timestamp"),
        F.coalesce(kw_val, F.lit(0.0)).alias("usageKw"),
        *[F.when(~opt_bad[f], opt_val[f]).alias(f) for f in _OPTIONAL],
        *keep,
        F.col("_raw"),
        F.when(dead, F.array(F.lit("dead_letter"))).otherwise(reasons).alias("reasons"),
        dead.alias("dead"),
        (~dead & ~blocked).alias("emit"),
    )
    return out


def readings_of(decoded: DataFrame, keep: list[str] | None = None) -> DataFrame:
    return decoded.where("emit").select(*READING_FIELDS, *(keep or []))


def ops_of(decoded: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Decoded rows with a data-quality finding that are not dead letters."""
    return decoded.where(~F.col("dead") & (F.size("reasons") > 0)).select(
        *READING_FIELDS, *(keep or []), "reasons", "emit")


def dead_letter_of(decoded: DataFrame, keep: list[str] | None = None) -> DataFrame:
    return decoded.where("dead").select(*(keep or []), F.col("_raw").alias("payload"))
