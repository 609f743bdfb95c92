"""JSON payloads derived from readings, with rule-based defects (test input).

Readings are serialised the way the publisher does (S4) and, by fixed rules
on ``event_id``, some payloads are damaged so the decoder's edge cases run
over the whole table.  The first matching rule wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.functions.expressions import once
from meterflow.schema import READING_FIELDS

# fixed values: (modulus, remainder, defect) in priority order
DEFECT_RULES = [
    (97, 3, "tombstone"),          # null payload: no row at all
    (89, 5, "no_site"),            # siteId key absent -> ops, no reading
    (83, 7, "quoted_usage"),       # "usageKw":"12.5" -> coerced
    (79, 11, "unknown_key"),       # extra "firmware" key -> ignored (lenient)
    (73, 13, "bad_voltage"),       # "voltage":"x" -> voltage null + ops
    (71, 17, "truncated"),         # first half of the text -> dead letter
    (67, 19, "no_timestamp"),      # timestamp absent -> 0 (lenient) + ops
    (61, 23, "decimal_timestamp"),  # timestamp + 0.7 -> truncated to the long
]


def defect_of(event_id) -> F.Column:
    c = F.lit(None).cast("string")
    for m, r, name in reversed(DEFECT_RULES):
        c = F.when(F.pmod(event_id, F.lit(m)) == r, F.lit(name)).otherwise(c)
    return c


def _json(fields: dict) -> F.Column:
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))


def payloads_from_readings(readings: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``event_id, defect, value`` and ``keep``; value is the (possibly damaged) JSON text."""
    base = {f: F.col(f) for f in READING_FIELDS}
    d = F.col("defect")
    variants = {
        "no_site": {k: v for k, v in base.items() if k != "siteId"},
        "quoted_usage": dict(base, usageKw=F.col("usageKw").cast("string")),
        "unknown_key": dict(base, firmware=F.lit("1.0")),
        "bad_voltage": dict(base, voltage=F.lit("x")),
        "no_timestamp": {k: v for k, v in base.items() if k != "timestamp"},
        "decimal_timestamp": dict(base, timestamp=F.col("timestamp").cast("double") + F.lit(0.7)),
    }
    full = _json(base)
    value = F.when(d == "tombstone", F.lit(None).cast("string")) \
             .when(d == "truncated", F.substring(full, 1, (F.length(full) / 2).cast("int")))
    for name, fields in variants.items():
        value = value.when(d == name, _json(fields))
    value = value.otherwise(full)
    tagged = once(readings.select("event_id", *READING_FIELDS, *keep), defect_of(F.col("event_id")), "defect")
    return once(tagged, value, "value").select("event_id", "defect", "value", *keep)
