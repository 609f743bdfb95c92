"""Result presentation for cross-engine comparison.

Registered queries end with :func:`present`: doubles are rounded to a fixed
number of places (summation order differs between engines) and dates are
rendered as ``yyyy-MM-dd`` text, so the SQL oracle can state the same values.

Means of 2-decimal readings often fall exactly on a half step of the 6th
decimal, where the last-bit noise of a different summation order decides
the rounding.  Rounding is therefore done half-up on a grid shifted by
``ROUND_SHIFT``; the SQL side adds the same shift.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6
ROUND_SHIFT = 3e-8


def present(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c + F.lit(ROUND_SHIFT), digits)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(*cols)
