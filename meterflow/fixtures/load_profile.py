"""An expected load by hour and weekday (test input for the profile deviation).

A triangle over the day that peaks at 14:00 UTC and loses 5 % for each hour
of distance; Saturdays and Sundays carry four fifths of it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterflow.functions.expressions import epoch_ms_to_date, utc_hour

PEAK_HOUR, LOSS, WEEKEND_SHARE = 14, 0.05, 0.8


def load_profile_factor(ms) -> Column:
    """Expected share of the peak load at an epoch-ms instant (UTC)."""
    away = F.abs(utc_hour(ms) - F.lit(PEAK_HOUR))
    day = F.lit(1.0) - F.lit(LOSS) * F.least(away, F.lit(24) - away)
    return F.when(F.weekday(epoch_ms_to_date(ms)) >= 5, day * F.lit(WEEKEND_SHARE)).otherwise(day)
