"""Column expressions of the curated trip fact (all built-in, codegen friendly).

Money stays DECIMAL(10,2); decimal literals are written as ``Decimal`` so the
arithmetic keeps SQL decimal semantics (a float literal would silently turn
the expression into DOUBLE arithmetic).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hour ranges and day names that define the trip flags.
RUSH_HOUR_RANGES = [(7, 9), (16, 19)]
LATE_NIGHT_RANGE = (0, 5)
DAY_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
WEEKEND_DAYS = ["Sat", "Sun"]
SAME_BOROUGH = "Same Borough"
CROSS_BOROUGH = "Cross Borough"


def seconds_between(start: Column, end: Column) -> Column:
    """Number of second boundaries crossed from ``start`` to ``end``.

    Whole elapsed seconds would count 08:00:00.9 -> 08:00:01.1 as 0; the
    mart counts boundaries (1), the difference of the two whole seconds.  (``date_trunc``
    and ``timestamp_diff`` would build a zoned time for each value, per row.)
    """
    whole = lambda ts: F.unix_seconds(ts.cast("timestamp"))
    return whole(end) - whole(start)


def day_abbrev(ts: Column) -> Column:
    """Three-letter English day name (Mon..Sun); ``dayname`` builds a formatter per row."""
    # element_at takes a NULL index for a value under ANSI, so NULL is kept apart
    return F.when(ts.isNotNull(), F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES]), F.weekday(ts) + 1))


def minutes_of(secs: Column) -> Column:
    """round(secs / 60.0, 2) as a decimal."""
    return F.round(secs / F.lit(Decimal("60.0")), 2)


def speed_mph(miles: Column, secs: Column) -> Column:
    """Average speed, NULL unless both duration and distance are positive."""
    return F.when((secs > 0) & (miles > 0),
                  F.round(miles / (secs / F.lit(Decimal("3600.0"))), 2))


def tip_percentage(tip: Column, fare: Column) -> Column:
    return F.when(fare > 0, F.round(tip / fare * F.lit(100), 2))


def fare_per_mile(fare: Column, miles: Column) -> Column:
    return F.when(miles > 0, F.round(fare / miles, 2))


def fare_per_minute(fare: Column, secs: Column) -> Column:
    return F.when(secs > 0, F.round(fare / (secs / F.lit(Decimal("60.0"))), 2))


def _in_ranges(hour: Column, ranges) -> Column:
    cond = F.lit(False)
    for low, high in ranges:
        cond = cond | hour.between(low, high)
    return cond


def is_rush_hour(hour: Column) -> Column:
    return F.coalesce(_in_ranges(hour, RUSH_HOUR_RANGES), F.lit(False))


def is_late_night(hour: Column) -> Column:
    return F.coalesce(_in_ranges(hour, [LATE_NIGHT_RANGE]), F.lit(False))


def is_weekend(day_name: Column) -> Column:
    return F.coalesce(day_name.isin(WEEKEND_DAYS), F.lit(False))



def either_true(a: Column, b: Column) -> Column:
    """True when either flag is true; NULL (missed lookup) counts as false."""
    return F.coalesce(a, F.lit(False)) | F.coalesce(b, F.lit(False))


def borough_type(pickup_borough: Column, dropoff_borough: Column) -> Column:
    """Same/Cross borough; a NULL on either side counts as Cross."""
    return F.when(pickup_borough == dropoff_borough, F.lit(SAME_BOROUGH)).otherwise(F.lit(CROSS_BOROUGH))


def count_if(cond: Column) -> Column:
    """sum(case when cond then 1 else 0 end): NULL conditions count 0."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def pct_of_count(part: Column, total: Column) -> Column:
    """round(part * 100.0 / nullif(total, 0), 2) with decimal arithmetic."""
    return F.round(part * F.lit(Decimal("100.0")) / F.nullif(total, F.lit(0)), 2)
