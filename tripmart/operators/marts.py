"""The four marts: grouped hash aggregates over the trip fact.

Every metric is made of counts and sums, so a mart can be built two ways from one
definition: straight from the trips, or from a mergeable state that holds those
counts and sums for finer groups (``partials``), from which all four marts can be
rolled up after one pass over the fact.  Spark plans partial aggregation before
each shuffle, so a zone, vendor or hour holding a third of all trips still sends
one partial row per task and group.

Money sums and averages stay decimal (exact).  Per-trip speed is a double rounded
to cents and below two million in a plausible trip, and is summed as a decimal.
Fare per mile has no bound (a fare over almost no distance); its sums are kept per
bin of magnitude (``functions.exact``), so no trip is left out and the result
does not depend on the order partial sums are combined in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions import exact
from tripmart.functions.expressions import count_if, pct_of_count

SPEED_TYPE = "decimal(28,2)"

DAILY_KEYS = ["pickup_date", "pickup_year", "pickup_month", "pickup_day_of_week", "is_weekend",
              "pickup_borough", "pickup_zone", "pickup_service_zone", "pickup_borough_group",
              "is_airport_pickup"]
HOURLY_KEYS = ["pickup_date", "pickup_year", "pickup_month", "pickup_day_of_week", "pickup_hour",
               "is_weekend", "is_rush_hour", "is_late_night", "pickup_borough", "pickup_borough_group"]
MONTHLY_KEYS = ["pickup_year", "pickup_month", "pickup_borough", "pickup_zone", "pickup_service_zone",
                "pickup_borough_group", "is_airport_pickup"]
VENDOR_KEYS = ["pickup_year", "pickup_month", "vendor_id", "vendor_name"]

# Merge (unique) keys of each mart: narrower than the group keys.
MERGE_KEYS = {
    "agg_daily_zone_summary": ["pickup_date", "pickup_zone"],
    "agg_hourly_demand": ["pickup_date", "pickup_hour", "pickup_borough"],
    "agg_monthly_zone_summary": ["pickup_year", "pickup_month", "pickup_zone"],
    "agg_vendor_performance": ["pickup_year", "pickup_month", "vendor_id"],
}


#: Flags that marts count, and the numbers they sum or average.
FLAGS = {
    "credit_card": lambda: F.col("payment_type_id") == 1,
    "cash": lambda: F.col("payment_type_id") == 2,
    "stored": lambda: F.col("store_and_fwd_flag") == "Y",
    "rush_hour": lambda: F.col("is_rush_hour"),
    "weekend": lambda: F.col("is_weekend"),
    "late_night": lambda: F.col("is_late_night"),
    "airport_trip": lambda: F.col("is_airport_trip"),
    "airport_pickup": lambda: F.col("is_airport_pickup"),
    "cross_borough": lambda: F.col("trip_borough_type") == "Cross Borough",
}
NUMBERS = {
    **{c: (lambda c=c: F.col(c)) for c in ("passenger_count", "fare_amount", "tip_amount", "tolls_amount", "total_amount",
                                           "tip_percentage", "trip_distance_miles", "trip_duration_minutes", "fare_per_minute")},
    "avg_speed_mph": lambda: F.col("avg_speed_mph").cast(SPEED_TYPE),
    # the part of the ratio that falls into the row's bin
    "fare_per_mile": lambda: exact.part_of(F.col("fare_per_mile")),
}
BIN = "_ratio_bin"


class FromTrips:
    """Counts and sums over trips."""
    trips = staticmethod(lambda: F.count(F.lit(1)))
    flag = staticmethod(lambda f: count_if(FLAGS[f]()))
    total = staticmethod(lambda c: F.sum(NUMBERS[c]()))
    number = staticmethod(lambda c: F.count(F.col(c)))


class FromState:
    """The same counts and sums over rows of a state."""
    trips = staticmethod(lambda: F.sum("_n"))
    flag = staticmethod(lambda f: F.sum(f"_c_{f}"))
    total = staticmethod(lambda c: F.sum(f"_s_{c}"))
    number = staticmethod(lambda c: F.sum(f"_n_{c}"))


def _columns(m) -> list[Column]:
    """Every count and sum, under the names of the state."""
    return ([m.trips().alias("_n")] + [m.flag(f).alias(f"_c_{f}") for f in FLAGS]
            + [c for n in NUMBERS for c in (m.total(n).alias(f"_s_{n}"), m.number(n).alias(f"_n_{n}"))])


def partials(fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state of the trips for each group of ``keys`` and each bin of the ratio."""
    return fact.withColumn(BIN, exact.bin_of(F.col("fare_per_mile"))).groupBy(*keys, BIN).agg(*_columns(FromTrips))


def merge(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A state of coarser groups; ``merge`` of unions of states is the state of all their trips."""
    return state.groupBy(*keys, BIN).agg(*_columns(FromState))


def _r2(col: Column) -> Column:
    return F.round(col, 2)


def _avg(m, name: str) -> Column:
    """round(avg(x), 2) from its sum and count."""
    return _r2(m.total(name) / F.nullif(m.number(name), F.lit(0)))


def _days() -> Column:
    return F.count_distinct("pickup_date")


def daily_metrics(m=FromTrips) -> list[Column]:
    return [
        m.trips().alias("trip_count"),
        m.total("passenger_count").alias("total_passengers"),
        m.total("fare_amount").alias("total_fare"),
        m.total("tip_amount").alias("total_tips"),
        m.total("tolls_amount").alias("total_tolls"),
        m.total("total_amount").alias("total_revenue"),
        _avg(m, "fare_amount").alias("avg_fare"),
        _avg(m, "tip_amount").alias("avg_tip"),
        _avg(m, "total_amount").alias("avg_total"),
        _avg(m, "tip_percentage").alias("avg_tip_percentage"),
        _r2(m.total("trip_distance_miles")).alias("total_distance_miles"),
        _avg(m, "trip_distance_miles").alias("avg_distance_miles"),
        _avg(m, "trip_duration_minutes").alias("avg_duration_minutes"),
        _avg(m, "avg_speed_mph").alias("avg_speed_mph"),
        m.flag("credit_card").alias("credit_card_trips"),
        m.flag("cash").alias("cash_trips"),
        m.flag("rush_hour").alias("rush_hour_trips"),
    ]


def hourly_metrics(m=FromTrips) -> list[Column]:
    return [
        m.trips().alias("trip_count"),
        m.total("passenger_count").alias("total_passengers"),
        _r2(m.total("total_amount")).alias("total_revenue"),
        _avg(m, "total_amount").alias("avg_revenue_per_trip"),
        _avg(m, "trip_distance_miles").alias("avg_distance_miles"),
        _avg(m, "trip_duration_minutes").alias("avg_duration_minutes"),
        _avg(m, "avg_speed_mph").alias("avg_speed_mph"),
        _avg(m, "tip_percentage").alias("avg_tip_percentage"),
        m.flag("airport_trip").alias("airport_trip_count"),
        m.flag("airport_pickup").alias("airport_pickup_count"),
        m.flag("cross_borough").alias("cross_borough_trip_count"),
    ]


def monthly_metrics(m=FromTrips) -> list[Column]:
    return [
        m.trips().alias("trip_count"),
        m.total("passenger_count").alias("total_passengers"),
        _days().alias("active_days"),
        _r2(m.trips() / F.nullif(_days(), F.lit(0))).alias("avg_daily_trips"),
        _r2(m.total("fare_amount")).alias("total_fare"),
        _r2(m.total("tip_amount")).alias("total_tips"),
        _r2(m.total("tolls_amount")).alias("total_tolls"),
        _r2(m.total("total_amount")).alias("total_revenue"),
        _avg(m, "fare_amount").alias("avg_fare"),
        _avg(m, "tip_amount").alias("avg_tip"),
        _avg(m, "total_amount").alias("avg_total"),
        _avg(m, "tip_percentage").alias("avg_tip_percentage"),
        _r2(m.total("trip_distance_miles")).alias("total_distance_miles"),
        _avg(m, "trip_distance_miles").alias("avg_distance_miles"),
        _avg(m, "trip_duration_minutes").alias("avg_duration_minutes"),
        _avg(m, "avg_speed_mph").alias("avg_speed_mph"),
        m.flag("credit_card").alias("credit_card_trips"),
        m.flag("cash").alias("cash_trips"),
        pct_of_count(m.flag("credit_card"), m.trips()).alias("credit_card_pct"),
        m.flag("rush_hour").alias("rush_hour_trips"),
        m.flag("weekend").alias("weekend_trips"),
        m.flag("late_night").alias("late_night_trips"),
    ]


def vendor_metrics(m=FromState) -> list[Column]:
    """Always over a state of one row per vendor, month and bin of the ratio."""
    n = m.trips()
    bins = F.collect_list(F.when(F.col("_n_fare_per_mile") > 0, F.struct(
        F.col(BIN).alias("bin"), F.col("_s_fare_per_mile").alias("part"), F.col("_n_fare_per_mile").alias("n"))))
    return [
        n.alias("trip_count"),
        m.total("passenger_count").alias("total_passengers"),
        _avg(m, "passenger_count").alias("avg_passengers_per_trip"),
        _r2(m.total("total_amount")).alias("total_revenue"),
        _avg(m, "total_amount").alias("avg_revenue_per_trip"),
        exact.rounded_average(bins).alias("avg_fare_per_mile"),
        _avg(m, "fare_per_minute").alias("avg_fare_per_minute"),
        _avg(m, "trip_distance_miles").alias("avg_distance_miles"),
        _avg(m, "trip_duration_minutes").alias("avg_duration_minutes"),
        _avg(m, "avg_speed_mph").alias("avg_speed_mph"),
        _avg(m, "tip_percentage").alias("avg_tip_percentage"),
        _r2(m.total("tip_amount")).alias("total_tips"),
        pct_of_count(m.flag("credit_card"), n).alias("credit_card_pct"),
        pct_of_count(m.flag("cash"), n).alias("cash_pct"),
        pct_of_count(m.flag("stored"), n).alias("store_and_fwd_pct"),
        pct_of_count(m.flag("airport_trip"), n).alias("airport_trip_pct"),
        pct_of_count(m.flag("rush_hour"), n).alias("rush_hour_trip_pct"),
    ]


MARTS = {
    "agg_daily_zone_summary": (DAILY_KEYS, daily_metrics),
    "agg_hourly_demand": (HOURLY_KEYS, hourly_metrics),
    "agg_monthly_zone_summary": (MONTHLY_KEYS, monthly_metrics),
    "agg_vendor_performance": (VENDOR_KEYS, vendor_metrics),
}
RATIO_MART = "agg_vendor_performance"
#: The finest groups that all four marts can be rolled up from.
STATE_KEYS = list(dict.fromkeys(DAILY_KEYS + HOURLY_KEYS + MONTHLY_KEYS + VENDOR_KEYS))


def build_mart(name: str, fact: DataFrame) -> DataFrame:
    keys, metrics = MARTS[name]
    if name == RATIO_MART:
        return _typed(name, partials(fact, keys).groupBy(*keys).agg(*metrics(FromState)))
    return _typed(name, fact.groupBy(*keys).agg(*metrics(FromTrips)))


def roll_up(name: str, state: DataFrame) -> DataFrame:
    """The same mart from a state of groups at least as fine as its own
    (``partials(fact, STATE_KEYS)`` for all four)."""
    keys, metrics = MARTS[name]
    return _typed(name, (merge(state, keys) if name == RATIO_MART else state).groupBy(*keys).agg(*metrics(FromState)))


# Stored types: sums of money, averages of money, other averages.
_TYPES = {
    "decimal(21,2)": ("total_fare", "total_tips", "total_tolls", "total_revenue"),
    "decimal(11,2)": ("avg_fare", "avg_tip", "avg_total", "avg_revenue_per_trip"),
    "decimal(18,2)": ("avg_tip_percentage", "avg_fare_per_minute"),
    "decimal(25,2)": ("avg_duration_minutes",),
    "decimal(29,2)": ("avg_speed_mph",),
    "decimal(27,2)": ("credit_card_pct", "cash_pct", "store_and_fwd_pct", "airport_trip_pct", "rush_hour_trip_pct"),
}
_TYPE_OF = {c: t for t, names in _TYPES.items() for c in names}


def _typed(name: str, mart: DataFrame) -> DataFrame:
    """One type per column, however the mart was built."""
    types = _TYPE_OF
    if name == "agg_daily_zone_summary":  # its sums are not rounded
        types = {**types, **dict.fromkeys(_TYPES["decimal(21,2)"], "decimal(20,2)")}
    return mart.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in mart.columns])


def grain_violations(mart_name: str, mart: DataFrame) -> DataFrame:
    """Merge keys carried by more than one mart row (should be empty)."""
    keys = MERGE_KEYS[mart_name]
    return (mart.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))
