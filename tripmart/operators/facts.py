"""Curated trip fact: six lookup joins, derived measures, plausibility filter.

Every join is a left join of the trip stream to a lookup, without a hint: Spark
broadcasts a side whose bytes are below its own threshold
(spark.sql.autoBroadcastJoinThreshold) and shuffles beyond.  With the usual
lookups the whole fact is one map-only stage over the trip scan.  The plausibility predicate is
written after the joins (as the model reads) and Catalyst pushes it down to
the scan side of every left join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.functions import expressions as X
from tripmart.operators import dims, staging
from tripmart.sources import lookups as L

# Plausibility bounds (seconds, miles).
MAX_TRIP_SECONDS = 86400
MAX_TRIP_MILES = 500

LOCATION_ATTRS = [
    ("borough", "{r}_borough"), ("zone_name", "{r}_zone"), ("service_zone", "{r}_service_zone"),
    ("is_airport", "is_airport_{r}"), ("borough_group", "{r}_borough_group"),
    ("manhattan_subregion", "{r}_manhattan_subregion"),
]


@dataclass
class Lookups:
    """The five lookups of the fact, each with a unique key."""

    vendor: DataFrame
    rate_code: DataFrame
    payment_type: DataFrame
    store_and_fwd_flag: DataFrame
    dim_location: DataFrame

    @classmethod
    def build(cls, spark: SparkSession, raw_zones: DataFrame, seed_dir: str | None = None) -> "Lookups":
        seeds = L.load_seeds(spark, seed_dir, check=False)
        dim = dims.dim_location(staging.stg_zones(raw_zones))
        checks = {n: (df, schemas.SEEDS[n][0]) for n, df in seeds.items()}
        L.check_lookups({**checks, "dim_location": (dim, "location_id")})
        return cls(seeds["vendor"], seeds["rate_code"], seeds["payment_type"], seeds["store_and_fwd_flag"], dim)


def join_codes(trips: DataFrame, lk: Lookups) -> DataFrame:
    """J1-J4: vendor, rate code, payment type and flag names (left joins)."""
    t = trips
    for lookup, key in [(lk.vendor, "vendor_id"), (lk.rate_code, "rate_code_id"),
                        (lk.payment_type, "payment_type_id"), (lk.store_and_fwd_flag, "store_and_fwd_flag")]:
        side = lookup.withColumnRenamed(key, f"_{key}")
        t = t.join(side, t[key] == side[f"_{key}"], "left").drop(f"_{key}")
    return t


def join_locations(trips: DataFrame, lk: Lookups) -> DataFrame:
    """J5-J6: the location dimension in two roles, pickup and dropoff.

    Both roles join the same projected dimension (under two aliases) and
    rename after the join, so the two build sides are one plan and Spark
    broadcasts the dimension once (ReusedExchange)."""
    dim = lk.dim_location.select("location_id", *[src for src, _ in LOCATION_ATTRS])
    t = trips
    for role, key in [("pickup", "pickup_location_id"), ("dropoff", "dropoff_location_id")]:
        d = dim.alias(f"_{role}")
        joined = t.join(d, F.col(key) == F.col(f"_{role}.location_id"), "left")
        t = joined.select(*[F.col(c) for c in t.columns],
                          *[F.col(f"_{role}.{src}").alias(dst.format(r=role)) for src, dst in LOCATION_ATTRS])
    return t


def enrich(trips: DataFrame, lk: Lookups) -> DataFrame:
    """All 52 fact columns, before the plausibility filter."""
    t = join_locations(join_codes(trips, lk), lk)
    pickup = F.col("pickup_datetime")
    # Computed once, then referenced: the day name and hour feed several
    # columns, and a non-trivial expression referenced twice stays in its own
    # projection instead of being re-evaluated per use.
    t = t.withColumns({
        "_secs": X.seconds_between(pickup, F.col("dropoff_datetime")),
        "pickup_day_of_week": X.day_abbrev(pickup),
        "pickup_hour": F.hour(pickup),
    })
    secs, miles = F.col("_secs"), F.col("trip_distance_miles")
    fare, tip = F.col("fare_amount"), F.col("tip_amount")
    hour, day = F.col("pickup_hour"), F.col("pickup_day_of_week")
    derived = {
        "pickup_date": F.to_date(pickup),
        "pickup_month": F.month(pickup),
        "pickup_year": F.year(pickup),
        "trip_duration_seconds": secs,
        "trip_duration_minutes": X.minutes_of(secs),
        "avg_speed_mph": X.speed_mph(miles, secs),
        "tip_percentage": X.tip_percentage(tip, fare),
        "fare_per_mile": X.fare_per_mile(fare, miles),
        "fare_per_minute": X.fare_per_minute(fare, secs),
        "is_rush_hour": X.is_rush_hour(hour),
        "is_weekend": X.is_weekend(day),
        "is_late_night": X.is_late_night(hour),
        "is_airport_trip": X.either_true(F.col("is_airport_pickup"), F.col("is_airport_dropoff")),
        "trip_borough_type": X.borough_type(F.col("pickup_borough"), F.col("dropoff_borough")),
    }
    return t.withColumns(derived).select(*schemas.FACT_COLUMNS)


def plausible(fact: DataFrame) -> DataFrame:
    """six ANDed bounds; a NULL in any term drops the row."""
    secs, miles = F.col("trip_duration_seconds"), F.col("trip_distance_miles")
    return fact.filter((secs > 0) & (secs < MAX_TRIP_SECONDS)
                       & (miles >= 0) & (miles < MAX_TRIP_MILES)
                       & (F.col("fare_amount") >= 0) & (F.col("total_amount") >= 0))


def fact_trips(stg: DataFrame, lk: Lookups) -> DataFrame:
    return plausible(enrich(stg, lk))
