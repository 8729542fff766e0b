"""Staging: typed rename of raw trips and zones, exact dedup, surrogate key.

Staging stays lazy (a DataFrame function, never materialised); Catalyst
fuses it with whatever consumes it, so a watermark filter or the fact's
plausibility filter lands directly above the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.functions.keys import surrogate_key

DUP_POLICIES = ("keep", "first", "error")


class TripKeyCollision(ValueError):
    """Two different staged rows share one surrogate trip key."""


CAST_MODES = ("ansi", "try")

# (staged name, raw column, target type) of every cast in staging.
STAGING_CASTS = [
    ("vendor_id", "VendorID", "int"), ("rate_code_id", "RatecodeID", "int"),
    ("pickup_location_id", "PULocationID", "int"), ("dropoff_location_id", "DOLocationID", "int"),
    ("payment_type_id", "payment_type", "int"), ("passenger_count", "passenger_count", "int"),
    ("trip_distance_miles", "trip_distance", "double"),
    ("pickup_datetime", "tpep_pickup_datetime", "timestamp_ntz"),
    ("dropoff_datetime", "tpep_dropoff_datetime", "timestamp_ntz"),
    ("fare_amount", "fare_amount", "decimal(10,2)"), ("extra_amount", "extra", "decimal(10,2)"),
    ("mta_tax", "mta_tax", "decimal(10,2)"), ("tip_amount", "tip_amount", "decimal(10,2)"),
    ("tolls_amount", "tolls_amount", "decimal(10,2)"),
    ("improvement_surcharge", "improvement_surcharge", "decimal(10,2)"),
    ("congestion_surcharge", "congestion_surcharge", "decimal(10,2)"),
    ("airport_fee", "airport_fee", "decimal(10,2)"), ("total_amount", "total_amount", "decimal(10,2)"),
]


def quarantine_bad_casts(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split raw trips into rows every staging cast accepts and rejected rows.

    Under ANSI a value that does not fit (e.g. money past DECIMAL(10,2))
    fails the whole job; this try_cast pass keeps the job alive and returns
    the offending rows (with the failing column names) for inspection.  Both
    outputs are lazy filters of one scan: no shuffle."""
    bad = [F.when(F.col(src).isNotNull() & F.col(src).try_cast(t).isNull(), F.lit(name))
           for name, src, t in STAGING_CASTS]
    flagged = raw.withColumn("_bad_casts", F.array_compact(F.array(*bad)))
    good = flagged.filter(F.size("_bad_casts") == 0).drop("_bad_casts")
    rejected = flagged.filter(F.size("_bad_casts") > 0).withColumnRenamed("_bad_casts", "rejected_columns")
    return good, rejected


def rename_trips(raw: DataFrame) -> DataFrame:
    """19 raw columns to snake_case with explicit types (no rows dropped)."""
    money = schemas.MONEY
    return raw.select(
        F.col("VendorID").cast("int").alias("vendor_id"),
        F.col("RatecodeID").cast("int").alias("rate_code_id"),
        F.col("PULocationID").cast("int").alias("pickup_location_id"),
        F.col("DOLocationID").cast("int").alias("dropoff_location_id"),
        F.col("payment_type").cast("int").alias("payment_type_id"),
        F.upper(F.trim(F.col("store_and_fwd_flag"))).alias("store_and_fwd_flag"),
        F.col("passenger_count").cast("int").alias("passenger_count"),
        F.col("trip_distance").cast("double").alias("trip_distance_miles"),
        F.col("tpep_pickup_datetime").cast("timestamp_ntz").alias("pickup_datetime"),
        F.col("tpep_dropoff_datetime").cast("timestamp_ntz").alias("dropoff_datetime"),
        F.col("fare_amount").cast(money).alias("fare_amount"),
        F.col("extra").cast(money).alias("extra_amount"),
        F.col("mta_tax").cast(money).alias("mta_tax"),
        F.col("tip_amount").cast(money).alias("tip_amount"),
        F.col("tolls_amount").cast(money).alias("tolls_amount"),
        F.col("improvement_surcharge").cast(money).alias("improvement_surcharge"),
        F.col("congestion_surcharge").cast(money).alias("congestion_surcharge"),
        F.col("airport_fee").cast(money).alias("airport_fee"),
        F.col("total_amount").cast(money).alias("total_amount"),
    )


def dedup_exact(df: DataFrame, columns=None) -> DataFrame:
    """Keep one row of each group of rows equal on ``columns`` (NULLs equal).

    A hash aggregate: each task first collapses the copies it holds, so a
    copy group holding a third of all rows still ships one row per task to
    the shuffle.  (The window form below sorts every copy into one task.)
    """
    return df.dropDuplicates(list(columns or schemas.DEDUP_COLUMNS))


def dedup_window(df: DataFrame, columns=None) -> DataFrame:
    """Window form of the same dedup: row_number over the copy group, keep 1.
    Kept for equivalence tests; ``dedup_exact`` is the one to run at scale."""
    cols = list(columns or schemas.DEDUP_COLUMNS)
    w = Window.partitionBy(*cols).orderBy(F.col("pickup_datetime"))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def add_trip_key(df: DataFrame) -> DataFrame:
    return df.select(surrogate_key(schemas.TRIP_KEY_COLUMNS).alias("trip_id"), *schemas.STG_TRIP_COLUMNS)


def key_collisions(stg: DataFrame) -> DataFrame:
    """Trip keys carried by more than one staged row (trip_id, n_rows)."""
    return (stg.groupBy("trip_id").agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def resolve_key_collisions(stg: DataFrame, policy: str) -> DataFrame:
    """Apply the duplicate-key policy.

    ``keep``: pass through (literal behaviour; the fact ``unique`` test then
    reports them).  ``first``: keep the smallest row over all 19 columns per
    key, a partial-aggregating ``min(struct)`` so hot keys stay cheap.
    ``error``: raise if any key repeats (a bounded probe: stops at one).
    """
    if policy not in DUP_POLICIES:
        raise ValueError(f"dup_policy must be one of {DUP_POLICIES}")
    if policy == "keep":
        return stg
    if policy == "error":
        if key_collisions(stg).limit(1).count():
            raise TripKeyCollision("staged trips repeat a trip_id; use dup_policy='first' to resolve")
        return stg
    picked = stg.groupBy("trip_id").agg(F.min(F.struct(*schemas.STG_TRIP_COLUMNS)).alias("_row"))
    return picked.select("trip_id", *[F.col(f"_row.{c}").alias(c) for c in schemas.STG_TRIP_COLUMNS])


def stg_trips(raw: DataFrame, dup_policy: str = "keep", cast_mode: str = "ansi") -> DataFrame:
    """Cleaned, deduplicated and keyed trips: trip_id + 19 columns.

    ``cast_mode='try'`` drops rows a cast would reject (see
    ``quarantine_bad_casts`` for the rejected rows) instead of failing."""
    if cast_mode not in CAST_MODES:
        raise ValueError(f"cast_mode must be one of {CAST_MODES}")
    if cast_mode == "try":
        raw, _ = quarantine_bad_casts(raw)
    return resolve_key_collisions(add_trip_key(dedup_exact(rename_trips(raw))), dup_policy)


def stg_zones(raw_zones: DataFrame) -> DataFrame:
    return raw_zones.select(
        F.col("LocationID").cast("int").alias("location_id"),
        F.trim(F.col("Borough")).alias("borough"),
        F.trim(F.col("Zone")).alias("zone_name"),
        F.trim(F.col("service_zone")).alias("service_zone"),
    )
