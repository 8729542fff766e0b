"""Declared schemas and column lists of every layer."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)

# Raw trip columns as the monthly files carry them (mixed case kept).
RAW_TRIP_COLUMNS = [
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
    "trip_distance", "RatecodeID", "store_and_fwd_flag", "PULocationID", "DOLocationID",
    "payment_type", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "congestion_surcharge", "airport_fee",
]

RAW_TRIPS = T.StructType([
    T.StructField("VendorID", T.IntegerType()),
    T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
    T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
    T.StructField("passenger_count", T.IntegerType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("RatecodeID", T.IntegerType()),
    T.StructField("store_and_fwd_flag", T.StringType()),
    T.StructField("PULocationID", T.IntegerType()),
    T.StructField("DOLocationID", T.IntegerType()),
    T.StructField("payment_type", T.IntegerType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("extra", T.DoubleType()),
    T.StructField("mta_tax", T.DoubleType()),
    T.StructField("tip_amount", T.DoubleType()),
    T.StructField("tolls_amount", T.DoubleType()),
    T.StructField("improvement_surcharge", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("congestion_surcharge", T.DoubleType()),
    T.StructField("airport_fee", T.DoubleType()),
])

PARTITION_COLUMNS = ["trip_year", "trip_month"]
AUDIT_COLUMNS = ["source_execution_id", "source_execution_dt", "source_file", "source_file_size"]

# Zone lookup CSV: header row, four columns, read with this schema.
RAW_ZONES = T.StructType([
    T.StructField("LocationID", T.IntegerType(), False),
    T.StructField("Borough", T.StringType()),
    T.StructField("Zone", T.StringType()),
    T.StructField("service_zone", T.StringType()),
])

# The four seed lookups: (key column, key type, name column).
SEEDS = {
    "vendor": ("vendor_id", T.IntegerType(), "vendor_name"),
    "rate_code": ("rate_code_id", T.IntegerType(), "rate_code_name"),
    "payment_type": ("payment_type_id", T.IntegerType(), "payment_type_name"),
    "store_and_fwd_flag": ("store_and_fwd_flag", T.StringType(), "store_and_fwd_description"),
}


def seed_schema(name: str) -> T.StructType:
    key, key_type, value = SEEDS[name]
    return T.StructType([T.StructField(key, key_type), T.StructField(value, T.StringType())])


# Staged trip columns in output order (after the key).
STG_TRIP_COLUMNS = [
    "vendor_id", "rate_code_id", "pickup_location_id", "dropoff_location_id",
    "payment_type_id", "store_and_fwd_flag", "passenger_count", "trip_distance_miles",
    "pickup_datetime", "dropoff_datetime", "fare_amount", "extra_amount", "mta_tax",
    "tip_amount", "tolls_amount", "improvement_surcharge", "congestion_surcharge",
    "airport_fee", "total_amount",
]

# Exact-duplicate removal compares all staged business columns.
DEDUP_COLUMNS = list(STG_TRIP_COLUMNS)

# Surrogate key inputs, in hashing order (a subset: see stg_key_collisions).
TRIP_KEY_COLUMNS = [
    "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id",
    "vendor_id", "rate_code_id", "payment_type_id", "passenger_count",
    "trip_distance_miles", "fare_amount", "tip_amount", "tolls_amount", "total_amount",
]

MONEY_COLUMNS = [
    "fare_amount", "extra_amount", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "congestion_surcharge", "airport_fee", "total_amount",
]

DIM_LOCATION_COLUMNS = [
    "location_id", "borough", "zone_name", "service_zone", "is_airport", "is_ewr",
    "is_yellow_zone", "borough_group", "manhattan_subregion",
]

FACT_COLUMNS = [
    "trip_id", "pickup_datetime", "dropoff_datetime", "pickup_date", "pickup_day_of_week",
    "pickup_hour", "pickup_month", "pickup_year", "trip_duration_seconds",
    "trip_duration_minutes", "passenger_count", "trip_distance_miles", "avg_speed_mph",
    "vendor_id", "vendor_name", "rate_code_id", "rate_code_name", "payment_type_id",
    "payment_type_name", "store_and_fwd_flag", "store_and_fwd_description",
    "pickup_location_id", "pickup_borough", "pickup_zone", "pickup_service_zone",
    "is_airport_pickup", "pickup_borough_group", "pickup_manhattan_subregion",
    "dropoff_location_id", "dropoff_borough", "dropoff_zone", "dropoff_service_zone",
    "is_airport_dropoff", "dropoff_borough_group", "dropoff_manhattan_subregion",
    "fare_amount", "extra_amount", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "congestion_surcharge", "airport_fee", "total_amount",
    "tip_percentage", "fare_per_mile", "fare_per_minute", "is_rush_hour", "is_weekend",
    "is_late_night", "is_airport_trip", "trip_borough_type",
]

# Fact and marts are stored partitioned by pickup month.
FACT_PARTITIONS = ["pickup_year", "pickup_month"]
