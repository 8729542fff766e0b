"""Trip-shaped test input derived from the driver's ``lineitem`` table.

No trip data ships with the project, so every test and registered query reads
raw trips computed from ``lineitem`` by integer arithmetic that Spark and
DuckDB evaluate identically.  The same mapping is given twice: as a Spark
plan (``raw_trips_fixture``) and as DuckDB SQL text (``raw_trips_sql``) for the
oracles.  Work grows with ``lineitem``: one scan, narrow projections, no
shuffle.

The zone lookup is an input file in production.  Tests use a zone table built
from a rule (``fixture_zone_rows``): 265 ids, five boroughs with repeating
zone names, airports, EWR, padded text and the ``N/A``/``Unknown`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.sources import lookups

# ---------------------------------------------------------------------------
# Fixed values of the fixture mapping (chosen for coverage, see FIXTURES.md).
VENDOR_BY_MOD5 = [1, 2, 6, 7, 9]            # 9 misses the vendor lookup
RATE_BY_MOD8 = [1, 2, 3, 4, 5, 6, 99, None]  # NULL join key
FLAG_BY_RETURNFLAG = {"R": " y", "A": "N "}  # N -> NULL
DUPLICATE_EVERY = 50                         # l_orderkey % 50 = 0 appears twice
COLLIDE_EVERY = 101                          # trips_collide: raised extra, same key
LATE_EVERY = 13                              # held back from the January batch
BASE_PICKUP = "2025-01-01 00:00:00"
SHIP_EPOCH = "1995-01-01"
PICKUP_DAYS = 59                             # January and February 2025
AIRPORT_FEE_ZONES = [132, 138]
BATCH_SPLIT_DATE = "2025-02-01"

# Fixed values of the rule-built zone fixture.
FIXTURE_BOROUGHS = ["Queens", "Bronx", "Manhattan", "Brooklyn", "Staten Island"]
# One Manhattan name per sub-region pattern; every other name is "<borough> Zone <k>".
FIXTURE_MANHATTAN = ["Midtown 1", "Times Sq 2", "Penn Station 3", "Garment 4", "Financial 5", "TriBeCa 6",
                     "Battery Park 7", "Seaport 8", "World Trade 9", "Upper East 10", "Upper West 11",
                     "Lenox Hill 12", "Yorkville 13", "Lincoln Square 14", "Central Park 15", "Harlem 16",
                     "Washington Heights 17", "Inwood 18", "Hamilton 19", "Manhattanville 20"]
FIXTURE_ZONES_PER_BOROUGH = {"Manhattan": 40, "Queens": 18, "Bronx": 15, "Brooklyn": 18, "Staten Island": 10}
FIXTURE_SPECIAL_ZONES = {
    1: ("EWR", "Newark Airport", "EWR"),
    132: ("Queens", "JFK Airport", "Airports"),
    138: ("Queens", "LaGuardia Airport", "Airports"),
    264: ("Unknown", "NV", "N/A"),
    265: ("N/A", "Outside of NYC", "N/A"),
}
ZONE_COUNT = 265
# ---------------------------------------------------------------------------


def fixture_zone_rows() -> list[tuple[int, str, str, str]]:
    """Raw zone rows (LocationID, Borough, Zone, service_zone) by rule.

    Names repeat only inside one borough with one service zone, so a zone
    name still determines borough, service zone and airport flag (the mart
    grain).  Every 17th name and 23rd borough carries padding to exercise trim.
    """
    rows = []
    for loc in range(1, ZONE_COUNT + 1):
        if loc in FIXTURE_SPECIAL_ZONES:
            borough, zone, service = FIXTURE_SPECIAL_ZONES[loc]
        else:
            borough = FIXTURE_BOROUGHS[(loc - 2) % len(FIXTURE_BOROUGHS)]
            k = ((loc - 2) // len(FIXTURE_BOROUGHS)) % FIXTURE_ZONES_PER_BOROUGH[borough]
            named = borough == "Manhattan" and k < len(FIXTURE_MANHATTAN)
            zone = FIXTURE_MANHATTAN[k] if named else f"{borough} Zone {k + 1:02d}"
            service = "Yellow Zone" if borough == "Manhattan" else "Boro Zone"
        if loc % 17 == 0:
            zone = f"  {zone} "
        if loc % 23 == 0:
            borough = f"{borough}  "
        rows.append((loc, borough, zone, service))
    return rows


def zones_fixture(spark: SparkSession) -> DataFrame:
    """The rule-built zone lookup as a raw zone DataFrame (265 rows).

    An inline VALUES relation: a JVM-side local relation, no Python RDD."""
    return spark.sql("SELECT * FROM " + zones_sql(string_type="STRING"))


def write_zones_csv(rows, path: str) -> str:
    """Write zone rows as the header CSV the zone reader expects."""
    import csv
    import os

    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh, quoting=csv.QUOTE_ALL)
        w.writerow(["LocationID", "Borough", "Zone", "service_zone"])
        for r in rows:
            w.writerow(r)
    return path


def _cents(c: Column) -> Column:
    return c.cast("double") / F.lit(100.0)


def raw_trips_fixture(spark: SparkSession, sf_dir: str, *, collide: bool = False,
                      keep_order_key: bool = False) -> DataFrame:
    """Raw trips (ingested layout: raw columns + trip_year/trip_month).

    One ``lineitem`` scan; duplicated rows are generated by ``explode`` of a
    copy number, not by a second scan or a self-join.
    """
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_shipdate")
    c = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    q = F.col("l_quantity").cast("bigint")
    days = F.datediff(F.to_date("l_shipdate"), F.lit(SHIP_EPOCH).cast("date")).cast("bigint")
    base = li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag",
        c.alias("c"), q.alias("q"), days.alias("d"))

    copies = F.array(F.lit(0))
    copies = F.when(F.col("l_orderkey") % DUPLICATE_EVERY == 0, F.array_append(copies, F.lit(1))).otherwise(copies)
    if collide:
        copies = F.when(F.col("l_orderkey") % COLLIDE_EVERY == 0, F.array_append(copies, F.lit(2))).otherwise(copies)
    base = base.withColumn("copy_no", F.explode(copies))

    pk, sk, ln, ok = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber"), F.col("l_orderkey")
    c, q, d = F.col("c"), F.col("q"), F.col("d")

    vendor = F.element_at(F.array(*[F.lit(v) for v in VENDOR_BY_MOD5]), (sk % 5 + 1).cast("int"))
    rate = F.element_at(F.array(*[F.lit(v).cast("int") for v in RATE_BY_MOD8]), (pk % 8 + 1).cast("int"))
    pu = ((pk * 7 + ln) % 266 + 1).cast("int")
    do = ((sk * 7 + ln * 31 + q) % 266 + 1).cast("int")
    flag = (F.when(F.col("l_returnflag") == "R", F.lit(FLAG_BY_RETURNFLAG["R"]))
            .when(F.col("l_returnflag") == "A", F.lit(FLAG_BY_RETURNFLAG["A"])))
    distance = F.when(pk % 97 == 0, F.lit(600.0)).otherwise((q - 1).cast("double") * F.lit(0.25))
    pickup_secs = (d % PICKUP_DAYS) * 86400 + c % 86400
    pickup = F.timestamp_add("SECOND", pickup_secs, F.lit(BASE_PICKUP).cast("timestamp_ntz"))
    ride_secs = F.when(pk % 193 == 0, F.lit(90000).cast("bigint")).otherwise(c % 7001 - 60)

    fare_c = c % 20000 - 300
    tip_c = c % 977
    tolls_c = F.when(ln == 7, F.lit(694)).otherwise(F.lit(0)).cast("bigint")
    extra_c = (ln * 50).cast("bigint") + F.when(F.col("copy_no") == 2, F.lit(50)).otherwise(F.lit(0))
    mta_c = F.lit(50).cast("bigint")
    impr_c = F.lit(100).cast("bigint")
    cong_c = F.when(ln != 3, F.lit(250).cast("bigint"))
    airport_c = F.when(pu.isin(AIRPORT_FEE_ZONES), F.lit(175)).otherwise(F.lit(0)).cast("bigint")
    # total is computed from the unraised extra: a collide copy keeps its total
    total_c = (fare_c + (ln * 50).cast("bigint") + mta_c + tip_c + tolls_c + impr_c
               + F.coalesce(cong_c, F.lit(0).cast("bigint")) + airport_c)

    trips = base.select(
        vendor.cast("int").alias("VendorID"),
        pickup.alias("tpep_pickup_datetime"),
        F.timestamp_add("SECOND", ride_secs, pickup).alias("tpep_dropoff_datetime"),
        (q % 7).cast("int").alias("passenger_count"),
        distance.alias("trip_distance"),
        rate.alias("RatecodeID"),
        flag.alias("store_and_fwd_flag"),
        pu.alias("PULocationID"),
        do.alias("DOLocationID"),
        (ok % 7).cast("int").alias("payment_type"),
        _cents(fare_c).alias("fare_amount"),
        _cents(extra_c).alias("extra"),
        _cents(mta_c).alias("mta_tax"),
        _cents(tip_c).alias("tip_amount"),
        _cents(tolls_c).alias("tolls_amount"),
        _cents(impr_c).alias("improvement_surcharge"),
        _cents(total_c).alias("total_amount"),
        _cents(cong_c).alias("congestion_surcharge"),
        _cents(airport_c).alias("airport_fee"),
        ok.alias("_orderkey"),
    )
    trips = trips.withColumns({
        "trip_year": F.year("tpep_pickup_datetime"),
        "trip_month": F.month("tpep_pickup_datetime"),
    })
    return trips if keep_order_key else trips.drop("_orderkey")


def raw_trips_batches(spark: SparkSession, sf_dir: str):
    """Two ingestion batches for the incremental scenarios.

    Batch 1 is the January file as first delivered: January pickups except
    the late rows (``l_orderkey % 13 = 0``).  Batch 2 is what the raw layer
    holds after February lands and January is re-delivered complete: all rows.
    """
    full = raw_trips_fixture(spark, sf_dir, keep_order_key=True)
    january = full.filter((F.col("tpep_pickup_datetime") < F.lit(BATCH_SPLIT_DATE).cast("timestamp_ntz"))
                          & (F.col("_orderkey") % LATE_EVERY != 0))
    return january.drop("_orderkey"), full.drop("_orderkey")


# --------------------------------------------------------------------------
# The same inputs as DuckDB SQL text, for the oracles.

def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def values_sql(rows, columns, types) -> str:
    """A VALUES relation with explicit column types."""
    body = ",\n    ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    casts = ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in zip(columns, types))
    return f"(SELECT {casts} FROM (VALUES\n    {body}\n) AS v({', '.join(columns)}))"


def zones_sql(rows=None, string_type: str = "VARCHAR") -> str:
    """Zone rows as a typed VALUES relation (STRING for Spark, VARCHAR for DuckDB)."""
    rows = rows if rows is not None else fixture_zone_rows()
    return values_sql(rows, ["LocationID", "Borough", "Zone", "service_zone"],
                      ["INTEGER", string_type, string_type, string_type])


def seed_sql(name: str) -> str:
    return lookups.seed_values_sql(name, "VARCHAR")


def raw_trips_sql(*, collide: bool = False, keep_order_key: bool = False) -> str:
    """DuckDB statement producing exactly ``raw_trips_fixture`` rows."""
    vendor_case = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(VENDOR_BY_MOD5))
    rate_case = " ".join(f"WHEN {i} THEN {_sql_literal(v)}" for i, v in enumerate(RATE_BY_MOD8))
    collide_sql = (f"\n    UNION ALL SELECT *, 2 AS copy_no FROM li WHERE l_orderkey % {COLLIDE_EVERY} = 0"
                   if collide else "")
    key_sql = ",\n    l_orderkey AS _orderkey" if keep_order_key else ""
    return f"""
WITH li AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS c,
         CAST(l_quantity AS BIGINT) AS q,
         CAST(date_diff('day', DATE '{SHIP_EPOCH}', CAST(l_shipdate AS DATE)) AS BIGINT) AS d
  FROM lineitem
), copies AS (
  SELECT *, 0 AS copy_no FROM li
  UNION ALL SELECT *, 1 AS copy_no FROM li WHERE l_orderkey % {DUPLICATE_EVERY} = 0{collide_sql}
), parts AS (
  SELECT *,
    CAST((7 * l_partkey + l_linenumber) % 266 + 1 AS INTEGER) AS pu,
    TIMESTAMP '{BASE_PICKUP}' + to_seconds((d % {PICKUP_DAYS}) * 86400 + c % 86400) AS pickup,
    CASE WHEN l_partkey % 193 = 0 THEN CAST(90000 AS BIGINT) ELSE c % 7001 - 60 END AS ride_secs,
    c % 20000 - 300 AS fare_c,
    c % 977 AS tip_c,
    CAST(CASE WHEN l_linenumber = 7 THEN 694 ELSE 0 END AS BIGINT) AS tolls_c,
    CAST(50 * l_linenumber AS BIGINT) AS extra0_c,
    CASE WHEN l_linenumber <> 3 THEN CAST(250 AS BIGINT) END AS cong_c
  FROM copies
), cents AS (
  SELECT *,
    CAST(CASE WHEN pu IN ({', '.join(str(z) for z in AIRPORT_FEE_ZONES)}) THEN 175 ELSE 0 END AS BIGINT) AS airport_c
  FROM parts
)
SELECT
    CAST(CASE l_suppkey % 5 {vendor_case} END AS INTEGER) AS VendorID,
    pickup AS tpep_pickup_datetime,
    pickup + to_seconds(ride_secs) AS tpep_dropoff_datetime,
    CAST(q % 7 AS INTEGER) AS passenger_count,
    CASE WHEN l_partkey % 97 = 0 THEN 600.0::DOUBLE ELSE CAST(q - 1 AS DOUBLE) * 0.25::DOUBLE END AS trip_distance,
    CAST(CASE l_partkey % 8 {rate_case} END AS INTEGER) AS RatecodeID,
    CASE l_returnflag WHEN 'R' THEN '{FLAG_BY_RETURNFLAG["R"]}' WHEN 'A' THEN '{FLAG_BY_RETURNFLAG["A"]}' END AS store_and_fwd_flag,
    pu AS PULocationID,
    CAST((7 * l_suppkey + 31 * l_linenumber + q) % 266 + 1 AS INTEGER) AS DOLocationID,
    CAST(l_orderkey % 7 AS INTEGER) AS payment_type,
    CAST(fare_c AS DOUBLE) / 100.0::DOUBLE AS fare_amount,
    CAST(extra0_c + CASE WHEN copy_no = 2 THEN 50 ELSE 0 END AS DOUBLE) / 100.0::DOUBLE AS extra,
    50 / 100.0::DOUBLE AS mta_tax,
    CAST(tip_c AS DOUBLE) / 100.0::DOUBLE AS tip_amount,
    CAST(tolls_c AS DOUBLE) / 100.0::DOUBLE AS tolls_amount,
    100 / 100.0::DOUBLE AS improvement_surcharge,
    CAST(fare_c + extra0_c + 50 + tip_c + tolls_c + 100 + coalesce(cong_c, 0) + airport_c AS DOUBLE) / 100.0::DOUBLE AS total_amount,
    CAST(cong_c AS DOUBLE) / 100.0::DOUBLE AS congestion_surcharge,
    CAST(airport_c AS DOUBLE) / 100.0::DOUBLE AS airport_fee,
    CAST(year(pickup) AS INTEGER) AS trip_year,
    CAST(month(pickup) AS INTEGER) AS trip_month{key_sql}
FROM cents
"""
