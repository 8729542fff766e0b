"""Registered queries of the run rules: unbounded ratios, one-pass marts, grain and
gate decisions, changed months, type drift, quarantine, audit columns, names.

The oracles spell their values out instead of taking them from the code they check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.incremental import loading as inc
from tripmart.operators import facts, marts, quality, staging
from tripmart.plans import oracle_sql as O
from tripmart.plans import pipeline, roundtrips
from tripmart.plans.registry import FAILING, _dq_ctes, _fact, _oracle_check, dq_models, lookups, present
from tripmart.session import configure
from tripmart.sources import drift, fixture, trips


# --- ratios without a ceiling, marts from one pass ------------------------------------

def q_mart_vendor_unbounded_ratio(spark, sf_dir):
    """Fares over next to no distance: ratios of 10^28 and 10^203, and ordinary ones."""
    cents = F.round(F.col("fare_amount") * 100).cast("bigint")
    scaled = lambda e: F.concat(cents.cast("string"), F.lit(f"E{e}")).cast("double")
    ratio = (F.when((F.col("vendor_id") == 2) & (F.col("pickup_hour") % 2 == 0), scaled(26))
             .when((F.col("vendor_id") == 6) & (F.col("payment_type_id") == 1), scaled(201))
             .when((F.col("vendor_id") == 9) & (F.col("payment_type_id") == 1), F.lit(float("inf")))
             .otherwise(F.col("fare_per_mile")))
    mart = marts.build_mart("agg_vendor_performance", _fact(spark, sf_dir).withColumn("fare_per_mile", ratio))
    avg = F.col("avg_fare_per_mile")
    power = F.when(F.col("vendor_id") == 2, 1e20).when(F.col("vendor_id") == 6, 1e195).otherwise(0.01)
    return mart.select("pickup_year", "pickup_month", "vendor_id", (avg == float("inf")).alias("is_infinite"),
                       F.when(avg != float("inf"), F.round(avg / power).cast("bigint")).alias("scaled_average"))


def _oracle_unbounded_ratio() -> str:
    ratio = ("CASE WHEN vendor_id = 2 AND pickup_hour % 2 = 0 THEN CAST(_fc AS DOUBLE) * 1e26 "
             "WHEN vendor_id = 6 AND payment_type_id = 1 THEN CAST(_fc AS DOUBLE) * 1e201 "
             "WHEN vendor_id = 9 AND payment_type_id = 1 THEN 'infinity'::DOUBLE ELSE CAST(_fpm_h AS DOUBLE) / 100 END")
    power = "CASE vendor_id WHEN 2 THEN 1e20 WHEN 6 THEN 1e195 ELSE 0.01 END"
    return O.with_sql(O.base_ctes() + [
        ("r", f"  SELECT pickup_year, pickup_month, vendor_id, _fpm_h, {ratio} AS ratio FROM fact"),
        # ordinary ratios in whole cents, the huge ones by a compensated sum
        ("a", "  SELECT pickup_year, pickup_month, vendor_id, count(ratio) AS n, max(ratio) AS top, fsum(ratio) AS total, "
              "sum(_fpm_h) AS h, count(_fpm_h) AS hn FROM r GROUP BY ALL")],
        "SELECT pickup_year, pickup_month, vendor_id, coalesce(top = 'infinity'::DOUBLE, NULL) AS is_infinite, "
        f"CASE WHEN top = 'infinity'::DOUBLE THEN NULL WHEN top < 1e15 THEN CAST((2 * h + hn) // (2 * hn) AS BIGINT) "
        f"ELSE CAST(round(total / n / {power}) AS BIGINT) END AS scaled_average FROM a")


def _one_pass(name):
    def run(spark, sf_dir):
        return present(marts.roll_up(name, marts.partials(_fact(spark, sf_dir), marts.STATE_KEYS)))
    return run


# --- grain and gate ----------------------------------------------------------------

def _spanning_zones() -> list[tuple]:
    """Zone names that lie in several boroughs."""
    return [(i, b, f"Z{i % 7}", s) for i, b, _, s in fixture.fixture_zone_rows()]


def q_run_grain_checks(spark, sf_dir):
    """The grain rows of a whole run's report, zone names spanning boroughs."""
    work = roundtrips._workdir(spark, "grain")
    layout = pipeline.Layout(work + "/lake", "TEST")
    zones = spark.sql("SELECT * FROM " + fixture.zones_sql(_spanning_zones(), "STRING"))
    zones.coalesce(1).write.option("header", True).csv(work + "/zones_csv")
    pipeline.ingest_zones(spark, layout, work + "/zones_csv")
    for (y, m), path in sorted(roundtrips.write_month_files(spark, sf_dir, work + "/inbound").items()):
        pipeline.ingest_month(spark, layout, path, y, m, source_file_size_mb=0)
    report = pipeline.build(spark, layout, quality_gate="report")
    rows = [tuple(r[c] for c in quality.REPORT_SCHEMA.fieldNames()) for r in report if r["test"] == quality.GRAIN]
    return spark.createDataFrame(rows, quality.REPORT_SCHEMA)


def _oracle_run_grain() -> str:
    ctes = O.staging_ctes(fixture.raw_trips_sql()) + O.lookup_ctes(_spanning_zones()) + O.fact_ctes()
    keys = {"agg_daily_zone_summary": "pickup_date,pickup_zone", "agg_monthly_zone_summary": "pickup_year,pickup_month,pickup_zone",
            "agg_hourly_demand": "pickup_date,pickup_hour,pickup_borough", "agg_vendor_performance": "pickup_year,pickup_month,vendor_id"}
    parts = []
    for name, key in keys.items():
        ctes.append((f"m_{name}", O.mart_sql(name)))
        parts.append(f"SELECT '{name}' AS model, '{key}' AS column_name, 'grain' AS test, 'error' AS severity, CAST(count(*) AS BIGINT) "
                     f"AS failures FROM (SELECT {key} FROM m_{name} GROUP BY {key} HAVING count(*) > 1)")
    return O.with_sql(ctes + [("g", "\nUNION ALL\n".join(parts))],
                      "SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM g")


def q_gate_decisions(spark, sf_dir):
    """What the gate does about a fact with repeated keys, odd flags and orphans."""
    models, parents = dq_models(spark, sf_dir, FAILING)
    checks = [c for c in quality.DECLARED_CHECKS if c.test in FAILING]
    return quality.decisions(quality.run_checks(models, checks, parents))


def _oracle_gate_decisions() -> str:
    ctes = _dq_ctes(FAILING)
    for name in marts.MARTS:
        ctes.append((f"m_{name}", O.mart_sql(name)))
    checks = [c for c in quality.DECLARED_CHECKS if c.test in FAILING]
    ctes.append(("checks", "\nUNION ALL\n".join(_oracle_check(c) for c in checks)))
    ctes.append(("bad", "  SELECT model, count(*) AS n, string_agg(model || '.' || column_name || ' ' || test || ': ' || failures, '; ' "
                        "ORDER BY model || '.' || column_name || ' ' || test || ': ' || failures) AS why FROM checks "
                        "WHERE failures > 0 AND severity = 'error' GROUP BY model"))
    ctes.append(("models", """  SELECT * FROM (VALUES ('stg_yellow_taxi_trips', []), ('stg_taxi_zone_lookup', []),
    ('dim_location', ['stg_taxi_zone_lookup']),
    ('fact_yellow_taxi_trips', ['stg_yellow_taxi_trips', 'dim_location', 'stg_taxi_zone_lookup']),
    ('agg_daily_zone_summary', ['fact_yellow_taxi_trips', 'stg_yellow_taxi_trips', 'dim_location', 'stg_taxi_zone_lookup']),
    ('agg_monthly_zone_summary', ['fact_yellow_taxi_trips', 'stg_yellow_taxi_trips', 'dim_location', 'stg_taxi_zone_lookup']),
    ('agg_hourly_demand', ['fact_yellow_taxi_trips', 'stg_yellow_taxi_trips', 'dim_location', 'stg_taxi_zone_lookup']),
    ('agg_vendor_performance', ['fact_yellow_taxi_trips', 'stg_yellow_taxi_trips', 'dim_location', 'stg_taxi_zone_lookup'])
    ) AS v(model, above)"""))
    ctes.append(("judged", """  SELECT m.model, any_value(o.n) AS n, any_value(o.why) AS own, string_agg(b.model, ',' ORDER BY b.model) AS blocked_by,
    string_agg(b.why, '; ' ORDER BY b.why) AS why
  FROM models m LEFT JOIN bad o ON o.model = m.model LEFT JOIN bad b ON list_contains(m.above, b.model) GROUP BY m.model"""))
    return O.with_sql(ctes, "SELECT model, CASE WHEN blocked_by IS NOT NULL THEN 'blocked' WHEN n IS NOT NULL THEN 'failed' ELSE 'passed' END "
                            "AS decision, CAST(coalesce(n, 0) AS BIGINT) AS failed_checks, blocked_by, coalesce(why, own) AS reason FROM judged")


# --- changed months ----------------------------------------------------------------

def q_changed_months(spark, sf_dir):
    """Pickup months that the second delivery changes, with the digests' own counts."""
    configure(spark)
    first, full = fixture.raw_trips_batches(spark, sf_dir)
    old = first.unionByName(full.filter("trip_month = 2 AND VendorID <> 7"))
    again = old.repartition(7)  # the same rows in another order change nothing
    months = inc.changed_months(inc.month_digests(old), inc.month_digests(full)).withColumn("delivery", F.lit("complete"))
    same = inc.changed_months(inc.month_digests(old), inc.month_digests(again)).withColumn("delivery", F.lit("same rows"))
    return months.unionByName(same)


def _oracle_changed_months() -> str:
    raw = fixture.raw_trips_sql(keep_order_key=True)
    return f"""WITH new AS (SELECT * EXCLUDE (_orderkey) FROM ({raw})),
old AS (SELECT * EXCLUDE (_orderkey) FROM ({raw}) WHERE (trip_month = 1 AND _orderkey % 13 <> 0) OR (trip_month = 2 AND VendorID <> 7)),
diff AS ((SELECT * FROM new EXCEPT ALL SELECT * FROM old) UNION ALL (SELECT * FROM old EXCEPT ALL SELECT * FROM new))
SELECT DISTINCT trip_year AS pickup_year, trip_month AS pickup_month, 'complete' AS delivery FROM diff"""


def q_incr_monthly_safe_one_month(spark, sf_dir):
    """January comes again complete, February as it was: only January is rebuilt."""
    configure(spark)
    lk, name = lookups(spark), "agg_monthly_zone_summary"
    first, full = fixture.raw_trips_batches(spark, sf_dir)
    old = first.unionByName(full.filter("trip_month = 2"))
    touched = inc.changed_months(inc.month_digests(old), inc.month_digests(full))
    target = marts.build_mart(name, facts.fact_trips(staging.stg_trips(old), lk)).withColumn("rebuilt", F.lit(False))
    rebuilt = marts.build_mart(name, inc.safe_rebuild_fact(staging.stg_trips(full), lk, touched)).withColumn("rebuilt", F.lit(True))
    return present(inc.replace_grains(target, rebuilt, ["pickup_year", "pickup_month"]))


def q_safe_identical_redelivery(spark, sf_dir):
    """January again, the same rows in other files: the next build rebuilds no month."""
    layout = roundtrips._built_layout(spark, sf_dir, "identical")
    work = layout.root.rsplit("/", 1)[0]
    again = fixture.raw_trips_fixture(spark, sf_dir).filter("trip_month = 1").repartition(5)
    files = roundtrips.write_month_files(spark, sf_dir, work + "/again", raw=again)
    changed = pipeline.ingest_month(spark, layout, files[(2025, 1)], 2025, 1, source_file_size_mb=0)
    pipeline.build(spark, layout, months=changed, quality_gate="skip")
    return present(spark.read.parquet(layout.fact).select(*schemas.FACT_COLUMNS)).withColumn("months_rebuilt", F.lit(len(changed)))


# --- type drift, quarantine --------------------------------------------------------

def _drifting_files(spark, sf_dir, inbound: str) -> list[str]:
    """January with long passengers and decimal surcharges; the first half of February
    with double passengers; the rest with pickup times in microseconds and one more column."""
    raw = fixture.raw_trips_fixture(spark, sf_dir)
    feb = F.col("trip_month") == 2
    early = F.col("tpep_pickup_datetime") < F.lit("2025-02-15").cast("timestamp_ntz")
    keep = schemas.RAW_TRIP_COLUMNS
    parts = {
        "a": raw.filter(~feb).select(*keep).withColumns({"passenger_count": F.col("passenger_count").cast("bigint"),
                                                         "improvement_surcharge": F.col("improvement_surcharge").cast("decimal(10,2)"),
                                                         "PULocationID": F.col("PULocationID").cast("smallint")}),
        "b": raw.filter(feb & early).select(*keep).withColumn("passenger_count", F.col("passenger_count").cast("double")),
        "c": raw.filter(feb & ~early).select(*keep).withColumns({
            "tpep_pickup_datetime": F.unix_micros(F.col("tpep_pickup_datetime").cast("timestamp")),
            "cbd_fee": F.col("VendorID") * 0.25}).withColumnRenamed("airport_fee", "Airport_Fee"),
    }
    for name, df in parts.items():
        df.write.parquet(f"{inbound}/{name}")
    return [f"{inbound}/{name}" for name in parts]


def q_drift_scan(spark, sf_dir):
    configure(spark)
    return drift.read_widened(spark, _drifting_files(spark, sf_dir, roundtrips._workdir(spark, "drift")))


def q_drift_raw_table(spark, sf_dir):
    """The same files ingested as three raw months and read as one table."""
    configure(spark)
    work = roundtrips._workdir(spark, "drift-raw")
    layout = pipeline.Layout(work + "/lake", "TEST")
    for month, path in enumerate(_drifting_files(spark, sf_dir, work + "/inbound"), 1):
        if month == 3:  # pickup times of the declared type; the column the others lack stays
            drift.read_widened(spark, [path], like=schemas.RAW_TRIPS).write.parquet(work + "/inbound/c2")
            path = work + "/inbound/c2"
        pipeline.ingest_month(spark, layout, path, 2025, month, source_file_size_mb=0)
    raw = pipeline.raw_trips_table(spark, layout)
    return raw.select(*[F.col(c).alias(c) for c in schemas.RAW_TRIP_COLUMNS], F.col("cbd_fee").cast("double").alias("cbd_fee"), "trip_year", "trip_month")


def _oracle_drift(raw_table: bool) -> str:
    names = [c for c in schemas.RAW_TRIP_COLUMNS]
    types = {"passenger_count": "DOUBLE", "PULocationID": "INTEGER", "improvement_surcharge": "DOUBLE"}
    if raw_table:
        types = {}
    columns = ", ".join(f"CAST({c} AS {types[c]}) AS {c}" if c in types else c for c in names)
    late = "trip_month = 2 AND tpep_pickup_datetime >= TIMESTAMP '2025-02-15'"
    extra = f", CASE WHEN {late} THEN VendorID * 0.25::DOUBLE END AS cbd_fee"
    if raw_table:
        extra += f", trip_year, CAST(CASE WHEN {late} THEN 3 ELSE trip_month END AS INTEGER) AS trip_month"
    return f"SELECT {columns}{extra} FROM ({fixture.raw_trips_sql()})"


def _spoilt(raw: DataFrame) -> DataFrame:
    """Vendors and zones as text, some without a number; fares and tips past their decimal."""
    return raw.withColumns({
        "VendorID": F.when(F.col("VendorID") == 9, "nine").otherwise(F.col("VendorID").cast("string")),
        "PULocationID": F.when(F.col("PULocationID") % 50 == 0, F.concat(F.lit("Z"), F.col("PULocationID"))).otherwise(F.col("PULocationID").cast("string")),
        "fare_amount": F.when(F.col("payment_type") == 6, F.col("fare_amount") + 1e9).otherwise(F.col("fare_amount")),
        "tip_amount": F.when(F.col("passenger_count") == 5, F.col("tip_amount") * 1e10).otherwise(F.col("tip_amount")),
    })


def q_quarantine_rows(spark, sf_dir):
    """Rows of a spoilt January file: loaded, rejected at ingest or in staging, with the
    columns at fault."""
    work = roundtrips._workdir(spark, "quarantine")
    layout = pipeline.Layout(work + "/lake", "TEST")
    pipeline.ingest_zones(spark, layout, roundtrips.write_zones(spark, work + "/zones_csv"))
    raw = _spoilt(fixture.raw_trips_fixture(spark, sf_dir).filter("trip_month = 1"))
    path = roundtrips.write_month_files(spark, sf_dir, work + "/inbound", raw=raw)[(2025, 1)]
    pipeline.ingest_month(spark, layout, path, 2025, 1, source_file_size_mb=0, cast_mode="try")
    pipeline.build(spark, layout, quality_gate="skip", cast_mode="try")
    at_ingest = spark.read.parquet(layout.rejected_at_ingest)
    at_ingest = at_ingest.select(F.lit("ingest").alias("step"), F.get_json_object("row", "$.tpep_pickup_datetime").cast("timestamp_ntz").alias("pickup"),
                                 F.concat_ws(",", "rejected_columns").alias("reasons"))
    in_staging = spark.read.parquet(layout.quarantine).select(
        F.lit("staging").alias("step"), F.col("tpep_pickup_datetime").alias("pickup"), F.concat_ws(",", "rejected_columns").alias("reasons"))
    good, _ = staging.quarantine_bad_casts(pipeline.raw_trips_table(spark, layout))
    loaded = good.select(F.lit("loaded").alias("step"), F.col("tpep_pickup_datetime").alias("pickup"), F.lit("").alias("reasons"))
    return loaded.unionByName(at_ingest).unionByName(in_staging)


def q_rejection_counts(spark, sf_dir):
    """Two runs over the same spoilt file: the counts of both stay."""
    work = roundtrips._workdir(spark, "rejections")
    layout = pipeline.Layout(work + "/lake", "TEST")
    pipeline.ingest_zones(spark, layout, roundtrips.write_zones(spark, work + "/zones_csv"))
    raw = _spoilt(fixture.raw_trips_fixture(spark, sf_dir).filter("trip_month = 1"))
    path = roundtrips.write_month_files(spark, sf_dir, work + "/inbound", raw=raw)[(2025, 1)]
    for _ in range(2):
        pipeline.ingest_month(spark, layout, path, 2025, 1, source_file_size_mb=0, cast_mode="try")
    pipeline.build(spark, layout, quality_gate="skip", cast_mode="try")
    counts = spark.read.parquet(layout.rejection_counts)
    return counts.groupBy("step", "column_name").agg(F.count_distinct("run_id").alias("runs"), F.min("n_rows").alias("least"), F.max("n_rows").alias("most"))


_SPOILT_SQL = """spoilt AS (
  SELECT tpep_pickup_datetime AS pickup, VendorID = 9 AS bad_vendor, PULocationID % 50 = 0 AS bad_zone,
    payment_type = 6 AS bad_fare,
    passenger_count = 5 AND abs(tip_amount * 1e10) >= 99999999.995 AS bad_tip
  FROM ({raw}) WHERE trip_month = 1)"""


def _oracle_quarantine() -> str:
    return f"WITH {_SPOILT_SQL.format(raw=fixture.raw_trips_sql())}" + """
SELECT CASE WHEN bad_vendor OR bad_zone THEN 'ingest' WHEN bad_fare OR bad_tip THEN 'staging' ELSE 'loaded' END AS step, pickup,
  CASE WHEN bad_vendor OR bad_zone THEN concat_ws(',', CASE WHEN bad_vendor THEN 'VendorID' END, CASE WHEN bad_zone THEN 'PULocationID' END)
       ELSE concat_ws(',', CASE WHEN bad_fare THEN 'fare_amount' END, CASE WHEN bad_tip THEN 'tip_amount' END) END AS reasons
FROM spoilt"""


def _oracle_rejections() -> str:
    return f"WITH {_SPOILT_SQL.format(raw=fixture.raw_trips_sql())}" + """,
counts AS (
  SELECT 'ingest' AS step, 'VendorID' AS column_name, 2 AS runs, count(*) AS n FROM spoilt WHERE bad_vendor
  UNION ALL SELECT 'ingest', 'PULocationID', 2, count(*) FROM spoilt WHERE bad_zone
  UNION ALL SELECT 'staging', 'fare_amount', 1, count(*) FROM spoilt WHERE bad_fare AND NOT bad_vendor AND NOT bad_zone
  UNION ALL SELECT 'staging', 'tip_amount', 1, count(*) FROM spoilt WHERE bad_tip AND NOT bad_vendor AND NOT bad_zone)
SELECT step, column_name, CAST(runs AS BIGINT) AS runs, CAST(n AS BIGINT) AS least, CAST(n AS BIGINT) AS most FROM counts WHERE n > 0"""


# --- audit columns, zone flags, names ----------------------------------------------

def q_ingest_audit(spark, sf_dir):
    """Per raw partition: rows, source file, its size in whole megabytes, run ids."""
    work = roundtrips._workdir(spark, "audit")
    layout = pipeline.Layout(work + "/lake", "TEST")
    for (y, m), path in sorted(roundtrips.write_month_files(spark, sf_dir, work + "/inbound").items()):
        pipeline.ingest_month(spark, layout, path, y, m, source_file_size_mb=10.99 + m)
    raw = pipeline.raw_trips_table(spark, layout)
    return raw.groupBy("trip_year", "trip_month", "source_file", "source_file_size").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("source_execution_id").alias("run_ids"),
        F.count_distinct("source_execution_dt").alias("run_times"),
        F.min(F.length("source_execution_id")).cast("bigint").alias("id_length"))


def q_zone_flag_trips(spark, sf_dir):
    """Trips by the flags of their pickup zone (the flags no mart carries)."""
    dim = lookups(spark).dim_location.select("location_id", "is_ewr", "is_yellow_zone", "manhattan_subregion")
    fact = _fact(spark, sf_dir)
    joined = fact.join(dim, fact["pickup_location_id"] == dim["location_id"])
    return joined.groupBy("is_ewr", "is_yellow_zone", "manhattan_subregion").agg(F.count(F.lit(1)).alias("trips"))


def q_export_names(spark, sf_dir):
    """Every month of the monthly mart exported: file names and their rows."""
    layout = roundtrips._built_layout(spark, sf_dir, "names")
    out = None
    for y, m in sorted(pipeline.indexed_months(spark, layout)):
        path = pipeline.export_month_slice(spark, layout, y, m)
        rows = spark.read.parquet(path).groupBy().agg(F.count(F.lit(1)).alias("n_rows"))
        part = rows.select(F.lit("/".join(path.rsplit("/", 2)[-2:])).alias("name"), "n_rows", F.lit(trips.trip_file_name(y, m)).alias("source"))
        out = part if out is None else out.unionByName(part)
    return out


def spark_queries() -> dict:
    return {
        "mart_vendor_unbounded_ratio": q_mart_vendor_unbounded_ratio,
        **{f"one_pass_{n}": _one_pass(n) for n in marts.MARTS},
        "run_grain_checks": q_run_grain_checks,
        "gate_decisions": q_gate_decisions,
        "changed_months": q_changed_months,
        "incr_monthly_safe_one_month": q_incr_monthly_safe_one_month,
        "safe_identical_redelivery": q_safe_identical_redelivery,
        "drift_scan": q_drift_scan,
        "drift_raw_table": q_drift_raw_table,
        "quarantine_rows": q_quarantine_rows,
        "rejection_counts": q_rejection_counts,
        "ingest_audit": q_ingest_audit,
        "zone_flag_trips": q_zone_flag_trips,
        "export_names": q_export_names,
    }


def oracle_queries() -> dict:
    return {
        "mart_vendor_unbounded_ratio": _oracle_unbounded_ratio(),
        **{f"one_pass_{n}": O.with_sql(O.base_ctes(), O.mart_sql(n)) for n in marts.MARTS},
        "run_grain_checks": _oracle_run_grain(),
        "gate_decisions": _oracle_gate_decisions(),
        "changed_months": _oracle_changed_months(),
        "incr_monthly_safe_one_month": O.with_sql(
            O.base_ctes() + [("m", O.mart_sql("agg_monthly_zone_summary"))], "SELECT *, pickup_month = 1 AS rebuilt FROM m"),
        "safe_identical_redelivery": O.with_sql(
            O.base_ctes(), f"SELECT {O.fact_select(schemas.FACT_COLUMNS)}, CAST(0 AS INTEGER) AS months_rebuilt FROM fact"),
        "drift_scan": _oracle_drift(False),
        "drift_raw_table": _oracle_drift(True),
        "quarantine_rows": _oracle_quarantine(),
        "rejection_counts": _oracle_rejections(),
        "ingest_audit": "SELECT trip_year, trip_month, 'yellow_tripdata_' || trip_year || '-' || lpad(CAST(trip_month AS VARCHAR), 2, '0') || "
                        "'.parquet' AS source_file, CAST(10 + trip_month AS INTEGER) AS source_file_size, CAST(count(*) AS BIGINT) AS n_rows, "
                        "CAST(1 AS BIGINT) AS run_ids, CAST(1 AS BIGINT) AS run_times, CAST(36 AS BIGINT) AS id_length "
                        f"FROM ({fixture.raw_trips_sql()}) GROUP BY trip_year, trip_month",
        "zone_flag_trips": O.with_sql(O.base_ctes(), "SELECT d.is_ewr, d.is_yellow_zone, d.manhattan_subregion, CAST(count(*) AS BIGINT) AS trips "
                                                     "FROM fact f JOIN dim d ON f.pickup_location_id = d.location_id GROUP BY ALL"),
        "export_names": O.with_sql(
            O.base_ctes() + [("m", O.mart_sql("agg_monthly_zone_summary"))],
            "SELECT 'TEST_EXPORT/AGG_MONTHLY_ZONE_SUMMARY_' || pickup_year || '_' || lpad(CAST(pickup_month AS VARCHAR), 2, '0') || '.parquet' "
            "AS name, CAST(count(*) AS BIGINT) AS n_rows, 'yellow_tripdata_' || pickup_year || '-' || "
            "lpad(CAST(pickup_month AS VARCHAR), 2, '0') || '.parquet' AS source FROM m GROUP BY pickup_year, pickup_month"),
    }
