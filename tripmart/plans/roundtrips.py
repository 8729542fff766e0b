"""Registered queries that write and read back: ingest, partition replace,
incremental-equals-full, export.  Each call works in a fresh folder under
the shared checkpoint folder of the session (``spark.checkpoint.dir``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.incremental import loading as inc
from tripmart.operators import marts
from tripmart.plans import fs, pipeline, sinks
from tripmart.plans import oracle_sql as O
from tripmart.plans.registry import present
from tripmart.session import configure, staging_path
from tripmart.sources import fixture, trips


def _workdir(spark: SparkSession, name: str) -> str:
    configure(spark)
    return staging_path(spark, f"q-{name}")


def write_month_files(spark: SparkSession, sf_dir: str, inbound: str, raw: DataFrame | None = None) -> dict:
    """Fixture trips as monthly source files named like the published ones.

    One pass without a shuffle: each task writes one file per month of its rows;
    then each partition folder is renamed to its file name."""
    raw = raw if raw is not None else fixture.raw_trips_fixture(spark, sf_dir)
    parts = inbound.rstrip("/") + "/_parts"
    raw.write.mode("overwrite").options(**sinks.SMALL_GROUPS).partitionBy("trip_year", "trip_month").parquet(parts)
    out = {}
    for year_dir in fs.list_files(spark, parts):
        for src in fs.list_files(spark, year_dir) if "trip_year=" in year_dir else []:
            y, m = int(year_dir.rpartition("=")[2]), int(src.rpartition("=")[2])
            out[(y, m)] = f"{inbound.rstrip('/')}/{trips.trip_file_name(y, m)}"
            fs.rename(spark, src, out[(y, m)])
    return out


def write_zones(spark: SparkSession, path: str) -> str:
    fixture.zones_fixture(spark).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def q_scan_trips_month(spark, sf_dir):
    files = write_month_files(spark, sf_dir, _workdir(spark, "scan") + "/inbound")
    return trips.read_trip_month(spark, files[(2025, 1)])


def q_ingest_normalise(spark, sf_dir):
    files = write_month_files(spark, sf_dir, _workdir(spark, "ingest") + "/inbound")
    df = trips.normalise_raw_trips(trips.read_trip_month(spark, files[(2025, 1)]), 2025, 1,
                                   source_file=trips.trip_file_name(2025, 1))
    # execution id, run time and file size vary per run: not compared
    return df.drop("source_execution_id", "source_execution_dt", "source_file_size")


def q_replace_partition(spark, sf_dir):
    work = _workdir(spark, "replace")
    layout = pipeline.Layout(work + "/lake", "TEST")
    full = write_month_files(spark, sf_dir, work + "/inbound")
    first, _ = fixture.raw_trips_batches(spark, sf_dir)
    v1 = write_month_files(spark, sf_dir, work + "/inbound_v1", raw=first)
    pipeline.ingest_month(spark, layout, v1[(2025, 1)], 2025, 1, source_file_size_mb=0)
    pipeline.ingest_month(spark, layout, full[(2025, 2)], 2025, 2, source_file_size_mb=0)
    # the complete January re-delivery replaces only its own partition
    pipeline.ingest_month(spark, layout, full[(2025, 1)], 2025, 1, source_file_size_mb=0)
    raw = spark.read.parquet(layout.raw_trips)
    return raw.select(*schemas.RAW_TRIP_COLUMNS, "trip_year", "trip_month")


def _three_runs(spark, sf_dir, name):
    """Safe-mode runs: January (late rows missing), February, January again
    (complete).  Returns the layout after the last build."""
    work = _workdir(spark, name)
    layout = pipeline.Layout(work + "/lake", "TEST")
    full = write_month_files(spark, sf_dir, work + "/inbound")
    first, _ = fixture.raw_trips_batches(spark, sf_dir)
    v1 = write_month_files(spark, sf_dir, work + "/inbound_v1", raw=first)
    pipeline.ingest_zones(spark, layout, write_zones(spark, work + "/zones_csv"))
    for path, (y, m) in [(v1[(2025, 1)], (2025, 1)), (full[(2025, 2)], (2025, 2)), (full[(2025, 1)], (2025, 1))]:
        touched = pipeline.ingest_month(spark, layout, path, y, m, source_file_size_mb=0)
        pipeline.build(spark, layout, mode=inc.SAFE, months=touched, quality_gate="skip")
    return layout


def q_full_refresh_equals_incremental(spark, sf_dir):
    layout = _three_runs(spark, sf_dir, "incremental")
    return present(spark.read.parquet(layout.mart("agg_daily_zone_summary")))


def q_safe_path_monthly(spark, sf_dir):
    """The third run touches January alone; February's partitions stay."""
    layout = _three_runs(spark, sf_dir, "safe-path")
    return present(spark.read.parquet(layout.mart("agg_monthly_zone_summary")))


def _rerun_after_failure(spark, sf_dir):
    """January is delivered without its late rows and with stray February trips,
    and built; the complete January lands, but the run dies before the build;
    the rerun ingests it again and builds."""
    work = _workdir(spark, "rerun")
    layout = pipeline.Layout(work + "/lake", "TEST")
    full_raw = fixture.raw_trips_fixture(spark, sf_dir)
    first, _ = fixture.raw_trips_batches(spark, sf_dir)
    stray = full_raw.filter(F.col("trip_month") == 2).filter(F.col("VendorID") == 2).withColumn("trip_month", F.lit(1))
    v1 = write_month_files(spark, sf_dir, work + "/inbound_v1", raw=first.unionByName(stray))[(2025, 1)]
    v2 = write_month_files(spark, sf_dir, work + "/inbound")[(2025, 1)]
    pipeline.ingest_zones(spark, layout, write_zones(spark, work + "/zones_csv"))
    touched = pipeline.ingest_month(spark, layout, v1, 2025, 1, source_file_size_mb=0)
    pipeline.build(spark, layout, months=touched, quality_gate="skip")
    pipeline.ingest_month(spark, layout, v2, 2025, 1, source_file_size_mb=0)  # and the run dies here
    touched = pipeline.ingest_month(spark, layout, v2, 2025, 1, source_file_size_mb=0)
    pipeline.build(spark, layout, months=touched, quality_gate="skip")
    return layout


def _rerun_table(name):
    def run(spark, sf_dir):
        layout = _rerun_after_failure(spark, sf_dir)
        return present(spark.read.parquet(layout.fact if name is None else layout.mart(name)))
    return run


def _reference_runs(spark, sf_dir, name):
    """Reference mode over files: January as first delivered, then February and
    the complete January."""
    work = _workdir(spark, name)
    layout = pipeline.Layout(work + "/lake", "TEST")
    full = write_month_files(spark, sf_dir, work + "/inbound")
    first, _ = fixture.raw_trips_batches(spark, sf_dir)
    v1 = write_month_files(spark, sf_dir, work + "/inbound_v1", raw=first)
    pipeline.ingest_zones(spark, layout, write_zones(spark, work + "/zones_csv"))
    pipeline.ingest_month(spark, layout, v1[(2025, 1)], 2025, 1, source_file_size_mb=0)
    pipeline.build(spark, layout, mode=inc.REFERENCE, quality_gate="skip")
    for m in (2, 1):
        pipeline.ingest_month(spark, layout, full[(2025, m)], 2025, m, source_file_size_mb=0)
    pipeline.build(spark, layout, mode=inc.REFERENCE, quality_gate="skip")
    return layout


def q_path_reference_fact(spark, sf_dir):
    return present(spark.read.parquet(_reference_runs(spark, sf_dir, "ref-fact").fact).select(*schemas.FACT_COLUMNS))


def q_path_reference_daily(spark, sf_dir):
    return present(spark.read.parquet(_reference_runs(spark, sf_dir, "ref-daily").mart("agg_daily_zone_summary")))


def q_full_refresh_on_existing(spark, sf_dir):
    """A full refresh of tables that lost the late rows brings them back."""
    layout = _reference_runs(spark, sf_dir, "refresh")
    pipeline.build(spark, layout, full_refresh=True, quality_gate="skip")
    return present(spark.read.parquet(layout.fact).select(*schemas.FACT_COLUMNS))


def _built_layout(spark, sf_dir, name):
    work = _workdir(spark, name)
    layout = pipeline.Layout(work + "/lake", "TEST")
    full = write_month_files(spark, sf_dir, work + "/inbound")
    pipeline.ingest_zones(spark, layout, write_zones(spark, work + "/zones_csv"))
    for (y, m), path in sorted(full.items()):
        pipeline.ingest_month(spark, layout, path, y, m, source_file_size_mb=0)
    pipeline.build(spark, layout, quality_gate="skip")
    return layout


def q_export_month_slice(spark, sf_dir):
    layout = _built_layout(spark, sf_dir, "export")
    path = pipeline.export_month_slice(spark, layout, 2025, 1)
    return present(spark.read.parquet(path))


def q_export_csv_roundtrip(spark, sf_dir):
    layout = _built_layout(spark, sf_dir, "export-csv")
    pipeline.export_month_slice(spark, layout, 2025, 1)
    path = pipeline.export_csv(spark, layout, 2025, 1)
    schema = spark.read.parquet(layout.mart("agg_monthly_zone_summary")).schema
    return present(spark.read.schema(schema).option("header", True).csv(path))


def spark_queries() -> dict:
    return {
        "scan_trips_month": q_scan_trips_month,
        "ingest_normalise": q_ingest_normalise,
        "replace_partition": q_replace_partition,
        "full_refresh_equals_incremental": q_full_refresh_equals_incremental,
        "export_month_slice": q_export_month_slice,
        "export_csv_roundtrip": q_export_csv_roundtrip,
        "safe_path_monthly": q_safe_path_monthly,
        "safe_rerun_after_failure": _rerun_table(None),
        **{f"safe_rerun_{n}": _rerun_table(n) for n in marts.MARTS},
        "path_reference_fact": q_path_reference_fact,
        "path_reference_daily": q_path_reference_daily,
        "full_refresh_on_existing": q_full_refresh_on_existing,
    }


# --------------------------------------------------------------------------
# Oracles

def _raw_month(month_cond: str, extra: str = "") -> str:
    return (f"SELECT {', '.join(schemas.RAW_TRIP_COLUMNS)}{extra} FROM ({fixture.raw_trips_sql(keep_order_key=True)}) "
            f"WHERE {month_cond}")


def _january_ctes() -> list[tuple[str, str]]:
    """One load of the complete January file alone."""
    raw = f"  SELECT * EXCLUDE (trip_year, trip_month) FROM ({fixture.raw_trips_sql()}) WHERE trip_month = 1"
    return O.staging_ctes(raw) + O.lookup_ctes() + O.fact_ctes()


def oracle_queries() -> dict:
    from tripmart.plans import registry

    monthly_jan = O.with_sql(O.base_ctes() + [("m", O.mart_sql("agg_monthly_zone_summary"))],
                             "SELECT * FROM m WHERE pickup_year = 2025 AND pickup_month = 1")
    return {
        "scan_trips_month": _raw_month("trip_year = 2025 AND trip_month = 1"),
        "ingest_normalise": _raw_month("trip_year = 2025 AND trip_month = 1",
                                       ", CAST(1 AS INTEGER) AS trip_month, CAST(2025 AS INTEGER) AS trip_year, "
                                       f"'{trips.trip_file_name(2025, 1)}' AS source_file"),
        "replace_partition": _raw_month("true", ", trip_year, trip_month"),
        "full_refresh_equals_incremental": O.with_sql(O.base_ctes(), O.mart_sql("agg_daily_zone_summary")),
        "export_month_slice": monthly_jan,
        "export_csv_roundtrip": monthly_jan,
        "safe_path_monthly": O.with_sql(O.base_ctes(), O.mart_sql("agg_monthly_zone_summary")),
        "safe_rerun_after_failure": O.with_sql(_january_ctes(), f"SELECT {O.fact_select(schemas.FACT_COLUMNS)} FROM fact"),
        **{f"safe_rerun_{n}": O.with_sql(_january_ctes(), O.mart_sql(n)) for n in marts.MARTS},
        "path_reference_fact": registry.oracle_incr_fact(),
        "path_reference_daily": registry.oracle_incr_mart("agg_daily_zone_summary"),
        "full_refresh_on_existing": O.with_sql(O.base_ctes(), f"SELECT {O.fact_select(schemas.FACT_COLUMNS)} FROM fact"),
    }
