"""End-to-end runs over files: ingest, build (both modes), export, layout rules."""

import os

import pytest
from pyspark.sql import functions as F

from tripmart.operators import marts
from tripmart.plans import pipeline, sinks
from tripmart.plans.roundtrips import write_month_files, write_zones
from tripmart.sources import fixture
from tripmart.incremental import loading as inc
from conftest import SF_SMALL


def test_namespace_rule():
    assert pipeline.namespace("DEV") == "DEV_CURATED"
    assert pipeline.namespace("DEV", "mrt") == "DEV_MRT"
    assert pipeline.export_name(2025, 1) == "AGG_MONTHLY_ZONE_SUMMARY_2025_01"


def test_reset_refuses_outside_root(spark, tmp_path):
    with pytest.raises(sinks.UnsafeReset):
        sinks.reset_table(spark, "/somewhere/else", str(tmp_path))


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("files"))
    full = write_month_files(spark, SF_SMALL, base + "/inbound")
    first, _ = fixture.raw_trips_batches(spark, SF_SMALL)
    v1 = write_month_files(spark, SF_SMALL, base + "/inbound_v1", raw=first)
    zones = write_zones(spark, base + "/zones")
    return full, v1, zones


def test_run_month_safe_equals_full_load(spark, tmp_path, files):
    full, v1, zones = files
    layout = pipeline.Layout(str(tmp_path / "lake"), "T")
    pipeline.run_month(spark, layout, v1[(2025, 1)], 2025, 1, zones_csv=zones, quality_gate="report")
    pipeline.run_month(spark, layout, full[(2025, 2)], 2025, 2, quality_gate="report")
    report, paths = pipeline.run_month(spark, layout, full[(2025, 1)], 2025, 1, quality_gate="report")
    # the fixture has zone ids outside the lookup: the location relationship check fails
    failed = {(r["model"], r["column_name"], r["test"]) for r in report if r["status"] == "fail"}
    assert ("fact_yellow_taxi_trips", "pickup_location_id", "relationships") in failed

    one = pipeline.Layout(str(tmp_path / "one"), "T")
    pipeline.ingest_zones(spark, one, zones)
    for (y, m), p in sorted(full.items()):
        pipeline.ingest_month(spark, one, p, y, m, source_file_size_mb=0)
    pipeline.build(spark, one, quality_gate="skip")
    for name in ["fact_yellow_taxi_trips", *marts.MARTS]:
        a = spark.read.parquet(layout.fact if name.startswith("fact") else layout.mart(name))
        b = spark.read.parquet(one.fact if name.startswith("fact") else one.mart(name))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    assert [os.path.basename(p) for p in paths] == ["AGG_MONTHLY_ZONE_SUMMARY_2025_01.parquet",
                                                    "AGG_MONTHLY_ZONE_SUMMARY_2025_01.csv"]
    assert all(os.path.isfile(p) for p in paths)


def test_reference_mode_loses_late_rows(spark, tmp_path, files):
    full, v1, zones = files
    layout = pipeline.Layout(str(tmp_path / "lake"), "R")
    pipeline.ingest_zones(spark, layout, zones)
    pipeline.ingest_month(spark, layout, v1[(2025, 1)], 2025, 1, source_file_size_mb=0)
    pipeline.build(spark, layout, mode=inc.REFERENCE, quality_gate="skip")
    first = spark.read.parquet(layout.fact)
    n1 = first.count()
    mark = first.agg(F.max("pickup_datetime")).first()[0]
    pipeline.ingest_month(spark, layout, full[(2025, 2)], 2025, 2, source_file_size_mb=0)
    pipeline.ingest_month(spark, layout, full[(2025, 1)], 2025, 1, source_file_size_mb=0)
    pipeline.build(spark, layout, mode=inc.REFERENCE, quality_gate="skip")
    fact = spark.read.parquet(layout.fact)
    # rows at or below the first run's mark never load: late January rows are lost
    assert fact.filter(F.col("pickup_datetime") <= F.lit(mark)).count() == n1
    jan_full = spark.read.parquet(one_month_fact(spark, full, zones, tmp_path)).filter("pickup_month = 1").count()
    assert fact.filter(F.col("pickup_month") == 1).count() < jan_full
    assert fact.filter(F.col("pickup_month") == 2).count() > 0


def one_month_fact(spark, full, zones, tmp_path):
    layout = pipeline.Layout(str(tmp_path / "all"), "A")
    pipeline.ingest_zones(spark, layout, zones)
    for (y, m), p in sorted(full.items()):
        pipeline.ingest_month(spark, layout, p, y, m, source_file_size_mb=0)
    pipeline.build(spark, layout, quality_gate="skip")
    return layout.fact


def test_partition_replace_keeps_other_months(spark, tmp_path, files):
    full, v1, _ = files
    layout = pipeline.Layout(str(tmp_path / "lake"), "P")
    pipeline.ingest_month(spark, layout, full[(2025, 1)], 2025, 1, source_file_size_mb=0)
    pipeline.ingest_month(spark, layout, full[(2025, 2)], 2025, 2, source_file_size_mb=0)
    feb = spark.read.parquet(layout.raw_trips).filter("trip_month = 2").count()
    touched = pipeline.ingest_month(spark, layout, v1[(2025, 1)], 2025, 1, source_file_size_mb=0)
    raw = spark.read.parquet(layout.raw_trips)
    assert raw.filter("trip_month = 2").count() == feb
    assert raw.filter("trip_month = 1").count() == spark.read.parquet(v1[(2025, 1)]).count()
    assert touched == {(2025, 1)}
    assert {"source_execution_id", "source_file", "source_file_size"} <= set(raw.columns)


def test_empty_month_clears_partition(spark, tmp_path, files):
    full, _, _ = files
    layout = pipeline.Layout(str(tmp_path / "lake"), "E")
    pipeline.ingest_month(spark, layout, full[(2025, 1)], 2025, 1, source_file_size_mb=0)
    empty = spark.read.parquet(full[(2025, 1)]).limit(0)
    sinks.replace_partition(spark, empty, layout.raw_trips, {"trip_year": 2025, "trip_month": 1})
    assert not os.path.exists(layout.raw_trips + "/trip_year=2025/trip_month=1")


def test_build_quarantines_bad_casts(spark, tmp_path, files):
    from helpers import raw_df, trip

    full, _, zones = files
    layout = pipeline.Layout(str(tmp_path / "lake"), "Q")
    pipeline.ingest_zones(spark, layout, zones)
    bad = raw_df(spark, [trip(fare_amount=1e9), trip()])
    sinks.replace_partition(spark, bad, layout.raw_trips, {"trip_year": 2025, "trip_month": 1})
    pipeline.build(spark, layout, quality_gate="skip", cast_mode="try")
    assert spark.read.parquet(layout.quarantine).count() == 1
    assert spark.read.parquet(layout.fact).count() == 1


@pytest.mark.parametrize("order", [[2, 1], [1, 1, 2, 2]])
def test_safe_runs_in_any_order_equal_full_load(spark, tmp_path, files, order):
    full, _, zones = files
    layout = pipeline.Layout(str(tmp_path / "lake"), "O")
    pipeline.ingest_zones(spark, layout, zones)
    for m in order:
        touched = pipeline.ingest_month(spark, layout, full[(2025, m)], 2025, m, source_file_size_mb=0)
        pipeline.build(spark, layout, months=touched, quality_gate="skip")
    ref = pipeline.Layout(str(tmp_path / "ref"), "O")
    pipeline.ingest_zones(spark, ref, zones)
    for (y, m), p in sorted(full.items()):
        pipeline.ingest_month(spark, ref, p, y, m, source_file_size_mb=0)
    pipeline.build(spark, ref, quality_gate="skip")
    for name in marts.MARTS:
        a, b = spark.read.parquet(layout.mart(name)), spark.read.parquet(ref.mart(name))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_cli_run_month(spark, tmp_path, files, capsys):
    import json

    from tripmart.__main__ import main

    full, _, zones = files
    root = str(tmp_path / "lake")
    assert main(["run-month", "--root", root, "--env", "CLI", "--file", full[(2025, 1)], "--year", "2025",
                 "--month", "1", "--zones", zones, "--quality", "report"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["checks"] == 64 and len(out["exported"]) == 2
    assert os.path.isfile(os.path.join(root, "CLI_EXPORT", "AGG_MONTHLY_ZONE_SUMMARY_2025_01.parquet"))


def test_month_files_are_written_without_a_shuffle(spark, tmp_path):
    """Each task of the input writes its own rows: one partition, one file a month."""
    rows = [(y, m, i) for i in range(40) for y, m in ((2024, 12), (2025, 1), (2025, 2))]
    raw = spark.createDataFrame(rows + rows[:5], "trip_year int, trip_month int, n long").coalesce(1)
    files = write_month_files(spark, "", str(tmp_path / "inbound"), raw=raw)
    assert sorted(files) == [(2024, 12), (2025, 1), (2025, 2)]
    for (y, m), path in files.items():
        assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 1
        got = sorted(r["n"] for r in spark.read.parquet(path).collect())
        assert got == sorted(n for yy, mm, n in rows + rows[:5] if (yy, mm) == (y, m))
