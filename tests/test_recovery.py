"""Runs that die, writes that fail, resets, gates and single steps."""

import json
import os

import pytest
from pyspark.sql import functions as F

from helpers import BASE, raw_df, trip
from tripmart.incremental import loading as inc
from tripmart.operators import marts, quality
from tripmart.plans import fs, pipeline, sinks
from tripmart.plans.roundtrips import write_zones

FEB = BASE.replace(month=2)


@pytest.fixture(scope="module")
def zones(spark, tmp_path_factory):
    return write_zones(spark, str(tmp_path_factory.mktemp("z") / "zones"))


def _file(spark, tmp_path, name, rows):
    path = str(tmp_path / name)
    raw_df(spark, rows).write.parquet(path)
    return path


def _layout(spark, tmp_path, zones):
    layout = pipeline.Layout(str(tmp_path / "lake"), "T")
    pipeline.ingest_zones(spark, layout, zones)
    return layout


def _trip(month=1, fare=10.0, **over):
    start = BASE if month == 1 else FEB
    return trip(tpep_pickup_datetime=start, tpep_dropoff_datetime=start.replace(minute=10), fare_amount=fare, **over)


def _counts(spark, layout):
    return {"fact": spark.read.parquet(layout.fact).count(),
            **{n: spark.read.parquet(layout.mart(n)).agg(F.sum("trip_count")).first()[0] for n in marts.MARTS}}


def test_rerun_of_a_dead_run_drops_stale_months(spark, tmp_path, zones):
    layout = _layout(spark, tmp_path, zones)
    v1 = _file(spark, tmp_path, "v1", [_trip(), _trip(month=2)])
    v2 = _file(spark, tmp_path, "v2", [_trip()])
    pipeline.build(spark, layout, months=pipeline.ingest_month(spark, layout, v1, 2025, 1), quality_gate="skip")
    pipeline.ingest_month(spark, layout, v2, 2025, 1)  # dies before the build
    pipeline.build(spark, layout, months=pipeline.ingest_month(spark, layout, v2, 2025, 1), quality_gate="skip")
    assert set(_counts(spark, layout).values()) == {1}
    assert pipeline.pending_months(spark, layout) == set()


def test_crash_between_raw_swap_and_index(spark, tmp_path, zones, monkeypatch):
    """The index written before the swap still names every month of the partition."""
    layout = _layout(spark, tmp_path, zones)
    v1 = _file(spark, tmp_path, "v1", [_trip()])
    v2 = _file(spark, tmp_path, "v2", [_trip(), _trip(month=2, fare=7.0)])
    feb = _file(spark, tmp_path, "feb", [_trip(month=2)])
    pipeline.build(spark, layout, months=pipeline.ingest_month(spark, layout, v1, 2025, 1), quality_gate="skip")
    real = sinks.replace_partition

    def dying(spark_, df, path, *a, **k):
        out = real(spark_, df, path, *a, **k)
        if path == layout.raw_trips:
            raise KeyboardInterrupt
        return out

    monkeypatch.setattr(sinks, "replace_partition", dying)
    with pytest.raises(KeyboardInterrupt):
        pipeline.ingest_month(spark, layout, v2, 2025, 1)
    monkeypatch.undo()
    pipeline.build(spark, layout, months=pipeline.ingest_month(spark, layout, feb, 2025, 2), quality_gate="skip")
    assert set(_counts(spark, layout).values()) == {3}


def test_default_build_and_empty_month(spark, tmp_path, zones):
    layout = _layout(spark, tmp_path, zones)
    pipeline.ingest_month(spark, layout, _file(spark, tmp_path, "a", [_trip()]), 2025, 1)
    pipeline.build(spark, layout)
    pipeline.ingest_month(spark, layout, _file(spark, tmp_path, "b", [_trip(month=2), _trip(month=2, fare=3.0)]), 2025, 2)
    report = pipeline.build(spark, layout)  # months: all that raw holds
    assert set(_counts(spark, layout).values()) == {3} and len(report) == 64
    report, _ = pipeline.run_month(spark, layout, _file(spark, tmp_path, "c", []), 2025, 3, export=False)
    assert set(_counts(spark, layout).values()) == {3} and len(report) == 64
    pipeline.run_month(spark, layout, _file(spark, tmp_path, "d", []), 2025, 2, export=False)
    assert set(_counts(spark, layout).values()) == {1}


def test_one_month_opens_only_its_raw_files(spark, tmp_path, zones):
    layout = _layout(spark, tmp_path, zones)
    pipeline.ingest_month(spark, layout, _file(spark, tmp_path, "a", [_trip()]), 2025, 1)
    pipeline.ingest_month(spark, layout, _file(spark, tmp_path, "b", [_trip(month=2)]), 2025, 2)
    raw = pipeline.raw_trips_table(spark, layout, pipeline.raw_partitions_for(spark, layout, [(2025, 2)]))
    assert raw.count() == 1 and all("trip_month=2" in f for f in raw.inputFiles()) and "trip_month" in raw.columns


def test_failed_fact_check_leaves_marts(spark, tmp_path, zones):
    layout = _layout(spark, tmp_path, zones)
    good = _file(spark, tmp_path, "good", [_trip()])
    bad = _file(spark, tmp_path, "bad", [_trip(), _trip(fare=4.0, RatecodeID=77)])  # no such rate code: error
    warn = _file(spark, tmp_path, "warn", [_trip(), _trip(fare=4.0, VendorID=77)])  # no such vendor: warn
    pipeline.run_month(spark, layout, good, 2025, 1, export=False)
    with pytest.raises(quality.DataQualityError):
        pipeline.run_month(spark, layout, bad, 2025, 1, export=False)
    counts = _counts(spark, layout)
    assert counts.pop("fact") == 2 and set(counts.values()) == {1}
    assert pipeline.pending_months(spark, layout) == {(2025, 1)}
    report, _ = pipeline.run_month(spark, layout, warn, 2025, 1, export=False)
    assert set(_counts(spark, layout).values()) == {2}
    assert [r["status"] for r in report if r["column_name"] == "vendor_id" and r["test"] == "relationships"] == ["warn"]


def test_failed_staging_check_leaves_fact(spark, tmp_path, zones):
    layout = _layout(spark, tmp_path, zones)
    pipeline.run_month(spark, layout, _file(spark, tmp_path, "good", [_trip()]), 2025, 1, export=False)
    with pytest.raises(quality.DataQualityError):
        pipeline.run_month(spark, layout, _file(spark, tmp_path, "bad", [_trip(), _trip(PULocationID=None)]), 2025, 1, export=False)
    assert set(_counts(spark, layout).values()) == {1}


def test_failing_full_refresh_keeps_the_old_tables(spark, tmp_path, zones):
    layout = _layout(spark, tmp_path, zones)
    pipeline.run_month(spark, layout, _file(spark, tmp_path, "good", [_trip()]), 2025, 1, export=False)
    bad = raw_df(spark, [_trip(fare=1e9)])  # does not fit its decimal
    sinks.replace_partition(spark, bad, layout.raw_trips, {"trip_year": 2025, "trip_month": 2})
    with pytest.raises(Exception):
        pipeline.build(spark, layout, full_refresh=True, quality_gate="skip")
    assert set(_counts(spark, layout).values()) == {1}


def test_refused_rename_keeps_the_old_export(spark, tmp_path, zones, monkeypatch):
    layout = _layout(spark, tmp_path, zones)
    _, paths = pipeline.run_month(spark, layout, _file(spark, tmp_path, "a", [_trip()]), 2025, 1)
    before = spark.read.parquet(paths[0]).collect()
    real = fs.rename

    def refuse(spark_, src, dst):
        if ".tmp-" in src:
            raise OSError("refused")
        real(spark_, src, dst)

    monkeypatch.setattr(fs, "rename", refuse)
    with pytest.raises(OSError):
        pipeline.export_month_slice(spark, layout, 2025, 1)
    assert spark.read.parquet(paths[0]).collect() == before


def test_impossible_rename_raises(spark, tmp_path):
    with pytest.raises(Exception):
        fs.rename(spark, str(tmp_path / "not there"), str(tmp_path / "x"))


def test_reset_covers_what_belongs_to_raw(spark, tmp_path, zones):
    layout = _layout(spark, tmp_path, zones)
    pipeline.run_month(spark, layout, _file(spark, tmp_path, "a", [_trip(), _trip(month=2)]), 2025, 1, export=False)
    pipeline.reset_raw(spark, layout)
    assert not any(os.path.exists(p) for p in (layout.raw_trips, layout.raw_month_index, layout.quarantine))
    report, _ = pipeline.run_month(spark, layout, _file(spark, tmp_path, "b", [_trip()]), 2025, 1, export=False, reset=True)
    assert set(_counts(spark, layout).values()) == {1} and len(report) == 64


def test_reset_resolves_dots(spark, tmp_path):
    (tmp_path / "x").mkdir()
    with pytest.raises(sinks.UnsafeReset):
        sinks.reset_table(spark, f"{tmp_path}/lake/../x", f"{tmp_path}/lake")
    assert (tmp_path / "x").exists()


def test_staging_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from tripmart import session

    class Conf:
        def get(self, _):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Session())


def test_bad_vendor_is_set_aside_at_ingest(spark, tmp_path, zones):
    layout = _layout(spark, tmp_path, zones)
    rows = raw_df(spark, [_trip(), _trip(fare=2.0)]).withColumn(
        "VendorID", F.when(F.col("fare_amount") == 2.0, "two").otherwise("2"))
    path = str(tmp_path / "odd")
    rows.write.parquet(path)
    with pytest.raises(Exception):
        pipeline.ingest_month(spark, layout, path, 2025, 1)
    pipeline.run_month(spark, layout, path, 2025, 1, cast_mode="try", export=False)
    assert set(_counts(spark, layout).values()) == {1}
    rejected = spark.read.parquet(layout.rejected_at_ingest).collect()
    assert [r["rejected_columns"] for r in rejected] == [["VendorID"]] and '"two"' in rejected[0]["row"]


def test_merge_into_empty_target_and_null_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda *r: spark.createDataFrame(list(r), "k string, v int, pickup_year int, pickup_month int")
    inc.merge_into_table(spark, path, rows(("a", 1, 2025, 1), (None, 2, 2025, 1), ("b", 3, 2025, 2)), ["k"])
    inc.merge_into_table(spark, path, rows(("a", 9, 2025, 1), (None, 8, 2025, 1)), ["k"])
    got = sorted((r["k"] or "", r["v"]) for r in spark.read.parquet(path).collect())
    assert got == [("", 2), ("", 8), ("a", 9), ("b", 3)]  # NULL never matches
    inc.merge_into_table(spark, path, rows((None, 7, 2025, 1)), ["k"], null_safe=True)
    got = sorted((r["k"] or "", r["v"]) for r in spark.read.parquet(path).collect())
    assert got == [("", 7), ("a", 9), ("b", 3)]
    assert not [p for p in os.listdir(tmp_path) if "merge-" in p or ".old-" in p]


def test_cli_steps(spark, tmp_path, zones, capsys):
    from tripmart.__main__ import main

    at = ["--root", str(tmp_path / "lake"), "--env", "CLI"]

    def run(*args):
        assert main([*args, *at]) == 0
        return json.loads(capsys.readouterr().out.strip().splitlines()[-1])

    path = _file(spark, tmp_path, "a", [_trip(), _trip(fare=5.0)])
    assert run("ingest", "--file", path, "--year", "2025", "--month", "1", "--zones", zones, "--casts", "try")["months"] == ["2025-01"]
    assert run("build", "--quality", "report", "--duplicates", "first")["checks"] == 64
    assert run("build", "--select", "agg_vendor_performance")["built"] == ["agg_vendor_performance"]
    assert run("test", "--quality", "report")["checks"] == 64
    assert len(run("export", "--year", "2025", "--month", "1")["exported"]) == 2
