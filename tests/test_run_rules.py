"""Ratios without a ceiling, moves that survive a kill, pending records, changed
months, gates before publication, type drift."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import BASE, raw_df, trip
from tripmart import schemas
from tripmart.functions import exact
from tripmart.incremental import loading as inc
from tripmart.operators import facts, marts, quality, staging
from tripmart.plans import fs, moves, pipeline, sinks
from tripmart.plans.roundtrips import write_zones
from tripmart.sources import drift, fixture

FEB = BASE.replace(month=2)


# --- exact averages ------------------------------------------------------------------

def averaged(spark, values, partitions):
    df = spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "x double").repartition(partitions)
    bins = (df.groupBy(exact.bin_of(F.col("x")).alias("bin")).agg(F.sum(exact.part_of(F.col("x"))).alias("part"), F.count("x").alias("n"))
            .filter("n > 0").agg(F.collect_list(F.struct("bin", "part", "n")).alias("b")))
    return bins.select(exact.rounded_average(F.col("b")).alias("a")).first()[0]


@pytest.mark.parametrize("values", [
    [0.01, 0.02, 1234.56], [1e300, 1e-2, 5e29], [1.7976931348623157e308, 1.0], [3.0, None], [1e15, 1e15 - 1, 123456789012345.67],
    [2.5e26, 1e26, 99999999.99], [1e22, 1e-1], [-1e30, 1e20], [round(50.0 / 1e-30, 2), 12.34, 5e-324]])
def test_average_against_fractions(spark, values):
    from fractions import Fraction

    known = [Fraction(repr(v)) for v in values if v is not None]
    if max(abs(v) for v in values if v is not None) < 1e15:
        known = [Fraction(round(v * 100), 100) for v in known]
    want = sum(known) / len(known)
    for parts in (1, 3):
        got = averaged(spark, values, parts)
        assert got == pytest.approx(float(want), rel=1e-15, abs=0.005)


def test_average_of_none_infinite_and_any_order(spark):
    assert averaged(spark, [None], 1) is None
    assert averaged(spark, [1.0, float("inf")], 2) == float("inf")
    assert math.isnan(averaged(spark, [float("-inf"), float("inf")], 2)) and math.isnan(averaged(spark, [float("nan"), 2.0], 2))
    r = random.Random(4)
    values = [round(r.random() * 10.0 ** r.randint(-2, 200), 2) for _ in range(400)]
    assert len({averaged(spark, r.sample(values, len(values)), p) for p in (1, 2, 5, 9)}) == 1


def test_no_ratio_is_left_out_of_the_vendor_mart(spark, lookups):
    """The rule is round(avg(fare per mile), 2) over all trips with a distance."""
    raw = raw_df(spark, [trip(trip_distance=1e-30, fare_amount=50.0), trip(trip_distance=2.0, fare_amount=10.0), trip(trip_distance=0.0, fare_amount=7.0)])
    fact = facts.fact_trips(staging.stg_trips(raw), lookups)
    plain = fact.agg(F.round(F.avg("fare_per_mile"), 2)).first()[0]
    for mart in (marts.build_mart("agg_vendor_performance", fact), marts.roll_up("agg_vendor_performance", marts.partials(fact, marts.STATE_KEYS))):
        row = mart.first()
        assert row["avg_fare_per_mile"] == pytest.approx(plain, rel=1e-15) and row["avg_fare_per_mile"] > 1e31 and row["trip_count"] == 3
    tiny = facts.fact_trips(staging.stg_trips(raw_df(spark, [trip(trip_distance=5e-324, fare_amount=50.0)])), lookups)
    assert marts.build_mart("agg_vendor_performance", tiny).first()["avg_fare_per_mile"] == float("inf")


def test_states_merge(spark, lookups):
    fact = facts.fact_trips(staging.stg_trips(fixture.raw_trips_fixture(spark, "/root/testdata/sf0.001")), lookups)
    halves = [marts.partials(fact.filter(c), marts.STATE_KEYS) for c in ("pickup_hour < 9", "pickup_hour >= 9")]
    both = halves[0].unionByName(halves[1])
    for name in marts.MARTS:
        a, b = marts.build_mart(name, fact), marts.roll_up(name, both)
        assert a.dtypes == b.dtypes and a.exceptAll(b).count() == b.exceptAll(a).count() == 0


# --- moves ----------------------------------------------------------------------------

ROWS = "k string, v int, pickup_year int, pickup_month int"
OLD = [("a", 1, 2025, 1), ("b", 2, 2025, 2), ("c", 3, 2025, 3)]
NEW = [("a", 9, 2025, 1), ("d", 4, 2025, 2), ("e", 5, 2025, 4)]
MERGED = {("a", 9, 1), ("b", 2, 2), ("d", 4, 2), ("c", 3, 3), ("e", 5, 4)}


def read(spark, path):
    df = spark.read.parquet(path)
    assert dict(df.dtypes)["pickup_month"] == "int"
    return sorted((r["k"], r["v"], r["pickup_month"]) for r in df.collect())


@pytest.mark.parametrize("dies_at", range(1, 10))
def test_a_merge_killed_at_any_move_is_finished(spark, tmp_path, monkeypatch, dies_at):
    path = str(tmp_path / "t")
    rows = lambda r: spark.createDataFrame(r, ROWS)
    inc.merge_into_table(spark, path, rows(OLD), ["k"])
    real, done = fs.rename, [0]

    def dying(spark_, src, dst):
        real(spark_, src, dst)
        done[0] += 1
        if done[0] == dies_at:
            raise KeyboardInterrupt  # a kill: nothing is undone

    monkeypatch.setattr(fs, "rename", dying)
    killed = False
    try:
        inc.merge_into_table(spark, path, rows(NEW), ["k"])
    except KeyboardInterrupt:
        killed = True
    monkeypatch.undo()
    if killed:
        read(spark, path)  # whatever is there is a table of whole rows
        inc.merge_into_table(spark, path, rows(NEW), ["k"])
    assert set(read(spark, path)) == MERGED and len(read(spark, path)) == len(MERGED)
    assert not fs.list_files(spark, str(tmp_path / "_moves" / "t"))
    assert killed or done[0] < dies_at


def test_a_refused_move_undoes_the_ones_before(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    inc.merge_into_table(spark, path, spark.createDataFrame(OLD, ROWS), ["k"])
    before, real = read(spark, path), fs.rename

    def refuse(spark_, src, dst):
        if dst.endswith("pickup_month=4") and ".new-" in src:
            raise OSError("refused")
        real(spark_, src, dst)

    monkeypatch.setattr(fs, "rename", refuse)
    with pytest.raises(OSError):
        inc.merge_into_table(spark, path, spark.createDataFrame(NEW, ROWS), ["k"])
    monkeypatch.undo()
    assert read(spark, path) == before and moves.recover(spark, path) == 0


def test_whole_tables_and_cleared_partitions(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = lambda r: spark.createDataFrame(r, ROWS)
    sinks.overwrite_table(rows(OLD), path, ["pickup_year", "pickup_month"])
    inc.replace_months_in_table(spark, path, rows(OLD[:1]), [(2025, 1), (2025, 2)])
    assert read(spark, path) == [("a", 1, 1), ("c", 3, 3)]
    staged = sinks.stage_table(rows(NEW), path, ["pickup_year", "pickup_month"])
    assert read(spark, path) == [("a", 1, 1), ("c", 3, 3)]
    real = fs.rename
    monkeypatch.setattr(fs, "rename", lambda s, a, b: (real(s, a, b), (_ for _ in ()).throw(KeyboardInterrupt()) if ".old" in b else None))
    with pytest.raises(KeyboardInterrupt):
        staged.publish(spark)  # the old table is set aside, the new one not yet in place
    monkeypatch.undo()
    assert not os.path.exists(path) and sinks.read_table(spark, path).count() == 3
    assert read(spark, path) == [("a", 9, 1), ("d", 4, 2), ("e", 5, 4)]


# --- runs -----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def zones(spark, tmp_path_factory):
    return write_zones(spark, str(tmp_path_factory.mktemp("z") / "zones"))


def _layout(spark, tmp_path, zones):
    layout = pipeline.Layout(str(tmp_path / "lake"), "T")
    pipeline.ingest_zones(spark, layout, zones)
    return layout


def _file(spark, tmp_path, name, rows):
    path = str(tmp_path / name)
    raw_df(spark, rows).write.parquet(path)
    return path


def _trip(month=1, **over):
    start = BASE if month == 1 else FEB
    return trip(tpep_pickup_datetime=start, tpep_dropoff_datetime=start.replace(minute=10), **over)


def _trips_in(spark, layout):
    return {n: spark.read.parquet(layout.mart(n)).agg(F.sum("trip_count")).first()[0] for n in marts.MARTS}


def test_ingest_between_start_and_end_of_a_build_stays_pending(spark, tmp_path, zones, monkeypatch):
    layout = _layout(spark, tmp_path, zones)
    pipeline.ingest_month(spark, layout, _file(spark, tmp_path, "a", [_trip()]), 2025, 1)
    late = _file(spark, tmp_path, "b", [_trip(), _trip(fare_amount=3.0)])
    real = pipeline.write_fact

    def slow(stg, lk, layout_):
        real(stg, lk, layout_)
        pipeline.ingest_month(spark, layout, late, 2025, 1)  # another run, after the fact was read

    monkeypatch.setattr(pipeline, "write_fact", slow)
    pipeline.build(spark, layout, quality_gate="skip")
    monkeypatch.undo()
    assert set(_trips_in(spark, layout).values()) == {1}
    assert pipeline.pending_months(spark, layout) == {(2025, 1)}
    pipeline.build(spark, layout, months=[], quality_gate="skip")
    assert set(_trips_in(spark, layout).values()) == {2} and pipeline.pending_months(spark, layout) == set()


def test_a_build_does_not_clear_an_ingest_that_is_still_writing(spark, tmp_path, zones, monkeypatch):
    layout = _layout(spark, tmp_path, zones)
    pipeline.run_month(spark, layout, _file(spark, tmp_path, "a", [_trip()]), 2025, 1, export=False)
    second = _file(spark, tmp_path, "b", [_trip(), _trip(fare_amount=3.0)])
    real = sinks.replace_partition

    def overtaken(spark_, df, path, *a):
        if path == layout.raw_trips:
            monkeypatch.undo()
            pipeline.build(spark, layout, months=[], quality_gate="skip")  # reads the old rows
        real(spark_, df, path, *a)

    monkeypatch.setattr(sinks, "replace_partition", overtaken)
    pipeline.ingest_month(spark, layout, second, 2025, 1)
    assert pipeline.pending_months(spark, layout) == {(2025, 1)}
    pipeline.build(spark, layout, months=[], quality_gate="skip")
    assert set(_trips_in(spark, layout).values()) == {2} and pipeline.pending_months(spark, layout) == set()


def test_only_changed_months_are_rebuilt(spark, tmp_path, zones):
    layout = _layout(spark, tmp_path, zones)
    rows = [_trip(), _trip(tip_amount=None), _trip(month=2), _trip(month=2)]
    first = _file(spark, tmp_path, "a", rows)
    assert pipeline.ingest_month(spark, layout, first, 2025, 1) == {(2025, 1), (2025, 2)}
    pipeline.build(spark, layout, quality_gate="skip")
    before = {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs_ in os.walk(layout.fact) for f in fs_ if f.endswith(".parquet")}
    again = _file(spark, tmp_path, "b", rows[::-1])
    assert pipeline.ingest_month(spark, layout, again, 2025, 1) == set()
    pipeline.build(spark, layout, months=set(), quality_gate="skip")
    after = {f: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs_ in os.walk(layout.fact) for f in fs_ if f.endswith(".parquet")}
    assert after == before  # no file was written
    assert pipeline.ingest_month(spark, layout, _file(spark, tmp_path, "c", rows + [_trip(month=2)]), 2025, 1) == {(2025, 2)}  # one copy more
    assert pipeline.ingest_month(spark, layout, _file(spark, tmp_path, "d", rows[2:]), 2025, 1) == {(2025, 1), (2025, 2)}
    swapped = [_trip(tip_amount=None, tolls_amount=2.0), _trip(tip_amount=2.0, tolls_amount=None)]
    digest = lambda r: inc.month_digests(raw_df(spark, r)).first()["digest"]
    assert digest(swapped[:1]) != digest(swapped[1:]) and digest(swapped) == digest(swapped[::-1])


def test_a_failing_dimension_is_not_published(spark, tmp_path, zones):
    layout = _layout(spark, tmp_path, zones)
    pipeline.run_month(spark, layout, _file(spark, tmp_path, "a", [_trip()]), 2025, 1, export=False)
    before = sorted(map(str, spark.read.parquet(layout.dim_location).collect()))
    bad = [(i, b, z if i != 4 else None, s) for i, b, z, s in fixture.fixture_zone_rows()]
    pipeline.ingest_zones(spark, layout, fixture.write_zones_csv([["" if v is None else v for v in r] for r in bad], str(tmp_path / "bad.csv")))
    spark.read.parquet(layout.raw_zones)
    with pytest.raises(quality.DataQualityError) as stopped:
        pipeline.build(spark, layout)
    assert sorted(map(str, spark.read.parquet(layout.dim_location).collect())) == before
    decided = {r["model"]: r["decision"] for r in stopped.value.decisions}
    assert decided["fact_yellow_taxi_trips"] == "blocked" and decided["stg_yellow_taxi_trips"] == "passed"


def test_a_zone_name_in_two_boroughs_stops_the_run(spark, tmp_path, zones):
    layout = _layout(spark, tmp_path, zones)
    pipeline.run_month(spark, layout, _file(spark, tmp_path, "a", [_trip(PULocationID=2), _trip(PULocationID=3)]), 2025, 1, export=False)
    before = _trips_in(spark, layout)
    spanning = [(i, b, "Twin" if i in (2, 3) else z, s) for i, b, z, s in fixture.fixture_zone_rows()]
    pipeline.ingest_zones(spark, layout, fixture.write_zones_csv(spanning, str(tmp_path / "twin.csv")))
    more = _file(spark, tmp_path, "b", [_trip(PULocationID=2), _trip(PULocationID=3), _trip(PULocationID=3, fare_amount=4.0)])
    with pytest.raises(quality.DataQualityError) as stopped:
        pipeline.run_month(spark, layout, more, 2025, 1, export=False)
    assert {(r["model"], r["test"]) for r in stopped.value.failed} == {("agg_daily_zone_summary", "grain"), ("agg_monthly_zone_summary", "grain")}
    assert _trips_in(spark, layout) == before and pipeline.pending_months(spark, layout) == {(2025, 1)}
    assert not [f for f in os.listdir(os.path.dirname(layout.mart("x"))) if ".new-" in f]
    mart = marts.build_mart("agg_daily_zone_summary", spark.read.parquet(layout.fact))
    assert quality.failing_rows(mart, quality.GRAIN_CHECKS[0]).count() == 2


# --- type drift -------------------------------------------------------------------------

@pytest.mark.parametrize("a, b, both", [
    (T.IntegerType(), T.LongType(), "bigint"), (T.LongType(), T.DoubleType(), "double"), (T.FloatType(), T.DoubleType(), "double"),
    (T.IntegerType(), T.DecimalType(10, 2), "decimal(12,2)"), (T.DecimalType(10, 2), T.DecimalType(9, 4), "decimal(12,4)"),
    (T.DecimalType(38, 0), T.DecimalType(38, 10), "double"), (T.LongType(), T.TimestampNTZType(), "timestamp_ntz"),
    (T.DateType(), T.TimestampType(), "timestamp_ntz"), (T.StringType(), T.LongType(), "string"), (T.NullType(), T.DateType(), "date"),
    (T.BooleanType(), T.LongType(), "string")])
def test_wider(a, b, both):
    assert drift.wider(a, b).simpleString() == drift.wider(b, a).simpleString() == both


def test_widened_folders(spark, tmp_path):
    for name, sql in (("a", "SELECT 1 AS n, 2L AS t, 'x' AS s"), ("b", "SELECT 2.5D AS N, TIMESTAMP_NTZ'1970-01-01 00:00:05' AS t"),
                      ("c", "SELECT 3L AS n, 4000000L AS t, 7 AS s, true AS extra")):
        spark.sql(sql).write.parquet(str(tmp_path / name))
    paths = [str(tmp_path / n) for n in "abc"]
    out = drift.read_widened(spark, paths)
    assert out.dtypes == [("n", "double"), ("t", "timestamp_ntz"), ("s", "string"), ("extra", "boolean")]
    assert sorted((r["n"], r["t"].second, r["s"], r["extra"]) for r in out.collect()) == [(1.0, 0, "x", None), (2.5, 5, None, None), (3.0, 4, "7", True)]
    assert drift.conflicts([spark.read.parquet(p).schema for p in paths]) == {
        "n": ["int", "double", "bigint"], "t": ["bigint", "timestamp_ntz"], "s": ["string", "int"]}
    plan = drift.read_widened(spark, paths[:1]).filter("n > 5").select("n")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(n), GreaterThan(n,5)]" in plan and "ReadSchema: struct<n:int>" in plan


def test_months_with_unlike_types_build(spark, tmp_path, zones):
    layout = _layout(spark, tmp_path, zones)
    a = raw_df(spark, [_trip()]).withColumn("trip_distance", F.col("trip_distance").cast("int")).withColumn("passenger_count", F.lit(1.0))
    a.write.parquet(str(tmp_path / "a"))
    raw_df(spark, [_trip(month=2)]).withColumn("cbd_fee", F.lit(1)).write.parquet(str(tmp_path / "b"))
    pipeline.ingest_month(spark, layout, str(tmp_path / "a"), 2025, 1)
    pipeline.ingest_month(spark, layout, str(tmp_path / "b"), 2025, 2)
    pipeline.build(spark, layout, one_pass_marts=True)
    assert set(_trips_in(spark, layout).values()) == {2}
    assert {"cbd_fee", *schemas.RAW_TRIP_COLUMNS} <= set(pipeline.raw_trips_table(spark, layout).columns)
    both = _layout(spark, tmp_path / "both", zones)  # two files of one month with unlike types
    pipeline.ingest_month(spark, both, [str(tmp_path / "a"), str(tmp_path / "b")], 2025, 1)
    assert pipeline.raw_trips_table(spark, both).count() == 2
