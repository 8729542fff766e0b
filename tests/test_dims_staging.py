"""Zone dimension, staging dedup and surrogate keys."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import raw_df, trip
from tripmart import schemas
from tripmart.operators import dims, staging
from tripmart.sources import fixture, lookups as L


def _dim_for(spark, rows):
    return dims.dim_location(staging.stg_zones(spark.createDataFrame(rows, schema=schemas.RAW_ZONES)))


@pytest.mark.parametrize("zone,region", [("Upper East Side North", "Upper Manhattan"),
                                         ("Central Harlem", "Northern Manhattan"),
                                         ("Central Park", "Upper Manhattan"),
                                         ("Hamilton Heights", "Northern Manhattan"),
                                         ("Lower East Side", "Other Manhattan"),
                                         ("Times Sq/Theatre District", "Midtown"),
                                         ("Battery Park City", "Lower Manhattan")])
def test_manhattan_subregions(spark, zone, region):
    r = _dim_for(spark, [(1, "Manhattan", zone, "Yellow Zone")]).first()
    assert r["manhattan_subregion"] == region and r["borough_group"] == "Manhattan"


def test_subregion_null_outside_manhattan(spark):
    r = _dim_for(spark, [(2, "Queens", "Central Harlem", "Boro Zone")]).first()
    assert r["manhattan_subregion"] is None and r["borough_group"] == "Outer Borough"


def test_airport_flags_and_groups(spark):
    rows = [(1, "EWR", "Newark Airport", "EWR"), (2, "Queens", "JFK Airport", "Airports"),
            (3, "Unknown", "NV", "N/A"), (4, "N/A", "Outside of NYC", "N/A"), (5, " Queens ", " Astoria ", "Boro Zone")]
    out = {r["location_id"]: r for r in _dim_for(spark, rows).collect()}
    assert out[1]["is_airport"] and out[1]["is_ewr"] and out[1]["borough_group"] == "New Jersey"
    assert out[2]["is_airport"] and not out[2]["is_ewr"]
    assert out[3]["borough_group"] == "Other" and out[4]["borough"] == "N/A"
    assert out[5]["borough"] == "Queens" and out[5]["zone_name"] == "Astoria"


def test_zone_csv_roundtrip_keeps_na(spark, tmp_path):
    path = fixture.write_zones_csv(fixture.fixture_zone_rows(), str(tmp_path / "zones.csv"))
    zones = L.read_zones(spark, path)
    assert zones.count() == 265
    assert zones.filter(F.col("service_zone") == "N/A").count() == 2
    assert zones.filter(F.col("Borough").isNull()).count() == 0


def test_fixture_zone_grain(spark):
    dim = dims.dim_location(staging.stg_zones(fixture.zones_fixture(spark)))
    per_zone = dim.groupBy("zone_name").agg(
        F.count_distinct("borough", "service_zone", "is_airport", "borough_group").alias("v"))
    assert per_zone.filter("v > 1").count() == 0


def test_dedup_exact_and_with_nulls(spark):
    rows = [trip(), trip(), trip(RatecodeID=None, store_and_fwd_flag=None),
            trip(RatecodeID=None, store_and_fwd_flag=None), trip(fare_amount=11.0)]
    stg = staging.stg_trips(raw_df(spark, rows))
    assert stg.count() == 3


def test_window_dedup_equals_hash_dedup(spark):
    rows = [trip(), trip(), trip(passenger_count=None), trip(passenger_count=None), trip(tip_amount=3.0)]
    renamed = staging.rename_trips(raw_df(spark, rows))
    a = staging.dedup_exact(renamed)
    b = staging.dedup_window(renamed)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_key_collision_policies(spark):
    rows = [trip(), trip(extra=1.0)]  # differ only in a column outside the key
    raw = raw_df(spark, rows)
    stg = staging.stg_trips(raw)
    assert stg.count() == 2 and stg.select("trip_id").distinct().count() == 1
    assert staging.key_collisions(stg).first()["n_rows"] == 2
    with pytest.raises(staging.TripKeyCollision):
        staging.stg_trips(raw, dup_policy="error")
    assert staging.stg_trips(raw, dup_policy="first").count() == 1


def test_surrogate_key_null_safe(spark):
    a = staging.stg_trips(raw_df(spark, [trip(RatecodeID=None)])).first()["trip_id"]
    b = staging.stg_trips(raw_df(spark, [trip(RatecodeID=1)])).first()["trip_id"]
    assert a != b and len(a) == 32


def test_seed_with_repeated_key_fails(spark, tmp_path):
    p = tmp_path / "vendor.csv"
    p.write_text("vendor_id,vendor_name\n1,A\n1,B\n")
    with pytest.raises(L.LookupError_):
        L.read_seed(spark, "vendor", str(p))


def test_seeds_load(spark):
    seeds = L.load_seeds(spark)
    assert {n: df.count() for n, df in seeds.items()} == {
        "vendor": 4, "rate_code": 7, "payment_type": 7, "store_and_fwd_flag": 2}


def test_quarantine_bad_casts(spark):
    rows = [trip(), trip(fare_amount=123456789.0), trip(total_amount=None)]
    raw = raw_df(spark, rows)
    good, bad = staging.quarantine_bad_casts(raw)
    assert good.count() == 2
    assert [r["rejected_columns"] for r in bad.collect()] == [["fare_amount"]]
    assert staging.stg_trips(raw, cast_mode="try").count() == 2
    with pytest.raises(Exception):
        staging.stg_trips(raw).count()  # ANSI: the overflow fails the job


def test_audit_columns(spark):
    from tripmart.sources import trips

    df = trips.normalise_raw_trips(raw_df(spark, [trip(), trip(fare_amount=3.0)]), 2025, 3,
                                   execution_id="run-1", source_file_size_mb=7.9)
    rows = df.collect()
    assert {r["source_execution_id"] for r in rows} == {"run-1"}
    assert {r["source_file"] for r in rows} == {"yellow_tripdata_2025-03.parquet"}
    assert {r["source_file_size"] for r in rows} == {7}
    assert {(r["trip_year"], r["trip_month"]) for r in rows} == {(2025, 3)}


def test_schema_evolution_on_read(spark, tmp_path):
    from tripmart.plans import pipeline, sinks

    layout = pipeline.Layout(str(tmp_path / "lake"), "S")
    jan = raw_df(spark, [trip()])
    feb = raw_df(spark, [trip(fare_amount=4.0)]).withColumn("cbd_congestion_fee", F.lit(0.75))
    sinks.replace_partition(spark, jan, layout.raw_trips, {"trip_year": 2025, "trip_month": 1})
    sinks.replace_partition(spark, feb, layout.raw_trips, {"trip_year": 2025, "trip_month": 2})
    raw = pipeline.raw_trips_table(spark, layout)
    assert "cbd_congestion_fee" in raw.columns
    assert staging.stg_trips(raw).count() == 2  # the staged projection ignores the new column


def test_large_lookup_is_not_broadcast(spark):
    """Spark's own byte threshold decides; the rows are the same either way."""
    from tripmart.operators import facts
    from tripmart.sources import fixture as fx

    stg = staging.stg_trips(raw_df(spark, [trip(), trip(VendorID=9)]))
    lk = facts.Lookups.build(spark, fx.zones_fixture(spark))
    small = facts.fact_trips(stg, lk)
    rows = sorted(map(str, small.collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = facts.fact_trips(stg, lk)
        assert "BroadcastHashJoin" not in large._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, large.collect())) == rows
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _seed_dir(tmp_path, **replaced):
    import shutil

    from tripmart.sources import lookups

    folder = tmp_path / "seeds"
    shutil.copytree(lookups.SEED_DIR, folder)
    for name, text in replaced.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_empty_seed_joins_to_nulls(spark, tmp_path):
    from tripmart.operators import facts
    from tripmart.sources import fixture as fx

    lk = facts.Lookups.build(spark, fx.zones_fixture(spark), _seed_dir(tmp_path, vendor="vendor_id,vendor_name\n"))
    row = facts.fact_trips(staging.stg_trips(raw_df(spark, [trip()])), lk).first()
    assert row["vendor_name"] is None and row["payment_type_name"] is not None


@pytest.mark.parametrize("rows", [3, 10_001])
def test_two_null_keys_repeat_at_any_size(spark, rows):
    from tripmart.sources import lookups

    df = spark.range(rows).selectExpr("IF(id < 2, NULL, id) AS k")
    with pytest.raises(lookups.LookupError_):
        lookups.check_lookups({"big": (df, "k")})
    lookups.check_lookups({"big": (df.filter("k IS NOT NULL").union(spark.sql("SELECT CAST(NULL AS BIGINT)")), "k")})


def test_relationship_to_a_large_parent(spark):
    from tripmart.operators import quality as q

    child = spark.createDataFrame([(1,), (20_000,), (None,), (5,), (20_000,)], "k int")
    check = q.Check("child", "k", q.RELATIONSHIPS, to_model="parent", to_field="id")
    parents = {"parent": spark.range(10_001)}
    assert [r["failures"] for r in q.run_checks({"child": child}, [check], parents).collect()] == [2]
    assert [r["k"] for r in q.failing_rows(child, check, parents).collect()] == [20_000, 20_000]


def test_quality_pass_expands_no_row(spark):
    from tripmart.operators import quality as q
    from tripmart.plans import registry

    models, parents = registry.dq_models(spark, "/root/testdata/sf0.001")
    plan = q.run_checks({q.FACT: models[q.FACT]}, q.DECLARED_CHECKS, {**parents, **models})._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_tiny_distances_do_not_stop_the_vendor_mart(spark, lookups):
    from tripmart.operators import facts, marts

    raw = raw_df(spark, [trip(trip_distance=1e-9, fare_amount=50.0), trip(trip_distance=5e-324, fare_amount=50.0), trip()])
    mart = marts.build_mart("agg_vendor_performance", facts.fact_trips(staging.stg_trips(raw), lookups))
    assert mart.agg(F.sum("trip_count")).first()[0] == 3
