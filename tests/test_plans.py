"""Physical-plan checks: broadcasts, pushdown, no Python in the hot path."""

from tripmart.operators import facts, marts, staging
from tripmart.sources import fixture
from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df):
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_fact_is_broadcast_joins_without_python(spark, lookups):
    fact = facts.fact_trips(staging.stg_trips(fixture.raw_trips_fixture(spark, SF_SMALL)), lookups)
    plan = _plan(fact)
    # four seeds, and the zone dimension in two roles
    assert plan.count("BroadcastHashJoin") == 6
    assert "SortMergeJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_plausibility_filter_reaches_scan(spark, lookups, tmp_path):
    path = str(tmp_path / "raw")
    fixture.raw_trips_fixture(spark, SF_SMALL).write.parquet(path)
    fact = facts.fact_trips(staging.stg_trips(spark.read.parquet(path)), lookups)
    pushed = [line for line in _formatted(fact).splitlines() if line.startswith("PushedFilters")]
    assert any("LessThan(trip_distance,500.0)" in p and "GreaterThanOrEqual(trip_distance,0.0)" in p
               for p in pushed)


def test_dedup_is_hash_aggregate_with_partial_step(spark):
    stg = staging.stg_trips(fixture.raw_trips_fixture(spark, SF_SMALL))
    plan = _plan(stg)
    assert plan.count("HashAggregate") >= 2 and "Window" not in plan


def test_mart_single_shuffle(spark, lookups):
    fact = facts.fact_trips(staging.stg_trips(fixture.raw_trips_fixture(spark, SF_SMALL)), lookups)
    plan = _plan(marts.build_mart("agg_hourly_demand", fact))
    # one exchange for the dedup, one for the mart grouping (plus the distinct-free aggregates)
    assert plan.count("Exchange hashpartitioning") == 2
    # the ratio's bins first, then the vendors
    plan = _plan(marts.build_mart("agg_vendor_performance", fact))
    assert plan.count("Exchange hashpartitioning") == 3
