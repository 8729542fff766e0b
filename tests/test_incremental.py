"""Reference watermark rules (literal behaviour) versus safe whole-month rebuilds."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import raw_df, trip
from tripmart.operators import facts, marts, staging
from tripmart.incremental import loading as inc


def _trips_on(days, month=1, zone=4):
    rows = []
    for i, d in enumerate(days):
        t = dt.datetime(2025, month, d, 10, i)
        rows.append(trip(tpep_pickup_datetime=t, tpep_dropoff_datetime=t + dt.timedelta(minutes=9),
                         PULocationID=zone))
    return rows


def test_late_rows_lost_in_reference_mode(spark, lookups):
    first = staging.stg_trips(raw_df(spark, _trips_on([10, 20])))
    fact1 = facts.fact_trips(first, lookups)
    both = staging.stg_trips(raw_df(spark, _trips_on([10, 20, 15])))  # day 15 arrives late
    fact2 = inc.incremental_fact(both, lookups, fact1)
    assert fact2.count() == 2  # the late trip is at or below the mark


def test_empty_target_loads_nothing_in_reference_mode(spark, lookups):
    stg = staging.stg_trips(raw_df(spark, _trips_on([3, 4])))
    empty = facts.fact_trips(stg, lookups).limit(0)
    assert inc.incremental_fact(stg, lookups, empty).count() == 0


def test_monthly_mart_loses_day_one_on_rerun(spark, lookups):
    name = "agg_monthly_zone_summary"
    fact = facts.fact_trips(staging.stg_trips(raw_df(spark, _trips_on([1, 1, 2, 3]))), lookups)
    first = marts.build_mart(name, fact)
    assert first.first()["trip_count"] == 4
    again = inc.incremental_mart(name, fact, first)  # same data, second run
    r = again.filter(F.col("pickup_zone").isNotNull()).first()
    assert r["trip_count"] == 2 and r["active_days"] == 2


def test_safe_rebuild_is_stable_on_rerun(spark, lookups):
    name = "agg_monthly_zone_summary"
    fact = facts.fact_trips(staging.stg_trips(raw_df(spark, _trips_on([1, 1, 2, 3]))), lookups)
    first = marts.build_mart(name, fact)
    again = inc.replace_grains(first, marts.build_mart(name, fact), ["pickup_year", "pickup_month"])
    assert again.exceptAll(first).count() == 0 and first.exceptAll(again).count() == 0


def test_merge_upsert_updates_and_inserts(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    s = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k int, v string")
    plain = sorted((str(r.k), r.v) for r in inc.merge_upsert(t, s, ["k"]).collect())
    assert plain == sorted([("1", "a"), ("2", "B"), ("3", "C"), ("None", "n"), ("None", "N")])
    safe = {(r.k, r.v) for r in inc.merge_upsert(t, s, ["k"], null_safe=True).collect()}
    assert safe == {(1, "a"), (2, "B"), (3, "C"), (None, "N")}


def test_merge_is_idempotent(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    s = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    once = inc.merge_upsert(t, s, ["k"])
    twice = inc.merge_upsert(once, s, ["k"])
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_watermark_is_one_scalar_subquery(spark, lookups):
    stg = staging.stg_trips(raw_df(spark, _trips_on([5, 6])))
    fact1 = facts.fact_trips(stg, lookups)
    plan = inc.above_watermark(stg, "fact_yellow_taxi_trips", fact1)._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan.lower()


def test_stray_future_pickup_raises_the_mark(spark, lookups):
    """A February pickup inside the January file raises the fact mark: the
    February load then drops every February trip up to that second."""
    jan = _trips_on([10, 20]) + _trips_on([2], month=2)          # stray row, 2 February
    fact1 = facts.fact_trips(staging.stg_trips(raw_df(spark, jan)), lookups)
    feb = _trips_on([1, 2, 3], month=2)
    both = staging.stg_trips(raw_df(spark, jan + feb))
    fact2 = inc.incremental_fact(both, lookups, fact1)
    feb_days = sorted(r["pickup_date"].day for r in fact2.filter(F.col("pickup_month") == 2).collect())
    assert feb_days == [2, 2, 3]  # the stray row, the 2 Feb trip after it, and 3 Feb; 1 Feb is lost
    daily1 = marts.build_mart("agg_daily_zone_summary", fact1)
    daily2 = inc.incremental_mart("agg_daily_zone_summary", fact2, daily1)
    feb2 = daily2.filter(F.col("pickup_date") == F.lit("2025-02-02").cast("date")).collect()
    assert [r["trip_count"] for r in feb2] == [1]  # 2 February is never re-aggregated


def _exchange_keys(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.split("hashpartitioning(")[1] for line in plan.splitlines() if "hashpartitioning(" in line]


def test_rows_are_not_dealt_by_month(spark, lookups):
    """The months of a safe rebuild reach the rows by broadcast, whatever their estimated size:
    dealt by month, two tasks would read all trips."""
    old, new = raw_df(spark, _trips_on([3, 4])), raw_df(spark, _trips_on([3, 4, 5]) + _trips_on([6], month=2))
    months = inc.months_of(new.select(F.year("tpep_pickup_datetime").alias("y"), F.month("tpep_pickup_datetime").alias("m")), "y", "m")
    name, before = "agg_monthly_zone_summary", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rebuilt = inc.safe_rebuild_fact(staging.stg_trips(new), lookups, months)
        plan = rebuilt._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin [pickup_year" in plan
        target = marts.build_mart(name, facts.fact_trips(staging.stg_trips(old), lookups))
        both = inc.replace_grains(target, marts.build_mart(name, rebuilt), ["pickup_year", "pickup_month"])
        assert "LeftAnti" in both._jdf.queryExecution().executedPlan().toString()
        assert not any(k.startswith("coalesce(pickup_year") for k in _exchange_keys(both))
        assert sorted((r.pickup_month, r.trip_count) for r in both.collect()) == [(1, 3), (2, 1)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_failing_rows_deduplicate_once(spark, tmp_path):
    """The plans of the fact's failing rows read staged trips, not the trips' source again and again."""
    from conftest import SF_SMALL
    from tripmart.plans import registry

    out = registry.q_dq_failing_rows(spark, SF_SMALL)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and out.count() > 0
