"""Edge rows of the fact: bounds, derived measures, flags (FIXTURES.md section 4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import BASE, raw_df, trip
from tripmart.operators import facts, staging
from tripmart.sources import fixture


def build_fact(spark, lookups, rows, filtered=True):
    stg = staging.stg_trips(raw_df(spark, rows))
    return facts.fact_trips(stg, lookups) if filtered else facts.enrich(stg, lookups)


@pytest.mark.parametrize("secs,kept", [(0, False), (1, True), (86399, True), (86400, False), (-5, False)])
def test_duration_bounds(spark, lookups, secs, kept):
    rows = [trip(tpep_dropoff_datetime=BASE + dt.timedelta(seconds=secs))]
    assert build_fact(spark, lookups, rows).count() == int(kept)


@pytest.mark.parametrize("miles,kept", [(-0.01, False), (0.0, True), (499.99, True), (500.0, False), (None, False)])
def test_distance_bounds(spark, lookups, miles, kept):
    assert build_fact(spark, lookups, [trip(trip_distance=miles)]).count() == int(kept)


def test_zero_distance_has_null_ratios(spark, lookups):
    r = build_fact(spark, lookups, [trip(trip_distance=0.0)]).first()
    assert r["avg_speed_mph"] is None and r["fare_per_mile"] is None


@pytest.mark.parametrize("fare,kept", [(-0.01, False), (0.0, True), (None, False)])
def test_fare_bounds(spark, lookups, fare, kept):
    assert build_fact(spark, lookups, [trip(fare_amount=fare)]).count() == int(kept)


def test_zero_fare_has_null_tip_percentage(spark, lookups):
    assert build_fact(spark, lookups, [trip(fare_amount=0.0)]).first()["tip_percentage"] is None


def test_second_boundaries_counted(spark, lookups):
    start = dt.datetime(2025, 1, 15, 8, 0, 0, 900000)
    rows = [trip(tpep_pickup_datetime=start, tpep_dropoff_datetime=start + dt.timedelta(milliseconds=200))]
    assert build_fact(spark, lookups, rows).first()["trip_duration_seconds"] == 1


@pytest.mark.parametrize("hour,rush", [(6, False), (7, True), (9, True), (10, False), (15, False),
                                       (16, True), (19, True), (20, False)])
def test_rush_hour(spark, lookups, hour, rush):
    t = BASE.replace(hour=hour, minute=59)
    r = build_fact(spark, lookups, [trip(tpep_pickup_datetime=t, tpep_dropoff_datetime=t + dt.timedelta(minutes=5))])
    assert r.first()["is_rush_hour"] is rush


@pytest.mark.parametrize("hour,late", [(0, True), (5, True), (6, False)])
def test_late_night(spark, lookups, hour, late):
    t = BASE.replace(hour=hour)
    r = build_fact(spark, lookups, [trip(tpep_pickup_datetime=t, tpep_dropoff_datetime=t + dt.timedelta(minutes=5))])
    assert r.first()["is_late_night"] is late


def test_weekend_and_day_name(spark, lookups):
    sat = dt.datetime(2025, 1, 18, 12, 0)
    r = build_fact(spark, lookups, [trip(tpep_pickup_datetime=sat, tpep_dropoff_datetime=sat + dt.timedelta(minutes=3))]).first()
    assert r["pickup_day_of_week"] == "Sat" and r["is_weekend"] is True


@pytest.mark.parametrize("pu,do,kind", [(264, 264, "Same Borough"), (265, 265, "Same Borough"),
                                        (266, 266, "Cross Borough"), (4, 266, "Cross Borough")])
def test_borough_type(spark, lookups, pu, do, kind):
    r = build_fact(spark, lookups, [trip(PULocationID=pu, DOLocationID=do)]).first()
    assert r["trip_borough_type"] == kind


def test_missed_lookups_keep_trip(spark, lookups):
    rows = [trip(VendorID=9, RatecodeID=None, PULocationID=266, store_and_fwd_flag=None)]
    r = build_fact(spark, lookups, rows).first()
    assert r["vendor_name"] is None and r["rate_code_name"] is None and r["pickup_zone"] is None
    assert r["is_airport_pickup"] is None and r["is_airport_trip"] is False


def test_flag_trim_upper_and_name(spark, lookups):
    r = build_fact(spark, lookups, [trip(store_and_fwd_flag=" y")]).first()
    assert r["store_and_fwd_flag"] == "Y" and r["store_and_fwd_description"] is not None


def test_money_is_decimal_and_ratios(spark, lookups):
    r = build_fact(spark, lookups, [trip(fare_amount=10.0, tip_amount=2.5, trip_distance=4.0)]).first()
    assert str(r["fare_amount"]) == "10.00"
    assert float(r["tip_percentage"]) == 25.0 and r["fare_per_mile"] == 2.5
    assert float(r["fare_per_minute"]) == 1.0 and float(r["trip_duration_minutes"]) == 10.0
    assert r["avg_speed_mph"] == 24.0


def test_fact_columns_in_order(spark, lookups):
    from tripmart import schemas

    assert build_fact(spark, lookups, [trip()]).columns == schemas.FACT_COLUMNS


def test_airport_fixture_zones(spark, lookups):
    airports = {r["location_id"] for r in lookups.dim_location.filter("is_airport").collect()}
    assert airports == {1, 132, 138}
    assert {(k, v[0]) for k, v in fixture.FIXTURE_SPECIAL_ZONES.items()} >= {(1, "EWR")}
