"""Property tests (hypothesis, few examples: each one runs Spark jobs)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import BASE, raw_df, trip
from tripmart.operators import facts, marts, staging
from tripmart.incremental import loading as inc
from conftest import SF_SMALL

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

trip_rows = st.lists(
    st.builds(lambda m, v, f, r, c: trip(tpep_pickup_datetime=BASE + dt.timedelta(minutes=m),
                                         tpep_dropoff_datetime=BASE + dt.timedelta(minutes=m + 7),
                                         VendorID=v, fare_amount=f, RatecodeID=r, store_and_fwd_flag=c),
              st.integers(0, 3), st.sampled_from([1, 2]), st.sampled_from([5.0, 7.25]),
              st.sampled_from([1, None]), st.sampled_from(["N", " y", None])),
    min_size=1, max_size=12)


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@SETTINGS
@given(rows=trip_rows)
def test_dedup_idempotent_and_equals_window(spark, rows):
    renamed = staging.rename_trips(raw_df(spark, rows))
    once = staging.dedup_exact(renamed)
    assert _same(staging.dedup_exact(once), once)
    assert _same(staging.dedup_window(renamed), once)


@SETTINGS
@given(target=st.lists(st.tuples(st.sampled_from([1, 2, 3, None]), st.text("ab", max_size=2)), max_size=6),
       source=st.lists(st.tuples(st.sampled_from([2, 3, 4, None]), st.text("AB", max_size=2)), max_size=6))
def test_merge_idempotent_and_covers_source(spark, target, source):
    schema = "k int, v string"
    t, s = spark.createDataFrame(target, schema), spark.createDataFrame(source, schema)
    for null_safe in (False, True):
        once = inc.merge_upsert(t, s, ["k"], null_safe)
        assert _same(inc.merge_upsert(once, s, ["k"], null_safe).dropDuplicates(), once.dropDuplicates())
        assert s.exceptAll(once).count() == 0  # every source row is in the result


def test_mart_totals_equal_fact_totals(spark, lookups):
    from tripmart.sources import fixture

    fact = facts.fact_trips(staging.stg_trips(fixture.raw_trips_fixture(spark, SF_SMALL)), lookups).cache()
    n, revenue = fact.agg(F.count(F.lit(1)), F.sum("total_amount")).first()
    for name in marts.MARTS:
        m = marts.build_mart(name, fact).agg(F.sum("trip_count"), F.sum("total_revenue")).first()
        assert m[0] == n, name
        assert abs(float(m[1]) - float(revenue)) < 0.01 * len(marts.MARTS), name
    fact.unpersist()
