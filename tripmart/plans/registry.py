"""Registered queries: each rebuilds its part of the pipeline over the
driver's tables (trips derived from ``lineitem``) and returns a DataFrame.

Outputs present decimals as DOUBLE so Spark and the DuckDB oracles compare
value for value; the stored tables keep their decimal types.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import schemas
from tripmart.operators import facts, marts, quality, staging
from tripmart.plans import oracle_sql as O
from tripmart.plans import sinks
from tripmart.session import configure
from tripmart.incremental import loading as inc
from tripmart.sources import fixture

QueryFn = Callable[[SparkSession, str], DataFrame]


def present(df: DataFrame) -> DataFrame:
    """Decimals as DOUBLE (exact-to-nearest); other columns unchanged."""
    cols = [F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


_LOOKUPS: dict[int, tuple[SparkSession, facts.Lookups]] = {}


def lookups(spark: SparkSession) -> facts.Lookups:
    """Fixture lookups (seeds + rule-built zones), checked once per session."""
    cached = _LOOKUPS.get(id(spark))
    if cached is None or cached[0] is not spark:
        cached = (spark, facts.Lookups.build(spark, fixture.zones_fixture(spark)))
        _LOOKUPS[id(spark)] = cached
    return cached[1]


def _stg(spark, sf_dir, collide=False) -> DataFrame:
    configure(spark)
    return staging.stg_trips(fixture.raw_trips_fixture(spark, sf_dir, collide=collide))


def _enriched(spark, sf_dir) -> DataFrame:
    return facts.enrich(_stg(spark, sf_dir), lookups(spark))


def _fact(spark, sf_dir) -> DataFrame:
    return facts.fact_trips(_stg(spark, sf_dir), lookups(spark))


# --------------------------------------------------------------------------
# Spark side

FACT_SLICES = {
    "fact_join_codes": (["trip_id", "vendor_id", "vendor_name", "rate_code_id", "rate_code_name",
                         "payment_type_id", "payment_type_name", "store_and_fwd_flag",
                         "store_and_fwd_description"], False),
    "fact_join_locations": (["trip_id", "pickup_location_id"]
                            + [d.format(r="pickup") for _, d in facts.LOCATION_ATTRS]
                            + ["dropoff_location_id"]
                            + [d.format(r="dropoff") for _, d in facts.LOCATION_ATTRS], False),
    "fact_time_parts": (["trip_id", "pickup_datetime", "pickup_date", "pickup_day_of_week",
                         "pickup_hour", "pickup_month", "pickup_year"], True),
    "fact_duration_speed": (["trip_id", "pickup_datetime", "dropoff_datetime", "trip_duration_seconds",
                             "trip_duration_minutes", "trip_distance_miles", "avg_speed_mph"], True),
    "fact_fare_ratios": (["trip_id", "fare_amount", "tip_amount", "trip_distance_miles",
                          "trip_duration_seconds", "tip_percentage", "fare_per_mile",
                          "fare_per_minute"], True),
    "fact_flags": (["trip_id", "pickup_hour", "pickup_day_of_week", "is_rush_hour", "is_weekend",
                    "is_late_night", "is_airport_trip", "trip_borough_type"], True),
    "fact_plausible": (["trip_id", "trip_duration_seconds", "trip_distance_miles", "fare_amount",
                        "total_amount"], True),
    "fact_trips": (list(schemas.FACT_COLUMNS), True),
}


def _fact_slice(name: str) -> QueryFn:
    cols, filtered = FACT_SLICES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        src = _fact(spark, sf_dir) if filtered else _enriched(spark, sf_dir)
        return present(src.select(*cols))
    return run


def _mart(name: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(marts.build_mart(name, _fact(spark, sf_dir)))
    return run


def q_stg_trips_clean(spark, sf_dir):
    return present(staging.rename_trips(fixture.raw_trips_fixture(spark, sf_dir)))


def q_stg_trips_dedup(spark, sf_dir):
    return present(staging.dedup_exact(staging.rename_trips(fixture.raw_trips_fixture(spark, sf_dir))))


def q_stg_trips_key(spark, sf_dir):
    return present(_stg(spark, sf_dir))


def q_stg_key_collisions(spark, sf_dir):
    return staging.key_collisions(_stg(spark, sf_dir, collide=True))


def q_mart_grain_unique(spark, sf_dir):
    # zone names that span boroughs, which the merge keys can not tell apart
    span = F.concat(F.lit("Z"), (F.col("pickup_location_id") % 7).cast("string"))
    fact = _fact(spark, sf_dir).withColumn("pickup_zone", span)
    parts = []
    for name in marts.MARTS:
        v = marts.grain_violations(name, marts.build_mart(name, fact))
        parts.append(v.agg(F.count(F.lit(1)).alias("duplicate_keys"),
                           F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("rows_in_duplicates"))
                     .select(F.lit(name).alias("mart"), "duplicate_keys", "rows_in_duplicates"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dq_models(spark, sf_dir, tests=None, written=False) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The eight tested models built over the fixture, and the seed parents.

    Where a test would find nothing, the input is spoilt: repeated trip keys
    for unique, flags that follow from the vendor for accepted_values.  ``written``
    stages the staged trips once, for callers that read them in several plans."""
    lk = lookups(spark)
    tests = tests or ()
    stg = _stg(spark, sf_dir, collide=quality.UNIQUE in tests)
    if written:
        stg, _ = sinks.stage(spark, stg, "dq-stg")
    fact = facts.fact_trips(stg, lk)
    if quality.ACCEPTED in tests:
        fact = fact.withColumn("store_and_fwd_flag", F.when(F.col("vendor_id") == 9, "X").when(F.col("vendor_id") == 7, "?")
                               .otherwise(F.col("store_and_fwd_flag")))
    models = {
        quality.STG_TRIPS: stg,
        quality.STG_ZONES: staging.stg_zones(fixture.zones_fixture(spark)),
        quality.DIM: lk.dim_location,
        quality.FACT: fact,
    }
    for name in marts.MARTS:
        models[name] = marts.build_mart(name, fact)
    parents = {"vendor": lk.vendor, "rate_code": lk.rate_code, "payment_type": lk.payment_type}
    return models, parents


def _dq(tests: tuple[str, ...] | None) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        models, parents = dq_models(spark, sf_dir, tests)
        checks = [c for c in quality.DECLARED_CHECKS if tests is None or c.test in tests]
        return quality.run_checks(models, checks, parents)
    return run


FAILING = (quality.UNIQUE, quality.ACCEPTED, quality.RELATIONSHIPS)


def q_dq_failing_rows(spark, sf_dir):
    """The trips behind the failures of the fact's checks."""
    models, parents = dq_models(spark, sf_dir, FAILING, written=True)
    fact, parents = models[quality.FACT], {**parents, **models}
    out = None
    for c in quality.DECLARED_CHECKS:
        if c.model == quality.FACT and c.test in FAILING:
            rows = quality.failing_rows(fact, c, parents).select(
                F.lit(c.column).alias("column_name"), F.lit(c.test).alias("test"), "trip_id",
                F.col(c.column).cast("string").alias("value"))
            out = rows if out is None else out.unionByName(rows)
    return out


DQ_QUERIES = {
    "dq_not_null": (quality.NOT_NULL,),
    "dq_unique": (quality.UNIQUE,),
    "dq_accepted_values": (quality.ACCEPTED,),
    "dq_relationships": (quality.RELATIONSHIPS,),
    "dq_report": None,
}


# Incremental scenarios: batch 1 = January as first delivered (late rows
# held back), batch 2 = the raw layer after February lands and January is
# re-delivered complete.
MERGE_FROM_DATE = "2025-01-25"
MONTH_GRAIN = ["pickup_year", "pickup_month"]
INCR_MARTS = {
    "incr_daily_reference": "agg_daily_zone_summary",
    "incr_hourly_reference": "agg_hourly_demand",
    "incr_monthly_reference": "agg_monthly_zone_summary",
    "incr_vendor_reference": "agg_vendor_performance",
}


def _batches(spark, sf_dir, written=False):
    """``written`` stages the first batch's trips once, for callers that read them in several plans."""
    configure(spark)
    lk = lookups(spark)
    jan_raw, full_raw = fixture.raw_trips_batches(spark, sf_dir)
    stg1, stg2 = staging.stg_trips(jan_raw), staging.stg_trips(full_raw)
    if written:
        stg1, _ = sinks.stage(spark, stg1, "incr-stg")
    fact1 = facts.fact_trips(stg1, lk)
    return lk, full_raw, stg2, fact1


def q_incr_fact_reference(spark, sf_dir):
    lk, _, stg2, fact1 = _batches(spark, sf_dir)
    return present(inc.incremental_fact(stg2, lk, fact1))


def _incr_mart(name: str) -> QueryFn:
    def run(spark, sf_dir):
        lk, _, stg2, fact1 = _batches(spark, sf_dir, written=True)
        fact2 = inc.incremental_fact(stg2, lk, fact1)
        first, _ = sinks.stage(spark, marts.build_mart(name, fact1), "incr-mart")
        return present(inc.incremental_mart(name, fact2, first))
    return run


def q_incr_monthly_safe(spark, sf_dir):
    lk, full_raw, stg2, fact1 = _batches(spark, sf_dir)
    name = "agg_monthly_zone_summary"
    first = marts.build_mart(name, fact1)
    touched = inc.months_of(full_raw.select(F.year("tpep_pickup_datetime").alias("y"),
                                            F.month("tpep_pickup_datetime").alias("m")), "y", "m")
    rebuilt = marts.build_mart(name, inc.safe_rebuild_fact(stg2, lk, touched))
    return present(inc.replace_grains(first, rebuilt, MONTH_GRAIN))


def q_merge_upsert_single_key(spark, sf_dir):
    lk, _, stg2, fact1 = _batches(spark, sf_dir)
    late = facts.fact_trips(stg2, lk).filter(F.col("pickup_date") >= F.lit(MERGE_FROM_DATE).cast("date"))
    changed = late.withColumn("total_amount", (F.col("total_amount") + F.lit(1)).cast(schemas.MONEY))
    return present(inc.merge_upsert(fact1, changed, inc.FACT_KEY))


def q_merge_upsert_composite_key(spark, sf_dir):
    lk, _, stg2, fact1 = _batches(spark, sf_dir)
    name = "agg_daily_zone_summary"
    late = facts.fact_trips(stg2, lk).filter(F.col("pickup_date") >= F.lit(MERGE_FROM_DATE).cast("date"))
    return present(inc.merge_upsert(marts.build_mart(name, fact1), marts.build_mart(name, late),
                                    marts.MERGE_KEYS[name], null_safe=True))


def spark_queries() -> dict[str, QueryFn]:
    q: dict[str, QueryFn] = {
        "stg_trips_clean": q_stg_trips_clean,
        "stg_trips_dedup": q_stg_trips_dedup,
        "stg_trips_key": q_stg_trips_key,
        "stg_key_collisions": q_stg_key_collisions,
    }
    for name in FACT_SLICES:
        q[name] = _fact_slice(name)
    for name in marts.MARTS:
        q[name] = _mart(name)
    q["mart_grain_unique"] = q_mart_grain_unique
    for name, tests in DQ_QUERIES.items():
        q[name] = _dq(tests)
    q["dq_failing_rows"] = q_dq_failing_rows
    q["incr_fact_reference"] = q_incr_fact_reference
    for qname, mart in INCR_MARTS.items():
        q[qname] = _incr_mart(mart)
    q["incr_monthly_safe"] = q_incr_monthly_safe
    q["merge_upsert_single_key"] = q_merge_upsert_single_key
    q["merge_upsert_composite_key"] = q_merge_upsert_composite_key
    from tripmart.plans import evidence, roundtrips
    q.update(roundtrips.spark_queries())
    q.update(evidence.spark_queries())
    return q


# --------------------------------------------------------------------------
# Oracle side

def _oracle_stg_trips_clean() -> str:
    ctes = O.staging_ctes(fixture.raw_trips_sql())
    return O.with_sql(ctes, f"SELECT {O.fact_select(schemas.STG_TRIP_COLUMNS)} FROM stg_renamed")


def _oracle_stg_trips_dedup() -> str:
    ctes = O.staging_ctes(fixture.raw_trips_sql())
    return O.with_sql(ctes, f"SELECT {O.fact_select(schemas.STG_TRIP_COLUMNS)} FROM stg_dedup")


def _oracle_stg_trips_key() -> str:
    ctes = O.staging_ctes(fixture.raw_trips_sql())
    return O.with_sql(ctes, f"SELECT {O.fact_select(['trip_id'] + schemas.STG_TRIP_COLUMNS)} FROM stg")


def _oracle_stg_key_collisions() -> str:
    ctes = O.staging_ctes(fixture.raw_trips_sql(collide=True))
    return O.with_sql(ctes, "SELECT trip_id, CAST(count(*) AS BIGINT) AS n_rows FROM stg "
                            "GROUP BY trip_id HAVING count(*) > 1")


def _oracle_fact_slice(name: str) -> str:
    cols, filtered = FACT_SLICES[name]
    return O.with_sql(O.base_ctes(), f"SELECT {O.fact_select(cols)} FROM {'fact' if filtered else 'measured'}")


def _oracle_mart(name: str) -> str:
    return O.with_sql(O.base_ctes(), O.mart_sql(name))


def _oracle_mart_grain_unique() -> str:
    ctes = O.base_ctes()
    ctes.append(("span", "  SELECT * REPLACE ('Z' || CAST(pickup_location_id % 7 AS VARCHAR) AS pickup_zone) FROM fact"))
    selects = []
    for name in marts.MARTS:
        ctes.append((f"m_{name}", O.mart_sql(name, "span")))
        keys = ", ".join(marts.MERGE_KEYS[name])
        selects.append(
            f"SELECT '{name}' AS mart, CAST(count(*) AS BIGINT) AS duplicate_keys, "
            f"CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_in_duplicates FROM "
            f"(SELECT {keys}, count(*) AS n FROM m_{name} GROUP BY {keys} HAVING count(*) > 1)")
    return O.with_sql(ctes, "\nUNION ALL\n".join(selects))


def oracle_queries() -> dict[str, str]:
    q = {
        "stg_trips_clean": _oracle_stg_trips_clean(),
        "stg_trips_dedup": _oracle_stg_trips_dedup(),
        "stg_trips_key": _oracle_stg_trips_key(),
        "stg_key_collisions": _oracle_stg_key_collisions(),
    }
    for name in FACT_SLICES:
        q[name] = _oracle_fact_slice(name)
    for name in marts.MARTS:
        q[name] = _oracle_mart(name)
    q["mart_grain_unique"] = _oracle_mart_grain_unique()
    for name, tests in DQ_QUERIES.items():
        q[name] = _oracle_dq(tests)
    q["dq_failing_rows"] = _oracle_failing_rows()
    q["incr_fact_reference"] = oracle_incr_fact()
    for qname, mart in INCR_MARTS.items():
        q[qname] = oracle_incr_mart(mart)
    q["incr_monthly_safe"] = _oracle_incr_monthly_safe()
    q["merge_upsert_single_key"] = _oracle_merge_single()
    q["merge_upsert_composite_key"] = _oracle_merge_composite()
    from tripmart.plans import evidence, roundtrips
    q.update(roundtrips.oracle_queries())
    q.update(evidence.oracle_queries())
    return q


def _batch_ctes() -> list[tuple[str, str]]:
    b1 = (f"  SELECT * EXCLUDE (_orderkey) FROM ({fixture.raw_trips_sql(keep_order_key=True)})\n"
          f"  WHERE tpep_pickup_datetime < TIMESTAMP '{fixture.BATCH_SPLIT_DATE}' "
          f"AND _orderkey % {fixture.LATE_EVERY} <> 0")
    return (O.staging_ctes(b1, prefix="b1_") + O.staging_ctes(fixture.raw_trips_sql())
            + O.lookup_ctes() + O.fact_ctes(prefix="b1_") + O.fact_ctes())


def _anti_union(target: str, source: str, keys, null_safe=False) -> str:
    op = "IS NOT DISTINCT FROM" if null_safe else "="
    cond = " AND ".join(f"s.{k} {op} t.{k}" for k in keys)
    return (f"  SELECT * FROM {target} t WHERE NOT EXISTS (SELECT 1 FROM {source} s WHERE {cond})\n"
            f"  UNION ALL SELECT * FROM {source}")


def _fact2_ctes() -> list[tuple[str, str]]:
    return _batch_ctes() + [
        ("inc_fact", "  SELECT * FROM fact WHERE pickup_datetime > (SELECT max(pickup_datetime) FROM b1_fact)"),
        ("fact2", _anti_union("b1_fact", "inc_fact", inc.FACT_KEY)),
    ]


def oracle_incr_fact() -> str:
    return O.with_sql(_fact2_ctes(), f"SELECT {O.fact_select(schemas.FACT_COLUMNS)} FROM fact2")


MART_MARK_SQL = {
    "agg_daily_zone_summary": "pickup_date", "agg_hourly_demand": "pickup_date",
    "agg_monthly_zone_summary": "make_date(pickup_year, pickup_month, 1)",
    "agg_vendor_performance": "make_date(pickup_year, pickup_month, 1)",
}


def oracle_incr_mart(name: str) -> str:
    ctes = _fact2_ctes() + [
        ("m1", O.mart_sql(name, "b1_fact")),
        ("m_inc", O.mart_sql(name, f"(SELECT * FROM fact2 WHERE pickup_date > "
                                   f"(SELECT max({MART_MARK_SQL[name]}) FROM m1)) AS src")),
        ("m2", _anti_union("m1", "m_inc", marts.MERGE_KEYS[name])),
    ]
    return O.with_sql(ctes, "SELECT * FROM m2")


def _oracle_incr_monthly_safe() -> str:
    # Both months are touched by batch 2, so the safe rebuild equals a full load.
    ctes = _batch_ctes() + [
        ("m1", O.mart_sql("agg_monthly_zone_summary", "b1_fact")),
        ("rebuilt", O.mart_sql("agg_monthly_zone_summary", "fact")),
        ("m2", _anti_union("m1", "rebuilt", MONTH_GRAIN, null_safe=True)),
    ]
    return O.with_sql(ctes, "SELECT * FROM m2")


def _oracle_merge_single() -> str:
    ctes = _batch_ctes() + [
        ("src", f"  SELECT * REPLACE (CAST(total_amount + 1 AS DECIMAL(10,2)) AS total_amount) FROM fact "
                f"WHERE pickup_date >= DATE '{MERGE_FROM_DATE}'"),
        ("merged", _anti_union("b1_fact", "src", inc.FACT_KEY)),
    ]
    return O.with_sql(ctes, f"SELECT {O.fact_select(schemas.FACT_COLUMNS)} FROM merged")


def _oracle_merge_composite() -> str:
    name = "agg_daily_zone_summary"
    ctes = _batch_ctes() + [
        ("m1", O.mart_sql(name, "b1_fact")),
        ("src", O.mart_sql(name, f"(SELECT * FROM fact WHERE pickup_date >= DATE '{MERGE_FROM_DATE}') AS f")),
        ("merged", _anti_union("m1", "src", marts.MERGE_KEYS[name], null_safe=True)),
    ]
    return O.with_sql(ctes, "SELECT * FROM merged")


DQ_MODEL_CTES = {
    quality.STG_TRIPS: "stg", quality.STG_ZONES: "stg_zones", quality.DIM: "dim", quality.FACT: "fact_dq",
    **{name: f"m_{name}" for name in marts.MARTS},
}


def _oracle_check(c: quality.Check) -> str:
    m = DQ_MODEL_CTES[c.model]
    head = f"SELECT '{c.model}' AS model, '{c.column}' AS column_name, '{c.test}' AS test, '{c.severity}' AS severity, "
    if c.test == quality.NOT_NULL:
        body = f"CAST(count(*) AS BIGINT) AS failures FROM {m} WHERE {c.column} IS NULL"
    elif c.test == quality.UNIQUE:
        body = (f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {c.column} FROM {m} "
                f"WHERE {c.column} IS NOT NULL GROUP BY {c.column} HAVING count(*) > 1)")
    elif c.test == quality.ACCEPTED:
        vals = ", ".join(f"'{v}'" for v in c.values)
        body = (f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {c.column} AS v FROM {m} "
                f"GROUP BY {c.column}) WHERE v NOT IN ({vals})")
    else:
        parent = DQ_MODEL_CTES.get(c.to_model, c.to_model)
        body = (f"CAST(count(*) AS BIGINT) AS failures FROM {m} c LEFT JOIN {parent} p "
                f"ON c.{c.column} = p.{c.to_field} WHERE c.{c.column} IS NOT NULL AND p.{c.to_field} IS NULL")
    return head + body


def _dq_ctes(tests) -> list[tuple[str, str]]:
    ctes = O.base_ctes(collide="unique" in (tests or ()))
    flag = ("CASE vendor_id WHEN 9 THEN 'X' WHEN 7 THEN '?' ELSE store_and_fwd_flag END"
            if "accepted_values" in (tests or ()) else "store_and_fwd_flag")
    ctes.append(("fact_dq", f"  SELECT * REPLACE ({flag} AS store_and_fwd_flag), {O.h_to_double('_min_h')} "
                            "AS trip_duration_minutes FROM fact"))
    return ctes


def _oracle_dq(tests) -> str:
    ctes = _dq_ctes(tests)
    for name in marts.MARTS:
        ctes.append((f"m_{name}", O.mart_sql(name)))
    checks = [c for c in quality.DECLARED_CHECKS if tests is None or c.test in tests]
    ctes.append(("checks", "\nUNION ALL\n".join(_oracle_check(c) for c in checks)))
    return O.with_sql(ctes, "SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' "
                            "ELSE 'fail' END AS status FROM checks")


def _oracle_failing_rows() -> str:
    """The fact's checks, spelt out."""
    parts = ["SELECT 'trip_id' AS column_name, 'unique' AS test, trip_id, trip_id AS value FROM fact_dq "
             "WHERE trip_id IN (SELECT trip_id FROM fact_dq GROUP BY trip_id HAVING count(*) > 1)"]
    for column, values in (("pickup_day_of_week", "'Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'"),
                           ("store_and_fwd_flag", "'Y', 'N'"), ("trip_borough_type", "'Same Borough', 'Cross Borough'")):
        parts.append(f"SELECT '{column}', 'accepted_values', trip_id, {column} FROM fact_dq WHERE {column} NOT IN ({values})")
    for column, parent, key in (("vendor_id", "vendor", "vendor_id"), ("rate_code_id", "rate_code", "rate_code_id"),
                                ("payment_type_id", "payment_type", "payment_type_id"),
                                ("pickup_location_id", "dim", "location_id"), ("dropoff_location_id", "dim", "location_id")):
        parts.append(f"SELECT '{column}', 'relationships', trip_id, CAST({column} AS VARCHAR) FROM fact_dq "
                     f"WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL)")
    return O.with_sql(_dq_ctes(FAILING), "\nUNION ALL\n".join(parts))
