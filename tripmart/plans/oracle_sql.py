"""DuckDB restatements of the registered queries (correctness oracles).

Each oracle restates the whole chain -- fixture from ``lineitem``, staging,
dimension, fact, mart -- as one SQL statement over the driver's views.  Where
Spark keeps exact decimals and DuckDB would go through DOUBLE, the oracle
computes in integer cents/hundredths with explicit half-up rounding; where
Spark rounds a DOUBLE (half-up on its shortest decimal text) the oracle rounds
the decimal text form.  All money/ratio outputs are DOUBLE on both sides.
"""

from __future__ import annotations

from tripmart import schemas
from tripmart.functions import expressions as X
from tripmart.functions import zones as Z
from tripmart.functions.keys import surrogate_key_sql
from tripmart.operators import facts, marts
from tripmart.sources import fixture


def sround2(x: str) -> str:
    """Spark's round(double, 2): half-up on the decimal text of the double."""
    return f"round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), 2)"


def h_to_double(h: str) -> str:
    """Hundredths (integer) to the nearest DOUBLE of h / 100."""
    return f"(CAST({h} AS DOUBLE) / 100.0::DOUBLE)"


def half_up_div(num: str, den: str) -> str:
    """round half up of num/den to an integer, for num >= 0 and den > 0."""
    return f"((2 * ({num}) + ({den})) // (2 * ({den})))"


def with_sql(ctes: list[tuple[str, str]], final: str) -> str:
    body = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in ctes)
    return f"WITH {body}\n{final}"


# --------------------------------------------------------------------------
# Layers

def _stg_renamed(source: str) -> str:
    m = "DECIMAL(10,2)"
    return f"""  SELECT
    CAST(VendorID AS INTEGER) AS vendor_id,
    CAST(RatecodeID AS INTEGER) AS rate_code_id,
    CAST(PULocationID AS INTEGER) AS pickup_location_id,
    CAST(DOLocationID AS INTEGER) AS dropoff_location_id,
    CAST(payment_type AS INTEGER) AS payment_type_id,
    upper(trim(store_and_fwd_flag)) AS store_and_fwd_flag,
    CAST(passenger_count AS INTEGER) AS passenger_count,
    CAST(trip_distance AS DOUBLE) AS trip_distance_miles,
    CAST(tpep_pickup_datetime AS TIMESTAMP) AS pickup_datetime,
    CAST(tpep_dropoff_datetime AS TIMESTAMP) AS dropoff_datetime,
    CAST(fare_amount AS {m}) AS fare_amount,
    CAST(extra AS {m}) AS extra_amount,
    CAST(mta_tax AS {m}) AS mta_tax,
    CAST(tip_amount AS {m}) AS tip_amount,
    CAST(tolls_amount AS {m}) AS tolls_amount,
    CAST(improvement_surcharge AS {m}) AS improvement_surcharge,
    CAST(congestion_surcharge AS {m}) AS congestion_surcharge,
    CAST(airport_fee AS {m}) AS airport_fee,
    CAST(total_amount AS {m}) AS total_amount
  FROM {source}"""


def _ilike_any(col: str, patterns) -> str:
    return "(" + " OR ".join(f"{col} ILIKE '{p}'" for p in patterns) + ")"


def _dim_sql() -> str:
    sub = " ".join(
        f"WHEN borough = 'Manhattan' AND {_ilike_any('zone_name', pats)} THEN '{label}'"
        for label, pats in Z.MANHATTAN_SUBREGIONS)
    outer = ", ".join(f"'{b}'" for b in Z.OUTER_BOROUGHS)
    return f"""  SELECT location_id, borough, zone_name, service_zone,
    CASE WHEN service_zone = 'Airports' THEN true WHEN zone_name ILIKE '%airport%' THEN true ELSE false END AS is_airport,
    CASE WHEN service_zone = 'EWR' THEN true ELSE false END AS is_ewr,
    CASE WHEN service_zone = 'Yellow Zone' THEN true ELSE false END AS is_yellow_zone,
    CASE WHEN borough = 'Manhattan' THEN 'Manhattan'
         WHEN borough IN ({outer}) THEN 'Outer Borough'
         WHEN borough = 'EWR' THEN 'New Jersey' ELSE 'Other' END AS borough_group,
    CASE {sub} WHEN borough = 'Manhattan' THEN 'Other Manhattan' ELSE NULL END AS manhattan_subregion
  FROM stg_zones"""


def _enriched_sql(source: str = "stg") -> str:
    rush = " OR ".join(f"hour(t.pickup_datetime) BETWEEN {a} AND {b}" for a, b in X.RUSH_HOUR_RANGES)
    late = "hour(t.pickup_datetime) BETWEEN {} AND {}".format(*X.LATE_NIGHT_RANGE)
    weekend = ", ".join(f"'{d}'" for d in X.WEEKEND_DAYS)
    loc_cols = []
    for role, alias in [("pickup", "pul"), ("dropoff", "dol")]:
        for src, dst in facts.LOCATION_ATTRS:
            loc_cols.append(f"{alias}.{src} AS {dst.format(r=role)}")
    loc = ",\n    ".join(loc_cols)
    return f"""  SELECT t.*,
    v.vendor_name, rc.rate_code_name, pt.payment_type_name, sf.store_and_fwd_description,
    {loc},
    date_diff('second', t.pickup_datetime, t.dropoff_datetime) AS _secs,
    CAST(round(t.fare_amount * 100) AS BIGINT) AS _fc,
    CAST(round(t.tip_amount * 100) AS BIGINT) AS _tc,
    CASE WHEN {rush} THEN true ELSE false END AS is_rush_hour,
    CASE WHEN strftime(t.pickup_datetime, '%a') IN ({weekend}) THEN true ELSE false END AS is_weekend,
    CASE WHEN {late} THEN true ELSE false END AS is_late_night,
    CASE WHEN pul.is_airport = true OR dol.is_airport = true THEN true ELSE false END AS is_airport_trip,
    CASE WHEN pul.borough = dol.borough THEN '{X.SAME_BOROUGH}' ELSE '{X.CROSS_BOROUGH}' END AS trip_borough_type
  FROM {source} t
  LEFT JOIN vendor v ON t.vendor_id = v.vendor_id
  LEFT JOIN rate_code rc ON t.rate_code_id = rc.rate_code_id
  LEFT JOIN payment_type pt ON t.payment_type_id = pt.payment_type_id
  LEFT JOIN store_and_fwd_flag sf ON t.store_and_fwd_flag = sf.store_and_fwd_flag
  LEFT JOIN dim pul ON t.pickup_location_id = pul.location_id
  LEFT JOIN dim dol ON t.dropoff_location_id = dol.location_id"""


def _measures_sql(source: str = "enriched") -> str:
    """Per-trip measures as exact integers (hundredths) plus DOUBLE forms."""
    speed = sround2("t.trip_distance_miles / (CAST((2000000 * _secs + 3600) // 7200 AS DOUBLE) / 1000000.0::DOUBLE)")
    fpm = sround2("CAST(t.fare_amount AS DOUBLE) / t.trip_distance_miles")
    mn = "((2000000 * _secs + 60) // 120)"
    return f"""  SELECT t.*,
    CAST(t.pickup_datetime AS DATE) AS pickup_date,
    strftime(t.pickup_datetime, '%a') AS pickup_day_of_week,
    CAST(hour(t.pickup_datetime) AS INTEGER) AS pickup_hour,
    CAST(month(t.pickup_datetime) AS INTEGER) AS pickup_month,
    CAST(year(t.pickup_datetime) AS INTEGER) AS pickup_year,
    CAST(_secs AS BIGINT) AS trip_duration_seconds,
    CASE WHEN _secs >= 0 THEN {half_up_div('100 * _secs', '60')} END AS _min_h,
    CASE WHEN _secs > 0 AND t.trip_distance_miles > 0 THEN CAST({speed} * 100 AS BIGINT) END AS _speed_h,
    CASE WHEN _fc > 0 THEN {half_up_div('10000 * CAST(_tc AS HUGEINT)', '_fc')} END AS _tipp_h,
    CASE WHEN t.trip_distance_miles > 0 THEN CAST({fpm} * 100 AS BIGINT) END AS _fpm_h,
    CASE WHEN _secs > 0 AND _fc >= 0 THEN {half_up_div('CAST(_fc AS HUGEINT) * 1000000', mn)} END AS _fpmin_h
  FROM {source} t"""


def _fact_filter(source: str = "measured") -> str:
    return f"""  SELECT * FROM {source}
  WHERE trip_duration_seconds > 0 AND trip_duration_seconds < {facts.MAX_TRIP_SECONDS}
    AND trip_distance_miles >= 0 AND trip_distance_miles < {facts.MAX_TRIP_MILES}
    AND fare_amount >= 0 AND total_amount >= 0"""


def lookup_ctes(zone_rows=None) -> list[tuple[str, str]]:
    ctes = [("zones_raw", "  SELECT * FROM " + fixture.zones_sql(zone_rows)),
            ("stg_zones", """  SELECT CAST(LocationID AS INTEGER) AS location_id, trim(Borough) AS borough,
    trim(Zone) AS zone_name, trim(service_zone) AS service_zone FROM zones_raw"""),
            ("dim", _dim_sql())]
    for name in schemas.SEEDS:
        ctes.append((name, "  SELECT * FROM " + fixture.seed_sql(name)))
    return ctes


def staging_ctes(raw_sql: str, prefix: str = "") -> list[tuple[str, str]]:
    """raw -> renamed -> distinct -> keyed, for one raw relation."""
    p = prefix
    return [
        (f"{p}raw", raw_sql),
        (f"{p}stg_renamed", _stg_renamed(f"{p}raw")),
        (f"{p}stg_dedup", f"  SELECT DISTINCT * FROM {p}stg_renamed"),
        (f"{p}stg", f"  SELECT {surrogate_key_sql(schemas.TRIP_KEY_COLUMNS)} AS trip_id, * FROM {p}stg_dedup"),
    ]


def fact_ctes(prefix: str = "", source: str | None = None) -> list[tuple[str, str]]:
    p = prefix
    return [
        (f"{p}enriched", _enriched_sql(source or f"{p}stg")),
        (f"{p}measured", _measures_sql(f"{p}enriched")),
        (f"{p}fact", _fact_filter(f"{p}measured")),
    ]


def base_ctes(*, collide: bool = False) -> list[tuple[str, str]]:
    return staging_ctes(fixture.raw_trips_sql(collide=collide)) + lookup_ctes() + fact_ctes()


# --------------------------------------------------------------------------
# Output projections (DOUBLE for every decimal)

FACT_OUTPUT = {
    "trip_duration_minutes": h_to_double("_min_h"),
    "avg_speed_mph": h_to_double("_speed_h"),
    "tip_percentage": h_to_double("_tipp_h"),
    "fare_per_mile": h_to_double("_fpm_h"),
    "fare_per_minute": h_to_double("_fpmin_h"),
}
for _m in schemas.MONEY_COLUMNS:
    FACT_OUTPUT[_m] = f"CAST({_m} AS DOUBLE)"


def fact_select(columns) -> str:
    return ", ".join(f"{FACT_OUTPUT[c]} AS {c}" if c in FACT_OUTPUT else c for c in columns)


def _cnt(cond: str) -> str:
    return f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


def _avg_h(h: str) -> str:
    """round(avg(x), 2) of a cents-exact decimal given as hundredths h."""
    return (f"(CAST(((2 * sum({h}) + count({h})) // nullif(2 * count({h}), 0)) AS DOUBLE) / 100.0::DOUBLE)")


def _pct(cond: str, n: str = "count(*)") -> str:
    k = f"sum(CASE WHEN {cond} THEN 1 ELSE 0 END)"
    return f"(CAST(((20000 * {k} + {n}) // nullif(2 * {n}, 0)) AS DOUBLE) / 100.0::DOUBLE)"


def _money_h(c: str) -> str:
    return f"CAST(round({c} * 100) AS BIGINT)"


def _miles4() -> str:
    return "CAST(trip_distance_miles * 4 AS BIGINT)"


def mart_metrics_sql(name: str) -> list[str]:
    n = "count(*)"
    avg_miles = f"(CAST(((50 * sum({_miles4()}) + {n}) // (2 * {n})) AS DOUBLE) / 100.0::DOUBLE)"
    sum_money = lambda c: f"CAST(sum({c}) AS DOUBLE)"
    avg_money = lambda c: _avg_h(_money_h(c))
    common = {
        "trip_count": f"CAST({n} AS BIGINT)",
        "total_passengers": "CAST(sum(passenger_count) AS BIGINT)",
        "avg_tip_percentage": _avg_h("_tipp_h"),
        "total_distance_miles": "CAST(round(sum(trip_distance_miles), 2) AS DOUBLE)",
        "avg_distance_miles": avg_miles,
        "avg_duration_minutes": _avg_h("_min_h"),
        "avg_speed_mph": _avg_h("_speed_h"),
        "credit_card_trips": _cnt("payment_type_id = 1"),
        "cash_trips": _cnt("payment_type_id = 2"),
        "rush_hour_trips": _cnt("is_rush_hour"),
    }
    if name == "agg_daily_zone_summary":
        m = dict(common)
        m.update({"total_fare": sum_money("fare_amount"), "total_tips": sum_money("tip_amount"),
                  "total_tolls": sum_money("tolls_amount"), "total_revenue": sum_money("total_amount"),
                  "avg_fare": avg_money("fare_amount"), "avg_tip": avg_money("tip_amount"),
                  "avg_total": avg_money("total_amount")})
        order = _metric_names(name)
    elif name == "agg_hourly_demand":
        m = dict(common)
        m.update({"total_revenue": sum_money("total_amount"),
                  "avg_revenue_per_trip": avg_money("total_amount"),
                  "airport_trip_count": _cnt("is_airport_trip"),
                  "airport_pickup_count": _cnt("is_airport_pickup"),
                  "cross_borough_trip_count": _cnt(f"trip_borough_type = '{X.CROSS_BOROUGH}'")})
        order = _metric_names(name)
    elif name == "agg_monthly_zone_summary":
        m = dict(common)
        days = "count(DISTINCT pickup_date)"
        m.update({"active_days": f"CAST({days} AS BIGINT)",
                  "avg_daily_trips": f"CAST({sround2(f'{n} / nullif({days}, 0)')} AS DOUBLE)",
                  "total_fare": sum_money("fare_amount"), "total_tips": sum_money("tip_amount"),
                  "total_tolls": sum_money("tolls_amount"), "total_revenue": sum_money("total_amount"),
                  "avg_fare": avg_money("fare_amount"), "avg_tip": avg_money("tip_amount"),
                  "avg_total": avg_money("total_amount"),
                  "credit_card_pct": _pct("payment_type_id = 1"),
                  "weekend_trips": _cnt("is_weekend"), "late_night_trips": _cnt("is_late_night")})
        order = _metric_names(name)
    else:
        m = dict(common)
        m.update({"avg_passengers_per_trip": f"CAST({sround2('avg(passenger_count)')} AS DOUBLE)",
                  "total_revenue": sum_money("total_amount"),
                  "avg_revenue_per_trip": avg_money("total_amount"),
                  "avg_fare_per_mile": _avg_h("_fpm_h"),
                  "avg_fare_per_minute": _avg_h("_fpmin_h"),
                  "total_tips": sum_money("tip_amount"),
                  "credit_card_pct": _pct("payment_type_id = 1"),
                  "cash_pct": _pct("payment_type_id = 2"),
                  "store_and_fwd_pct": _pct("store_and_fwd_flag = 'Y'"),
                  "airport_trip_pct": _pct("is_airport_trip"),
                  "rush_hour_trip_pct": _pct("is_rush_hour")})
        order = _metric_names(name)
    return [f"{m[c]} AS {c}" for c in order]


def _metric_names(name: str) -> list[str]:
    return MART_METRIC_NAMES[name]


MART_METRIC_NAMES = {
    "agg_daily_zone_summary": [
        "trip_count", "total_passengers", "total_fare", "total_tips", "total_tolls", "total_revenue",
        "avg_fare", "avg_tip", "avg_total", "avg_tip_percentage", "total_distance_miles",
        "avg_distance_miles", "avg_duration_minutes", "avg_speed_mph", "credit_card_trips",
        "cash_trips", "rush_hour_trips"],
    "agg_hourly_demand": [
        "trip_count", "total_passengers", "total_revenue", "avg_revenue_per_trip",
        "avg_distance_miles", "avg_duration_minutes", "avg_speed_mph", "avg_tip_percentage",
        "airport_trip_count", "airport_pickup_count", "cross_borough_trip_count"],
    "agg_monthly_zone_summary": [
        "trip_count", "total_passengers", "active_days", "avg_daily_trips", "total_fare",
        "total_tips", "total_tolls", "total_revenue", "avg_fare", "avg_tip", "avg_total",
        "avg_tip_percentage", "total_distance_miles", "avg_distance_miles", "avg_duration_minutes",
        "avg_speed_mph", "credit_card_trips", "cash_trips", "credit_card_pct", "rush_hour_trips",
        "weekend_trips", "late_night_trips"],
    "agg_vendor_performance": [
        "trip_count", "total_passengers", "avg_passengers_per_trip", "total_revenue",
        "avg_revenue_per_trip", "avg_fare_per_mile", "avg_fare_per_minute", "avg_distance_miles",
        "avg_duration_minutes", "avg_speed_mph", "avg_tip_percentage", "total_tips",
        "credit_card_pct", "cash_pct", "store_and_fwd_pct", "airport_trip_pct",
        "rush_hour_trip_pct"],
}


def mart_sql(name: str, source: str = "fact") -> str:
    keys = marts.MARTS[name][0]
    cols = ", ".join(keys)
    metrics = ",\n    ".join(mart_metrics_sql(name))
    return f"  SELECT {cols},\n    {metrics}\n  FROM {source}\n  GROUP BY {cols}"
