"""Declarative data-quality checks: not_null, unique, accepted_values,
relationships, grain, with a severity gate.

Checks are data (``Check``); results are a Spark DataFrame with one row per
check: (model, column_name, test, severity, failures, status).  Failure
counts follow the usual SQL test conventions: failing rows for not_null and
relationships, failing distinct values for unique and accepted_values; NULL
passes accepted_values and relationships.

Cost at scale: per model, all not_null and relationships checks share ONE
aggregate pass; accepted_values filters on the column (the scan prunes by
statistics) and each unique check is one partially aggregated groupBy.  The
report is a handful of rows; only the gate collects it.  ``failing_rows``
returns the rows behind a count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NOT_NULL, UNIQUE, ACCEPTED, RELATIONSHIPS = "not_null", "unique", "accepted_values", "relationships"
GRAIN = "grain"  # the columns (comma-separated) name one row
ERROR, WARN = "error", "warn"

REPORT_SCHEMA = T.StructType([
    T.StructField("model", T.StringType(), False),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("test", T.StringType(), False),
    T.StructField("severity", T.StringType(), False),
    T.StructField("failures", T.LongType(), False),
    T.StructField("status", T.StringType(), False),
])


class DataQualityError(RuntimeError):
    """At least one error-severity check failed."""

    def __init__(self, failed_rows, decided=()):
        self.failed = failed_rows
        self.decisions = list(decided)
        lines = [f"{r['model']}.{r['column_name']} {r['test']}: {r['failures']}" for r in failed_rows]
        blocked = [r["model"] for r in self.decisions if r["decision"] == BLOCKED]
        if blocked:
            lines.append("not built: " + ", ".join(blocked))
        super().__init__("data-quality checks failed:\n  " + "\n  ".join(lines))


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str
    severity: str = ERROR
    values: tuple = field(default=())
    to_model: str | None = None
    to_field: str | None = None


def not_null(model, *columns, severity=ERROR):
    return [Check(model, c, NOT_NULL, severity) for c in columns]


# The declared checks of every model (60 checks).
STG_TRIPS, STG_ZONES, DIM, FACT = ("stg_yellow_taxi_trips", "stg_taxi_zone_lookup", "dim_location",
                                   "fact_yellow_taxi_trips")
DAILY, MONTHLY, HOURLY, VENDOR = ("agg_daily_zone_summary", "agg_monthly_zone_summary",
                                  "agg_hourly_demand", "agg_vendor_performance")
DECLARED_CHECKS: list[Check] = [
    *not_null(STG_TRIPS, "trip_id", "vendor_id", "pickup_datetime", "dropoff_datetime",
              "pickup_location_id", "dropoff_location_id"),
    Check(STG_ZONES, "location_id", UNIQUE),
    *not_null(STG_ZONES, "location_id", "borough", "zone_name", "service_zone"),
    Check(DIM, "location_id", UNIQUE),
    *not_null(DIM, "location_id", "borough", "zone_name", "service_zone"),
    Check(DIM, "borough_group", ACCEPTED, values=("Manhattan", "Outer Borough", "New Jersey", "Other")),
    *not_null(FACT, "trip_id"),
    Check(FACT, "trip_id", UNIQUE),
    *not_null(FACT, "pickup_datetime", "dropoff_datetime", "pickup_date"),
    Check(FACT, "pickup_day_of_week", ACCEPTED, values=("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")),
    *not_null(FACT, "pickup_hour", "pickup_month", "pickup_year", "trip_duration_seconds",
              "trip_duration_minutes", "trip_distance_miles", "vendor_id"),
    Check(FACT, "vendor_id", RELATIONSHIPS, WARN, to_model="vendor", to_field="vendor_id"),
    Check(FACT, "rate_code_id", RELATIONSHIPS, to_model="rate_code", to_field="rate_code_id"),
    Check(FACT, "payment_type_id", RELATIONSHIPS, to_model="payment_type", to_field="payment_type_id"),
    Check(FACT, "store_and_fwd_flag", ACCEPTED, values=("Y", "N")),
    *not_null(FACT, "pickup_location_id"),
    Check(FACT, "pickup_location_id", RELATIONSHIPS, to_model=DIM, to_field="location_id"),
    *not_null(FACT, "dropoff_location_id"),
    Check(FACT, "dropoff_location_id", RELATIONSHIPS, to_model=DIM, to_field="location_id"),
    *not_null(FACT, "fare_amount", "total_amount", "is_rush_hour", "is_weekend", "is_late_night",
              "is_airport_trip"),
    Check(FACT, "trip_borough_type", ACCEPTED, values=("Same Borough", "Cross Borough")),
    *not_null(DAILY, "pickup_date", "pickup_zone", "trip_count"),
    *not_null(MONTHLY, "pickup_year", "pickup_month", "pickup_zone", "trip_count"),
    *not_null(HOURLY, "pickup_date", "pickup_hour", "pickup_borough", "trip_count"),
    *not_null(VENDOR, "pickup_year", "pickup_month", "vendor_id", "trip_count"),
]

# The marts are merged by keys narrower than their groups (a zone name spanning two
# boroughs would make two rows of one key): asserted before a mart is public.
GRAIN_CHECKS: list[Check] = [
    Check(DAILY, "pickup_date,pickup_zone", GRAIN),
    Check(MONTHLY, "pickup_year,pickup_month,pickup_zone", GRAIN),
    Check(HOURLY, "pickup_date,pickup_hour,pickup_borough", GRAIN),
    Check(VENDOR, "pickup_year,pickup_month,vendor_id", GRAIN),
]
ALL_CHECKS: list[Check] = DECLARED_CHECKS + GRAIN_CHECKS

# What each model is built from.
PARENTS_OF: dict[str, tuple[str, ...]] = {
    STG_TRIPS: (), STG_ZONES: (), DIM: (STG_ZONES,), FACT: (STG_TRIPS, DIM),
    DAILY: (FACT,), MONTHLY: (FACT,), HOURLY: (FACT,), VENDOR: (FACT,),
}
PASSED, FAILED, BLOCKED = "passed", "failed", "blocked"


def _rows(model: str, checks: Sequence[Check], counts: DataFrame) -> DataFrame:
    """Turn a one-row DataFrame of counts (one column per check) into report rows."""
    parts = [F.struct(F.lit(c.column).alias("column_name"), F.lit(c.test).alias("test"),
                      F.lit(c.severity).alias("severity"),
                      F.col(f"_c{i}").cast("bigint").alias("failures"))
             for i, c in enumerate(checks)]
    out = counts.select(F.explode(F.array(*parts)).alias("r")).select("r.*")
    return out.select(F.lit(model).alias("model"), "column_name", "test", "severity",
                      F.coalesce(F.col("failures"), F.lit(0).cast("bigint")).alias("failures"))


def _single_pass(model: str, df: DataFrame, checks: Sequence[Check],
                 parents: Mapping[str, DataFrame]) -> tuple[DataFrame | None, list[Check]]:
    """One aggregate over ``df`` for every check on single rows.

    A parent's distinct keys come in by a left join (Spark broadcasts a small
    side and shuffles a large one); a child row without a match fails."""
    aggs, done, rest = [], [], []
    for c in checks:
        if c.test == GRAIN:
            rest.append(c)
            continue
        col = F.col(c.column)
        if c.test == NOT_NULL:
            agg = F.count_if(col.isNull())
        elif c.test == RELATIONSHIPS:
            k, hit = f"_k{len(done)}", f"_hit{len(done)}"
            keys = parents[c.to_model].select(F.col(c.to_field).alias(k)).distinct().withColumn(hit, F.lit(True))
            df = df.join(keys, df[c.column] == keys[k], "left")
            agg = F.count_if(col.isNotNull() & F.col(hit).isNull())
        else:
            rest.append(c)
            continue
        aggs.append(agg.alias(f"_c{len(done)}"))
        done.append(c)
    if not done:
        return None, rest
    if all(c.test == NOT_NULL for c in done):
        # Only rows with some NULL can fail: the filter reaches the scan (and
        # passes below a lazy dedup), so clean data costs almost nothing.
        any_null = None
        for c in done:
            any_null = F.col(c.column).isNull() if any_null is None else any_null | F.col(c.column).isNull()
        df = df.filter(any_null)
    return _rows(model, done, df.agg(*aggs)), rest


def failing_rows(df: DataFrame, c: Check, parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The rows of the tested model that fail check ``c``: with a NULL, with a
    value that is not accepted, without a parent, or with a repeated key."""
    col = F.col(c.column) if c.test != GRAIN else None
    if c.test == NOT_NULL:
        return df.filter(col.isNull())
    if c.test == ACCEPTED:
        return df.filter(col.isNotNull() & ~col.isin(list(c.values)))
    if c.test == RELATIONSHIPS:
        keys = (parents or {})[c.to_model].select(F.col(c.to_field).alias("_k"))
        return df.filter(col.isNotNull()).join(keys, df[c.column] == keys["_k"], "left_anti")
    if c.test == GRAIN:
        key = [F.col(k) for k in c.column.split(",")]
        again = df.groupBy(F.struct(*key).alias("_k")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
        return df.join(again, F.struct(*key) == F.col("_k"), "left_semi")
    if c.test == UNIQUE:
        keys = (df.filter(col.isNotNull()).groupBy(col.alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
                .filter(F.col("_n") > 1).select("_k"))
        return df.join(keys, F.col(c.column) == F.col("_k"), "left_semi")
    raise ValueError(f"unknown test {c.test}")


def _keyed(model: str, df: DataFrame, c: Check) -> DataFrame:
    """A check on values: a filter that the scan can prune, then a groupBy."""
    if c.test == GRAIN:
        bad = (df.groupBy(*c.column.split(",")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))
        return _rows(model, [c], bad.agg(F.count(F.lit(1)).alias("_c0")))
    col = F.col(c.column)
    if c.test == UNIQUE:
        bad = (df.filter(col.isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
               .filter(F.col("n") > 1))
    elif c.test == ACCEPTED:
        bad = failing_rows(df, c).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    else:
        raise ValueError(f"unknown test {c.test}")
    return _rows(model, [c], bad.agg(F.count(F.lit(1)).alias("_c0")))


def run_checks(models: Mapping[str, DataFrame], checks: Sequence[Check] = tuple(DECLARED_CHECKS),
               parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The report DataFrame for every check whose model is given."""
    parents = dict(parents or {})
    parents.update(models)
    parts = []
    for model, df in models.items():
        mine = [c for c in checks if c.model == model]
        if not mine:
            continue
        single, rest = _single_pass(model, df, mine, parents)
        if single is not None:
            parts.append(single)
        parts.extend(_keyed(model, df, c) for c in rest)
    if not parts:
        spark = next(iter(models.values())).sparkSession
        return spark.createDataFrame([], REPORT_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", F.when(F.col("failures") == 0, F.lit("pass"))
                          .when(F.col("severity") == WARN, F.lit("warn")).otherwise(F.lit("fail")))


def _ancestors() -> list[tuple[str, str]]:
    """(model, model it depends on, directly or not)."""
    def above(model: str) -> set[str]:
        return set(PARENTS_OF[model]).union(*[above(p) for p in PARENTS_OF[model]])
    return [(m, a) for m in PARENTS_OF for a in sorted(above(m))]


def decisions(report: DataFrame) -> DataFrame:
    """The gate as data: (model, decision, failed_checks, blocked_by, reason) of every
    model.

    A model with a failed check of its own is ``failed``; one below a failed model is
    ``blocked`` and is not built or made public; warnings stop nothing.  ``blocked_by``
    lists failed models above it, ``reason`` the failed checks that decide."""
    spark = report.sparkSession
    text = F.concat_ws(" ", F.concat_ws(".", "model", "column_name"), F.concat("test", F.lit(":")), F.col("failures").cast("string"))
    failed = (report.filter(F.col("status") == "fail").groupBy(F.col("model").alias("_m"))
              .agg(F.count(F.lit(1)).alias("_n"), F.concat_ws("; ", F.sort_array(F.collect_list(text))).alias("_why")))
    models = spark.createDataFrame([(m,) for m in PARENTS_OF], "model string")
    above = spark.createDataFrame(_ancestors(), "below string, above string")
    blocked = (above.join(failed, F.col("above") == F.col("_m")).groupBy("below")
               .agg(F.concat_ws(",", F.sort_array(F.collect_list("above"))).alias("blocked_by"),
                    F.concat_ws("; ", F.sort_array(F.collect_list("_why"))).alias("_above")))
    out = (models.join(failed, F.col("model") == F.col("_m"), "left").join(blocked, F.col("model") == F.col("below"), "left"))
    return out.select(
        "model", F.when(F.col("blocked_by").isNotNull(), BLOCKED).when(F.col("_n").isNotNull(), FAILED).otherwise(PASSED).alias("decision"),
        F.coalesce("_n", F.lit(0)).cast("bigint").alias("failed_checks"), "blocked_by",
        F.coalesce("_above", "_why").alias("reason"))


def gate(report: DataFrame, raise_on_error: bool = True) -> list:
    """Collect the (small) report; raise if an error-severity check failed.
    Warnings are returned, not raised."""
    rows = report.collect()
    failed = [r for r in rows if r["status"] == "fail"]
    if failed and raise_on_error:
        seen = report.sparkSession.createDataFrame([tuple(r[c] for c in REPORT_SCHEMA.fieldNames()) for r in failed], REPORT_SCHEMA)
        raise DataQualityError(failed, decisions(seen).collect())
    return rows
