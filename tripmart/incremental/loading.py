"""Incremental loading of the fact and the marts.

Two modes:

``reference``
    The high-water-mark rule as the models state it: take source rows
    strictly above ``max(<mark>)`` of the existing target, then merge them
    into the target on the table's unique key (update matched, insert new;
    plain equality, so NULL keys never match).  Reproduced literally, with
    its consequences: late rows at or below the mark are lost, a stray
    future pickup raises the mark, the monthly marts re-aggregate their
    newest month without its first day, and an existing empty target loads
    nothing.

``safe`` (default)
    Whole-grain recomputation: every pickup month touched by the raw months
    of this run (old and new content) is rebuilt from all staged rows of that
    month and its partitions replaced (dynamic partition overwrite).  All
    four marts have grains inside one month, so rebuilding whole months is
    exact: N monthly runs in any order, with reruns, equal one full load.

Everything here has a lazy DataFrame form (used by the registered queries,
the watermark as a scalar subquery) and a table form over Parquet paths
(used by the pipeline, the watermark collected once as a literal so file
statistics can skip row groups).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.operators import facts, marts
from tripmart.plans import sinks

REFERENCE, SAFE = "reference", "safe"
FACT_KEY = ["trip_id"]

# Watermark of each incremental table: (target expression, source column).
def _month_start() -> Column:
    return F.make_date(F.col("pickup_year"), F.col("pickup_month"), F.lit(1))


WATERMARKS = {
    "fact_yellow_taxi_trips": (lambda: F.col("pickup_datetime"), "pickup_datetime"),
    "agg_daily_zone_summary": (lambda: F.col("pickup_date"), "pickup_date"),
    "agg_hourly_demand": (lambda: F.col("pickup_date"), "pickup_date"),
    "agg_monthly_zone_summary": (_month_start, "pickup_date"),
    "agg_vendor_performance": (_month_start, "pickup_date"),
}


# --------------------------------------------------------------------------
# Lazy forms

def above_watermark(source: DataFrame, table: str, target: DataFrame) -> DataFrame:
    """Source rows strictly above the target's high-water mark.

    The mark is an uncorrelated scalar subquery (planned once).  An empty
    target gives a NULL mark, so no row passes, as in the reference rule."""
    target_expr, source_col = WATERMARKS[table]
    mark = target.select(F.max(target_expr())).scalar()
    return source.filter(F.col(source_col) > mark)


def _renamed_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct key tuples under private names (avoids self-join ambiguity
    when target and source share lineage)."""
    return df.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()


def _key_match(target: DataFrame, keys: Sequence[str], null_safe: bool) -> Column:
    out = None
    for k in keys:
        c = target[k].eqNullSafe(F.col(f"_k_{k}")) if null_safe else target[k] == F.col(f"_k_{k}")
        out = c if out is None else out & c
    return out


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Keyed upsert: target rows whose key appears in ``source`` are replaced
    by the source rows; other target rows stay; new keys are inserted.

    A left-anti join on the keys plus a union -- one shuffle of each side by
    key (or a broadcast of the source keys when AQE sees they are small).
    ``null_safe`` matches NULL keys to each other (safe mode); plain
    equality never matches them (reference merge)."""
    return unmatched(target, source, keys, null_safe).unionByName(source.select(*target.columns))


def unmatched(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """The target rows that a keyed upsert of ``source`` keeps."""
    return target.join(_renamed_keys(source, keys), _key_match(target, keys, null_safe), "left_anti")


def replace_grains(target: DataFrame, rebuilt: DataFrame, grain_cols: Sequence[str]) -> DataFrame:
    """Safe mode, lazily: drop every target grain (e.g. month) present in
    ``rebuilt`` and add the rebuilt rows.  The grains are few: they go to the target's rows."""
    kept = target.join(F.broadcast(_renamed_keys(rebuilt, grain_cols)), _key_match(target, grain_cols, True), "left_anti")
    return kept.unionByName(rebuilt.select(*target.columns))


def incremental_fact(stg: DataFrame, lk: facts.Lookups, target: DataFrame | None) -> DataFrame:
    """Reference rule for the fact: watermark on staging, then merge on trip_id."""
    if target is None:
        return facts.fact_trips(stg, lk)
    fresh = facts.fact_trips(above_watermark(stg, "fact_yellow_taxi_trips", target), lk)
    return merge_upsert(target, fresh, FACT_KEY)


def incremental_mart(name: str, fact: DataFrame, target: DataFrame | None) -> DataFrame:
    """Reference rule for a mart: watermark on the fact, regroup, merge on the mart key.

    The regrouped rows are staged: the merge reads them twice (keys and rows), and each
    reading would run the fact's plan again."""
    if target is None:
        return marts.build_mart(name, fact)
    fresh, _ = sinks.stage(fact.sparkSession, marts.build_mart(name, above_watermark(fact, name, target)), "fresh-mart")
    return merge_upsert(target, fresh, marts.MERGE_KEYS[name])


def months_of(df: DataFrame, year_col: str, month_col: str) -> DataFrame:
    return df.select(F.col(year_col).alias("pickup_year"), F.col(month_col).alias("pickup_month")).distinct()


def safe_rebuild_fact(stg: DataFrame, lk: facts.Lookups, months: DataFrame) -> DataFrame:
    """Fact rows of whole pickup months, rebuilt from every staged row.

    The months go to the rows: dealt by month, a month's rows would meet in one task."""
    fact = facts.fact_trips(stg, lk)
    return fact.join(F.broadcast(months), list(schemas.FACT_PARTITIONS), "left_semi")


# --------------------------------------------------------------------------
# Table forms (paths)

def collect_watermark(target: DataFrame, table: str):
    """The high-water mark as a Python literal (one small aggregate job)."""
    target_expr, _ = WATERMARKS[table]
    return target.agg(F.max(target_expr()).alias("m")).first()["m"]


def stage_merge(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
                partition_cols: Sequence[str] = tuple(schemas.FACT_PARTITIONS), null_safe: bool = False) -> sinks.Staged:
    """Upsert ``source`` into the Parquet table at ``path``, up to publication.

    Only partitions the source touches are read and rewritten (the keys
    determine the partition: a trip key fixes the pickup time, a mart key
    its date/month).  The source is computed and written once, beside the table; the
    rows that the table keeps of those partitions are added there, so the table
    is never overwritten by a plan that reads it.  A partition new to the table is
    neither read again nor merged."""
    from tripmart.plans import fs

    target = sinks.read_table(spark, path)
    if target is None:
        return sinks.stage_partitions(spark, source, path, partition_cols)
    shape = target.unionByName(source.select(*target.columns)).schema  # one type for both, as a union has
    as_shaped = lambda df: df.select(*[F.col(f.name).cast(f.dataType) for f in shape.fields])
    staged = sinks.stage_partitions(spark, as_shaped(source), path, partition_cols)
    if not any(fs.has_data(spark, held) for _, held in staged.moves):
        return staged
    fresh = staged.frame(spark)
    cond = F.lit(False)
    for values in fresh.select(*partition_cols).distinct().collect():
        c = F.lit(True)
        for col, v in zip(partition_cols, values):
            c = c & F.col(col).eqNullSafe(F.lit(v))
        cond = cond | c
    kept = as_shaped(unmatched(target.filter(cond), fresh, keys, null_safe))
    kept.write.mode("append").partitionBy(*partition_cols).parquet(staged.folder)
    return staged


def merge_into_table(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
                     partition_cols: Sequence[str] = tuple(schemas.FACT_PARTITIONS),
                     null_safe: bool = False) -> None:
    """``stage_merge``, then the merged partitions take the place of the old ones."""
    stage_merge(spark, path, source, keys, partition_cols, null_safe).publish(spark)


def replace_months_in_table(spark: SparkSession, path: str, rebuilt: DataFrame,
                            months: Sequence[tuple[int, int]],
                            partition_cols: Sequence[str] = tuple(schemas.FACT_PARTITIONS)) -> None:
    """Safe mode: replace whole month partitions of the table at ``path``; months of
    ``months`` without rows are cleared (their trips disappeared from raw)."""
    sinks.stage_partitions(spark, rebuilt, path, partition_cols, months).publish(spark)


# --------------------------------------------------------------------------
# What a delivery changes

def month_digests(raw: DataFrame) -> DataFrame:
    """(pickup_year, pickup_month, digest) of raw trips: an order-free digest of the
    multiset of rows (their 19 columns, NULLs told apart) of each pickup month.

    The exact sum of the row hashes is kept as the sums of their lower, middle and upper
    thirds: whole numbers, which 2^41 rows of a month do not exceed."""
    columns = [F.col(c) for c in schemas.RAW_TRIP_COLUMNS]
    bit = lambda i: F.lit(1 << i).cast("bigint")
    nulls = reduce(Column.__add__, [F.when(c.isNull(), bit(i)).otherwise(F.lit(0).cast("bigint")) for i, c in enumerate(columns)])
    at = F.col("tpep_pickup_datetime")
    rows = raw.select(F.year(at).alias("pickup_year"), F.month(at).alias("pickup_month"),
                      F.xxhash64(*columns, nulls).alias("h")).filter("pickup_year IS NOT NULL")
    h, third = F.col("h"), F.lit((1 << 21) - 1).cast("bigint")
    sums = [F.sum(h.bitwiseAND(third)), F.sum(F.shiftright(h, 21).bitwiseAND(third)), F.sum(F.shiftright(h, 42))]
    return (rows.groupBy("pickup_year", "pickup_month")
            .agg(F.concat_ws(":", F.count(F.lit(1)).cast("string"), *[s.cast("string") for s in sums],
                             F.bit_xor("h").cast("string")).alias("digest")))


def changed_months(old: DataFrame, new: DataFrame) -> DataFrame:
    """Pickup months whose digests differ (one side may lack the month)."""
    pair = ["pickup_year", "pickup_month"]
    both = old.withColumnRenamed("digest", "_old").join(new.withColumnRenamed("digest", "_new"), pair, "full")
    return both.filter(~F.col("_old").eqNullSafe(F.col("_new")) | F.col("_old").isNull()).select(*pair)
