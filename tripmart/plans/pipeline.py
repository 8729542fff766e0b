"""End-to-end monthly run: ingest -> staging -> dimension -> fact -> marts ->
export, with data-quality gates between them.

Only the dimension, fact and marts are materialised; staging stays a lazy
plan over the raw table so Catalyst fuses it with each consumer.  Tables are
Parquet directories laid out by environment namespace under one root.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import schemas
from tripmart.operators import facts, marts, quality, staging
from tripmart.plans import fs, moves, sinks
from tripmart.sources import drift, lookups, trips
from tripmart.incremental import loading as inc

# Export file name pattern and layer labels.
EXPORT_NAME = "AGG_MONTHLY_ZONE_SUMMARY_{year:04d}_{month:02d}"
DEFAULT_LAYER = "CURATED"


def namespace(env: str, layer: str | None = None) -> str:
    """Per-environment namespace: ``{env}_CURATED`` without a label, else
    ``{env}_{LABEL}`` upper-cased."""
    return f"{env}_{(layer or DEFAULT_LAYER).strip().upper()}"


def export_name(year: int, month: int) -> str:
    return EXPORT_NAME.format(year=int(year), month=int(month))


@dataclass
class Layout:
    root: str
    env: str

    def _p(self, layer: str | None, name: str) -> str:
        return f"{self.root.rstrip('/')}/{namespace(self.env, layer)}/{name}"

    @property
    def raw_trips(self) -> str:
        return self._p("EDL", "yellow_taxi_trips")

    @property
    def raw_month_index(self) -> str:
        """(trip_year, trip_month) -> pickup months present in that raw partition, with
        the digest of their rows (NULL while a write is under way)."""
        return self._p("EDL", "yellow_taxi_trips_pickup_months")

    @property
    def pending_months(self) -> str:
        """Pickup months whose trips changed and that no build has rebuilt yet: one
        folder per ingest, ``open`` while it writes and ``closed`` after."""
        return self._p("EDL", "yellow_taxi_trips_pending_months")

    @property
    def rejection_counts(self) -> str:
        """Append-only: rejected rows per run, step and column."""
        return self._p("EDL", "yellow_taxi_trips_rejection_counts")

    @property
    def rejected_at_ingest(self) -> str:
        """Rows of the source files that an ingest cast rejected, as JSON."""
        return self._p("EDL", "yellow_taxi_trips_rejected_at_ingest")

    @property
    def quarantine(self) -> str:
        """Raw rows a staging cast rejected (cast_mode='try')."""
        return self._p("EDL", "yellow_taxi_trips_rejected")

    @property
    def raw_zones(self) -> str:
        return self._p("EDL", "taxi_zone_lookup")

    @property
    def dim_location(self) -> str:
        return self._p(None, "dim_location")

    @property
    def fact(self) -> str:
        return self._p(None, "fact_yellow_taxi_trips")

    def mart(self, name: str) -> str:
        return self._p("MRT", name)

    @property
    def export_dir(self) -> str:
        return self._p("EXPORT", "")

    @property
    def feed_dir(self) -> str:
        return self._p("DATA_FEED", "")


# --------------------------------------------------------------------------
# Ingest

def recover(spark: SparkSession, layout: Layout) -> int:
    """Finish the moves that killed runs left half done, in every table."""
    tables_ = [layout.raw_trips, layout.raw_month_index, layout.rejected_at_ingest, layout.quarantine, layout.raw_zones,
               layout.dim_location, layout.fact, *[layout.mart(n) for n in marts.MARTS]]
    return sum(moves.recover(spark, t) for t in tables_)


def ingest_month(spark: SparkSession, layout: Layout, source_path: str | list[str], year: int, month: int,
                 source_file_size_mb: float | None = None, reset: bool = False,
                 cast_mode: str = "ansi") -> set[tuple[int, int]]:
    """S1 + P1-P3 + K1: load one monthly file (or the files of a month, whose types may
    differ) into its raw partition.

    Returns the pickup months whose trips changed, old content against new, by the
    digests of their rows: a file that comes again unchanged changes none.  They
    are written down as pending, and the month index is widened to them, before the
    raw partition changes: a run that dies anywhere leaves months to rebuild that
    the next build finds.  ``cast_mode='try'`` sets rows that an ingest cast rejects
    aside instead of failing."""
    partition = {"trip_year": int(year), "trip_month": int(month)}
    if reset:
        reset_raw(spark, layout)
    paths = [source_path] if isinstance(source_path, str) else list(source_path)
    raw = trips.read_trip_month(spark, paths[0]) if len(paths) == 1 else drift.read_widened(spark, paths)
    run = uuid.uuid4().hex
    if cast_mode == "try":
        raw, rejected = trips.split_bad_rows(raw)
        sinks.replace_partition(spark, rejected, layout.rejected_at_ingest, partition)
        count_rejections(spark, layout, run, "ingest", _read_partition(spark, layout.rejected_at_ingest, partition))
    size = source_file_size_mb
    if size is None:
        size = sum(_size_mb(spark, p) for p in paths)
    normalised = trips.normalise_raw_trips(raw, year, month, execution_id=str(uuid.uuid4()),
                                           source_file=",".join(os.path.basename(p.rstrip("/")) for p in paths),
                                           source_file_size_mb=size)
    moves.recover(spark, layout.raw_trips)
    old, new = _old_digests(spark, layout, partition), _collected(inc.month_digests(normalised))
    changed = {m for m in old.keys() | new.keys() if old.get(m) is None or old.get(m) != new.get(m)}
    _open_pending(spark, layout, run, partition, changed)
    _write_months(spark, layout.raw_month_index, partition, {m: None for m in old.keys() | new.keys()})
    sinks.replace_partition(spark, normalised.drop("trip_year", "trip_month"), layout.raw_trips, partition)
    _write_months(spark, layout.raw_month_index, partition, new)
    _close_pending(spark, layout, run, partition, changed)
    return changed


def reset_raw(spark: SparkSession, layout: Layout) -> None:
    """K4: drop the raw trips with their month index and rejected rows.  What
    the dropped partitions held stays pending, so that a build clears it."""
    if fs.has_data(spark, layout.raw_month_index):
        held = spark.read.parquet(layout.raw_month_index).select("pickup_year", "pickup_month").distinct().collect()
        months = {(r["pickup_year"], r["pickup_month"]) for r in held}
        run, everywhere = uuid.uuid4().hex, {"trip_year": 0, "trip_month": 0}
        _close_pending(spark, layout, run, everywhere, months)
    for path in (layout.raw_trips, layout.raw_month_index, layout.quarantine, layout.rejected_at_ingest):
        sinks.reset_table(spark, path, layout.root)


INDEX_SCHEMA = "pickup_year int, pickup_month int, digest string"
PENDING_SCHEMA = "trip_year int, trip_month int, pickup_year int, pickup_month int"


def _collected(digests: DataFrame) -> dict[tuple[int, int], str | None]:
    """A few rows: the pickup months of one delivery."""
    return {(r["pickup_year"], r["pickup_month"]): r["digest"] for r in digests.collect()}


def _partition_folder(table: str, partition: Mapping[str, int]) -> str:
    return f"{table.rstrip('/')}/{sinks.partition_folder(list(partition), list(partition.values()))}"


def _read_partition(spark: SparkSession, table: str, partition: Mapping[str, int]) -> DataFrame | None:
    folder = _partition_folder(table, partition)
    return spark.read.parquet(folder) if fs.has_data(spark, folder) else None


def _old_digests(spark: SparkSession, layout: Layout, partition: dict) -> dict[tuple[int, int], str | None]:
    """Pickup months of a raw partition's current content and their digests: from
    the month index, else (no index yet) from a scan of the partition."""
    folder = _partition_folder(layout.raw_month_index, partition)
    if fs.has_data(spark, folder):
        return _collected(spark.read.schema(INDEX_SCHEMA).parquet(folder))
    held = _read_partition(spark, layout.raw_trips, partition)
    return _collected(inc.month_digests(held)) if held is not None else {}


def _values(spark: SparkSession, schema: str, rows: Iterable[tuple]) -> DataFrame:
    """A few rows as one partition."""
    names = ", ".join(c.split()[0] for c in schema.split(", "))
    casts = ", ".join(f"CAST({c.split()[0]} AS {c.split()[1]}) AS {c.split()[0]}" for c in schema.split(", "))
    text = lambda v: "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)
    values = ", ".join("(" + ", ".join(map(text, r)) + ")" for r in rows)
    some = values or "(" + ", ".join("NULL" for _ in names.split(", ")) + ")"
    df = spark.sql(f"SELECT {casts} FROM VALUES {some} AS t({names})").coalesce(1)
    return df if values else df.limit(0)


def _write_months(spark: SparkSession, table: str, partition: dict, months: Mapping[tuple[int, int], str | None]) -> None:
    """Record pickup months and their digests for one raw partition."""
    rows = _values(spark, INDEX_SCHEMA, [(y, m, d) for (y, m), d in sorted(months.items())])
    sinks.replace_partition(spark, rows, table, partition)


def _pending_folder(layout: Layout, run: str, stage: str) -> str:
    return f"{layout.pending_months.rstrip('/')}/run={run}/stage={stage}"


def _write_pending(spark: SparkSession, layout: Layout, run: str, stage: str, partition: dict, months) -> None:
    if months:
        rows = [(partition["trip_year"], partition["trip_month"], y, m) for y, m in sorted(months)]
        _values(spark, PENDING_SCHEMA, rows).write.mode("overwrite").parquet(_pending_folder(layout, run, stage))


def _open_pending(spark: SparkSession, layout: Layout, run: str, partition: dict, months) -> None:
    """Before the raw partition changes.  No build clears an open record: it may
    have read the old rows."""
    _write_pending(spark, layout, run, "open", partition, months)


def _close_pending(spark: SparkSession, layout: Layout, run: str, partition: dict, months) -> None:
    """After it: what earlier, dead ingests of the partition left open is closed too."""
    left = [p for p in pending_records(spark, layout) if p[1] == "open" and p[2:4] == (partition["trip_year"], partition["trip_month"])]
    _write_pending(spark, layout, run, "closed", partition, set(months) | {p[4:6] for p in left})
    for dead in {p[0] for p in left}:
        fs.delete(spark, _pending_folder(layout, dead, "open"))


def pending_records(spark: SparkSession, layout: Layout) -> list[tuple]:
    """(run, stage, trip_year, trip_month, pickup_year, pickup_month) of every record."""
    if not fs.has_data(spark, layout.pending_months):
        return []
    df = spark.read.schema(f"{PENDING_SCHEMA}, run string, stage string").parquet(layout.pending_months)
    return [tuple(r) for r in df.select("run", "stage", "trip_year", "trip_month", "pickup_year", "pickup_month").collect()]


def pending_months(spark: SparkSession, layout: Layout) -> set[tuple[int, int]]:
    """Changed months that no build has finished with."""
    return {p[4:6] for p in pending_records(spark, layout)}


def clear_pending(spark: SparkSession, layout: Layout, rebuilt: list[tuple]) -> None:
    """Drop the records that a build read at its start, and no others: an ingest that
    came in between stays pending."""
    for run in sorted({p[0] for p in rebuilt if p[1] == "closed"}):
        fs.delete(spark, _pending_folder(layout, run, "closed"))


def count_rejections(spark: SparkSession, layout: Layout, run: str, step: str, rejected: DataFrame | None) -> None:
    """Append (run, step, column, rows) of a run's rejected rows; history stays."""
    if rejected is None:
        return
    counts = (rejected.select(F.explode("rejected_columns").alias("column_name")).groupBy("column_name")
              .agg(F.count(F.lit(1)).alias("n_rows")).coalesce(1))
    (counts.select(F.lit(run).alias("run_id"), F.current_timestamp().alias("run_dt"), F.lit(step).alias("step"),
                   "column_name", "n_rows").write.mode("append").parquet(layout.rejection_counts))


def indexed_months(spark: SparkSession, layout: Layout) -> set[tuple[int, int]]:
    """All pickup months that the raw partitions hold."""
    if not fs.has_data(spark, layout.raw_month_index):
        return set(_collected(inc.month_digests(raw_trips_table(spark, layout))))
    rows = spark.read.parquet(layout.raw_month_index).select("pickup_year", "pickup_month").distinct().collect()
    return {(r["pickup_year"], r["pickup_month"]) for r in rows if r["pickup_year"] is not None}


def raw_partitions_for(spark: SparkSession, layout: Layout, months: Iterable[tuple[int, int]]):
    """Raw partitions that can hold trips picked up in ``months`` (from the
    month index); None when no index exists (no pruning then)."""
    if not fs.has_data(spark, layout.raw_month_index):
        return None
    wanted = partition_filter(months)
    rows = spark.read.parquet(layout.raw_month_index).filter(wanted).select("trip_year", "trip_month").distinct().collect()
    return sorted({(r["trip_year"], r["trip_month"]) for r in rows})


def _size_mb(spark: SparkSession, path: str) -> float:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fsys = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fsys.getContentSummary(p).getLength() / 1024 / 1024


def ingest_zones(spark: SparkSession, layout: Layout, csv_path: str) -> None:
    """S2 + K2: the zone lookup, replaced whole."""
    zones = lookups.read_zones(spark, csv_path).withColumns({
        "source_execution_id": F.lit(str(uuid.uuid4())),
        "source_execution_dt": F.current_timestamp(),
        "source_file": F.lit(os.path.basename(csv_path.rstrip("/"))),
    })
    sinks.overwrite_table(zones, layout.raw_zones)


# --------------------------------------------------------------------------
# Build

def raw_trips_table(spark: SparkSession, layout: Layout, parts: list[tuple[int, int]] | None = None) -> DataFrame:
    """The raw trips, or only the given (trip_year, trip_month) partitions: then
    no file of another partition is opened, not even for its schema."""
    if parts is None:
        parts = _raw_partitions(spark, layout)
    folders = [_partition_folder(layout.raw_trips, dict(zip(schemas.PARTITION_COLUMNS, p))) for p in parts]
    folders = [f for f in folders if fs.has_data(spark, f)]
    if folders:
        # months may differ in types and carry extra columns (K3)
        return drift.read_widened(spark, folders, base_path=layout.raw_trips)
    columns = [*schemas.RAW_TRIPS.fields, *[T.StructField(c, T.IntegerType()) for c in schemas.PARTITION_COLUMNS]]
    return spark.createDataFrame([], T.StructType(columns))


def _raw_partitions(spark: SparkSession, layout: Layout) -> list[tuple[int, int]]:
    """(trip_year, trip_month) of every raw folder, from the file listing."""
    value = lambda folder: folder.rstrip("/").rpartition("=")[2]
    years = [f for f in fs.list_files(spark, layout.raw_trips) if "/trip_year=" in f]
    return sorted((int(value(y)), int(value(m))) for y in years for m in fs.list_files(spark, y) if "/trip_month=" in m)


def month_ranges_filter(col: str, months: Iterable[tuple[int, int]]):
    """OR of half-open [month start, next month start) ranges on a timestamp
    column: prunes Parquet row groups by their min/max statistics.  No month,
    no row."""
    cond = None
    for y, m in sorted(months):
        start = dt.datetime(y, m, 1)
        end = dt.datetime(y + (m == 12), m % 12 + 1, 1)
        term = ((F.col(col) >= F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz"))
                & (F.col(col) < F.lit(end.isoformat(sep=" ")).cast("timestamp_ntz")))
        cond = term if cond is None else cond | term
    return cond if cond is not None else F.lit(False)


MART_THREADS = 4


def run_concurrently(tasks: dict, max_workers: int = MART_THREADS) -> dict:
    """Submit independent Spark jobs (e.g. the four mart writes) from a few
    driver threads so their stages share the executors; re-raises the first
    failure.  Each job still plans and runs on the cluster."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max_workers) as pool:
        futures = {name: pool.submit(fn) for name, fn in tasks.items()}
        return {name: f.result() for name, f in futures.items()}


def stage_marts(spark: SparkSession, layout: Layout, fact: DataFrame, months: Iterable[tuple[int, int]] | None = None,
                names: Iterable[str] | None = None, one_pass: bool = False) -> dict[str, sinks.Staged]:
    """The marts (all, or ``names``) from ``fact``, written beside their tables: whole,
    or whole ``months`` only.

    ``one_pass`` reads the fact once, into a state of the finest groups of all marts
    (staged in the shared folder), and rolls the marts up from it; else each mart reads
    the columns it needs.  The results are equal."""
    names = list(names or marts.MARTS)
    months = None if months is None else sorted(months)
    state = state_path = None
    if one_pass:
        state, state_path = sinks.stage(spark, marts.partials(fact, marts.STATE_KEYS), "mart-state")

    def stage(name: str) -> sinks.Staged:
        mart = marts.build_mart(name, fact) if state is None else marts.roll_up(name, state)
        if months is None:
            return sinks.stage_table(mart, layout.mart(name), schemas.FACT_PARTITIONS)
        return sinks.stage_partitions(spark, mart, layout.mart(name), schemas.FACT_PARTITIONS, months)

    staged = run_concurrently({n: (lambda n=n: stage(n)) for n in names})
    if state_path:
        fs.delete(spark, state_path)
    return staged


def write_marts(spark: SparkSession, layout: Layout, fact: DataFrame,
                months: Iterable[tuple[int, int]] | None = None, names: Iterable[str] | None = None,
                one_pass: bool = False) -> None:
    """``stage_marts``, then all of them made public."""
    for staged in stage_marts(spark, layout, fact, months, names, one_pass).values():
        staged.publish(spark)


def build_marts(spark: SparkSession, layout: Layout, names: Iterable[str]) -> None:
    """One or some marts alone, whole, from the published fact."""
    names = list(names)
    unknown = set(names) - set(marts.MARTS)
    if unknown:
        raise ValueError(f"no such mart: {sorted(unknown)}")
    write_marts(spark, layout, spark.read.parquet(layout.fact), names=names)


def partition_filter(months: Iterable[tuple[int, int]], year_col: str = "pickup_year",
                     month_col: str = "pickup_month"):
    """Predicate on year/month partition columns (directory pruning)."""
    cond = None
    for y, m in sorted(months):
        term = (F.col(year_col) == int(y)) & (F.col(month_col) == int(m))
        cond = term if cond is None else cond | term
    return cond if cond is not None else F.lit(False)


#: Up to so many pickup months a task that holds all of them writes a file into each.
FEW_MONTHS = 3


def write_fact(stg: DataFrame, lk: facts.Lookups, layout: Layout) -> None:
    """The whole fact.  The 20 staged columns are spread by pickup month, not
    the 52 of the fact: the lookups then run where the rows are written.

    If the month index names few months, the rows are written where the dedup left them,
    as those of a monthly run are: files stay a third of a task's share, and a shuffle
    less is run."""
    spark = stg.sparkSession
    if not fs.has_data(spark, layout.raw_month_index) or len(indexed_months(spark, layout)) > FEW_MONTHS:
        stg = (stg.withColumns({"_y": F.year("pickup_datetime"), "_m": F.month("pickup_datetime")})
               .hint("rebalance", "_y", "_m").drop("_y", "_m"))
    sinks.overwrite_table(facts.fact_trips(stg, lk), layout.fact, schemas.FACT_PARTITIONS, rebalance=False)


def build(spark: SparkSession, layout: Layout, *, mode: str = inc.SAFE,
          months: Iterable[tuple[int, int]] | None = None, full_refresh: bool = False,
          dup_policy: str = "keep", quality_gate: str = "raise", seed_dir: str | None = None,
          cast_mode: str = "ansi", one_pass_marts: bool = False):
    """Transform stage: dimension, fact, four marts, each checked before what
    depends on it is written.  Dimension and marts are checked before they are
    public themselves, the marts also for their grain: a merge key must name one row.

    ``cast_mode='try'`` keeps the run alive on values a cast rejects: those
    raw rows are written to the quarantine table instead of failing the job.
    ``dup_policy='keep'`` leaves repeated trip keys to the fact's ``unique``
    check, which runs before the marts; ``'error'`` probes staging before the
    build, which recomputes the staging plan.

    ``mode='safe'`` rebuilds whole pickup ``months`` (None: all that raw holds),
    and always those still pending from earlier runs; a first run or a full
    refresh rebuilds everything.  ``mode='reference'`` applies the watermark +
    merge rule literally.  With ``quality_gate='raise'`` a failed
    error-severity check stops the run: failed staging or dimension checks leave
    dimension, fact and marts, failed fact or mart checks the marts, as they were,
    and the months stay pending.  Only the pending records read at the start are
    cleared at the end.  Returns the quality report rows."""
    if mode not in (inc.SAFE, inc.REFERENCE):
        raise ValueError(f"unknown mode {mode}")
    recover(spark, layout)
    lk = facts.Lookups.build(spark, spark.read.parquet(layout.raw_zones).select(*schemas.RAW_ZONES.fieldNames()),
                             seed_dir)
    first_run = not fs.has_data(spark, layout.fact)
    whole = full_refresh or first_run
    pending = pending_records(spark, layout)
    months = sorted((indexed_months(spark, layout) if months is None else set(months)) | {p[4:6] for p in pending})
    raw_parts = None if whole or mode != inc.SAFE else raw_partitions_for(spark, layout, months)
    raw = raw_trips_table(spark, layout, raw_parts)
    if cast_mode == "try":
        # quarantine the raw partitions this run reads (all of them on a full load)
        good, rejected = staging.quarantine_bad_casts(raw)
        if raw_parts is None:
            sinks.overwrite_table(rejected, layout.quarantine, schemas.PARTITION_COLUMNS)
        else:  # replace (or clear) exactly the raw partitions read
            inc.replace_months_in_table(spark, layout.quarantine, rejected, raw_parts, schemas.PARTITION_COLUMNS)
        if fs.has_data(spark, layout.quarantine):
            held = spark.read.parquet(layout.quarantine)
            if raw_parts is not None:
                held = held.filter(partition_filter(raw_parts, *schemas.PARTITION_COLUMNS))
            count_rejections(spark, layout, uuid.uuid4().hex, "staging", held)
        raw = good
    stg = staging.stg_trips(raw, dup_policy)
    if not whole and mode == inc.SAFE:
        # exact: copies share a pickup time, so every row of these pickup
        # months sits in the indexed raw partitions
        stg = stg.filter(month_ranges_filter("pickup_datetime", months))
    scope = months if not whole and mode == inc.SAFE else None

    rows: list = []

    def check(*models: str, staged: Mapping[str, DataFrame] | None = None) -> None:
        if quality_gate != "skip":
            found = {**tables(spark, layout, stg, [m for m in models if m not in (staged or {})], scope), **(staged or {})}
            parents = {"vendor": lk.vendor, "rate_code": lk.rate_code, "payment_type": lk.payment_type,
                       quality.DIM: lk.dim_location}
            rows.extend(quality.gate(quality.run_checks(found, quality.ALL_CHECKS, parents),
                                     raise_on_error=(quality_gate == "raise")))

    check(quality.STG_TRIPS, quality.STG_ZONES, quality.DIM, staged={quality.DIM: lk.dim_location})
    sinks.overwrite_table(lk.dim_location, layout.dim_location)
    if whole:
        write_fact(stg, lk, layout)
    elif mode == inc.SAFE:
        if months:
            inc.replace_months_in_table(spark, layout.fact, facts.fact_trips(stg, lk), months)
    else:
        mark = inc.collect_watermark(spark.read.parquet(layout.fact), "fact_yellow_taxi_trips")
        fresh = (stg.filter(F.col("pickup_datetime") > F.lit(str(mark)).cast("timestamp_ntz"))
                 if mark is not None else stg.limit(0))
        inc.merge_into_table(spark, layout.fact, facts.fact_trips(fresh, lk), inc.FACT_KEY)
    check(quality.FACT)

    fact = spark.read.parquet(layout.fact)
    staged: dict[str, sinks.Staged] = {}
    if whole:
        staged = stage_marts(spark, layout, fact, one_pass=one_pass_marts)
    elif mode == inc.SAFE:
        if months:
            staged = stage_marts(spark, layout, fact.filter(partition_filter(months)), months, one_pass=one_pass_marts)
    else:
        def merge_mart(name: str) -> sinks.Staged:
            path = layout.mart(name)
            target = sinks.read_table(spark, path)
            if target is None:
                return sinks.stage_table(marts.build_mart(name, fact), path, schemas.FACT_PARTITIONS)
            mark = inc.collect_watermark(target, name)
            src = fact.filter(F.col("pickup_date") > F.lit(mark)) if mark is not None else fact.limit(0)
            return inc.stage_merge(spark, path, marts.build_mart(name, src), marts.MERGE_KEYS[name])
        staged = run_concurrently({n: (lambda n=n: merge_mart(n)) for n in marts.MARTS})
    try:
        check(*marts.MARTS, staged={n: s.frame(spark) for n, s in staged.items()})
    except quality.DataQualityError:
        for s in staged.values():
            s.drop(spark)
        raise
    for s in staged.values():
        s.publish(spark)
    if whole or mode == inc.SAFE:
        clear_pending(spark, layout, pending)
    return rows


def tables(spark: SparkSession, layout: Layout, stg: DataFrame | None, models: Iterable[str],
           months: list[tuple[int, int]] | None = None) -> dict[str, DataFrame]:
    """The tested ``models``.  With ``months``, fact and marts are limited to
    those pickup months (the rows this run rewrote); the lookups stay whole.
    Every declared check is per row or per trip key, and equal keys share a
    pickup month, so month-scoped checks are exact for the new data."""
    def of(name: str) -> DataFrame:
        if name == quality.STG_TRIPS:
            return stg
        if name == quality.STG_ZONES:
            return staging.stg_zones(spark.read.parquet(layout.raw_zones))
        if name == quality.DIM:
            return spark.read.parquet(layout.dim_location)
        df = spark.read.parquet(layout.fact if name == quality.FACT else layout.mart(name))
        return df if months is None else df.filter(partition_filter(months))

    return {name: of(name) for name in models}


def check_published(spark: SparkSession, layout: Layout, seed_dir: str | None = None,
                    quality_gate: str = "raise") -> list:
    """The checks over the tables as they are, without building."""
    recover(spark, layout)
    lk = facts.Lookups.build(spark, spark.read.parquet(layout.raw_zones).select(*schemas.RAW_ZONES.fieldNames()),
                             seed_dir)
    stg = staging.stg_trips(raw_trips_table(spark, layout))
    models = tables(spark, layout, stg, [quality.STG_TRIPS, quality.STG_ZONES, quality.DIM, quality.FACT, *marts.MARTS])
    report = quality.run_checks(models, quality.ALL_CHECKS,
                                {"vendor": lk.vendor, "rate_code": lk.rate_code, "payment_type": lk.payment_type})
    return quality.gate(report, raise_on_error=(quality_gate == "raise"))


# --------------------------------------------------------------------------
# Export

def export_month_slice(spark: SparkSession, layout: Layout, year: int, month: int) -> str:
    """X1: one month of the monthly zone mart as ONE Parquet file with the
    exact export name (a month of this mart is at most a few hundred rows)."""
    mart = spark.read.parquet(layout.mart("agg_monthly_zone_summary"))
    month_rows = mart.filter((F.col("pickup_year") == int(year)) & (F.col("pickup_month") == int(month)))
    target = f"{layout.export_dir.rstrip('/')}/{export_name(year, month)}.parquet"
    _single_file(spark, month_rows, target, "parquet")
    return target


def export_csv(spark: SparkSession, layout: Layout, year: int, month: int) -> str:
    """X2: the exported slice as one headed CSV with the exact feed name."""
    source = f"{layout.export_dir.rstrip('/')}/{export_name(year, month)}.parquet"
    target = f"{layout.feed_dir.rstrip('/')}/{export_name(year, month)}.csv"
    _single_file(spark, spark.read.parquet(source), target, "csv")
    return target


def _single_file(spark: SparkSession, df: DataFrame, target: str, fmt: str) -> None:
    tmp = target + f".tmp-{uuid.uuid4().hex}"
    w = df.coalesce(1).write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(tmp)
    else:
        w.parquet(tmp)
    parts = [f for f in fs.list_files(spark, tmp) if f.endswith(f".{fmt}") or f.rsplit("/", 1)[-1].startswith("part-")]
    if len(parts) != 1:
        raise RuntimeError(f"expected one part file in {tmp}, found {len(parts)}")
    fs.swap_in(spark, parts[0], target)
    fs.delete(spark, tmp)


def run_month(spark: SparkSession, layout: Layout, source_path: str, year: int, month: int, *,
              zones_csv: str | None = None, mode: str = inc.SAFE, export: bool = True,
              quality_gate: str = "raise", reset: bool = False, full_refresh: bool = False,
              cast_mode: str = "ansi", dup_policy: str = "keep", seed_dir: str | None = None,
              one_pass_marts: bool = False):
    """The monthly run: ingest the file, build everything, export the month.

    ``reset`` drops the raw trip table before loading (only under the
    layout root); ``full_refresh`` rebuilds the fact and marts from all raw;
    the other parameters are those of :func:`build`."""
    if zones_csv:
        ingest_zones(spark, layout, zones_csv)
    touched = ingest_month(spark, layout, source_path, year, month, reset=reset, cast_mode=cast_mode)
    report = build(spark, layout, mode=mode, months=touched, quality_gate=quality_gate,
                   full_refresh=full_refresh or reset, cast_mode=cast_mode, dup_policy=dup_policy, seed_dir=seed_dir,
                   one_pass_marts=one_pass_marts)
    paths = []
    if export:
        paths = [export_month_slice(spark, layout, year, month)]
        paths.append(export_csv(spark, layout, year, month))
    return report, paths
