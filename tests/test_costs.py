"""What keeps the trip queries' cost per row down, and that the results stay."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from helpers import raw_df, trip
from tripmart import schemas
from tripmart.functions import expressions as X
from tripmart.incremental import loading as inc
from tripmart.operators import marts
from tripmart.plans import pipeline, registry, roundtrips
from tripmart.session import READ_BYTES, READ_BYTES_CONF, configure

SF = "/root/testdata/sf0.001"


def test_seconds_and_days_without_zoned_times(spark):
    configure(spark)
    times = [(dt.datetime(2025, 1, 1, 8, 0, 0, 900000), dt.datetime(2025, 1, 1, 8, 0, 1, 100000), 1, "Wed"),
             (dt.datetime(1969, 12, 31, 23, 59, 59, 500000), dt.datetime(1970, 1, 1, 0, 0, 0, 400000), 1, "Wed"),
             (dt.datetime(2025, 3, 9, 1, 59, 0), dt.datetime(2025, 3, 9, 3, 0, 0), 3660, "Sun"),
             (dt.datetime(2025, 1, 6, 0, 0, 1), dt.datetime(2025, 1, 5, 23, 59, 59), -2, "Mon"),
             (None, dt.datetime(2025, 1, 5), None, None)]
    df = spark.createDataFrame(times, "a timestamp_ntz, b timestamp_ntz, secs bigint, day string")
    got = df.select("secs", "day", X.seconds_between(F.col("a"), F.col("b")).alias("s"), X.day_abbrev(F.col("a")).alias("d"))
    assert got.schema["s"].dataType.simpleString() == "bigint"
    assert [(r["s"], r["d"]) for r in got.collect()] == [t[2:] for t in times]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "date_trunc" not in plan and "timestampdiff" not in plan.lower() and "dayname" not in plan


def test_long_methods_fall_back(spark):
    configure(spark)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_incremental_mart_reads_its_inputs_once(spark):
    """The regrouped rows are read from a staged folder, not planned twice over lineitem."""
    configure(spark)
    lk, _, stg2, fact1 = registry._batches(spark, SF, written=True)
    assert all("incr-stg" in f for f in fact1.inputFiles())
    name = "agg_vendor_performance"
    got = inc.incremental_mart(name, inc.incremental_fact(stg2, lk, fact1), marts.build_mart(name, fact1))
    assert any("fresh-mart" in f for f in got.inputFiles()) and not any("lineitem" in f for f in got.inputFiles())
    lazy = marts.build_mart(name, registry._batches(spark, SF)[3])
    assert sorted(map(str, marts.build_mart(name, fact1).collect())) == sorted(map(str, lazy.collect()))


def _lake(spark, root, months):
    layout = pipeline.Layout(root, "TEST")
    pipeline.ingest_zones(spark, layout, roundtrips.write_zones(spark, f"{root}/zones_csv"))
    for m in range(1, months + 1):
        at = dt.datetime(2025, m, 15, 8)
        rows = [trip(VendorID=1 + k % 2, fare_amount=10.0 + k % 40, tpep_pickup_datetime=at + dt.timedelta(minutes=k),
                     tpep_dropoff_datetime=at + dt.timedelta(minutes=k + 9)) for k in range(60)]
        raw_df(spark, rows + rows[:5]).repartition(4).write.parquet(f"{root}/in/{m}")
        pipeline.ingest_month(spark, layout, f"{root}/in/{m}", 2025, m, source_file_size_mb=0)
    return layout


def test_few_months_are_written_where_the_dedup_left_them(spark, tmp_path, monkeypatch):
    configure(spark)
    hints = []
    real = type(spark.range(0)).hint
    monkeypatch.setattr(type(spark.range(0)), "hint", lambda self, name, *a: hints.append((name, self.columns[-1])) or real(self, name, *a))
    got = {}
    for months in (pipeline.FEW_MONTHS, pipeline.FEW_MONTHS + 1):
        layout = _lake(spark, f"{tmp_path}/{months}", months)
        hints.clear()
        pipeline.build(spark, layout, quality_gate="skip")
        assert (("rebalance", "_m") in hints) == (months > pipeline.FEW_MONTHS)
        fact = spark.read.parquet(layout.fact)
        assert fact.count() == 60 * months
        got[months] = sorted(map(str, fact.filter("pickup_month = 1").select(*schemas.FACT_COLUMNS).collect()))
    assert len(set(map(str, got.values()))) == 1


def test_month_digests_sum_whole_numbers(spark):
    configure(spark)
    rows = [trip(tip_amount=float(k), passenger_count=None if k % 3 else 1, RatecodeID=None if k % 2 else 1) for k in range(40)]
    raw = raw_df(spark, rows)
    digest = lambda df: {(r["pickup_year"], r["pickup_month"]): r["digest"] for r in inc.month_digests(df).collect()}
    assert digest(raw) == digest(raw.repartition(5)) and len(digest(raw)) == 1
    plan = inc.month_digests(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert "decimal" not in plan.replace("decimal(10,2)", "")
    moved = [{**r, "passenger_count": r["RatecodeID"], "RatecodeID": r["passenger_count"]} for r in rows]
    for other in (rows[:-1], rows + rows[:1], rows[:-1] + rows[:1], moved):
        assert digest(raw_df(spark, other)) != digest(raw)
    assert digest(raw_df(spark, [trip(tpep_pickup_datetime=None)])) == {}


def test_a_merge_writes_its_source_once(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter

    path, wrote, real = f"{tmp_path}/t", [], DataFrameWriter.parquet
    of = lambda v, *rows: spark.createDataFrame(rows, f"k string, v {v}, pickup_year int, pickup_month int")
    inc.merge_into_table(spark, path, of("decimal(5,2)", ("a", Decimal("1.50"), 2025, 1), ("b", Decimal("2.25"), 2025, 1)), ["k"])
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, at, *a, **k: wrote.append(at) or real(self, at, *a, **k))
    inc.merge_into_table(spark, path, of("decimal(5,2)", ("c", Decimal("3.00"), 2025, 2)), ["k"])
    assert len(wrote) == 1  # a new partition: neither staged elsewhere nor read again
    inc.merge_into_table(spark, path, of("decimal(9,4)", ("b", Decimal("7.1234"), 2025, 1), ("d", None, 2025, 1)), ["k"])
    assert len(wrote) == 3 and wrote[1] == wrote[2]  # the source, and the rows kept beside it
    january = spark.read.parquet(f"{path}/pickup_year=2025/pickup_month=1")
    assert dict(january.dtypes)["v"] == "decimal(9,4)"
    assert {r["k"]: r["v"] for r in january.collect()} == {"a": Decimal("1.5000"), "b": Decimal("7.1234"), "d": None}
    assert [r["k"] for r in spark.read.parquet(f"{path}/pickup_year=2025/pickup_month=2").collect()] == ["c"]


def test_a_task_reads_a_share_of_a_raw_file(spark, tmp_path):
    """One delivered file of 1.5 million trips is one row group of Spark's own size; tasks share the raw partition."""
    before = spark.conf.get(READ_BYTES_CONF)
    try:
        spark.conf.set(READ_BYTES_CONF, "128m")
        configure(spark)
        assert int(spark.conf.get(READ_BYTES_CONF)) == READ_BYTES
        spark.conf.set(READ_BYTES_CONF, "16m")
        configure(spark)
        assert spark.conf.get(READ_BYTES_CONF) == "16m"  # a smaller share stays
    finally:
        spark.conf.set(READ_BYTES_CONF, before)
    layout = pipeline.Layout(f"{tmp_path}/lake", "TEST")
    one = raw_df(spark, [trip()])
    odd = lambda k, n: (F.xxhash64("id", F.lit(k)) % n).cast("double")
    at = F.timestamp_add("SECOND", F.abs(F.xxhash64("id", F.lit(0)) % 2000000), F.lit("2025-01-02").cast("timestamp_ntz"))
    many = spark.range(0, 1_500_000, 1, 1).crossJoin(one).withColumns({
        "tpep_pickup_datetime": at, "fare_amount": odd(1, 1 << 40), "tip_amount": odd(2, 1 << 40), "total_amount": odd(3, 1 << 40),
        "trip_distance": odd(4, 1 << 40), "tolls_amount": odd(5, 1 << 40)}).drop("id")
    many.coalesce(1).write.parquet(f"{tmp_path}/in")
    pipeline.ingest_month(spark, layout, f"{tmp_path}/in", 2025, 1, source_file_size_mb=0)
    raw = pipeline.raw_trips_table(spark, layout)
    shares = [r["n"] for r in raw.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(shares) == 1_500_000 and max(shares) < 1_000_000
