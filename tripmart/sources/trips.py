"""Monthly raw trip files: scan, type normalisation and audit columns."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: monthly file name pattern (two-digit month in the name).
TRIP_FILE_PATTERN = "yellow_tripdata_{year:04d}-{month:02d}.parquet"

# Raw columns re-typed at ingest.
INT_COLUMNS = ["VendorID", "passenger_count", "RatecodeID", "payment_type", "PULocationID", "DOLocationID"]


def trip_file_name(year: int, month: int) -> str:
    return TRIP_FILE_PATTERN.format(year=int(year), month=int(month))


def read_trip_month(spark: SparkSession, path: str) -> DataFrame:
    """Scan one monthly file (or folder); schema from the Parquet footer."""
    return spark.read.parquet(path)


def split_bad_rows(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows every ingest cast accepts, rejected rows as JSON with the names of
    the columns at fault).  Both are filters of one scan."""
    casts = {**dict.fromkeys(INT_COLUMNS, "int"), "airport_fee": "double"}
    bad = F.array_compact(F.array(*[F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(c))
                                    for c, t in casts.items()]))
    row = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    return (df.filter(F.size(bad) == 0),
            df.filter(F.size(bad) > 0).select(bad.alias("rejected_columns"), row.alias("row")))


def normalise_raw_trips(df: DataFrame, year: int, month: int, *, execution_id: str | None = None,
                        source_file: str | None = None, source_file_size_mb: float = 0.0,
                        with_audit: bool = True) -> DataFrame:
    """Ingest projection: six integer casts, airport_fee to double, the file's
    year/month as partition literals (not derived from pickup time), and the
    four audit columns.  Narrow transformations only: no shuffle."""
    cols = {c: F.col(c).cast("int") for c in INT_COLUMNS}
    cols["airport_fee"] = F.col("airport_fee").cast("double")
    cols["trip_month"] = F.lit(int(month)).cast("int")
    cols["trip_year"] = F.lit(int(year)).cast("int")
    if with_audit:
        cols["source_execution_id"] = F.lit(execution_id or str(uuid.uuid4()))
        cols["source_execution_dt"] = F.current_timestamp()
        cols["source_file"] = F.lit(source_file or trip_file_name(year, month))
        # whole megabytes, truncated like an int cast of the float size
        cols["source_file_size"] = F.lit(float(source_file_size_mb)).cast("int")
    return df.withColumns(cols)
