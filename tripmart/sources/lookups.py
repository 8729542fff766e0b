"""Zone lookup and seed lookups (small CSV inputs).

The seeds are tiny fixed tables shipped in ``tripmart/resources/seeds``; the
zone lookup is an input file read from a path (the public taxi-zone CSV in
production, a rule-built fixture in tests).  Every lookup is checked for a
unique key at load: a repeated key would fan out fact rows in the left joins.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import schemas

SEED_DIR = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "resources", "seeds")
SEED_NAMES = list(schemas.SEEDS)


class LookupError_(ValueError):
    """A lookup violates its key contract."""


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Raw zone lookup: header CSV read with the declared four-column schema.

    The text ``N/A`` is a value, not NULL (only empty fields become NULL).
    """
    return (spark.read.schema(schemas.RAW_ZONES)
            .option("header", True)
            .option("mode", "FAILFAST")
            .csv(path))


def read_seed(spark: SparkSession, name: str, path: str | None = None, check_unique: bool = True) -> DataFrame:
    """One seed lookup with its declared schema; fails on a repeated key.

    With a ``path`` (shared storage) the CSV reader loads it.  Without one
    the packaged seed is read on the driver and embedded in the plan as a
    typed VALUES relation, so executors never need the package files."""
    if path is None:
        df = spark.sql("SELECT * FROM " + seed_values_sql(name, "STRING"))
    else:
        df = (spark.read.schema(schemas.seed_schema(name))
              .option("header", True)
              .option("mode", "FAILFAST")
              .csv(path))
    if check_unique:
        check_lookups({name: (df, schemas.SEEDS[name][0])})
    return df


def load_seeds(spark: SparkSession, seed_dir: str | None = None, check: bool = True) -> dict[str, DataFrame]:
    """All four seeds, their keys checked in one job.  ``seed_dir`` None uses
    the packaged seeds."""
    seeds = {n: read_seed(spark, n, os.path.join(seed_dir, f"{n}.csv") if seed_dir else None,
                          check_unique=False) for n in SEED_NAMES}
    if check:
        check_lookups({n: (df, schemas.SEEDS[n][0]) for n, df in seeds.items()})
    return seeds


def check_lookups(lookups: dict[str, tuple[DataFrame, str]]) -> None:
    """Raise if a lookup repeats its key.  One rule for any size: a key, NULL
    among them, belongs to one row.  One job for all lookups: their keys are
    counted by partially aggregated groupBys; one row each reaches the driver."""
    parts = [df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
             .agg(F.count_if(F.col("n") > 1).alias("repeated")).select(F.lit(name).alias("name"), "repeated")
             for name, (df, key) in lookups.items()]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    for r in union.collect():
        if r["repeated"]:
            raise LookupError_(f"lookup {r['name']} repeats its key {lookups[r['name']][1]}")


def seed_rows(name: str) -> list[tuple]:
    """The packaged seed file's rows, typed by the declared schema."""
    import csv

    key_type = schemas.SEEDS[name][1]
    with open(os.path.join(SEED_DIR, f"{name}.csv"), newline="") as fh:
        rows = list(csv.reader(fh))[1:]
    is_int = key_type.typeName() == "integer"
    return [(int(k) if is_int else k, v) for k, v in rows]


def seed_values_sql(name: str, string_type: str = "VARCHAR") -> str:
    """A packaged seed as a typed VALUES relation (Spark: STRING, DuckDB: VARCHAR)."""
    key, key_type, value = schemas.SEEDS[name]
    kt = "INTEGER" if key_type.typeName() == "integer" else string_type

    def lit(v):
        return "NULL" if v is None else (str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'")

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in seed_rows(name))
    return (f"(SELECT CAST({key} AS {kt}) AS {key}, CAST({value} AS {string_type}) AS {value} "
            f"FROM (VALUES {body}) AS v({key}, {value}))")
