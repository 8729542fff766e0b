"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.session import staging_path

#: A word is a maximal run without ASCII white space (fixed by the contracts).
WORD = r"[^\x20\x09-\x0D]+"


BATCH_CONF, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000


def small_batches(spark: SparkSession) -> None:
    """For what this session runs from now on: at most ``BATCH_ROWS`` rows at once to
    a Python worker, whose memory is then a few texts' and not ten thousand texts'."""
    now = int(spark.conf.get(BATCH_CONF))
    if not 0 < now <= BATCH_ROWS:
        spark.conf.set(BATCH_CONF, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    Cuts lineage in a way that survives the loss of any executor, and gives
    the optimizer the true size of small results.  Rows of whole texts reach Python
    workers in batches of ``BATCH_ROWS``, so that a worker stays small."""
    spark = df.sparkSession
    path = staging_path(spark, f"llm-{name}")
    before = spark.conf.get(BATCH_CONF)
    spark.conf.set(BATCH_CONF, str(min(int(before), BATCH_ROWS) if int(before) > 0 else BATCH_ROWS))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(BATCH_CONF, before)
    return spark.read.schema(df.schema).parquet(path)


def n_words(text: Column) -> Column:
    """Words of a whole text; null counts none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns an operator is about to add (case-insensitively): the
    operator's column replaces a clashing extra column of the input."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def shield(df: DataFrame, *needed: str) -> tuple[DataFrame, list[Column]]:
    """``df`` with every column but ``needed`` renamed out of the way of an
    operator's own names, and the columns that bring all back in order."""
    names = {c: c if c in needed else f"__in_{i}" for i, c in enumerate(df.columns)}
    return (df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]),
            [F.col(n).alias(c) for c, n in names.items()])
