"""Table writers: partition replace, full overwrite, keyed merge.

Tables are Parquet directories.  New partitions and tables are written beside the
table by one Spark job and moved in by ``moves``, which writes the moves down
first: a job that fails leaves the table as it was, and a run killed between two
moves is finished by whoever opens the table next.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.plans import fs, moves
from tripmart.session import READ_BYTES, staging_path

#: Writer options of partitions: a row group is read by one task, so it is no larger than a task's share.
SMALL_GROUPS = {"parquet.block.size": str(READ_BYTES)}

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # fixed value: Spark's folder of a NULL


class UnsafeReset(ValueError):
    """A reset was asked for a path outside the configured root."""


@dataclass
class Staged:
    """New content of a table, written beside it and not yet public."""
    table: str
    folder: str
    schema: T.StructType
    moves: list[tuple[str | None, str]] = field(default_factory=list)

    def frame(self, spark: SparkSession) -> DataFrame:
        if fs.has_data(spark, self.folder):
            return spark.read.schema(self.schema).parquet(self.folder)
        return spark.createDataFrame([], self.schema)

    def publish(self, spark: SparkSession) -> None:
        moves.publish(spark, self.table, self.moves)
        if fs.exists(spark, self.folder):  # a whole table has been moved itself
            fs.delete(spark, self.folder)

    def drop(self, spark: SparkSession) -> None:
        fs.delete(spark, self.folder)


def partition_folder(columns: Sequence[str], values: Sequence) -> str:
    return "/".join(f"{c}={NULL_PARTITION if v is None else v}" for c, v in zip(columns, values))


def stage_partitions(spark: SparkSession, df: DataFrame, path: str, partition_cols: Sequence[str],
                     replaced: Sequence[tuple] = ()) -> Staged:
    """Write the partitions present in ``df`` beside the table at ``path``; publishing
    replaces them and clears those of ``replaced`` that got no row.

    Monthly runs touch one or two partitions, so each task writes at most that many
    files and no extra shuffle is spent on layout."""
    moves.recover(spark, path)
    path = path.rstrip("/")
    staged = Staged(path, f"{path}.new-{uuid.uuid4().hex}", df.schema)
    df.write.options(**SMALL_GROUPS).partitionBy(*partition_cols).parquet(staged.folder)
    level = [staged.folder]
    for column in partition_cols:
        level = [f for folder in level for f in fs.list_files(spark, folder) if f.rsplit("/", 1)[-1].startswith(f"{column}=")]
    written = ["/".join(f.rstrip("/").split("/")[-len(partition_cols):]) for f in level]
    staged.moves = [(f"{staged.folder}/{part}", f"{path}/{part}") for part in written]
    gone = [part for part in (partition_folder(partition_cols, v) for v in replaced) if part not in written]
    staged.moves += [(None, f"{path}/{part}") for part in gone]
    return staged


def write_partitions(df: DataFrame, path: str, partition_cols: Sequence[str]) -> None:
    """Replace exactly the partitions present in ``df``; keep all others."""
    stage_partitions(df.sparkSession, df, path, partition_cols).publish(df.sparkSession)


def replace_partition(spark: SparkSession, df: DataFrame, path: str, partition: dict[str, int]) -> None:
    """K1: replace one partition (e.g. one year/month) with ``df``.

    Rows are pinned to the partition values first; an empty ``df`` clears the
    partition."""
    pinned = df.withColumns({k: F.lit(v).cast("int") for k, v in partition.items()})
    stage_partitions(spark, pinned, path, list(partition), [tuple(partition.values())]).publish(spark)


def stage_table(df: DataFrame, path: str, partition_cols: Sequence[str] = (), rebalance: bool = True) -> Staged:
    """Write a whole new table beside the one at ``path``.

    A partitioned full load first rebalances rows by partition (AQE splits a
    large month into advisory-size tasks): without it every task of the
    preceding shuffle would write a small file into every month.  A caller that
    has spread the rows already says so with ``rebalance=False``."""
    moves.recover(df.sparkSession, path)
    if partition_cols and rebalance:
        df = df.hint("rebalance", *partition_cols)
    path = path.rstrip("/")
    new = f"{path}.new-{uuid.uuid4().hex}"
    w = df.write.mode("errorifexists")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(new)
    return Staged(path, new, df.schema, [(new, path)])


def overwrite_table(df: DataFrame, path: str, partition_cols: Sequence[str] = (), rebalance: bool = True) -> None:
    """K2/K5: replace the whole table; a failing write leaves the old one as it was."""
    stage_table(df, path, partition_cols, rebalance).publish(df.sparkSession)


def reset_table(spark: SparkSession, path: str, root: str) -> None:
    """K4: drop a table's files, refusing anything outside ``root``."""
    inside = fs.qualified(spark, root).rstrip("/") + "/"
    if not fs.qualified(spark, path).startswith(inside):
        raise UnsafeReset(f"{path} is not under {root}")
    moves.recover(spark, path)
    fs.delete(spark, path)


def stage(spark: SparkSession, df: DataFrame, name: str, partition_cols: Sequence[str] = ()) -> tuple[DataFrame, str]:
    """Write ``df`` to a fresh folder under the shared checkpoint dir and read
    it back: cuts lineage (e.g. before overwriting a table the plan reads).
    Returns the staged DataFrame and its folder (delete it when done)."""
    path = staging_path(spark, name)
    w = df.write.mode("errorifexists")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)
    return spark.read.parquet(path), path


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    moves.recover(spark, path)
    return spark.read.parquet(path) if fs.has_data(spark, path) else None
