"""Sharding by a Feistel permutation of global row numbers.

Every row gets a gapless global row number; a keyed Feistel network with cycle
walking permutes 0..n-1; shard and slot are the remainder and the quotient of
the permuted number.  Anyone who knows (row number, n, shards, seed) can compute
where the row went (:func:`locate`).
"""

from __future__ import annotations

import math
import struct

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripmart.llm.common import materialize, shield, table, without

ROUNDS = 6
#: Walks tried inside one expression; the bound is proven for n < 256 (a walk is
#: at most ``a*b - n + 1 <= a`` long) and checked by ``raise_error`` beyond.
WALKS = 24
MIN_BUCKETS, MAX_BUCKETS, ROWS_PER_BUCKET = 256, 65_536, 20_000


def domain(n: int) -> tuple[int, int]:
    """Sides (a, b) of the smallest near-square domain with a * b >= n."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def _round(left: str, right: str, key: int, r: int, side: int) -> str:
    """(left + hash(right)) modulo its side; a bijection whatever the hash."""
    return f"pmod({left} + pmod(xxhash64({right}, {key}L, {r}L), {side}L), {side}L)"


def permute(df: DataFrame, number: str, n: int, seed: int, out: str) -> DataFrame:
    """Add ``out``: the permuted ``number`` of 0..n-1 (JVM expressions only)."""
    a, b = domain(n)
    df = df.withColumns({"__l": F.expr(f"`{number}` div {b}L"), "__r": F.expr(f"pmod(`{number}`, {b}L)")})
    for r in range(ROUNDS):
        df = (df.withColumn("__l", F.expr(_round("__l", "__r", seed, r, a))) if r % 2 == 0
              else df.withColumn("__r", F.expr(_round("__r", "__l", seed, r, b))))
    # Rare rows that land in n..a*b-1 walk on: one more network per step.
    net = (f"aggregate(sequence(0, {ROUNDS - 1}), named_struct('l', w div {b}L, 'r', pmod(w, {b}L)), (s, i) -> "
           f"CASE WHEN i % 2 = 0 THEN named_struct('l', pmod(s.l + pmod(xxhash64(s.r, {seed}L, CAST(i AS BIGINT)), {a}L), {a}L), 'r', s.r) "
           f"ELSE named_struct('l', s.l, 'r', pmod(s.r + pmod(xxhash64(s.l, {seed}L, CAST(i AS BIGINT)), {b}L), {b}L)) END, "
           f"s -> s.l * {b}L + s.r)")
    walk = f"aggregate(sequence(1, {WALKS}), __p, (w, k) -> CASE WHEN w < {n}L THEN w ELSE {net} END)"
    return (df.withColumn("__p", F.expr(f"__l * {b}L + __r"))
            .withColumn(out, F.when(F.col("__p") < n, F.col("__p")).otherwise(F.expr(walk)))
            .withColumn(out, F.when(F.col(out) < n, F.col(out)).otherwise(F.raise_error(F.lit("cycle walk too long"))))
            .drop("__l", "__r", "__p"))


def number_rows(df: DataFrame, keys: list[str], out: str, n: int) -> DataFrame:
    """Add gapless global row numbers 0..n-1 in (hash bucket, keys) order.

    The hash of all ``keys`` picks the bucket, so one hot key value with
    different other keys spreads; rows equal in every key are interchangeable.
    One shuffle for the window; the offsets are at most 65,536 rows."""
    buckets = min(MAX_BUCKETS, max(MIN_BUCKETS, -(-n // ROWS_PER_BUCKET)))
    df = df.withColumn("__b", F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int"))
    sizes = df.groupBy("__b").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    rank = F.row_number().over(Window.partitionBy("__b").orderBy(*[F.col(f"`{k}`") for k in keys]))
    return (df.withColumn("__k", rank)
            .join(F.broadcast(offsets), "__b")  # bounded: MAX_BUCKETS rows of 12 bytes
            .withColumn(out, F.col("__first") + F.col("__k") - 1)
            .drop("__b", "__k", "__first"))


def shard(df: DataFrame, keys: list[str], shards: int, seed: int = 20_250_101) -> DataFrame:
    """Every row with ``row_number``, ``shard`` (0..shards-1) and ``slot`` (0.. without gaps).

    Counts differ by one at most.  Nulls in ``keys`` are ordinary values;
    repeated rows get slots of their own; an empty table stays empty; extra
    columns stay, whatever their names, but those named like an output are replaced."""
    n = df.count()
    safe, own = shield(without(df, "row_number", "shard", "slot"), *keys)
    safe = permute(number_rows(safe, keys, "row_number", n), "row_number", n, seed, "__to")
    return safe.select(*own, "row_number", F.pmod("__to", F.lit(shards)).cast("int").alias("shard"),
                       F.expr(f"__to div {shards}L").alias("slot"))


def write_shards(df: DataFrame, keys: list[str], shards: int, path: str, seed: int = 20_250_101) -> None:
    """Write the shuffled table: one folder per shard, each file in slot order."""
    out = shard(df, keys, shards, seed)
    (out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def locate(number: int, n: int, shards: int, seed: int = 20_250_101) -> tuple[int, int]:
    """(shard, slot) of one row number, computed outside Spark."""
    import xxhash

    def h(value: int, r: int) -> int:
        x = 42
        for v in (value, seed, r):
            x = xxhash.xxh64(struct.pack("<q", v), seed=x).intdigest()
        return x - (1 << 64) if x >> 63 else x

    a, b = domain(n)
    p = number
    while True:
        left, right = divmod(p, b)
        for r in range(ROUNDS):
            if r % 2 == 0:
                left = (left + h(right, r) % a) % a
            else:
                right = (right + h(left, r) % b) % b
        p = left * b + right
        if p < n:
            return p % shards, p // shards


def query(spark, sf_dir):
    """op3: all documents into 8 shards under the law ``rows``."""
    text = F.col("text")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"))
    docs = materialize(docs, "shard-sizes")  # the texts are read once
    return shard(docs, ["doc_id", "text_crc32", "size"], 8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number")
