"""Hard-negative mining by slot-decomposed selection.

Of an anchor's rows with its own label the best ``positives`` are its positives;
each opens a window of scores below its own, and the best ``negatives`` rows of
other labels in each window are its hard negatives.  Windows overlap, so they are
not searched one by one: their upper limits, in falling order, split the scores
into disjoint slots, and every row falls into one slot of an anchor.  Tasks keep
the best rows of each slot, a combiner keeps the best over all tasks, and merges
from the last slot upwards give the best rows below every upper limit; a window's
lower limit then cuts that list short.

Anchors meet all rows block by block: a cell pairs a bounded block of anchors with
a bounded block of rows.  Scores are inner products of floor(256 x) and exact.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripmart.llm.common import materialize, table

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # a window, in percent of the positive's score
#: A block of rows and one of anchors: bytes of vectors, and rows at most.
BLOCK_BYTES, MOST_ROWS, MOST_ANCHORS, LEAST_ROWS = 1 << 24, 16_384, 4_096, 512
TILE = 1 << 22  # scores held at once
NEVER = np.iinfo(np.int64).min


# --- exact scores of a cell ---------------------------------------------------------

def _whole(values: np.ndarray) -> list[int]:
    return [math.floor(x * SCALE) if abs(x) < 2.0 ** 53 else int(x) * SCALE for x in values.tolist()]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of ``a`` with all of ``b`` (components already
    times ``SCALE`` and rounded down where below 2**53); ``NEVER`` where the product
    does not fit 64 bits."""
    most = (np.abs(a).max(initial=0.0) + 1) * (np.abs(b).max(initial=0.0) + 1) * max(1, a.shape[1])
    if most < 2.0 ** 53:  # every partial sum is a whole number that a double holds
        return (a @ b.T).astype(np.int64)
    if most < 2.0 ** 62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    exact = np.array([[int(x) for x in row] for row in a.tolist()], object).reshape(a.shape) @ \
        np.array([[int(x) for x in row] for row in b.tolist()], object).reshape(b.shape).T
    fits = np.vectorize(lambda x: NEVER if abs(x) >= 1 << 63 else x, otypes=[np.int64])
    return fits(exact) if exact.size else np.zeros(exact.shape, np.int64)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact scores of raw vectors; the few rows of huge components go the slow way alone."""
    def floored(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        huge = np.abs(x).max(axis=1, initial=0.0) >= 2.0 ** 16
        return np.floor(np.where(huge[:, None], 0.0, x) * SCALE), huge

    (x, huge_a), (y, huge_b) = floored(a), floored(b)
    out = products(x, y)
    for rows, cols in ((np.flatnonzero(huge_a), np.arange(len(b))), (np.flatnonzero(~huge_a), np.flatnonzero(huge_b))):
        if len(rows) and len(cols):
            left, right = ([_whole(v) for v in m] for m in (a[rows], b[cols]))
            for i, u in zip(rows, left):
                for j, v in zip(cols, right):
                    s = sum(p * q for p, q in zip(u, v))
                    out[i, j] = s if abs(s) < 1 << 63 else NEVER
    return out


def best(s: np.ndarray, ok: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``most`` greatest scores of each row where ``ok``, ties by
    column; ``most`` passes over the matrix."""
    left = np.where(ok, s, NEVER)
    rows, at, out = np.arange(len(s)), [], []
    for _ in range(min(most, s.shape[1])):
        j = left.argmax(axis=1)
        found = left[rows, j] > NEVER
        at.append(rows[found])
        out.append(j[found])
        left[rows, j] = NEVER
    return (np.concatenate(at), np.concatenate(out)) if at else (rows[:0], rows[:0])


def _tiles(anchors: pd.DataFrame, rows: pd.DataFrame):
    """(anchors, ids, labels, scores) tile by tile; only vectors of one length meet,
    and rows come by id, so that the first of equal scores has the least id."""
    rows = rows.sort_values("vec_id")
    by_size = rows["vector"].map(len)
    for size, mine in anchors.groupby(anchors["vector"].map(len)):
        those = rows[by_size == size]
        if not len(those):
            continue
        b = np.array(those["vector"].tolist(), np.float64).reshape(len(those), size)
        ids, labels = those["vec_id"].to_numpy(np.int64), those["label"].to_numpy(np.int64)
        step = max(1, TILE // len(those))
        for at in range(0, len(mine), step):
            some = mine.iloc[at:at + step]
            yield some, ids, labels, scores(np.array(some["vector"].tolist(), np.float64).reshape(len(some), size), b)


def _positives(most: int):
    def find(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"anchor_id": [], "vec_id": [], "score": []}, dtype="int64")]
        for label, mine in anchors.groupby("label"):
            for some, ids, _, s in _tiles(mine, rows[rows["label"] == label]):
                me = some["vec_id"].to_numpy(np.int64)
                i, j = best(s, (s > NEVER) & (ids != me[:, None]), most)
                out.append(pd.DataFrame({"anchor_id": me[i], "vec_id": ids[j], "score": s[i, j]}))
        return pd.concat(out)

    return find


def _slots(most: int):
    def find(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"anchor_id": [], "slot": [], "vec_id": [], "score": []}, dtype="int64")]
        for some, ids, labels, s in _tiles(anchors, rows):
            me, other = some["vec_id"].to_numpy(np.int64), labels != some["label"].to_numpy(np.int64)[:, None]
            slots = max(map(len, some["limits"]))  # upper limits in falling order, then the least lower one
            limits = np.full((len(some), slots), NEVER, np.int64)
            for n, own in enumerate(some["limits"]):
                limits[n, :len(own) - 1] = own[:-1]
                limits[n, len(own) - 1:] = own[-1] - 1
            for k in range(slots - 1):
                i, j = best(s, other & (s <= limits[:, k, None]) & (s > limits[:, k + 1, None]), most)
                out.append(pd.DataFrame({"anchor_id": me[i], "slot": k, "vec_id": ids[j], "score": s[i, j]}))
        return pd.concat(out)

    return find


# --- the jobs --------------------------------------------------------------------

def _cells(anchors: DataFrame, rows: DataFrame, blocks: tuple[int, int], find, schema: str) -> DataFrame:
    """Every block of anchors with every block of rows; a cell is one bounded group."""
    of_anchors, of_rows = blocks
    everywhere = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    anchors = anchors.toDF(*anchors.columns)  # columns of its own: both sides read one table
    a = (anchors.withColumn("ab", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(of_anchors)).cast("int"))
         .withColumn("rb", everywhere(of_rows)))
    r = (rows.withColumn("rb", F.pmod(F.xxhash64("vec_id"), F.lit(of_rows)).cast("int"))
         .withColumn("ab", everywhere(of_anchors)))
    return a.groupBy("ab", "rb").cogroup(r.groupBy("ab", "rb")).applyInPandas(find, schema)


def _first(df: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The best rows of each group: at most ``most`` leave a task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id"))
    return df.withColumn("rank", rank).filter(F.col("rank") <= most)


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows``: vec_id, label and embedding; further columns only matter to
    ``is_anchor``.  Rows with a null id, label or vector or a null or non-finite
    component take no part (zero and empty vectors do); inner products are defined
    between vectors of one length only, and a product that does not fit 64 bits has
    no score.  Rows that repeat an id count once, the one of least (label, vector);
    equal vectors with ids of their own tie, and ties go to the smaller id.  Windows
    of negative scores are empty; an anchor without positives gives no row, and an
    empty table gives none.  Whatever the share of a label, blocks go by id."""
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    used = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                       F.col("embedding").cast("array<double>").alias("vector"), is_anchor.alias("asks"))
    used = used.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & F.coalesce(fine, F.lit(False)))
    one = used.groupBy("vec_id").agg(F.min(F.struct("label", "vector", "asks")).alias("r")).select("vec_id", "r.*")
    used = materialize(one, "mined-rows")
    size = used.agg(F.count("*").alias("n"), F.count_if("asks").alias("asks"), F.max(F.size("vector")).alias("d")).first()
    block = max(64, min(MOST_ROWS, BLOCK_BYTES // (8 * max(size["d"] or 1, 1))))
    # Enough cells for all cores, but none of few rows.
    cores = rows.sparkSession.sparkContext.defaultParallelism
    blocks = (max(1, -(-size["asks"] // min(block, MOST_ANCHORS))),
              max(1, -(-size["n"] // block), min(2 * cores, -(-size["n"] // LEAST_ROWS))))
    held, asked = used.select("vec_id", "label", "vector"), used.filter("asks").select("vec_id", "label", "vector")

    found = _cells(asked, held, blocks, _positives(positives), "anchor_id long, vec_id long, score long")
    # Limits without overflow: score = 100 q + r.
    found = (_first(found, ["anchor_id"], positives)
             .select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
                     F.expr("(score - pmod(score, 100)) div 100").alias("q"), F.pmod("score", F.lit(100)).alias("r"))
             .select("anchor_id", "positive_id", "positive_score", F.expr(f"q * {high} + (r * {high}) div 100").alias("upper"),
                     F.expr(f"q * {low} + (r * {low} + 99) div 100").alias("lower"))
             .filter("lower <= upper"))
    found = materialize(found, "mined-positives")
    limits = (found.groupBy("anchor_id").agg(F.sort_array(F.collect_set("upper"), asc=False).alias("uppers"), F.min("lower").alias("least"))
              .select(F.col("anchor_id").alias("vec_id"), "uppers", F.concat("uppers", F.array("least")).alias("limits")))
    limits = materialize(limits, "mined-limits")  # at most ``positives`` numbers per anchor

    met = _cells(asked.join(limits.select("vec_id", "limits"), "vec_id"), held, blocks, _slots(negatives),
                 "anchor_id long, slot int, vec_id long, score long")
    slots = (_first(met, ["anchor_id", "slot"], negatives)
             .groupBy("anchor_id", "slot").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("down"), "vec_id"))).alias("top"))
             .groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("slot", "top"))).alias("slots")))
    # From the last slot upwards: each slot's rows, then the best of all slots below it.
    merged = slots.select("anchor_id", F.expr(
        f"aggregate(reverse(slots), slice(slots, 1, 0), (done, s) -> concat(array(named_struct('slot', s.slot, 'top', "
        f"slice(concat(s.top, coalesce(get(done, 0).top, slice(s.top, 1, 0))), 1, {negatives}))), done))").alias("merged"))
    own = (found.join(limits.select(F.col("vec_id").alias("anchor_id"), "uppers"), "anchor_id")
           .withColumn("slot", F.array_position("uppers", F.col("upper")).cast("int") - 1).join(merged, "anchor_id"))
    top = F.expr("filter(get(filter(merged, m -> m.slot >= slot), 0).top, t -> -t.down >= lower)")
    return (own.select("anchor_id", "positive_id", "positive_score", F.posexplode(top).alias("at", "t"))
            .select("anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("t.vec_id").alias("negative_id"),
                    "positive_score", (-F.col("t.down")).alias("negative_score")))


def query(spark, sf_dir):
    """op11: every 50th vector as an anchor, every 7th with the next label."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END")
    return mine(rows.select("vec_id", label.alias("label"), "embedding"), F.expr("vec_id % 50 = 0"))


ORACLE = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank,
         vec_id AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""
