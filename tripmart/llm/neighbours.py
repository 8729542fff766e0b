"""Approximate nearest neighbours by a forest of random-projection trees.

Trees are fitted on a bounded sample: a node splits at the median projection on
the line between two sampled vectors.  Every vector is indexed in one leaf of
each tree.  A query walks all trees at once through one priority queue, ordered
by how far it is on the wrong side of the splits, and asks a number of leaves.
Queries meet vectors leaf by leaf, where exact cosines in double precision rank
the candidates.  How many leaves to ask is measured: for a bounded sample of
queries the true neighbours come from a scan of all rows, and the queue is
followed as far as needed to meet ``RECALL`` of them.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripmart.llm.common import materialize, table

TREES, LEAF = 10, 256
#: Vectors the trees are fitted on, and queries the search is measured on (both: those of least hash).
SAMPLE_ROWS, SAMPLE_QUERIES = 20_000, 128
LEAST_SAMPLED = 8  # sampled vectors in a leaf
RECALL = 0.96
#: A leaf with more vectors is cut into parts by hash.
PART = 4096
ASKED = 256  # queries compared with a part at once
HELD = 200_000  # rows a task holds before it keeps only the nearest
SEED = 7


@dataclass
class Tree:
    normals: np.ndarray  # inner nodes x dimension
    cuts: np.ndarray
    left: np.ndarray  # inner node, or ~leaf
    right: np.ndarray
    leaves: int

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row of unit vectors."""
        if not len(self.cuts):
            return np.zeros(len(x), np.int32)
        at = np.zeros(len(x), np.int64)
        go = np.arange(len(x))
        while len(go):
            n = at[go]
            below = np.einsum("ij,ij->i", x[go], self.normals[n]) <= self.cuts[n]
            at[go] = np.where(below, self.left[n], self.right[n])
            go = go[at[go] >= 0]
        return (~at).astype(np.int32)


def fit_tree(x: np.ndarray, total: int, rng: np.random.Generator) -> Tree:
    """One tree for ``total`` vectors from the sampled unit vectors ``x``."""
    normals, cuts, left, right, leaves = [], [], [], [], 0
    stack = [(np.arange(len(x)), -1, False)]
    while stack:
        rows, above, is_right = stack.pop()
        node = None
        if len(rows) >= 2 * LEAST_SAMPLED and len(rows) * total > LEAF * len(x):
            for _ in range(4):
                a, b = x[rng.choice(rows, 2, replace=False)]
                w = a - b
                if (size := float(np.linalg.norm(w))) < 1e-6:
                    continue
                p = x[rows] @ (w / size)
                cut = float(np.median(p))
                below = p <= cut
                if 0 < below.sum() < len(rows):
                    node = len(cuts)
                    normals.append(w / size)
                    cuts.append(cut)
                    left.append(0)
                    right.append(0)
                    stack += [(rows[below], node, False), (rows[~below], node, True)]
                    break
        if node is None:
            node, leaves = ~leaves, leaves + 1
        if above >= 0:
            (right if is_right else left)[above] = node
    d = x.shape[1] if x.ndim == 2 else 0
    return Tree(np.array(normals, np.float32).reshape(-1, d), np.array(cuts), np.array(left, np.int64),
                np.array(right, np.int64), leaves)


def order_of_leaves(trees: list[Tree], q: np.ndarray) -> Iterator[tuple[int, int]]:
    """(tree, leaf) in the order of one queue shared by all trees."""
    side = [t.normals @ q - t.cuts for t in trees]
    queue = [(0.0, k, 0 if len(t.cuts) else ~0) for k, t in enumerate(trees)]
    while queue:
        far, k, node = heapq.heappop(queue)
        while node >= 0:
            d = float(side[k][node])
            near, other = (trees[k].left[node], trees[k].right[node]) if d <= 0 else (trees[k].right[node], trees[k].left[node])
            heapq.heappush(queue, (max(far, abs(d)), k, int(other)))
            node = int(near)
        yield k, ~node


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return (x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]).astype(np.float32)


def _matrix(values, d: int) -> np.ndarray:
    return np.array([np.asarray(v, np.float64) for v in values], np.float64).reshape(-1, d)


def cosines(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Cosine of paired rows in double precision; each pair's value is its own."""
    dot = np.einsum("ij,ij->i", q, v)
    return dot / (np.sqrt(np.einsum("ij,ij->i", q, q)) * np.sqrt(np.einsum("ij,ij->i", v, v)))


def best(q: np.ndarray, v: np.ndarray, first: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, vector row, cosine) of the ``most`` nearest vectors of each query;
    equal cosines go by ``first``, the vectors' least ids."""
    rough = (q / np.linalg.norm(q, axis=1)[:, None]) @ (v / np.linalg.norm(v, axis=1)[:, None]).T
    if v.shape[0] > most:
        edge = np.partition(rough, v.shape[0] - most, axis=1)[:, v.shape[0] - most]
        qi, vi = np.nonzero(rough >= edge[:, None] - 1e-9)
    else:
        qi, vi = np.nonzero(np.ones_like(rough, bool))
    score = cosines(q[qi], v[vi])
    order = np.lexsort((first[vi], -score, qi))
    qi, vi, score = qi[order], vi[order], score[order]
    start = np.searchsorted(qi, np.arange(len(q)))
    keep = np.arange(len(qi)) - start[qi] < most
    return qi[keep], vi[keep], score[keep]


def _usable(v: Column) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return v.isNotNull() & F.coalesce(fine, F.lit(False)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))


def _distinct(rows: DataFrame, k: int) -> DataFrame:
    """Distinct vectors (key h1, h2) with their ``k + 1`` least ids.

    Equal vectors tie and ties go to the smaller id, so no other id of a
    vector can be among the k nearest of any query but itself."""
    rank = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id"))
    return (rows.withColumn("__k", rank).filter(F.col("__k") <= k + 1).groupBy("h1", "h2")
            .agg(F.first("vector").alias("vector"), F.sort_array(F.collect_list("vec_id")).alias("ids")))


def search(rows: DataFrame, is_query: Column, k: int = 5, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query row.

    ``rows``: vec_id and embedding.  Null ids, and vectors that are null, empty,
    zero or hold null or non-finite components take no part; vectors of another
    length have no cosine with a query, so each length is a search of its own.  Repeated vectors are indexed once and all returned in
    id order; ties go to the smaller id; an empty table gives no rows."""
    rows = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"), is_query.alias("__q"))
    rows = rows.filter(F.col("vec_id").isNotNull() & _usable(F.col("vector")))
    sizes = [r["d"] for r in rows.filter("__q").select(F.size("vector").alias("d")).distinct().orderBy("d").collect()]
    found = [_search_size(rows.filter(F.size("vector") == d), d, k, recall) for d in sizes]
    if not found:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _search_size(rows: DataFrame, d: int, k: int, recall: float) -> DataFrame:
    """``search`` among vectors of length ``d``."""
    spark = rows.sparkSession
    flat = F.transform("vector", lambda x: x + 0.0)  # one zero, whatever its sign
    rows = rows.withColumns({"h1": F.xxhash64(flat, F.lit(1)), "h2": F.xxhash64(flat, F.lit(2))})
    vectors = materialize(_distinct(rows.select("vec_id", "vector", "h1", "h2"), k), "ann-vectors")
    total = vectors.count()
    asked = rows.filter("__q").select(F.col("vec_id").alias("query_id"), "h1", "h2")
    queries = materialize(asked.select("h1", "h2").distinct().join(vectors.select("h1", "h2", "vector"), ["h1", "h2"]), "ann-queries")

    sample = vectors.orderBy("h1", "h2").limit(SAMPLE_ROWS).select("vector").toPandas()["vector"]
    x = _unit(_matrix(sample, d)) if len(sample) else np.zeros((0, d), np.float32)
    rng = np.random.default_rng(SEED)
    trees = [fit_tree(x, total, rng) for _ in range(TREES)]
    forest = spark.sparkContext.broadcast(trees)  # at most 2 * SAMPLE_ROWS / LEAST_SAMPLED nodes a tree

    def assign(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            u = _unit(_matrix(part["vector"], d))
            part["leaves"] = list(np.stack([t.leaf_of(u) for t in forest.value], axis=1)) if len(part) else []
            yield part

    indexed = materialize(vectors.mapInPandas(assign, "h1 long, h2 long, vector array<double>, ids array<long>, leaves array<int>"), "ann-index")
    filled = (indexed.select(F.posexplode("leaves").alias("tree", "leaf")).groupBy("tree", "leaf").count().collect())
    counts = {(r["tree"], r["leaf"]): r["count"] for r in filled}  # one number per leaf of the forest
    most = _leaves_needed(queries, indexed, trees, d, k, recall)
    counted = spark.sparkContext.broadcast(counts)

    def ask(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for h1, h2, v, u in zip(part["h1"], part["h2"], part["vector"], _unit(_matrix(part["vector"], d))):
                seen, found = 0, [0] * TREES
                for t, leaf in order_of_leaves(forest.value, u):
                    n = counted.value.get((t, leaf), 0)
                    out += [(t, leaf, p, True, h1, h2, v, None) for p in range(-(-n // PART))]
                    seen, found[t] = seen + 1, found[t] + n
                    if seen >= most and max(found) > k:
                        break
            yield pd.DataFrame(out, columns=["tree", "leaf", "part", "asks", "h1", "h2", "vector", "ids"])

    schema = "tree int, leaf int, part int, asks boolean, h1 long, h2 long, vector array<double>, ids array<long>"
    parts = spark.createDataFrame([(t, l, -(-n // PART)) for (t, l), n in counts.items()] or [(0, 0, 1)], "tree int, leaf int, parts int")
    held = (indexed.select("h1", "h2", "vector", "ids", F.posexplode("leaves").alias("tree", "leaf"))
            .join(F.broadcast(parts), ["tree", "leaf"])  # a row per leaf of the forest
            .select("tree", "leaf", F.pmod("h2", F.col("parts")).cast("int").alias("part"), F.lit(False).alias("asks"), "h1", "h2", "vector", "ids"))
    met = (held.unionByName(queries.mapInPandas(ask, schema)).repartition("tree", "leaf", "part")
           .sortWithinPartitions("tree", "leaf", "part", "asks"))

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted: the vectors of a leaf's part, then its queries."""
        key, v, ids = None, [], []
        held: list[pd.DataFrame] = []
        for batch in batches:
            for here, g in batch.groupby(["tree", "leaf", "part"], sort=False):
                if here != key:
                    key, v, ids = here, [], []
                hold, q = g[~g["asks"]], g[g["asks"]]
                v += list(hold["vector"])
                ids += list(hold["ids"])
                if not len(q) or not v:
                    continue
                block, first = _matrix(v, d), np.array([i[0] for i in ids], np.int64)
                for at in range(0, len(q), ASKED):
                    some = q.iloc[at:at + ASKED]
                    qi, vi, score = best(_matrix(some["vector"], d), block, first, k + 1)
                    held.append(pd.DataFrame({"h1": some["h1"].to_numpy()[qi], "h2": some["h2"].to_numpy()[qi], "score": score,
                                              "first": first[vi], "ids": [ids[j] for j in vi]}))
            if sum(map(len, held)) > HELD:
                held = [_nearest(held, k)]
                if len(held[0]) > HELD // 2:
                    yield held.pop()
        if held:
            yield _nearest(held, k)

    found = met.mapInPandas(meet, "h1 long, h2 long, score double, first long, ids array<long>")
    # A vector met in several trees has one score; keep each query's k + 1 best vectors.
    found = found.groupBy("h1", "h2", "first").agg(F.max("score").alias("score"), F.first("ids").alias("ids"))
    near = Window.partitionBy("h1", "h2").orderBy(F.desc("score"), "first")
    found = (found.withColumn("__k", F.row_number().over(near)).filter(F.col("__k") <= k + 1)
             .groupBy("h1", "h2").agg(F.collect_list(F.struct("score", "ids")).alias("near")))
    pairs = (asked.join(found, ["h1", "h2"]).select("query_id", F.explode("near").alias("n"))
             .select("query_id", "n.score", F.explode("n.ids").alias("vec_id")).filter("vec_id <> query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _nearest(parts: list[pd.DataFrame], k: int) -> pd.DataFrame:
    """Each query's k + 1 nearest vectors among those met in a task so far."""
    rows = pd.concat(parts).drop_duplicates(["h1", "h2", "first"])
    return rows.sort_values(["h1", "h2", "score", "first"], ascending=[True, True, False, True]).groupby(["h1", "h2"]).head(k + 1)


def nearest_by_scan(queries: pd.DataFrame, vectors: DataFrame, d: int, k: int) -> pd.DataFrame:
    """The true k nearest vectors of a bounded set of queries: one scan in blocks."""
    q = vectors.sparkSession.sparkContext.broadcast((queries[["h1", "h2"]].to_numpy(np.int64), _matrix(queries["vector"], d)))

    def scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, x = q.value
        top = None
        for part in parts:
            if not len(part):
                continue
            first = np.array([i[0] for i in part["ids"]], np.int64)
            qi, vi, score = best(x, _matrix(part["vector"], d), first, k + 1)
            new = pd.DataFrame({"q": qi, "score": score, "first": first[vi], "h1": part["h1"].to_numpy()[vi],
                                "h2": part["h2"].to_numpy()[vi], "leaves": [part["leaves"].iloc[j] for j in vi]})
            top = new if top is None else pd.concat([top, new])
            top = top.sort_values(["q", "score", "first"], ascending=[True, False, True]).groupby("q").head(k + 1)
        if top is not None:
            yield top

    near = vectors.mapInPandas(scan, "q int, score double, first long, h1 long, h2 long, leaves array<int>")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "first"))
    return near.withColumn("__k", rank).filter(F.col("__k") <= k + 1).toPandas()


def _leaves_needed(queries: DataFrame, indexed: DataFrame, trees: list[Tree], d: int, k: int, recall: float) -> int:
    """Leaves to ask so that ``recall`` of the true neighbours are met."""
    sample = queries.orderBy(F.xxhash64("h1", "h2"), "h1").limit(SAMPLE_QUERIES).toPandas()
    if not len(sample):
        return TREES
    true = nearest_by_scan(sample, indexed, d, k)
    places: list[float] = []
    units = _unit(_matrix(sample["vector"], d))
    for i, near in true.groupby("q"):
        me = (sample["h1"].iloc[i], sample["h2"].iloc[i])
        place = {leaf: n for n, leaf in enumerate(order_of_leaves(trees, units[i]), 1)}
        for h1, h2, leaves in zip(near["h1"], near["h2"], near["leaves"]):
            if (h1, h2) != me:
                places.append(min(place[t, int(leaf)] for t, leaf in enumerate(leaves)))
    return max(TREES, math.ceil(float(np.quantile(places, recall)))) if places else TREES


def query(spark, sf_dir):
    """op10: every 50th vector against all."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(rows, F.col("vec_id") % 50 == 0)
