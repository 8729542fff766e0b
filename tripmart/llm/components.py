"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b; any orderable type).

    Each round every node moves to the least node in its neighbourhood and from
    there once more; links between the places reached are the next round's.
    The links shrink by at least half a round; nothing is collected.  A hub's
    neighbours meet as partial minima, and joins on it are split by AQE."""
    links = materialize(links.filter("a <> b").select("a", "b").distinct(), "links")
    moves: list[DataFrame] = []
    while not links.isEmpty():
        both = links.union(links.select("b", "a")).toDF("a", "b")
        least = both.groupBy("a").agg(F.min("b").alias("b"))
        step = least.select(F.col("a").alias("node"), F.least("a", "b").alias("to"))
        again = step.select(F.col("node").alias("to"), F.col("to").alias("next"))
        move = materialize(step.join(again, "to", "left").select("node", F.coalesce("next", "to").alias("to")), "moves")
        moves.append(move)
        links = (links.join(move.toDF("a", "ta"), "a").join(move.toDF("b", "tb"), "b")
                 .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).filter("a <> b").distinct())
        links = materialize(links, "links")
    if not moves:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = moves[0].withColumnRenamed("to", "root")
    for move in moves[1:]:
        out = out.join(move.toDF("root", "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return out
