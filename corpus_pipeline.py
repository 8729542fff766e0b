"""From raw documents to token ids: quality rules, near-dedup, personal data,
source mixing, byte-level BPE.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir),
docs being what the stage before kept, and returns a DataFrame.  All but the last
return the columns of ``documents``.

Null ids, texts and sources, empty and very long texts, ties, repeated rows, empty
tables and extra columns of any name have the results that the operators state:
``quality.keep``, ``neardup.keep_one``, ``privacy.sanitise``, ``mixing.mix`` and
``bpe.tokenised``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.llm import bpe, mixing, neardup, privacy, quality
from tripmart.llm.common import materialize, small_batches, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base limits or the learned decision list reject go.

    The list is learned from the labels of the documents that came in."""
    small_batches(spark)
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, the one of least doc_id."""
    return neardup.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced in the texts, and terms that disclose it."""
    return privacy.sanitise(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the others go."""
    return mixing.mix(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row: doc_id, source, token ids, their number, and digests of the ids
    and of the decoded bytes."""
    small_batches(spark)
    return bpe.tokenised(docs.select("doc_id", "source", "text")).drop("text")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("tokenise", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over all documents; each stage is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: A learned list, sampled similarities and merges have no SQL; tests hold the
#: stages against brute-force versions.
ORACLE_SQL = None
