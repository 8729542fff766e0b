import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text, source) rows, with columns that clash with
    what operators add or use inside."""
    def make(rows, extra=True):
        df = spark.createDataFrame([(i, t, "en", s, len(t) if t is not None else None) for i, t, s in rows], DOC)
        if extra:
            from pyspark.sql import functions as F

            for name in ("size", "kept", "key", "q", "u", "p", "shard", "slot", "n_tokens", "class_id", "__b", "base", "spans",
                         "terms", "n_words", "taken", "ids", "bands"):
                df = df.withColumn(name, F.lit("mine"))
        return df

    return make


@pytest.fixture(scope="session")
def words():
    """Deterministic texts of distinct words."""
    import random

    def make(n, seed):
        r = random.Random(seed)
        return " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9))) for _ in range(n))

    return make
