"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint has bit k set if more than half of the text's shingle hashes have
it.  Fingerprints within ``ERRORS`` bits are links, classes are the connected
components.  To find links without comparing all fingerprints, 64 bits are cut
into ``ERRORS + EXACT`` segments: two linked fingerprints agree wholly in at
least ``EXACT`` of them, and of the two halves of the other bits one has at most
one error.  So for every choice of exact segments and of a half, the half is
decoded by the perfect binary Golay code: a word within three errors of a
codeword has that codeword's index as its home key; a word exactly three errors
off also has the five codewords at distance four as keys.  A word and any word
one bit away then meet: the home key of each is among the keys of the other.
Fingerprints are joined on (segments' bits, codeword index), home keys on one
side and all keys on the other, and the distance is verified in the join.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm.common import materialize, shield, table, without
from tripmart.llm.components import components

WORDS_PER_SHINGLE, SEED = 3, 42
BITS, ERRORS, EXACT = 64, 3, 2
#: Generator polynomial of the binary Golay code of 23 bits, 12 of them data.
LENGTH, CHECK_BITS, GENERATOR = 23, 11, 0b110001110101
_U = np.uint64


# --- fingerprints ----------------------------------------------------------------

def fingerprint(text: str | None) -> int:
    """64 bits of a whole text; zero without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and white space
    if not words:
        return 0
    size = min(WORDS_PER_SHINGLE, len(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    ones, n = np.zeros(BITS, np.int64), len(words) - size + 1
    for at in range(0, n, 1 << 16):  # bounded memory for very long texts
        last = min(n, at + (1 << 16))
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in
                           zip(starts[at:last].tolist(), ends[at + size - 1:last + size - 1].tolist())], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


@F.pandas_udf(T.LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


# --- keys ------------------------------------------------------------------------

class Golay:
    """Codeword indices near 23-bit words, for whole arrays."""

    def __init__(self):
        rest = [1 << i for i in range(CHECK_BITS)]  # remainders of the powers of x
        for _ in range(CHECK_BITS, LENGTH):
            up = rest[-1] << 1
            rest.append(up ^ GENERATOR if up >> CHECK_BITS else up)
        self.rest = np.array(rest, np.uint32)
        self.error = np.zeros(1 << CHECK_BITS, np.uint32)  # of each syndrome, at most three bits
        words = np.arange(1 << (LENGTH - CHECK_BITS), dtype=np.uint32) << np.uint32(CHECK_BITS)
        codewords = words ^ self.syndrome(words)
        light = codewords[np.bitwise_count(codewords) == 7]
        #: Per syndrome of three errors: the indices between its codeword and the five next ones.
        self.next = np.full((1 << CHECK_BITS, 5), -1, np.int64)
        for weight in (1, 2, 3):
            for bits in itertools.combinations(range(LENGTH), weight):
                e = np.uint32(sum(1 << b for b in bits))
                s = self.syndrome(np.array([e]))[0]
                self.error[s] = e
                if weight == 3:
                    self.next[s] = light[(light & e) == e] >> CHECK_BITS

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words), np.uint32)
        for i, r in enumerate(self.rest):
            out ^= ((words >> np.uint32(i)) & np.uint32(1)) * r
        return out

    def near(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the home codeword, the five others at distance four or -1) of each word."""
        s = self.syndrome(words)
        home = ((words ^ self.error[s]) >> np.uint32(CHECK_BITS)).astype(np.int64)
        others = self.next[s]
        return home, np.where(others < 0, -1, others ^ home[:, None])


def _segments() -> list[tuple[int, int]]:
    """(first bit, width) of each segment."""
    cuts = np.linspace(0, BITS, ERRORS + EXACT + 1).round().astype(int)
    return [(int(a), int(b - a)) for a, b in zip(cuts, cuts[1:])]


def _pack(f: np.ndarray, segments: list[tuple[int, int]]) -> np.ndarray:
    out, at = np.zeros(len(f), np.uint64), 0
    for first, width in segments:
        out |= ((f >> _U(first)) & _U((1 << width) - 1)) << _U(at)
        at += width
    return out


def keys(f: np.ndarray, golay: Golay) -> tuple[np.ndarray, list[np.ndarray]]:
    """(home keys, all keys) of signed 64-bit fingerprints; two at most three bits
    apart have a key in common that is a home key of either."""
    f = f.view(np.uint64)
    home, others = [], []
    whole = _segments()
    for k, exact in enumerate(itertools.combinations(range(len(whole)), EXACT)):
        fixed = _pack(f, [whole[i] for i in exact])
        rest = [whole[i] for i in range(len(whole)) if i not in exact]
        half = (sum(w for _, w in rest) + 1) // 2
        free = _pack(f, rest)
        for part, word in enumerate((free & _U((1 << half) - 1), free >> _U(half))):
            index, more = golay.near(word.astype(np.uint32))
            base = (((_U(2 * k + part) << _U(32)) | fixed) << _U(LENGTH - CHECK_BITS)).astype(np.int64)
            home.append(base | index)
            others.append(np.where(more < 0, -1, base[:, None] | more))
    home = np.stack(home, axis=1)
    every = np.concatenate([home, *others], axis=1)
    return home, [x[x >= 0] for x in every]


_golay: list[Golay] = []


def _golay_of_worker() -> Golay:
    if not _golay:
        _golay.append(Golay())
    return _golay[0]


@F.pandas_udf(T.ArrayType(T.LongType()))
def home_keys(f: pd.Series) -> pd.Series:
    return pd.Series(list(keys(f.to_numpy(np.int64), _golay_of_worker())[0]), dtype=object)


@F.pandas_udf(T.ArrayType(T.LongType()))
def all_keys(f: pd.Series) -> pd.Series:
    return pd.Series(keys(f.to_numpy(np.int64), _golay_of_worker())[1], dtype=object)


# --- links and classes -----------------------------------------------------------

def links(prints: DataFrame, most: int = ERRORS) -> DataFrame:
    """(a, b), a < b: all pairs of different fingerprints at most ``most`` (up to three) bits apart.

    ``prints``: distinct values in a long column ``f``.  A bucket holds fingerprints
    that agree in 25 bits at least and in a codeword; pairs farther apart never
    leave the join.  Spark sizes the exploded sides by the fingerprints, twenty and
    more times too low, and would broadcast one: both are shuffled."""
    if not 0 <= most <= ERRORS:
        raise ValueError(f"links are found up to {ERRORS} bits")
    home = prints.select(F.col("f").alias("a"), F.explode(home_keys("f")).alias("key"))
    probe = prints.select(F.col("f").alias("b"), F.explode(all_keys("f")).alias("key"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= most
    met = home.hint("merge").join(probe, (home["key"] == probe["key"]) & (F.col("a") != F.col("b")) & near)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def nodes_of(prints: DataFrame, most: int = ERRORS) -> DataFrame:
    """(f, component_id, n_links) of every distinct fingerprint in ``prints`` (doc_id, f)."""
    nodes = materialize(prints.groupBy("f").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    found = materialize(links(nodes.select("f"), most), "simhash-links")
    ends = found.select(F.col("a").alias("f")).union(found.select("b"))  # an explode would be sized as one end
    degree = ends.groupBy("f").agg(F.count("*").alias("n_links"))
    linked = materialize(nodes.join(components(found).withColumnRenamed("node", "f"), "f").join(degree, "f"), "simhash-linked")
    heads = linked.groupBy("root").agg(F.min("least").alias("head"))
    linked = linked.join(heads, "root").select("f", "head", "n_links")
    return nodes.join(linked, "f", "left").select(
        "f", F.when(F.col("n_links").isNull(), F.col("least")).otherwise(F.col("head")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def classes(docs: DataFrame, most: int = ERRORS) -> DataFrame:
    """All rows and columns of ``docs`` with ``fingerprint`` (16 hex digits),
    ``component_id`` (the least doc_id reachable over links) and ``n_links`` (other
    fingerprints linked to the row's own).

    Needs doc_id and text.  Null and empty texts and texts of white space have
    fingerprint zero, which links like any other; texts of one or two words are one
    shingle; whole texts count, however long.  Equal fingerprints are one node, so
    repeated rows and copies cost one row each, however many.  A null doc_id gives
    no class its id; a class of such rows only has a null id.  An empty table stays
    empty; extra columns stay, and columns named like an output are replaced."""
    rows, own = shield(without(docs, "fingerprint", "component_id", "n_links"), "doc_id", "text")
    rows = rows.withColumn("f", fingerprints("text"))
    known = nodes_of(materialize(rows.select("doc_id", "f"), "simhash-read"), most)
    return rows.join(known, "f").select(*own, _hex("f"), "component_id", "n_links")


def _hex(name: str) -> Column:
    return F.lower(F.lpad(F.hex(name), 16, "0")).alias("fingerprint")


def query(spark, sf_dir):
    """op12: every document with its fingerprint and component; the texts are read once."""
    docs = table(spark, sf_dir, "documents")
    read = materialize(docs.select("doc_id", fingerprints("text").alias("f")), "simhash-read")
    return read.join(nodes_of(read), "f").select("doc_id", _hex("f"), "component_id", "n_links")
