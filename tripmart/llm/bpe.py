"""Byte-level BPE encoding and decoding by monoid tree reduction.

A text is cut into matches of a pattern.  Each match is encoded on its own: its
bytes are halved down to short leaves, leaves are merged by rank, and two
neighbouring token lists are joined by re-encoding a window around the seam.
The window grows until the pairs of tokens at both its edges are stable: a token
list is the encoding of its bytes exactly if every neighbouring pair encodes to
itself, so nothing outside such a window can change.  Joining is associative.
Decoding concatenates token bytes up the same kind of tree.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm.common import shield, table, without

#: Longest piece of bytes merged directly; beyond LONG bytes by a heap.
LEAF, LONG = 6, 64
NEVER = 1 << 60
SWAPPED = sys.byteorder == "big"
#: Bounds of a worker's caches: entries, and code points of a text piece kept.
CACHED, CACHED_CHARS = 120_000, 64
BLOCK = 4096  # ids decoded at once
MARKS = ".,;:!?#$%&*"  # a run of them after a word is a piece of its own
OUT = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                    T.StructField("decoded_sha256", T.StringType())])
IDS = T.ArrayType(T.IntegerType())
ALL = T.StructType([T.StructField("ids", IDS), *OUT.fields])


class Bounded(dict):
    """A cache of two generations that computes what it misses.

    When the younger one holds half of what may be kept it becomes the older one,
    whose entries come back when asked for; those nobody asks for go with it."""

    def __init__(self, make, most: int = CACHED):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        value = self.older.get(key, self)
        if value is self:
            value = self.make(key)
        if len(key) <= CACHED_CHARS:
            if 2 * len(self) >= self.most:
                self.older = dict(self)
                super().clear()
            self[key] = value
        return value

    def clear(self) -> None:
        self.older = {}
        super().clear()


class Codec:
    """Encoder and decoder for one rank table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.leaves = Bounded(self.merge)
        self.seams = Bounded(self._seam)
        self.after_space = Bounded(self._after_space)
        self.marks = Bounded(self.ids)
        size = max(self.bytes_of, default=-1) + 1
        self.length = np.array([len(self.bytes_of.get(i, b"")) for i in range(size)], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(self.bytes_of.get(i, b"") for i in range(size)), np.uint8)

    def forget(self) -> None:
        """Empty the caches: a worker that waits for its next task holds the vocabulary alone."""
        for cache in (self.leaves, self.seams, self.after_space, self.marks):
            cache.clear()

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Merge the neighbours of least rank, leftmost first, until none is left.

        Encodings are tuples: the garbage collector does not visit those of numbers."""
        if len(piece) > LONG:
            return self.merge_long(piece)
        get = self.ranks.get
        parts = [piece[i:i + 1] for i in range(len(piece))]
        pair = [get(piece[i:i + 2], NEVER) for i in range(len(piece) - 1)]
        while pair:
            least = min(pair)
            if least == NEVER:
                break
            i = pair.index(least)
            both = parts[i] = parts[i] + parts[i + 1]
            del parts[i + 1], pair[i]
            if i:
                pair[i - 1] = get(parts[i - 1] + both, NEVER)
            if i < len(pair):
                pair[i] = get(both + parts[i + 1], NEVER)
        return tuple(map(self.ranks.__getitem__, parts))

    def merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same by a heap of (rank, place): for windows that had to grow."""
        get, n = self.ranks.get, len(piece)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that starts at i
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if j < 0 or j >= n or end[j] != stop:
                continue  # one of the two has changed meanwhile
            end[i], end[j] = stop, -1
            if stop < n:
                before[stop] = i
                if (r := get(piece[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (k := before[i]) >= 0 and (r := get(piece[k:stop])) is not None:
                heapq.heappush(heap, (r, k, stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i:end[i]]])
            i = end[i]
        return tuple(out)

    def _seam(self, pair: tuple[int, int]) -> tuple[int, ...] | None:
        """What the bytes of two neighbouring tokens encode to; None: to these two."""
        both = self.merge(self.bytes_of[pair[0]] + self.bytes_of[pair[1]])
        return None if both == pair else both

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of the bytes of both, given the encodings of each."""
        seams = self.seams
        middle, i, j = seams[left[-1], right[0]], 1, 1  # i and j: tokens of the window on either side
        if middle is None:
            return left + right
        while True:
            left_ok = i == len(left) or seams[left[-i - 1], middle[0]] is None
            right_ok = j == len(right) or seams[middle[-1], right[j]] is None
            if left_ok and right_ok:
                return left[:len(left) - i] + middle + right[j:]
            i = i if left_ok else min(len(left), 2 * i)
            j = j if right_ok else min(len(right), 2 * j)
            middle = self.leaves[b"".join(map(self.bytes_of.__getitem__, left[len(left) - i:] + right[:j]))]

    def reduce(self, piece: bytes) -> tuple[int, ...]:
        """Encode the halves and join them."""
        n = len(piece)
        half = n // 2
        if n <= LEAF:
            return self.leaves[piece]
        if n <= 2 * LEAF:
            return self.join(self.leaves[piece[:half]], self.leaves[piece[half:]])
        return self.join(self.reduce(piece[:half]), self.reduce(piece[half:]))

    def match_ids(self, match: str) -> bytes:
        """Ids of one match, as little-endian 32-bit integers."""
        raw = match.encode("utf-8")
        whole = self.ranks.get(raw)  # a match that is a token is that token
        return _bytes((whole,) if whole is not None else self.reduce(raw))

    def ids(self, piece: str) -> bytes:
        """Ids of each match of the pattern in turn."""
        return b"".join(map(self.match_ids, self.find(piece)))

    def _after_space(self, piece: str) -> bytes | None:
        """Ids of a space and a piece; a plain word, or one and marks, needs no pattern.
        None: the space has white space beside it, so no match need begin there."""
        if piece.isalpha():
            return self.match_ids(" " + piece)
        word = piece.rstrip(MARKS)
        if word.isalpha():
            return self.after_space[word] + self.marks[piece[len(word):]]
        if not piece or piece[0].isspace() or piece[-1].isspace():
            return None
        return self.ids(" " + piece)

    def encode(self, text: str | None) -> np.ndarray:
        """Token ids of a whole text; a null text is empty.

        A space between two other characters begins a match, so a text may be
        cut there and equal pieces encoded once."""
        first, *pieces = (text or "").split(" ")
        found = list(map(self.after_space.__getitem__, pieces))
        if None in found or not first or first[-1].isspace():
            first, *pieces = _glued([first, *pieces])
            found = [self.after_space[p] or self.ids(" " + p) for p in pieces]
        return np.frombuffer(b"".join([self.ids(first), *found]), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        """Token bytes, gathered by blocks and concatenated up a tree."""
        parts = [self._block(ids[k:k + BLOCK]) for k in range(0, len(ids), BLOCK)]
        while len(parts) > 1:
            parts = [b"".join(parts[k:k + 2]) for k in range(0, len(parts), 2)]
        return parts[0] if parts else b""

    def _block(self, ids: np.ndarray) -> bytes:
        n = self.length[ids]
        shift = np.repeat(self.start[ids] - (np.cumsum(n) - n), n)
        return self.flat[shift + np.arange(len(shift))].tobytes()


def _bytes(ids: tuple[int, ...]) -> bytes:
    if SWAPPED:
        out = array("I", ids)
        out.byteswap()
        return out.tobytes()
    return array("I", ids).tobytes()  # 4 bytes on every platform that Spark runs on


def _glued(pieces: list[str]) -> list[str]:
    """Pieces put together again where the space between them has white space beside it."""
    groups, group, open_ = [], [pieces[0]], not pieces[0] or pieces[0][-1].isspace()
    for p in pieces[1:]:
        if open_ or not p or p[0].isspace():
            group.append(p)
        else:
            groups.append(" ".join(group))
            group = [p]
        open_ = not p or p[-1].isspace()
    return [*groups, " ".join(group)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def default_tokenizer() -> tuple[str, str]:
    """(path of the ranks, pattern) of the public multilingual vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


class _Shared:
    """One codec per Python worker, built from a broadcast rank table."""
    codecs: dict[tuple[str, str], Codec] = {}

    @classmethod
    def get(cls, ranks, digest: str, pattern: str) -> Codec:
        """``digest`` knows the vocabulary; an address could be used again."""
        key = digest, pattern
        if key not in cls.codecs:
            cls.codecs.clear()
            cls.codecs[key] = Codec(dict(ranks.value), pattern)
        return cls.codecs[key]


def _udf(spark, path: str | None, pattern: str | None, kind: str):
    """The vocabulary is read by the driver and broadcast: its size is that of
    the file, whatever the data."""
    default = default_tokenizer() if path is None or pattern is None else (None, None)
    pattern = pattern or default[1]
    table_ = list(read_ranks(path or default[0]).items())
    known = hashlib.sha256(repr(table_).encode()).hexdigest()
    ranks = spark.sparkContext.broadcast(table_)

    def codec() -> Codec:
        return _Shared.get(ranks, known, pattern)

    if kind in ("digest", "all"):
        out = OUT if kind == "digest" else ALL

        @F.pandas_udf(out)
        def digest(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            c = codec()
            for part in texts:
                rows = []
                for text in part:
                    ids = c.encode(text)
                    own = (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(c.decode(ids)).hexdigest())
                    rows.append(own if out is OUT else (ids.astype(np.int32), *own))
                yield pd.DataFrame(rows, columns=out.names)
            c.forget()

        return digest
    if kind == "encode":
        @F.pandas_udf(IDS)
        def encode(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            c = codec()
            for part in texts:
                yield pd.Series([c.encode(t).astype(np.int32) for t in part], dtype=object)
            c.forget()

        return encode

    @F.pandas_udf(T.StringType())
    def decode(ids: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = codec()
        for part in ids:
            yield pd.Series([c.decode(np.asarray(x if x is not None else [], "<u4")).decode("utf-8", "replace") for x in part], dtype=object)

    return decode


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Every row with ``ids``; null and empty texts have none.  Rows stay in
    their partitions; extra columns stay, but one named ``ids`` is replaced."""
    return without(docs, "ids").withColumn("ids", _udf(docs.sparkSession, path, pattern, "encode")("text"))


def decode(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Every row with ``decoded``, the text of its ``ids``."""
    return without(docs, "decoded").withColumn("decoded", _udf(docs.sparkSession, path, pattern, "decode")("ids"))


def digests(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Every row with the number of its ids, their digest and the decoded digest."""
    return _added(docs, path, pattern, "digest", OUT)


def tokenised(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """The same with the ids themselves, encoded once."""
    return _added(docs, path, pattern, "all", ALL)


def _added(docs: DataFrame, path: str | None, pattern: str | None, kind: str, out: T.StructType) -> DataFrame:
    safe, own = shield(without(docs, *out.names), "text")
    return safe.withColumn("__d", _udf(docs.sparkSession, path, pattern, kind)("text")).select(*own, "__d.*")


def query(spark, sf_dir):
    """op7: all documents, encoded and decoded."""
    return digests(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
