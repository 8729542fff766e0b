"""Near-duplicates by improved consistent weighted sampling.

Equal texts are one class to begin with, known by a digest.  A text is the set
of its five-word shingles, weighted by TF-IDF: tf is 1 + ln(count), idf the smoothed
ln(1 + documents / unlike documents with the shingle), exact for every shingle in more than
``RARE`` of all documents and the same for the others.  Near copies are hardly more than one
document here: a frequent passage counts less the more texts it is in, and a family of
copies keeps its own text against its few edits.
Improved consistent weighted sampling draws one (shingle, level) per hash
function with a probability of agreement equal to the weighted Jaccard
similarity.  Samples are banded, and texts that share a band meet in a bucket with
their weighted shingles.  A bucket is one bounded group: a pair that is not connected
yet, and that no bucket of an earlier band holds, is compared by a longer sketch
first (``SKETCH`` more samples; a pair at the similarity falls below ``REFUTED`` with
a probability below 1e-6) and then by exact weighted Jaccard similarity, and only the links that
connect leave the task.  Buckets beyond the bound go another exact way: their texts
are compared with two pivots, and what is not connected then meets by a prefix filter
over the rarest shingles.  Classes are the connected components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm import shingles
from tripmart.llm.bloom import Bloom
from tripmart.llm.common import materialize, shield, table
from tripmart.llm.components import components

SIMILARITY = 0.8
BANDS, ROWS = 16, 4  # a pair at 0.8 shares a band with probability 0.9998
SKETCH = 512  # samples of a byte each that tell unlike texts of a bucket apart
REFUTED = 0.09  # how far an estimate may lie below the similarity: five standard deviations
#: A bucket compared within one task: texts, and shingles of them (5 bytes each).
MOST_TEXTS, MOST_SHINGLES = 2048, 8_000_000
RARE = 1 / 64  # a shingle in a smaller share of all documents has the greatest idf
GROUP = 256  # documents looked at together for common shingles
MAX_COMMON = 4_000_000
PACK = 1024  # common shingles in one row of a group of copies
MOST_HELD = 2_000_000  # common shingles held in a task before its groups move
SLOTS = 18  # bits of the counters that tell frequent shingles from rare ones
PART = 1024  # rows of a frequent shingle compared in one task's share
_DRAWS = 1 << 16
_U = np.uint64
_LOW = _U((1 << 48) - 1)


class Sampler:
    """Consistent weighted samples of a text.

    The draws r, c ~ Gamma(2, 1) and b ~ U(0, 1) of a shingle and a hash function
    come from a table of seeded triples; a sample is the least
    ln c - r (t - b) - r with level t = floor(ln w / r + b), as one 64-bit key of
    its rank and of (shingle, level)."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.r, self.c, self.b = rng.gamma(2, 1, _DRAWS), rng.gamma(2, 1, _DRAWS), rng.random(_DRAWS)
        unit = np.log(self.c) + self.r * self.b - self.r  # weight 1 has level 0
        self.sorted = np.sort(unit)
        self.rank = (np.argsort(np.argsort(unit, kind="stable"), kind="stable").astype(np.uint64)) << _U(48)
        self.keys = rng.integers(1, 1 << 63, bands * rows, dtype=np.uint64) * _U(2) + _U(1)

    def samples(self, s: np.ndarray, w: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """(texts x functions) keys; ``starts``: where each text's shingles begin."""
        out = np.empty((len(starts), len(self.keys)), np.uint64)
        odd = np.flatnonzero(w != 1)
        lw = np.log(w[odd])
        for k, key in enumerate(self.keys):
            h = (s ^ key) * _U(0x9FB21C651E98DF25)
            h ^= h >> _U(29)
            h *= _U(0xD6E8FEB86659FD93)
            h ^= h >> _U(32)
            draw = h >> _U(48)
            v = self.rank[draw] | (h & _LOW)
            if len(odd):
                d = draw[odd]
                t = np.floor(lw / self.r[d] + self.b[d])
                a = np.log(self.c[d]) - self.r[d] * (t - self.b[d]) - self.r[d]
                rank = np.minimum(np.searchsorted(self.sorted, a), _DRAWS - 1).astype(np.uint64)
                level = t.astype(np.int64).view(np.uint64) * _U(0x9E3779B97F4A7C15)
                low = np.where(t == 0, h[odd], shingles.mix(h[odd] + level))
                v[odd] = (rank << _U(48)) | (low & _LOW)
            out[:, k] = np.minimum.reduceat(v, starts)
        return out

    def band_hashes(self, samples: np.ndarray) -> np.ndarray:
        out = np.zeros((len(samples), self.bands), np.uint64)
        for j in range(self.rows):
            out = shingles.mix(out * _U(0x9FB21C651E98DF25) + samples[:, j::self.rows][:, :self.bands])
        return out.view(np.int64)


def idf(share):
    """Smoothed inverse document frequency, 1 for a shingle in a third of all documents."""
    return np.log(1 + 1 / np.maximum(share, RARE)) / math.log(1 + 3)


def weights(counts: np.ndarray, hashes: np.ndarray, common: dict[str, np.ndarray] | None) -> np.ndarray:
    """TF-IDF of distinct shingles over the greatest idf (the similarity knows no unit):
    a rare shingle that occurs once weighs 1; ``common``: sorted hashes and their idf."""
    w = 1 + np.log(counts)
    if common is not None and len(common["hash"]):
        at = np.minimum(np.searchsorted(common["hash"], hashes), len(common["hash"]) - 1)
        w = np.where(common["hash"][at] == hashes, w * (common["idf"][at] / idf(RARE)), w)
    return w


def _tables(texts: list[str | None], common) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(position, distinct shingles, weights) of the texts that have words."""
    for i, all_ in shingles.documents(texts):
        if len(all_):
            s, n = np.unique(all_, return_counts=True)
            yield i, s, weights(n, s, common)


def common_shingles(texts: DataFrame) -> dict[str, np.ndarray]:
    """Exact idf of the shingles that are in more than ``RARE`` of all documents; all
    others have the greatest one.

    Such a shingle is as frequent in at least one group of documents (else it
    could not be so overall), so the first pass names candidates group by group,
    the second counts only those and the third, of what is left, the unlike documents.
    There are at most 1 / RARE times as many as a document has shingles on average,
    whatever the corpus."""
    def name(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        n = 0

        def flush() -> pd.DataFrame:
            s, often = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0))
            s = s[often > RARE * len(held)]
            if len(s):  # repeats within a document do not count
                _, each = np.unique(np.concatenate([np.intersect1d(s, np.unique(x)) for x in held]), return_counts=True)
                s = s[each > RARE * len(held)]
            return pd.DataFrame({"hash": s.view(np.int64), "n": 0})

        for part in parts:
            for _, x in shingles.documents(part["text"].tolist()):
                if not len(x):
                    continue
                held.append(x)
                n += 1
                if len(held) >= 2 * GROUP:
                    rest, held = held[GROUP:], held[:GROUP]
                    yield flush()
                    held = rest
        if held:
            yield flush()
        yield pd.DataFrame({"hash": [0], "n": [n]})  # documents with words

    named = materialize(texts.mapInPandas(name, "hash long, n long"), "idf-named")
    total = named.agg(F.sum("n")).first()[0] or 0
    wanted = named.filter("n = 0").select("hash").distinct()
    if wanted.isEmpty():
        return {"hash": np.zeros(0, np.uint64), "idf": np.zeros(0)}
    if wanted.count() > MAX_COMMON:
        return _idf(_unlike(texts, _above(_counted_by_join(texts, wanted), total)), total)
    asked = texts.sparkSession.sparkContext.broadcast(np.sort(wanted.toPandas()["hash"].to_numpy().view(np.uint64)))

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        want = asked.value
        seen = np.zeros(len(want), np.int64)
        for part in parts:
            for _, x in shingles.documents(part["text"].tolist()):
                at = np.minimum(np.searchsorted(want, x), len(want) - 1)
                seen[np.unique(at[want[at] == x])] += 1
        yield pd.DataFrame({"hash": want.view(np.int64), "n": seen})[seen > 0]

    return _idf(_unlike(texts, _above(texts.mapInPandas(count, "hash long, n long"), total)), total)


def _counted_by_join(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(hash, n): candidates too many for a broadcast meet the texts' shingles by a join."""
    def each(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = [np.unique(x) for _, x in shingles.documents(part["text"].tolist())]
            s, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            for at in range(0, len(s), 100_000):
                yield pd.DataFrame({"hash": s[at:at + 100_000].view(np.int64), "n": n[at:at + 100_000]})

    return texts.mapInPandas(each, "hash long, n long").join(wanted, "hash", "left_semi")


def _above(counts: DataFrame, total: int) -> np.ndarray:
    """The shingles in more than ``RARE`` of all documents: at most 1 / RARE times a text's average."""
    counted = counts.groupBy("hash").agg(F.sum("n").alias("n")).filter(F.col("n") > RARE * total).select("hash").toPandas()
    return np.sort(counted["hash"].to_numpy(np.int64).view(np.uint64))


def _unlike(texts: DataFrame, hashes: np.ndarray) -> DataFrame:
    """(hash, n): the effective number of unlike documents with each shingle.

    Documents that agree in ``ROWS`` plain samples are taken for copies of one another;
    groups of n1, n2, ... such documents are (n1 + n2 + ...)^2 / (n1^2 + n2^2 + ...)
    documents, which is their number if all are unlike.  A document's shingles move as
    places in the sorted hashes, packed, one row for all documents of a task that agree."""
    asked = texts.sparkSession.sparkContext.broadcast(hashes)

    def met(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        want, sampler = asked.value, Sampler(1, ROWS, seed=13)
        found: dict[int, list[np.ndarray]] = {}
        held = 0

        def flush() -> pd.DataFrame:
            rows = []
            for key, some in found.items():
                at, n = np.unique(np.concatenate(some), return_counts=True)
                rows += [(key, at[k:k + PACK].astype(np.int32).tobytes(), n[k:k + PACK].astype(np.int32).tobytes()) for k in range(0, len(at), PACK)]
            return pd.DataFrame(rows, columns=["copies", "at", "n"])

        for part in parts if len(want) else ():
            for _, x in shingles.documents(part["text"].tolist()):
                at = np.minimum(np.searchsorted(want, x), len(want) - 1)
                at = np.unique(at[want[at] == x])
                if len(at):
                    key = sampler.band_hashes(sampler.samples(x, np.ones(len(x)), np.array([0])))[0, 0]
                    found.setdefault(int(key), []).append(at.astype(np.int32))
                    held += len(at)
                if held > MOST_HELD:
                    yield flush()
                    found, held = {}, 0
        if found:
            yield flush()

    def add(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        want = asked.value
        total, squares, here = np.zeros(len(want)), np.zeros(len(want)), np.zeros(len(want))
        key, touched = None, []

        def close() -> None:
            at = np.unique(np.concatenate(touched))
            total[at] += here[at]
            squares[at] += here[at] ** 2
            here[at] = 0

        for part in parts:
            for copies, at, n in zip(part["copies"], part["at"], part["n"]):
                if copies != key and touched:
                    close()
                    touched = []
                key = copies
                touched.append(np.frombuffer(at, np.int32))
                here[touched[-1]] += np.frombuffer(n, np.int32)
        if touched:
            close()
        at = np.flatnonzero(total)
        yield pd.DataFrame({"hash": want[at].view(np.int64), "total": total[at], "squares": squares[at]})

    groups = texts.mapInPandas(met, "copies long, at binary, n binary").repartition("copies").sortWithinPartitions("copies")
    sums = groups.mapInPandas(add, "hash long, total double, squares double").groupBy("hash").agg(F.sum("total").alias("n"), F.sum("squares").alias("squares"))
    return sums.select("hash", (F.col("n") * F.col("n") / F.col("squares")).alias("n"))


def _idf(counts: DataFrame, total: int) -> dict[str, np.ndarray]:
    """Of the common shingles alone."""
    counted = counts.filter(F.col("n") > RARE * total).toPandas()
    hashes, n = counted["hash"].to_numpy(np.int64).view(np.uint64), counted["n"].to_numpy(float)
    order = np.argsort(hashes)
    return {"hash": hashes[order], "idf": idf(n[order] / max(total, 1))}


def similarity(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted sets."""
    if not len(a) or not len(b):
        return 0.0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    hit = b[at] == a
    shared = float(np.minimum(wa[hit], wb[at[hit]]).sum())
    return shared / (float(wa.sum()) + float(wb.sum()) - shared)


def _digest(text):
    """16 bytes that know a text; null for a null text."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def _signatures(rows: DataFrame, common) -> DataFrame:
    """(doc_id, key, bands) of every row; no bands without words."""
    def sign(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sampler = Sampler()
        for part in parts:
            bands: list = [None] * len(part)
            size = np.zeros(len(part), np.int64)
            s, w, where, n = [], [], [], 0

            def flush() -> None:
                starts = np.cumsum([0] + [len(x) for x in s[:-1]])
                for i, b in zip(where, sampler.band_hashes(sampler.samples(np.concatenate(s), np.concatenate(w), starts))):
                    bands[i] = b

            for i, x, wx in _tables(part["text"].tolist(), common.value):
                s.append(x)
                w.append(wx)
                where.append(i)
                size[i] = len(x)
                n += len(x)
                if n > 100_000:
                    flush()
                    s, w, where, n = [], [], [], 0
            if s:
                flush()
            yield pd.DataFrame({"doc_id": part["doc_id"], "key": part["key"], "bands": bands, "n": size})

    return rows.mapInPandas(sign, "doc_id string, key binary, bands array<long>, n long")


PACKED = 5  # bytes kept of a shingle's hash where texts are compared


def _pack(s: np.ndarray) -> bytes:
    """The upper ``PACKED`` bytes of sorted hashes."""
    return np.ascontiguousarray((s >> _U(64 - 8 * PACKED)).view(np.uint8).reshape(-1, 8)[:, :PACKED]).tobytes()


def _unpack(b) -> np.ndarray:
    out = np.zeros((len(b) // PACKED, 8), np.uint8)
    out[:, :PACKED] = np.frombuffer(b, np.uint8).reshape(-1, PACKED)
    return out.view(np.uint64).ravel()


def _sets(rows: DataFrame, common, wanted: Bloom) -> DataFrame:
    """(key, doc_id, s, w, sketch): packed weighted shingles of the texts that may be
    wanted (by the hash ``h``) and the sketch that is compared first."""
    def build(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sampler = Sampler(SKETCH, 1, seed=12)

        def drawn(got: list[tuple[int, np.ndarray, np.ndarray]]) -> pd.DataFrame:
            starts = np.cumsum([0] + [len(s) for _, s, _ in got[:-1]])
            sketch = sampler.samples(np.concatenate([s for _, s, _ in got]), np.concatenate([w for *_, w in got]), starts)
            return pd.DataFrame({"key": [keys[i] for i, *_ in got], "doc_id": [ids[i] for i, *_ in got],
                                 "s": [_pack(s) for _, s, _ in got],
                                 "w": [w.astype(np.float32) if (w != 1).any() else None for *_, w in got],
                                 "sketch": [x.astype(np.uint8).tobytes() for x in sketch]})

        for part in parts:
            part = part[wanted.hits(part["h"].to_numpy(np.int64))]
            keys, ids = part["key"].tolist(), part["doc_id"].tolist()
            got, n = [], 0
            for row in _tables(part["text"].tolist(), common.value):
                got.append(row)
                n += len(row[1])
                if n > 100_000:  # few shingles at once, however long the texts
                    yield drawn(got)
                    got, n = [], 0
            if got:
                yield drawn(got)

    return rows.mapInPandas(build, "key binary, doc_id string, s binary, w array<float>, sketch binary")


def _weights_of(s: np.ndarray, w) -> np.ndarray:
    return np.ones(len(s)) if w is None else np.asarray(w, float)


UNPACKED = 500_000  # shingles held unpacked at once


class _Bucket:
    """The texts of one bucket (key, bands, s, w, sketch) and what connects them."""

    def __init__(self, rows: pa.Table):
        n = rows.num_rows
        self.keys, self.packed, self.w = rows["key"].to_pylist(), rows["s"].combine_chunks(), rows["w"].combine_chunks()
        self.bands = np.array(rows["bands"].to_pylist(), np.int64).reshape(n, -1)
        self.sketch = np.frombuffer(b"".join(rows["sketch"].to_pylist()), np.uint8).reshape(n, -1)
        self.root = np.arange(n)
        self.sets: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.held = 0

    def set_of(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if i not in self.sets:
            if self.held > UNPACKED:
                self.sets.clear()
                self.held = 0
            s = _unpack(self.packed[i].as_buffer())
            self.sets[i] = s, _weights_of(s, self.w[i].as_py())
            self.held += len(s)
        return self.sets[i]

    def links(self, band: int, least: float) -> list[tuple[bytes, bytes]]:
        """Pairs at ``least`` or more that connect texts not connected before.

        Likely pairs come first, so that most others are connected when their turn comes."""
        found, waiting = [], []
        for i in range(len(self.keys) - 1):
            alike = (self.sketch[i + 1:] == self.sketch[i]).mean(axis=1)
            close = np.flatnonzero(alike >= least - REFUTED)
            if band:  # a bucket of an earlier band has seen the others
                close = close[~(self.bands[i + 1:][close, :band] == self.bands[i, :band]).any(axis=1)]
            sure = alike[close] >= least + REFUTED / 2
            found += self.join(i, close[sure] + i + 1, least, at_once=16)
            if not sure.all():
                waiting.append((i, (close[~sure] + i + 1).astype(np.int32)))
        for i, those in waiting:
            found += self.join(i, those, least, at_once=256)
        return found

    def join(self, i: int, those: np.ndarray, least: float, at_once: int) -> list[tuple[bytes, bytes]]:
        found = []
        for at in range(0, len(those), at_once):
            some = those[at:at + at_once]
            some = some[self.root[some] != self.root[i]]
            if not len(some):
                continue
            for j in some[self.similarities(i, some) >= least - 1e-9]:
                if self.root[i] != self.root[j]:
                    self.root[self.root == self.root[j]] = self.root[i]
                    found.append(tuple(sorted((self.keys[i], self.keys[int(j)]))))
        return found

    def similarities(self, i: int, those: np.ndarray) -> np.ndarray:
        """Weighted Jaccard similarity of one text and some others."""
        s, w = self.set_of(i)
        others = [self.set_of(int(j)) for j in those]
        t, v = np.concatenate([x for x, _ in others]), np.concatenate([x for _, x in others])
        starts = np.cumsum([0] + [len(x) for x, _ in others[:-1]])
        at = np.minimum(np.searchsorted(s, t), len(s) - 1)
        shared = np.add.reduceat(np.where(s[at] == t, np.minimum(w[at], v), 0.0), starts)
        return shared / (w.sum() + np.add.reduceat(v, starts) - shared)


def _meet(buckets: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(a, b): links that connect the texts of each bucket (band, hash, key, bands)."""
    rows = buckets.join(sets, "key").select("band", "hash", "key", "bands", "s", "w", "sketch")
    rows = rows.repartition("band", "hash").sortWithinPartitions("band", "hash", "key")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []  # slices of batches, not copies

        def close() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held)
            found = _Bucket(whole).links(at[0], least) if whole.num_rows > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.binary()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            band, hash_ = (batch.column(c).to_numpy() for c in ("band", "hash"))
            starts = [0, *(np.flatnonzero((np.diff(band) != 0) | (np.diff(hash_) != 0)) + 1).tolist(), len(band)]
            for first, last in zip(starts, starts[1:]):
                if first == last:
                    continue
                here = int(band[first]), int(hash_[first])
                if here != at:
                    if held:
                        yield close()
                    at, held = here, []
                held.append(batch.slice(first, last - first))
        if held:
            yield close()

    return rows.mapInArrow(meet, "a binary, b binary")


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose weighted Jaccard similarity is at least ``least``."""
    @F.pandas_udf("double")
    def measure(sa: pd.Series, wa: pd.Series, sb: pd.Series, wb: pd.Series) -> pd.Series:
        out = []
        for x, u, y, v in zip(sa, wa, sb, wb):
            x, y = _unpack(x), _unpack(y)
            out.append(similarity(x, _weights_of(x, u), y, _weights_of(y, v)))
        return pd.Series(out, dtype=float)

    sets = sets.select("key", "s", "w")
    rows = (pairs.join(sets.toDF("a", "sa", "wa"), "a").join(sets.toDF("b", "sb", "wb"), "b")
            .select("a", "b", measure("sa", "wa", "sb", "wb").alias("similarity")))
    return rows.filter(F.col("similarity") >= least - 1e-9)


def _stars(buckets: DataFrame) -> DataFrame:
    """(a, b): each text of a bucket with its two pivots: the member of least hash and
    the one that shares buckets with most others, the likely original of copies."""
    least = F.min(F.struct(F.xxhash64("key", "band").alias("h"), "key"))
    most = F.max(F.struct(F.col("weight").alias("h"), "key"))
    pivots = buckets.groupBy("band", "hash").agg(F.array(most["key"], least["key"]).alias("p"))
    pivots = pivots.select("band", "hash", F.explode("p").alias("p"))
    pairs = buckets.join(pivots, ["band", "hash"]).filter(F.col("key") != F.col("p"))
    return pairs.select(F.least("key", "p").alias("a"), F.greatest("key", "p").alias("b")).distinct()


def _slots(s: np.ndarray) -> np.ndarray:
    return (shingles.mix(s) >> _U(64 - SLOTS)).astype(np.int64)


def _rest(texts: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """All pairs (a, b) of ``texts`` (key, root) with different roots that can be
    at least ``least`` similar.

    Shingles have one order, the rarest first (by counters that may collide: any
    order is exact).  At the first shingle that a similar pair shares, in this
    order, each text must still have the weight that the pair has in common, which
    is at least least / (1 + least) of both weights and ``least`` of the greater;
    so only the start of each text is looked at, and a long passage that unlike
    texts share comes last.  A shingle's greatest component is never paired with
    itself; rows of a frequent shingle are split by salt."""
    held = sets.select("key", "s", "w").join(texts, "key")

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(1 << SLOTS, np.int64)
        for part in parts:
            for s in part["s"]:
                np.add.at(seen, _slots(_unpack(s)), 1)
        at = np.flatnonzero(seen)
        yield pd.DataFrame({"slot": at, "n": seen[at]})

    counted = held.select("s").mapInPandas(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    often = np.zeros(1 << SLOTS, np.int64)
    often[counted["slot"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    asked = texts.sparkSession.sparkContext.broadcast(often)

    def start(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        often = asked.value
        for part in parts:
            out = []
            for s, w in zip(part["s"], part["w"]):
                s = _unpack(s)
                w = _weights_of(s, w)
                n = often[_slots(s)]
                order = np.lexsort((s, n))
                tail = np.cumsum(w[order][::-1])[::-1]  # weight from here on
                first = int(np.searchsorted(n[order], 2))  # no other text has the shingles before
                last = int(np.searchsorted(-tail, -(least - 1e-6) * tail[0], "right"))
                out.append((s[order[first:last]].view(np.int64), tail[first:last], tail[0]))
            yield pd.DataFrame({"key": part["key"], "root": part["root"], "s": [x for x, _, _ in out],
                                "tail": [x for _, x, _ in out], "total": [float(x) for _, _, x in out]})

    starts = materialize(held.mapInPandas(start, "key binary, root binary, s array<long>, tail array<double>, total double"), "dup-starts")
    flat = starts.select("key", "root", "total", F.inline(F.arrays_zip("s", "tail")))
    groups = (flat.groupBy("s", "root").agg(F.count("*").alias("n"))
              .groupBy("s").agg(F.ceil(F.sum("n") / PART).alias("parts"), F.count("*").alias("roots"), F.max(F.struct("n", "root")).alias("most"))
              .filter("roots > 1").select("s", "parts", F.col("most.root").alias("big")))
    met = materialize(flat.join(groups, "s"), "dup-met")
    x = met.filter("root <> big").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).alias("x")
    y = met.withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts"))).alias("y")
    common = F.least("x.tail", "y.tail") >= (least / (1 + least) - 1e-6) * (F.col("x.total") + F.col("y.total"))
    once = (F.col("y.root") == F.col("y.big")) | (F.col("x.key") < F.col("y.key"))
    pairs = x.join(y, (F.col("x.s") == F.col("y.s")) & (F.col("x.part") == F.col("y.part")) & (F.col("x.root") != F.col("y.root")) & once & common)
    return pairs.select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b")).distinct()


def _joined_roots(roots: DataFrame, new: DataFrame) -> DataFrame:
    """Roots after some more links: components of the links between roots, which
    are few, then one step for all nodes."""
    edges = (new.join(roots.toDF("a", "ra"), "a", "left").join(roots.toDF("b", "rb"), "b", "left")
             .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")))
    moved = materialize(components(edges), "dup-moved")
    known = roots.join(moved.toDF("root", "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return known.union(moved.join(roots.select("node"), "node", "left_anti").select("node", "root"))


def _row_hash() -> Column:
    """A row's text and id in one hash: exact copies have one of their own each."""
    return F.xxhash64("key", "doc_id")


def links(docs: DataFrame, least: float = SIMILARITY) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, links, roots): doc_id, key of every row; links (a, b) between
    keys of different texts that are at least ``least`` similar and connect all such;
    node, root of every key that has a link."""
    rows = docs.select("doc_id", "text").withColumn("key", _digest(F.col("text")))
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(docs.select("text")))
    signed = _signatures(rows.withColumn("doc_id", F.col("doc_id").cast("string")), common)  # ids as text: pandas has no null long
    signed = materialize(signed.withColumn("doc_id", F.col("doc_id").cast("long")), "dup-signed")
    # One row of each text stands for its copies.
    texts = (signed.filter("bands IS NOT NULL").groupBy("key")
             .agg(F.min("doc_id").alias("doc_id"), F.any_value("bands").alias("bands"), F.any_value("n").alias("shingles")))
    texts = materialize(texts.select("key", "doc_id", "shingles", "bands"), "dup-texts-signed")
    keyed = texts.select("key", "shingles", F.posexplode("bands").alias("band", "hash"))
    shared = keyed.groupBy("band", "hash").agg(F.count("*").alias("n"), F.sum("shingles").alias("total")).filter("n > 1")
    buckets = materialize(keyed.join(shared, ["band", "hash"]).select("key", "band", "hash", "n", "total"), "dup-buckets")
    weight = buckets.groupBy("key").agg(F.sum("n").alias("weight"))
    wanted = materialize(weight.join(texts, "key").select("key", "doc_id", "weight", "bands"), "dup-wanted")
    bloom = Bloom(wanted.select(_row_hash().alias("h")))
    sets = _sets(rows.filter("key IS NOT NULL").select("key", F.col("doc_id").cast("string").alias("doc_id"), "text", _row_hash().alias("h")), common, bloom)
    chosen = wanted.select("key", F.col("doc_id").cast("string").alias("chosen"))
    sets = sets.join(chosen, "key").filter(F.col("doc_id").eqNullSafe(F.col("chosen"))).drop("doc_id", "chosen").dropDuplicates(["key"])
    sets = materialize(sets, "dup-sets")

    small = (F.col("n") <= MOST_TEXTS) & (F.col("total") <= MOST_SHINGLES)
    fitting = buckets.filter(small).join(wanted.select("key", "bands"), "key")
    found = materialize(_meet(fitting, sets, least).distinct(), "dup-links")
    roots = materialize(components(found), "dup-roots")
    large = buckets.filter(~small)
    if not large.isEmpty():
        stars = materialize(_stars(large.join(wanted.select("key", "weight"), "key")), "dup-pairs")
        new = materialize(_verified(stars, sets, least).select("a", "b"), "dup-links")
        found, roots = found.union(new), materialize(_joined_roots(roots, new), "dup-roots")
        left = materialize(large.select("key").distinct().join(roots.toDF("key", "root"), "key", "left")
                           .select("key", F.coalesce("root", "key").alias("root")), "dup-left")
        pairs = materialize(_rest(left, sets, least).join(stars, ["a", "b"], "left_anti"), "dup-pairs")
        new = materialize(_verified(pairs, sets, least).select("a", "b"), "dup-links")
        found, roots = found.union(new), materialize(_joined_roots(roots, new), "dup-roots")
    return signed.select("doc_id", "key"), found, roots


def classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(doc_id, key, class_id, class_key, copies) of every row of ``docs``.

    class_id is the least doc_id of the class; copies counts its rows with the
    same text.  Rows with a null text stand alone (class_id: their own doc_id);
    empty texts are equal; a text without words is near none but its equals;
    a null doc_id never gives a class its id unless it has no other; repeated
    rows are copies; an empty table stays empty."""
    members, _, root = links(docs, least)
    texts = members.filter("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    texts = materialize(texts, "dup-texts")
    joined = texts.join(root.toDF("key", "root"), "key")  # only texts with links
    heads = joined.groupBy("root").agg(F.min("least").alias("class_id"))
    linked = joined.join(heads, "root").select("key", "class_id", F.col("root").alias("class_key"))
    known = materialize(texts.join(linked, "key", "left").select(
        "key", F.when(F.col("class_key").isNull(), F.col("least")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_key", "key").alias("class_key"), "copies"), "dup-classes")
    return members.join(known, "key", "left").select(
        "doc_id", "key", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        "class_key", F.coalesce("copies", F.lit(1)).alias("copies"))


def keep_one(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row of each class, the one of least doc_id, with all its own columns.

    Rows with a null text all stay.  Extra columns stay, whatever their names."""
    safe, own = shield(docs, "doc_id", "text")
    known = classes(safe, least).filter("key IS NOT NULL")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    known = materialize(known.select("class_key", "doc_id", "key"), "dup-known")
    # Only rows of classes with several rows can go; the others stay where they are.
    several = known.groupBy("class_key").agg(F.min(order).alias("f"), F.count("*").alias("rows")).filter("rows > 1")
    several = materialize(several, "dup-several")
    members = known.join(several.select("class_key"), "class_key", "left_semi")
    rows = safe.withColumn("key", _digest(F.col("text")))
    rows = rows.withColumn("__hit", Bloom(members.select(_row_hash().alias("h"))).may_hold(F.coalesce(_row_hash(), F.lit(0))) & F.col("key").isNotNull())
    alone, hit = rows.filter(~F.col("__hit")), rows.filter("__hit")
    first = several.select("f.key", "f.doc_id").withColumn("is_first", F.lit(True))
    same = lambda a, b: (F.col(f"{a}.key") == F.col(f"{b}.key")) & F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id"))
    counted = members.groupBy("key", "doc_id").agg(F.count("*").alias("again"))
    judged = (counted.alias("m").join(first.alias("f"), same("m", "f"), "left")
              .select("m.key", "m.doc_id", F.coalesce("is_first", F.lit(False)).alias("is_first"), "again"))
    judged = materialize(judged, "dup-judged")
    hit = (hit.alias("r").join(judged.alias("j"), same("r", "j"), "left")
           .select(*[F.col(f"r.{c}").alias(c) for c in rows.columns], "is_first", "again").filter(F.coalesce("is_first", F.lit(True))))
    once = hit.filter(F.coalesce("again", F.lit(1)) == 1)
    repeated = hit.filter("again > 1").dropDuplicates(["key"])  # of rows repeated with their id, one
    return alone.select(*own).unionByName(once.select(*own)).unionByName(repeated.select(*own))


def query(spark, sf_dir):
    """op5: every document with its class."""
    found = classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", "copies", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))
