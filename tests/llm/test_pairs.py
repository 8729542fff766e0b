"""Hard negatives, SimHash classes and fill-in-middle, held against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tripmart.llm import fim, negatives, registry, simhash

SF = "/root/testdata/sf0.001"


# --- hard negatives ---------------------------------------------------------------

VEC = "vec_id long, label long, embedding array<double>"


def mined(rows, is_anchor, positives=5, negs=3, low=50, high=95):
    """All scores of all anchors, window by window."""
    first = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        first[i] = min(first.get(i, (label, v)), (label, v))
    whole = {i: [math.floor(x * 256) if abs(x) < 2.0 ** 53 else int(x) * 256 for x in v] for i, (_, v) in first.items()}
    out = []
    for a in filter(is_anchor, first):
        scores = {b: sum(p * q for p, q in zip(whole[a], whole[b])) for b in first if b != a and len(whole[b]) == len(whole[a])}
        near = sorted((-s, b) for b, s in scores.items() if abs(s) < 1 << 63)
        for s, p in [x for x in near if first[x[1]][0] == first[a][0]][:positives]:
            window = [x for x in near if first[x[1]][0] != first[a][0] and low * -s <= 100 * -x[0] <= high * -s]
            out += [(a, p, k, b, -s, -t) for k, (t, b) in enumerate(window[:negs], 1)]
    return sorted(out)


def of(df):
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in df.collect())


def test_windows_with_ties_against_brute_force(spark):
    r = random.Random(3)
    rows = [(i, r.randint(0, 2), [r.choice([0.0, 0.004, 0.5, 1.0, -0.25]) for _ in range(3)]) for i in range(-40, 160)]
    got = of(negatives.mine(spark.createDataFrame(rows, VEC), F.expr("vec_id % 3 = 0"), 4, 2, 30, 90))
    assert got == mined(rows, lambda i: i % 3 == 0, 4, 2, 30, 90) and len(got) > 200


def test_rows_that_take_no_part_and_odd_ones(spark):
    good = [(i, i % 3, [1.0, i / 50, -0.5]) for i in range(0, 60)]
    odd = [(None, 1, [1.0, 1.0, 1.0]), (70, None, [1.0, 1.0, 1.0]), (71, 1, None), (72, 1, [1.0, None, 2.0]), (73, 1, [float("nan"), 1.0, 1.0]),
           (74, 2, [float("inf"), 1.0, 1.0]), (80, 1, [0.0, 0.0, 0.0]), (81, 1, []), (90, 0, []), (82, 0, [1.0, 2.0]), (83, 1, [1.0, 1.0]), (100, 0, [1.5, 1.0]),
           (84, 2, [3e9, 1e9, 2.0]), (85, 2, [1e300, 0.0, 1.0]), (110, 2, [-1e200, 1e200, 4.0]), (86, 0, [2e9, 1e9, 1.0])]
    rows = good + odd + good[:7] + [(5, 0, [9.0, 9.0, 9.0])] * 3  # repeated ids: the least (label, vector) counts
    df = spark.createDataFrame(rows, VEC)
    for c in ("score", "rank", "slot", "r", "q", "asks", "ab", "limits", "vector"):
        df = df.withColumn(c, F.lit("mine"))
    got = of(negatives.mine(df, F.expr("vec_id % 10 = 0")))
    assert got == mined(rows, lambda i: i % 10 == 0) and got
    assert of(negatives.mine(df.limit(0), F.expr("vec_id % 10 = 0"))) == []
    assert of(negatives.mine(df.filter("vec_id = 10"), F.lit(True))) == []


def test_one_label_with_most_rows_and_equal_vectors(spark):
    rows = [(i, 0 if i % 3 else i % 4, [0.5, 0.5] if i % 2 else [0.5, 0.4 + (i % 11) / 100]) for i in range(400)]
    assert of(negatives.mine(spark.createDataFrame(rows, VEC), F.expr("vec_id % 20 = 0"))) == mined(rows, lambda i: i % 20 == 0)


def test_slots_are_disjoint_and_merged(spark, monkeypatch):
    """Blocks of a few rows and tiles of a few scores: the same rows from many cells."""
    monkeypatch.setattr(negatives, "LEAST_ROWS", 8)
    r = random.Random(5)
    rows = [(i, r.randint(0, 3), [r.uniform(0, 1) for _ in range(4)]) for i in range(300)]
    assert of(negatives.mine(spark.createDataFrame(rows, VEC), F.expr("vec_id % 10 = 0"))) == mined(rows, lambda i: i % 10 == 0)


# --- SimHash ----------------------------------------------------------------------

def printed(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    size = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + size]).encode(), 42) for i in range(len(words) - size + 1)]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def linked(prints):
    """{row: (least id of its component, links)} of (id, fingerprint) rows."""
    values = sorted({f for _, f in prints})
    near = {f: [g for g in values if g != f and (f ^ g).bit_count() <= 3] for f in values}
    root = {}
    for f in values:
        if f not in root:
            todo, seen = [f], {f}
            while todo:
                for g in near[todo.pop()]:
                    if g not in seen:
                        seen.add(g)
                        todo.append(g)
            ids = [i for i, g in prints if g in seen and i is not None]
            root |= {g: min(ids) if ids else None for g in seen}
    return {f: (root[f], len(near[f])) for f in values}


SAMPLES = [None, "", " \t\r\n", "one", "One\x0btwo", "Ä É ß z", "a b c", "A B C", "a b c a b c", "x" * 50_000, "w " * 30_000, "é\x1cb c d 😀", "a  b c d"]


@pytest.mark.parametrize("text", SAMPLES)
def test_fingerprint(text):
    assert simhash.fingerprint(text) % (1 << 64) == printed(text)


def test_golay_code_is_perfect_and_keys_meet():
    golay = simhash.Golay()
    assert sorted(np.bitwise_count(golay.error).tolist()) == sorted([0] + [1] * 23 + [2] * 253 + [3] * 1771)
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 3000).astype(np.uint32)
    home, others = golay.near(words)
    for bit in range(23):
        home2, _ = golay.near(words ^ np.uint32(1 << bit))
        assert ((home == home2) | (others == home2[:, None]).any(axis=1)).all()
    assert set((others >= 0).sum(axis=1).tolist()) == {0, 5}


@pytest.mark.parametrize("errors", [0, 1, 2, 3])
def test_any_three_errors_share_a_home_key(errors):
    r = random.Random(errors)
    a = np.array([r.getrandbits(64) for _ in range(1500)], np.uint64)
    b = np.array([int(x) ^ sum(1 << k for k in r.sample(range(64), errors)) for x in a], np.uint64)
    golay = simhash.Golay()
    home, _ = simhash.keys(a.view(np.int64), golay)
    _, every = simhash.keys(b.view(np.int64), golay)
    assert all(set(h.tolist()) & set(e.tolist()) for h, e in zip(home, every))


def test_links_against_all_pairs(spark):
    r = random.Random(8)
    values = [r.getrandbits(64) for _ in range(300)]
    for f in values[:60]:  # a chain, a dense ball, pairs just too far
        values += [f ^ sum(1 << k for k in r.sample(range(64), n)) for n in (1, 2, 3, 4)]
    values += [values[0] ^ m for m in range(256)]
    signed = [f - (1 << 64) if f >> 63 else f for f in set(values)]
    got = {tuple(x) for x in simhash.links(spark.createDataFrame([(f,) for f in signed], "f long")).collect()}
    want = {(min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) % (1 << 64)).bit_count() <= 3}
    assert got == want
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "f long"), 4)


def test_exploded_sides_are_not_broadcast(spark, tmp_path):
    # 3,000 fingerprints are 24 kB, but their keys 380,000 rows: a broadcast of 20 MB under a threshold of 1 MB
    spark.range(3000).select(F.xxhash64("id").alias("f")).write.parquet(f"{tmp_path}/prints")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(1 << 20))
    try:
        plan = simhash.links(spark.read.parquet(f"{tmp_path}/prints"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_classes_of_odd_rows(spark, docs_of, words):
    base = words(400, 1)
    texts = SAMPLES + [base, base + " end", base.upper(), "start " + base, words(300, 2)]
    rows = [(i, t, "a") for i, t in enumerate(texts)] + [(None, "lone text of null id", "b"), (None, base, None), (3, base, "c")]
    rows += [(900 + i, "the same copy again and again", "a") for i in range(150)] + rows[:4]
    for df in (docs_of(rows), docs_of(rows).withColumn("f", F.lit(1)).withColumn("component_id", F.lit("x")).withColumn("root", F.lit("y"))):
        out = simhash.classes(df)
        assert out.columns == [c for c in df.columns if c != "component_id"] + ["fingerprint", "component_id", "n_links"]
        known = linked([(i, printed(t)) for i, t, _ in rows])
        assert Counter((x.doc_id, x.text, x.fingerprint, x.component_id, x.n_links, x.key) for x in out.collect()) == \
            Counter((i, t, f"{printed(t):016x}", *known[printed(t)], "mine") for i, t, _ in rows)
    assert simhash.classes(docs_of([])).collect() == []


def test_simhash_query(spark):
    docs = [(x.doc_id, printed(x.text)) for x in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    known = linked(docs)
    got = {x.doc_id: (x.fingerprint, x.component_id, x.n_links) for x in registry.QUERIES["op12_golay_simhash"](spark, SF).collect()}
    assert got == {i: (f"{f:016x}", *known[f]) for i, f in docs}


# --- fill in the middle ------------------------------------------------------------

def cut(doc_id, text):
    text = text or ""
    u = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    lo, hi = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    p, m, s = "".join(u[:lo]), "".join(u[lo:hi]), "".join(u[hi:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50:
        return len(u), "plain", None, None, text
    return (len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 80 else (len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def fim_rows():
    r = random.Random(2)
    texts = [None, "", " ", "\t\n ", "one", " one ", "é😀 two three  ", "has <P> in it", "<S><M>", "ends with < and P> x", "< P > <S < S>", "a" * 9000]
    texts += ["".join(r.choice(["word", " ", "\n", "<", "P>", "é", "\x0b", "< M>"]) for _ in range(r.randint(1, 60))) for _ in range(60)]
    rows = [(i * 7 + k * 1000, t, "a") for i, t in enumerate(texts) for k in range(3)]
    rows += [(None, "null id words here", "b"), (None, None, "b"), (5, "tie one two", "a"), (5, "tie three", "a"), (-3, "negative id, four words", None)]
    long_ = " ".join(f"w{i}" for i in range(150_000))
    rows += [(k, long_, "c") for k in range(1, 7)] + [(2 ** 62 + k, "large id, one two three", "a") for k in range(9)]
    return rows + rows[:50] + [(1, "hot row of a few words", "h")] * 400


def test_fim_digests(spark, docs_of):
    rows = fim_rows()
    df = docs_of(rows).withColumn("n", F.lit("x")).withColumn("form", F.lit("y")).withColumn("copies", F.lit("z")).repartition(6)
    out = fim.digests(df)
    got = Counter(tuple(x) for x in out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256").collect())
    want = Counter((i, *c[:4], sha(c[4]), sha(t)) for i, t, _ in rows for c in [cut(i, t)])
    assert got == want
    assert {"plain", "psm", "spm"} == {k[2] for k in got}
    assert fim.digests(docs_of([])).collect() == []


def test_fim_pieces_leave_in_small_batches(spark, docs_of):
    """A batch of whole texts is never held as pieces as well."""
    import pyarrow as pa

    texts = ["word " * 5000] * 300
    batch = pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    out = list(fim._cut(True)(iter([batch])))
    pieces = [b for b in out if b.num_rows and b.column("at")[0].as_py() >= 0]
    assert max(b.num_rows for b in pieces) <= 256 and max(b.nbytes for b in pieces) < 3 << 20
    assert sum(sum(len(t) for t in b.column("text").to_pylist() if t not in fim.MARKS) for b in pieces) == sum(len(t) for t in texts)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    fim.digests(docs_of([(1, "a b", "a")]))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000


def test_fim_outputs_and_restoration(spark, docs_of):
    rows = fim_rows()
    out = fim.transform(docs_of(rows))
    assert Counter((x.doc_id, x.n, x.form, x.prefix_chars, x.middle_chars, x.output) for x in out.collect()) == Counter((i, *cut(i, t)) for i, t, _ in rows)
    back = fim.restore(out.withColumn("text", F.lit("replaced")).withColumn("p", F.lit("mine")))
    assert Counter((x.doc_id, x.text, x.p) for x in back.collect()) == Counter((i, t or "", "mine") for i, t, _ in rows)
