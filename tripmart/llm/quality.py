"""Quality rules: base limits and a learned decision list.

Statistics of every whole text are measured once.  Sequential covering learns
an ordered list of threshold conjunctions from labelled statistics: a rule is
grown literal by literal on two thirds of a bounded sample, pruned on the other
third, and kept if it is precise there; the examples it covers are removed and
the next rule is learned.  The list becomes one ordered Spark CASE expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm.common import materialize, shield, table, without

SYMBOLS = b"#*$%&|<>"
SPACE = " \t\n\x0b\x0c\r"
#: Base limits (fixed by the contract).
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("mean_word_chars", "symbols_per_word", "dup_lines_per_line", "repeat_share", "upper_share",
            "shouts_per_word", "digit_share", "words_per_line", "distinct_share", "marks_per_word")
SCHEMA = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS] + [T.StructField(f, T.DoubleType()) for f in FEATURES])

#: At most so many labelled documents are fitted on (those with the least hash).
SAMPLE_ROWS = 20_000
MAX_RULES, MAX_LITERALS, CUTS = 16, 4, 64
#: A rule stays if it is this precise on all left and on the pruning third, and covers so many there.
MIN_PRECISION, MIN_HELD_PRECISION, MIN_COVER = 0.95, 0.8, 2

_UPPER, _LOWER, _DIGIT = (np.array([chr(i) in s for i in range(256)]) for s in
                          ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"))
_MARK = np.array([33 <= i < 127 and not chr(i).isalnum() for i in range(256)])
_SYMBOL = np.array([i in SYMBOLS for i in range(256)])
_SPACE = np.array([chr(i) in SPACE for i in range(256)])
_LEAD = np.array([i & 0xC0 != 0x80 for i in range(256)])  # bytes that begin a code point


def repeated_words(words: list[bytes]) -> tuple[int, int]:
    """Words inside 3-word windows that occur twice or more, and distinct words."""
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    if len(words) < 4:  # two windows at least
        return 0, len(ids)
    pairs = code[:-1] * len(ids) + code[1:]
    if len(ids) > 2_000_000:  # the cube would leave 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(ids) + code[2:]
    _, where, often = np.unique(windows, return_inverse=True, return_counts=True)
    again = often[where] > 1
    inside = np.zeros(len(words), bool)
    for k in range(3):
        inside[k:len(words) - 2 + k] |= again
    return int(inside.sum()), len(ids)


def measure(text: str | None) -> tuple:
    """The columns of SCHEMA for one whole text; null and empty texts give zeros."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at ASCII white space only
    n = len(words)
    per = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    dups = len(lines) - len(set(lines))
    chars = int(per[_LEAD].sum() - per[_SPACE].sum())
    repeat, distinct = repeated_words(words)
    upper, letters, symbols = int(per[_UPPER].sum()), int(per[_UPPER].sum() + per[_LOWER].sum()), int(per[_SYMBOL].sum())
    share = lambda a, b: a / b if b else 0.0
    return (n, chars, symbols, dups, repeat,
            share(chars, n), share(symbols, n), share(dups, len(lines)), share(repeat, n), share(upper, letters),
            share(int(per[33]), n), share(int(per[_DIGIT].sum()), chars), share(n, len(lines)), share(distinct, n),
            share(int(per[_MARK].sum()), n))


@F.pandas_udf(SCHEMA)
def statistics(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for part in texts:
        yield pd.DataFrame([measure(t) for t in part], columns=SCHEMA.names)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    """Rejects when every (feature, above, threshold) literal holds."""
    literals: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, above, at in self.literals:
            out = out & ((F.col(name) > at) if above else (F.col(name) <= at))
        return out

    def __str__(self) -> str:
        return " AND ".join(f"{n} {'>' if a else '<='} {t:.6g}" for n, a, t in self.literals)


def _covers(x: np.ndarray, literals: list[tuple[int, bool, float]]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for j, above, at in literals:
        out &= (x[:, j] > at) if above else (x[:, j] <= at)
    return out


def _grow(x: np.ndarray, bad: np.ndarray) -> list[tuple[int, bool, float]]:
    """Add the literal with the best information gain until no good example is covered."""
    literals: list[tuple[int, bool, float]] = []
    inside = np.ones(len(x), bool)
    while len(literals) < MAX_LITERALS and (~bad[inside]).any():
        p, n = bad[inside].sum(), (~bad[inside]).sum()
        best, gain = None, 1e-9
        for j in range(x.shape[1]):
            cuts = np.unique(np.quantile(x[inside, j], np.linspace(0, 1, CUTS + 1)))
            middle = np.unique((cuts[1:] + cuts[:-1]) / 2)
            order = np.sort(x[inside & bad, j]), np.sort(x[inside & ~bad, j])
            pl, nl = (np.searchsorted(o, middle, side="right") for o in order)
            for above, p1, n1 in ((False, pl, nl), (True, p - pl, n - nl)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    g = p1 * (np.log2(p1 / (p1 + n1)) - np.log2(p / (p + n)))
                g = np.where(p1 > 0, g, -np.inf)
                if len(g) and g.max() > gain:
                    best, gain = (j, above, float(middle[int(g.argmax())])), g.max()
        if best is None:
            break
        literals.append(best)
        inside &= _covers(x, [best])
    return literals


def learn(x: np.ndarray, bad: np.ndarray, hold: np.ndarray, names=FEATURES) -> list[Rule]:
    """An ordered list of rejecting rules; ``hold`` marks the pruning third."""
    rules: list[Rule] = []
    left = np.ones(len(x), bool)
    while len(rules) < MAX_RULES and (left & ~hold & bad).sum() >= MIN_COVER:
        literals = _grow(x[left & ~hold], bad[left & ~hold])
        xh, bh = x[left & hold], bad[left & hold]

        def worth(k: int) -> tuple[float, int]:
            c = _covers(xh, literals[:k])
            p, n = int(bh[c].sum()), int((~bh[c]).sum())
            return ((p - n) / (p + n) if p + n else -1.0, -k)

        if not literals:
            break
        literals = literals[:max(range(1, len(literals) + 1), key=worth)]
        c = _covers(xh, literals)
        every = _covers(x[left], literals)
        if c.sum() < MIN_COVER or bh[c].mean() < MIN_HELD_PRECISION or bad[left][every].mean() < MIN_PRECISION:
            break
        rules.append(Rule(tuple((names[j], above, at) for j, above, at in literals)))
        left &= ~_covers(x, literals)
    return rules


def fit(measured: DataFrame, labels: DataFrame) -> list[Rule]:
    """Learn from the documents of ``measured`` (doc_id and SCHEMA) that are labelled.

    A document with any label quality 0 is bad; those that fail the base limits
    have nothing to teach.  The sample is bounded by
    SAMPLE_ROWS, so what the driver holds does not grow.  Without labels, or
    without bad ones, the list is empty and rejects nothing."""
    wanted = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    wanted = wanted.withColumn("__h", F.xxhash64("doc_id")).orderBy("__h", "doc_id").limit(SAMPLE_ROWS)
    rows = (measured.filter(~base_failed()).join(wanted, "doc_id").groupBy("doc_id", "__h", "quality")
            .agg(F.min(F.struct(*FEATURES)).alias("s"))  # one row for a repeated doc_id
            .select("doc_id", "__h", "quality", "s.*").toPandas().sort_values(["__h", "doc_id"]))
    if rows.empty:
        return []
    return learn(rows[list(FEATURES)].to_numpy(float), (rows["quality"] == 0).to_numpy(),
                 (rows["__h"].to_numpy() % 3 == 0))


def verdict(rules: list[Rule]) -> tuple[Column, Column]:
    """(kept, rule): one ordered CASE; the first rule that fits rejects."""
    failed = base_failed()
    rule = F.when(failed, "base")
    for r in rules:
        rule = rule.when(r.column(), str(r))
    return rule.isNull(), rule


def judge(measured: DataFrame, rules: list[Rule]) -> DataFrame:
    kept, rule = verdict(rules)
    return measured.withColumns({"base_failed": base_failed(), "kept": kept, "rule": rule})


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns.

    Null and empty texts have no words and are rejected; repeated rows are each
    judged alike; extra columns stay, whatever their names; an empty table
    stays empty."""
    safe, own = shield(docs, "doc_id", "text")
    rules = fit(materialize(_measured(safe.select("doc_id", "text")).drop("text"), "quality-stats"), labels)
    return judge(_measured(safe), rules).filter("kept").select(*own)


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("__s", statistics("text")).select(*docs.columns, "__s.*")


def query(spark, sf_dir):
    """op1: every document with its statistics and verdict."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    measured = materialize(_measured(docs).drop("text"), "quality-stats")
    rules = fit(measured, table(spark, sf_dir, "labels"))
    return judge(measured, rules).select("doc_id", *COUNTS, "base_failed", "kept", "rule", *FEATURES)
