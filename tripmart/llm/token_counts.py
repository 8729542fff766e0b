"""Token counts by dynamic programming over a trie of pre-tokens.

The distinct pre-tokens of a batch (a word-begin mark and a word) are inserted
in a trie.  One walk computes the forward scores of a unigram model: the score
of a node is the best sum of piece scores over all cuts of its prefix, so a
prefix shared by many pre-tokens is scored once.  Terminal nodes keep the number
of tokens on their best path; a document's count is the sum over its pre-tokens.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from os.path import commonprefix

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm.common import shield, table, without

MARK = "▁"  # begins a word in the vocabulary
#: Pre-tokens kept counted in a worker between batches, and scored in one trie.
CACHED, IN_TRIE = 400_000, 50_000
CACHED_CHARS = 64
#: Rank offset of the Zipf-Mandelbrot law that turns ranks into probabilities.
OFFSET = 2.7
#: A character without a piece costs its UTF-8 bytes, each a token of this rank.
UNKNOWN_RANK = 1_000_000
OUT = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("n_pretokens", T.LongType())])


def piece_scores(ranks: dict[str, int]) -> dict[str, float]:
    """Log probabilities of the pieces from their ranks: p falls as 1 / (rank + OFFSET)."""
    total = math.log(sum(1 / (r + OFFSET) for r in ranks.values())) if ranks else 0.0
    return {p: -math.log(r + OFFSET) - total for p, r in ranks.items()}


def read_ranks(path: str) -> dict[str, int]:
    """Ordinary pieces of a vocabulary file with their order (0, 1, ...)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return {p: k for k, p in enumerate(pieces)}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Model:
    """Unigram model over pieces; unknown characters fall back to their bytes."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.unknown = -math.log(UNKNOWN_RANK)
        self.counts: dict[str, int] = {}
        self._automaton()

    def _automaton(self) -> None:
        """States that know every piece ending at a character: per state its
        transitions, and (length, score) of the pieces that end there."""
        self.go: list[dict[str, int]] = [{}]
        own: list[float | None] = [None]
        depth = [0]
        for p, s in self.scores.items():
            at = 0
            for c in p:
                nxt = self.go[at].get(c)
                if nxt is None:
                    nxt = self.go[at][c] = len(self.go)
                    self.go.append({})
                    own.append(None)
                    depth.append(depth[at] + 1)
                at = nxt
            own[at] = s
        self.fail = [0] * len(self.go)
        self.out: list[tuple[tuple[int, float], ...]] = [()] * len(self.go)
        layer = list(self.go[0].values())
        for at in layer:
            self.out[at] = ((1, own[at]),) if own[at] is not None else ()
        while layer:
            after = []
            for at in layer:
                for c, nxt in self.go[at].items():
                    f = self.fail[nxt] = self.move(self.fail[at], c)
                    self.out[nxt] = (((depth[nxt], own[nxt]),) if own[nxt] is not None else ()) + self.out[f]
                    after.append(nxt)
            layer = after

    def move(self, state: int, c: str) -> int:
        """The state after one more character."""
        while True:
            nxt = self.go[state].get(c)
            if nxt is not None:
                return nxt
            if not state:
                return 0
            state = self.fail[state]

    def score(self, words: Iterable[str]) -> dict[str, int]:
        """Tokens of each distinct word, by one walk over their trie.

        Sorted words visit the trie depth first; what two neighbours share is
        kept on the path, so every node is scored once.  A node has its best
        score and, among equal scores, the fewest tokens."""
        out: dict[str, int] = {}
        go, ends, scores = self.go, self.out, self.scores
        last, states, best, tokens = "", [0], [0.0], [0]
        for word in sorted(words):
            shared = len(commonprefix((last, word)))
            if shared < len(last):
                del states[shared + 1:], best[shared + 1:], tokens[shared + 1:]
            state = states[-1]
            for c in word[shared:]:
                nxt = go[state].get(c)
                state = self.move(state, c) if nxt is None else nxt
                if c in scores:
                    top, fewest = -math.inf, 0
                else:
                    size = len(c.encode("utf-8", "surrogatepass"))
                    top, fewest = best[-1] + size * self.unknown, tokens[-1] + size
                for back, s in ends[state]:
                    s += best[-back]
                    if s >= top:
                        k = tokens[-back] + 1
                        if s > top or k < fewest:
                            top, fewest = s, k
                states.append(state)
                best.append(top)
                tokens.append(fewest)
            out[word] = tokens[-1]
            last = word
        return out

    def count(self, texts: list[str | None]) -> list[tuple[int, int]]:
        """(tokens, pre-tokens) of whole texts; null and empty ones have none."""
        words = [[w.decode("utf-8", "surrogatepass") for w in (t or "").encode("utf-8", "surrogatepass").split()] for t in texts]
        known = self.counts
        new = {w for ws in words for w in ws if w not in known}
        fresh: dict[str, int] = {}
        todo = list(new)
        for k in range(0, len(todo), IN_TRIE):
            fresh.update((w[1:], n) for w, n in self.score(MARK + w for w in todo[k:k + IN_TRIE]).items())
        rows = []
        for ws in words:
            try:
                rows.append((sum(map(known.__getitem__, ws)), len(ws)))
            except KeyError:
                rows.append((sum(known[w] if w in known else fresh[w] for w in ws), len(ws)))
        if len(known) + len(fresh) > CACHED:
            known.clear()
        known.update((w, n) for w, n in fresh.items() if len(w) <= CACHED_CHARS)
        return rows


class _Shared:
    """One model per Python worker."""
    models: dict[str, Model] = {}

    @classmethod
    def get(cls, scores, digest: str) -> Model:
        """``digest`` knows the vocabulary; an address could be used again."""
        if digest not in cls.models:
            cls.models.clear()
            cls.models[digest] = Model(dict(scores.value))
        return cls.models[digest]


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Every row with n_tokens and n_pretokens of its whole text.

    Rows stay in their partitions; whole texts count, however long; a null or empty text counts 0; repeated rows
    count alike; an empty table stays empty; extra columns stay, but those named
    like an output are replaced.  The vocabulary is read by the driver and
    broadcast; its size is that of the file."""
    pieces = list(piece_scores(read_ranks(path or default_path())).items())
    digest = hashlib.sha256(repr(pieces).encode()).hexdigest()
    scores = docs.sparkSession.sparkContext.broadcast(pieces)

    @F.pandas_udf(OUT)
    def counted(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = _Shared.get(scores, digest)
        for part in texts:
            values, rows, chars = part.tolist(), [], 0
            chunk: list = []
            for v in values:  # tries of bounded text, however long the batch
                chunk.append(v)
                chars += len(v or "")
                if chars > 4_000_000:
                    rows += model.count(chunk)
                    chunk, chars = [], 0
            rows += model.count(chunk)
            yield pd.DataFrame(rows, columns=OUT.names)

    safe, own = shield(without(docs, *OUT.names), "text")
    return safe.withColumn("__c", counted("text")).select(*own, "__c.*")


def query(spark, sf_dir):
    """op8: token counts of all documents."""
    return token_counts(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
