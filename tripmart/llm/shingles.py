"""Hashes of words and word shingles, computed for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WORDS_PER_SHINGLE = 5
#: Bytes of text hashed together; a longer text is a piece of its own.
PIECE = 1 << 19

_U = np.uint64
_RNG = np.random.default_rng(20_250_105)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_PLACE = _RNG.integers(1, 1 << 63, WORDS_PER_SHINGLE, dtype=np.uint64) * _U(2) + _U(1)
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (two multiply-and-shift rounds)."""
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


class _Powers:
    """Powers of the base and of its inverse, as far as the longest piece needs."""
    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            up, down = np.full(n, _BASE, np.uint64), np.full(n, _BACK, np.uint64)
            up[0] = down[0] = 1
            cls.up, cls.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return cls.up, cls.down


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of every word of UTF-8 bytes, in order."""
    b = np.frombuffer(raw, np.uint8)
    white = _WHITE[b]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], white, [True])).view(np.int8)))
    start, stop = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64), start
    up, down = _Powers.get(len(b) + 1)
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTE[b] * up[:len(b)], out=total[1:])
    return mix((total[stop] - total[start]) * down[start] + (stop - start).astype(np.uint64)), start


def shingle_hashes(words: np.ndarray, size: int = WORDS_PER_SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``size`` words; a shorter text is one shingle, none is none."""
    n = len(words)
    if n == 0:
        return words
    size = min(n, size)
    out = np.full(n - size + 1, size, np.uint64)
    for k in range(size):
        out += words[k:n - size + 1 + k] * _PLACE[k]
    return mix(out)


def documents(texts: list[str | None], size: int = WORDS_PER_SHINGLE) -> Iterator[tuple[int, np.ndarray]]:
    """(position, shingle hashes) of each whole text, lower-cased; null: no shingle.

    Texts are hashed together piece by piece, so short ones stay cheap."""
    batch: list[tuple[int, bytes]] = []
    held = 0
    for i, t in enumerate(texts):
        raw = (t or "").lower().encode("utf-8", "surrogatepass")
        batch.append((i, raw))
        held += len(raw) + 1
        if held >= PIECE:
            yield from _together(batch, size)
            batch, held = [], 0
    yield from _together(batch, size)


def _together(batch: list[tuple[int, bytes]], size: int) -> Iterator[tuple[int, np.ndarray]]:
    if not batch:
        return
    words, start = word_hashes(b" ".join(raw for _, raw in batch))
    ends = np.cumsum([len(raw) + 1 for _, raw in batch])
    cuts = np.searchsorted(start, ends)
    first = 0
    for (i, _), last in zip(batch, cuts):
        yield i, shingle_hashes(words[first:last], size)
        first = last
