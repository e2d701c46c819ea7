"""Hashed word shingles of whole texts, vectorised."""

from __future__ import annotations

import numpy as np

CHUNK = 1 << 20                         # bytes hashed at once, to the next blank

# Fixed value: the characters between words.
BLANKS = b" \t\n\x0b\f\r"

_rng = np.random.default_rng(20240601)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[list(BLANKS)] = False

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse modulo 2^64."""
    if len(_powers[0]) <= n:
        size = max(n + 1, 1 << 16)
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _chunk_words(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, dtype=np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate(([False], _IS_WORD[b], [False]))))
    starts, ends = edges[::2], edges[1::2]
    power, inverse = _power_tables(len(b))
    total = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[b] * power[:len(b)], out=total[1:])
    h = (total[ends] - total[starts]) * inverse[starts]
    return _mix(h ^ (ends - starts).astype(np.uint64))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash per word, A-Z lower-cased, in order."""
    data = text.encode("utf-8", "surrogatepass").lower()    # bytes: only A-Z
    if len(data) <= CHUNK:
        return _chunk_words(data)
    out, at = [], 0
    while at < len(data):
        end = at + CHUNK
        while end < len(data) and _IS_WORD[data[end]]:
            end += 1
        out.append(_chunk_words(data[at:end]))
        at = end
    return np.concatenate(out)


def shingle_set(text: str, words: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles; the whole sequence is
    one shingle when there are fewer words, and no words make no shingles."""
    w = word_hashes(text)
    if not len(w):
        return w
    n = min(words, len(w))
    h = np.full(len(w) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        h = h * _STEP + w[i:len(w) - n + 1 + i]
    return np.unique(_mix(h))
