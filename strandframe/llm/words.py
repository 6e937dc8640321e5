"""Vectorised words of texts: maximal runs of bytes other than space and tab to carriage return, A-Z lower-cased, as
64-bit hashes, and hashes of runs of several words."""

from __future__ import annotations

import numpy as np

from strandframe.llm.pretokens import span_hashes

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))

#: Bytes that are hashed at once; a longer text is cut at a space.
CHUNK = 4_000_000


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _chunk(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    return (span_hashes(_LOWER[data], starts, ends) if len(starts) else np.empty(0, np.uint64)), starts


def words_at(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and where it starts, in order."""
    a = np.frombuffer(data, np.uint8)
    if len(a) <= CHUNK:
        return _chunk(a)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    at = 0
    while at < len(a):
        end = min(len(a), at + CHUNK)
        while end < len(a):
            cut = np.flatnonzero(_SPACE[a[end : end + CHUNK]])
            if len(cut):
                end += int(cut[0])
                break
            end = min(len(a), end + CHUNK)
        hashes, starts = _chunk(a[at:end])
        out.append((hashes, starts + at))
        at = end
    return np.concatenate([h for h, _ in out]), np.concatenate([s for _, s in out])


def word_hashes(data: bytes) -> np.ndarray:
    """The hash of every word, in order."""
    return words_at(data)[0]


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """The hash of every run of width words; of all words, if there are fewer; none for none."""
    n = len(words)
    if n == 0:
        return words
    size = min(n, width)
    h = np.full(n - size + 1, np.uint64(size) * _C)
    for k in range(size):
        h = (h ^ words[k : k + n - size + 1]) * _A + _B
        h ^= h >> np.uint64(29)
    return mix(h)
