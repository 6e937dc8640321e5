"""Vectorised pre-tokenisation for byte-level BPE: the matches of the public split pattern over whole batches of
texts, as offsets and 64-bit hashes, without an object for each match.

The pattern is ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``. Since every
alternative is a run of one class of characters, its matches follow from the places where the class changes:

* a run of white space before something else gives up its last character; if that is a plain space, it belongs to
  the run that follows, else it stands alone; at the end of a text the run stays whole;
* a lone apostrophe that isn't preceded by a plain space takes the letters of a contraction.

Words are known by a 64-bit hash of their characters and length (two of ten million different words meet with a
probability of about 3e-6).
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

SPACE, LETTER, NUMBER, OTHER, BREAK = range(5)

#: The code points with the Unicode property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

#: Code points gathered before they are split at once; longer texts are cut where a match surely begins.
CHUNK = 500_000

_BREAK_CODE = 0x110000
_CUT = re.compile(r"(?<=[^\s]) (?=[^\W\d_])")
_MULT = 0x9E3779B97F4A7C15
_STEP = 0xD6E8FEB86659FD93
_M64 = (1 << 64) - 1


@lru_cache(1)
def _classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(_BREAK_CODE)), np.uint8, _BREAK_CODE)
    table = np.append(table, np.uint8(BREAK))
    table[WHITE_SPACE] = SPACE
    return table


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number modulo 2^64, and of its inverse."""
    size = 1 << max(10, (n - 1).bit_length())
    if size not in _powers:
        _powers.clear()
        both = []
        for base in (_STEP, pow(_STEP, -1, 1 << 64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            both.append(np.cumprod(p, dtype=np.uint64))
        _powers[size] = (both[0], both[1])
    up, down = _powers[size]
    return up[:n], down[:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each values[start:end] (not empty), the same wherever the span lies."""
    v = (values.astype(np.uint64) + np.uint64(1)) * np.uint64(_MULT)
    v ^= v >> np.uint64(29)
    up, down = powers(len(v))
    v *= up
    sums = np.empty(len(v) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(v, out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    h ^= (ends - starts).astype(np.uint64) * np.uint64(_STEP)
    h ^= h >> np.uint64(31)
    h *= np.uint64(_MULT)
    h ^= h >> np.uint64(32)
    return h


def split(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the matches in texts that each end with a break code; and the matches before each break."""
    cls = _classes()[codes]
    n = len(cls)
    before = np.empty_like(cls)
    before[0], before[1:] = BREAK, cls[:-1]
    after = np.empty_like(cls)
    after[-1], after[:-1] = BREAK, cls[1:]
    start = (cls != before) | (cls == BREAK)
    last = (cls == SPACE) & (after != SPACE) & (after != BREAK)
    start |= last
    glued = last & (codes == 32)
    start[1:] &= ~glued[:-1]
    lone = np.flatnonzero((codes == 39) & start & (after == LETTER))
    if len(lone):
        one = codes[lone + 1]
        two = codes[np.minimum(lone + 2, n - 1)]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ~short & (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l")))
        for at, size in ((lone[short], 2), (lone[long], 3)):
            start[at + 1] = False
            start[at + size] = True
    at = np.flatnonzero(start)
    ends = np.append(at[1:], n)
    real = cls[at] != BREAK
    upto = np.cumsum(real)[~real]
    return at[real], ends[real], upto


@dataclass
class Group:
    """The matches of some texts or pieces of them. docs: (index of the text, first match, match after the last)."""

    text: str
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    docs: list[tuple[int, int, int]]


def _pieces(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > 2 * CHUNK and (cut := _CUT.search(text, at + CHUNK)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def _group(parts: list[tuple[int, str]]) -> Group:
    encoded = [p.encode("utf-32-le", "surrogatepass") for _, p in parts]
    stop = np.uint32(_BREAK_CODE).tobytes()
    codes = np.frombuffer(stop.join(encoded) + stop, np.uint32)
    starts, ends, upto = split(codes)
    hashes = span_hashes(codes, starts, ends) if len(starts) else np.empty(0, np.uint64)
    lo = np.concatenate(([0], upto[:-1])).tolist()
    return Group("\0".join(p for _, p in parts), starts, ends, hashes, [(i, a, b) for (i, _), a, b in zip(parts, lo, upto.tolist(), strict=True)])


def groups(texts: list[str | None]) -> Iterator[Group]:
    """The matches of all texts (null: empty), in order."""
    parts: list[tuple[int, str]] = []
    size = 0
    for i, text in enumerate(texts):
        for piece in _pieces(text or ""):
            parts.append((i, piece))
            size += len(piece)
            if size >= CHUNK:
                yield _group(parts)
                parts, size = [], 0
    if parts:
        yield _group(parts)


def gather(flat: np.ndarray, offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[offset:offset + length] of each pair, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(offsets - (ends - lengths), lengths)]


class WordCache:
    """The ids of each different word that this process has met, by its hash; encode turns new words into ids.

    encode: words in UTF-8 -> (ids one after another, number of ids of each word). At most ``most`` words are kept;
    beyond that the cache starts anew, so memory stays bounded and results are the same.
    """

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], most: int = 300_000):
        self.encode, self.most = encode, most
        self.clear()

    def clear(self) -> None:
        self.index: dict[int, int] = {}
        self.flat = np.empty(1 << 16, np.int32)
        self.offsets = np.zeros(1 << 12, np.int64)
        self.lengths = np.zeros(1 << 12, np.int64)
        self.used = 0

    def _add(self, hashes: list[int], words: list[bytes]) -> None:
        ids, lengths = self.encode(words)
        n = len(self.index)
        while n + len(words) > len(self.offsets):
            self.offsets, self.lengths = (np.append(x, np.zeros_like(x)) for x in (self.offsets, self.lengths))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.append(self.flat, np.empty_like(self.flat))
        self.flat[self.used : self.used + len(ids)] = ids
        self.lengths[n : n + len(words)] = lengths
        self.offsets[n : n + len(words)] = self.used + np.cumsum(lengths) - lengths
        self.used += len(ids)
        self.index.update(zip(hashes, range(n, n + len(words)), strict=True))

    def ids(self, group: Group) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all matches of the group, and the number of ids before each match (and after the last)."""
        if not len(group.hashes):
            return np.empty(0, np.int32), np.zeros(1, np.int64)
        different, first, place = np.unique(group.hashes, return_index=True, return_inverse=True)
        if len(self.index) + len(different) > self.most:
            self.clear()
        keys = different.tolist()
        known = np.fromiter((self.index.get(k, -1) for k in keys), np.int64, len(keys))
        if len(new := np.flatnonzero(known < 0)):
            a, b = group.starts[first[new]].tolist(), group.ends[first[new]].tolist()
            had = len(self.index)
            self._add([keys[i] for i in new.tolist()], [group.text[x:y].encode("utf-8", "surrogatepass") for x, y in zip(a, b, strict=True)])
            known[new] = np.arange(had, had + len(new))
        word = known[place]
        lengths = self.lengths[word]
        return gather(self.flat, self.offsets[word], lengths), np.concatenate(([0], np.cumsum(lengths)))
