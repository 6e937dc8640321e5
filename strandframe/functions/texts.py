"""Vectors of reads as text, a symbol a position, made for a batch of reads at once."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandframe.model import ABSENT, AMBIGUOUS, BASES, DELETION, MATCH, MISSING

#: Letters that a read made as text may have; of reads with others, vectors are made as arrays.
LETTERS = "ACGTN"
#: Symbols that are made at once, about.
SYMBOLS = 1 << 20
_KNOWN = np.isin(np.arange(256), list(LETTERS.encode()))
#: What an operation puts into the text (0: what the read has).
_FILL = {"M": 0, "D": ord(AMBIGUOUS), "S": ord(MISSING)}


@lru_cache(maxsize=100_000)
def _parsed(cigar: str, letters: str, match: tuple[str, ...], gap: tuple[str, ...], extra: tuple[str, ...], silent: tuple[str, ...]) -> tuple | None:
    """Of a CIGAR: what its operations put into the text, as (fill, length, reference offset, read offset), and how many bases
    of the reference and of the read it needs. None: not known here."""
    found = re.findall(f"([0-9]+)({letters})", cigar)
    if any(len(n) > 9 for n, _ in found):
        return None
    out, i, j, known = [], 0, 0, (*match, *gap, *extra, *silent, "S")
    if any(op not in known for _, op in found):
        return (), 0, 0  # the vector is empty
    for at, (digits, op) in enumerate(found):
        n = int(digits)
        if op in match:
            out.append((_FILL["M"], n, i, j))
            i, j = i + n, j + n
        elif op in gap:
            out.append((_FILL["D"], n, i, j))
            i += n
        elif op in extra:
            j += n
        elif op == "S":
            if at == len(found) - 1:
                out.append((_FILL["S"], n, i, j))
            j += n
    return tuple(o for o in out if o[1]), i, j


@lru_cache(maxsize=100_000)
def ambiguous(sequence: bytes, end: int, size: int, around: int) -> bool:
    """functions.columns.deletion_is_ambiguous()."""
    lo, hi = end - size - around, end + around

    def flanks(e: int) -> bytes:
        return _slice(sequence, lo, e - size) + _slice(sequence, e, hi)

    own = flanks(end)
    return any(e != end and flanks(e) == own for e in range(end - size, end + size + 1))


def _slice(s: bytes, a: int, b: int) -> bytes:
    return s[a:b]


class _Strings:
    """The bytes of a string array: row r has data[at[r]:at[r] + n[r]]."""

    def __init__(self, array: pa.Array) -> None:
        wide = array.cast(pa.large_string())
        _, offsets, data = wide.buffers()
        ends = np.frombuffer(offsets, np.int64)[wide.offset:wide.offset + len(wide) + 1] if len(wide) else np.zeros(1, np.int64)
        self.data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(1, np.uint8)
        self.at, self.n = ends[:-1], np.diff(ends)
        self.valid = wide.is_valid().to_numpy(zero_copy_only=False)

    def without(self, bad: np.ndarray) -> np.ndarray:
        """Which rows have no byte that is bad."""
        hits = bad[self.data]
        if not hits.any():
            return np.ones(len(self.n), bool)
        before = np.concatenate([[0], np.cumsum(hits)])
        return before[self.at + self.n] == before[self.at]


def vector_texts(cigar: pa.Array, pos: pa.Array, seq: pa.Array, qual: pa.Array, sequence: pa.Array, mode: tuple, cutoff: int, around: int) -> pa.Array:
    """The text of each read's vector, from its position on: what operators.vectors.read_bits() gives as an array. Null for a
    read that isn't whole, that reaches beyond its reference or has other letters than LETTERS."""
    rows, read, score, own = len(cigar), _Strings(seq), _Strings(qual), _Strings(sequence)
    names = cigar.dictionary_encode()
    codes = names.indices.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    parsed = [None if c is None else _parsed(c, *mode) for c in names.dictionary.to_pylist()] or [None]
    needs = np.array([(0, 0, 0) if p is None else (1, p[1], p[2]) for p in parsed], np.int64)[codes]
    first = pos.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ascii_, other = np.arange(256) >= 128, ~_KNOWN
    ok = cigar.is_valid().to_numpy(zero_copy_only=False) & read.valid & score.valid & own.valid & (needs[:, 0] == 1) & (first >= 1)
    ok &= (first - 1 + needs[:, 1] <= own.n) & (needs[:, 2] <= read.n) & (needs[:, 2] <= score.n) & read.without(other) & score.without(ascii_) & own.without(ascii_)
    table = np.array([o for p in parsed if p for o in p[0]] or [(0, 0, 0, 0)], np.int64)
    many = np.array([len(p[0]) if p else 0 for p in parsed], np.int64)
    begin = np.concatenate([[0], np.cumsum(many)])[:-1]
    total = np.array([sum(o[1] for o in p[0]) if p else 0 for p in parsed], np.int64)[codes] * ok
    ends = np.cumsum(total)
    cuts = np.unique(np.concatenate([[0], np.searchsorted(ends, np.arange(SYMBOLS, ends[-1], SYMBOLS)) + 1, [rows]])) if rows else [0]
    out = [_symbols(np.flatnonzero(ok[a:b]) + a, codes, many, begin, table, first, read, score, own, cutoff, around) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    data = np.concatenate(out) if out else np.zeros(0, np.uint8)
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    text = pa.LargeStringArray.from_buffers(rows, pa.py_buffer(offsets), pa.py_buffer(data), pa.py_buffer(np.packbits(ok, bitorder="little")))
    return text.cast(pa.string())


def _symbols(rows: np.ndarray, codes: np.ndarray, many: np.ndarray, begin: np.ndarray, table: np.ndarray, first: np.ndarray, read: _Strings, score: _Strings, own: _Strings, cutoff: int, around: int) -> np.ndarray:
    each = many[codes[rows]]
    of = np.repeat(rows, each)
    op = table[np.repeat(begin[codes[rows]], each) + _within(each)]
    fill, n, i, j = op.T
    at = np.repeat(np.arange(len(of)), n)
    within = _within(n)
    is_read = fill == 0
    start = np.where(is_read, 1, 0)

    def letters(s: _Strings, offset: np.ndarray) -> np.ndarray:
        return s.data[((s.at[of] + offset) * start)[at] + within * start[at]]

    base, sure = letters(read, j), letters(score, j).astype(np.int16) - 33 > cutoff
    out = np.where(sure, np.where(base == letters(own, first[of] - 1 + i), ord(MATCH), base), ord(AMBIGUOUS)).astype(np.uint8)
    out = np.where(is_read[at], out, fill[at].astype(np.uint8))
    last = np.cumsum(n) - 1
    gone = np.flatnonzero(fill == _FILL["D"])
    if len(gone):
        r = of[gone]
        end = first[r] + i[gone] + n[gone] - 1
        for k, x, length, e, size in zip(last[gone].tolist(), own.at[r].tolist(), own.n[r].tolist(), end.tolist(), n[gone].tolist(), strict=True):
            if not ambiguous(own.data[x:x + length].tobytes(), e, size, around):
                out[k] = ord(DELETION)
    return out


def _within(n: np.ndarray) -> np.ndarray:
    """0, 1, ... of each of n."""
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n)


def vector_text(cigar: Column, pos: Column, seq: Column, qual: Column, sequence: Column, mode: tuple, cutoff: int, around: int) -> Column:
    """vector_texts() as a column."""

    def texts(cigar: pa.Array, pos: pa.Array, seq: pa.Array, qual: pa.Array, sequence: pa.Array) -> pa.Array:
        return vector_texts(cigar, pos, seq, qual, sequence, mode, cutoff, around)

    return F.arrow_udf(texts, "string")(cigar, pos.cast("int"), seq, qual, sequence)


def _resolved(a: str, b: str) -> str:
    """functions.columns.resolve_bits()."""
    if ABSENT in (a, b) or a == b:
        return b if a == ABSENT else a
    if MATCH in (a, b):
        return MATCH
    for symbol in (AMBIGUOUS, MISSING):
        if symbol in (a, b):
            return b if a == symbol else a
    clash = (a in BASES and b in (*BASES, DELETION)) or (a == DELETION and b in BASES)
    return AMBIGUOUS if clash else a


_MERGED = np.zeros((256, 256), np.uint8)
for _a in (*LETTERS, ABSENT, AMBIGUOUS, DELETION, MATCH, MISSING):
    for _b in (*LETTERS, ABSENT, AMBIGUOUS, DELETION, MATCH, MISSING):
        _MERGED[ord(_a), ord(_b)] = ord(_resolved(_a, _b))


def merged_texts(start1: pa.Array, text1: pa.Array, start2: pa.Array, text2: pa.Array) -> pa.Array:
    """The texts of two mates' vectors as one, from the first position of either on. Null where one is null, or the two are
    so far apart that most of the text would be empty."""
    one, two = _Strings(text1), _Strings(text2)
    at1, at2 = (s.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for s in (start1, start2))
    low = np.where(one.n == 0, at2, np.where(two.n == 0, at1, np.minimum(at1, at2)))
    high = np.maximum(np.where(one.n == 0, low, at1 + one.n), np.where(two.n == 0, low, at2 + two.n))
    ok = one.valid & two.valid & (high - low <= 4 * (one.n + two.n) + 1000)
    ends = np.cumsum((high - low) * ok)
    rows = len(ok)
    cuts = np.unique(np.concatenate([[0], np.searchsorted(ends, np.arange(SYMBOLS, ends[-1], SYMBOLS)) + 1, [rows]])) if rows else [0]
    out = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        r = np.flatnonzero(ok[a:b]) + a
        size = (high - low)[r]
        base = np.cumsum(size) - size
        sides = []
        for s, at in ((one, at1), (two, at2)):
            n, side = s.n[r], np.full(size.sum(), ord(ABSENT), np.uint8)
            within = _within(n)
            side[np.repeat(base + at[r] - low[r], n) + within] = s.data[np.repeat(s.at[r], n) + within]
            sides.append(side)
        out.append(_MERGED[sides[0], sides[1]])
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    data = np.concatenate(out) if out else np.zeros(0, np.uint8)
    return pa.LargeStringArray.from_buffers(rows, pa.py_buffer(offsets), pa.py_buffer(data), pa.py_buffer(np.packbits(ok, bitorder="little"))).cast(pa.string())


def merged_text(start1: Column, text1: Column, start2: Column, text2: Column) -> Column:
    """merged_texts() as a column."""

    def texts(start1: pa.Array, text1: pa.Array, start2: pa.Array, text2: pa.Array) -> pa.Array:
        return merged_texts(start1, text1, start2, text2)

    return F.arrow_udf(texts, "string")(start1.cast("int"), text1, start2.cast("int"), text2)


def merged_start(start1: Column, text1: Column, start2: Column, text2: Column) -> Column:
    """Where merged_text() begins."""
    return F.when(text1 == "", start2).when(text2 == "", start1).otherwise(F.least(start1, start2))


def inside(text: Column, start: Column, end: Column) -> Column:
    """What of a vector's text, from position start on, lies before end or there."""
    return F.substr(text, F.lit(1), F.greatest(end - start + 1, F.lit(0)))


def count_of(text: Column, letters: str) -> Column:
    """How many symbols of the text are among the letters."""
    return F.length(text) - F.length(F.translate(text, letters, ""))


def dense(text: Column, start: Column, end: Column) -> Column:
    """operators.render.dense_text() from 1 to end, of a vector's text from a position of 1 at least on."""
    known = inside(text, start, end)
    return F.concat(F.repeat(F.lit(ABSENT), F.least(start - 1, end)), known, F.repeat(F.lit(ABSENT), end - F.greatest(start, F.lit(1)) + 1 - F.length(known)))


def bits_of(text: Column, start: Column) -> Column:
    """The vector of a text, as an array."""
    each = F.transform(F.split(text, ""), lambda c, i: F.struct((start + i).cast("int").alias("pos"), c.alias("bit")))
    return F.filter(each, lambda b: ~b["bit"].isin("", ABSENT))


def symbols(fragments: DataFrame, *columns: str) -> DataFrame:
    """(columns, pos, bit): a row for each symbol of vectors (start, text)."""
    each = fragments.select(*columns, "start", F.posexplode(F.split("text", "")).alias("at", "bit")).filter(~F.col("bit").isin("", ABSENT))
    return each.select(*columns, (F.col("start") + F.col("at")).cast("int").alias("pos"), "bit")
