"""Fuzzy search for short licence notices.

Base: places where a phrase's words stand consecutively (words: runs of 0-9, a-z and anything beyond ASCII, after
lower-casing A-Z). Fuzzy: a notice of n characters may have up to ``errors`` edits. By the pigeonhole principle one of
its errors + 1 pieces then stands in the text unchanged, so the pieces are searched as exact seeds; around each seed's
place a window as wide as the notice can lie is cut out, overlapping windows are joined, and the regex library's
bounded-error matching (``{e<=k}``) verifies the edits there and gives the span. Texts are folded first (A-Z
lower-cased, each run of non-word characters one space), span ends are mapped back to words.

Edits may not turn the notice into another licence's: the distinctive word (``mit``, ``apache`` ...) has at most one
edit, short ones none.

Defined results: null is the empty text; it has no words, no places and no labels, and score 0. The score is 1 with a
base place, else 1 - edits / characters of the best fuzzy notice. Rows stand for themselves, in any order; other
columns play no part. No shuffle.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from strandframe.llm.common import slices

#: Base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


@dataclass(frozen=True)
class Notice:
    """phrase: folded words. errors: edits allowed in all. core: the word that tells licences apart, unchanged but for
    core_errors edits."""

    phrase: str
    label: str
    errors: int
    core: str
    core_errors: int = 0


#: Notices searched with errors.
NOTICES = [
    Notice("under the mit license", "mit", 2, "mit"),
    Notice("permission is hereby granted free of charge to any person obtaining a copy", "mit", 6, "granted", 1),
    Notice("apache license version 2", "apache-2", 3, "apache", 1),
    Notice("licensed under cc by nc", "cc-by-nc", 2, "nc"),
    Notice("licensed under cc by sa", "cc-by-sa", 2, "sa"),
    Notice("gnu general public license", "gpl", 3, "gnu", 0),
    Notice("gnu lesser general public license", "lgpl", 3, "lesser", 1),
    Notice("mozilla public license", "mpl", 2, "mozilla", 1),
    Notice("redistribution and use in source and binary forms with or without modification", "bsd", 6, "redistribution", 2),
    Notice("this is free and unencumbered software released into the public domain", "unlicense", 6, "unencumbered", 2),
]

_UPPER = bytes(range(65, 91))
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_RUN = re.compile(rb" {2,}")


def pieces(phrase: str, errors: int) -> list[tuple[int, str]]:
    """The phrase cut into errors + 1 pieces of about the same length, with their places."""
    n = errors + 1
    cuts = [len(phrase) * i // n for i in range(n + 1)]
    return [(a, phrase[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def pattern(notice: Notice) -> regex.Pattern:
    """The notice with at most its errors, its core word with at most its own; between word ends."""
    before, core, after = notice.phrase.partition(notice.core)
    loose = "".join([f"(?:{regex.escape(x)})" if x else "" for x in (before, after)][:1])
    core_ = f"(?:{regex.escape(core)}){{e<={notice.core_errors}}}" if notice.core_errors else f"(?:{regex.escape(core)})"
    tail = f"(?:{regex.escape(after)}){{e<={notice.errors}}}" if after else ""
    head = f"{loose}{{e<={notice.errors}}}" if before else ""
    return regex.compile(rf"(?b)(?<![^ ]){head}{core_}{tail}(?![^ ])")


@dataclass(frozen=True)
class Match:
    label: str
    edits: int
    length: int
    first_word: int
    last_word: int


@lru_cache(1)
def _search() -> list[tuple[Notice, regex.Pattern, list[tuple[int, bytes]]]]:
    return [(n, pattern(n), [(at, piece.encode()) for at, piece in pieces(n.phrase, n.errors)]) for n in NOTICES]


def fold(text: str) -> bytes:
    """The words of a text, one space between them and one on both sides."""
    return _RUN.sub(b" ", b" " + text.encode("utf-8", "surrogatepass").translate(_FOLD) + b" ")


def _windows(text: bytes, notice: Notice, seeds: list[tuple[int, bytes]]) -> list[tuple[int, int]]:
    """Where the notice can stand, by its seeds: windows that overlap are one up to the length of two notices, so that
    the work stays in proportion to the text. An edit may be of a character of four bytes."""
    size, slack = len(notice.phrase.encode()), 4 * notice.errors + 4
    spans = set()
    for at, seed in seeds:
        place = text.find(seed)
        while place >= 0:
            spans.add((max(0, place - at - slack), min(len(text), place - at + size + slack)))
            place = text.find(seed, place + 1)
    joined: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if joined and a <= joined[-1][1] and b - joined[-1][0] <= 2 * (size + slack):
            joined[-1] = (joined[-1][0], max(b, joined[-1][1]))
        else:
            joined.append((a, b))
    return joined


def _at_characters(text: bytes, a: int, b: int) -> tuple[int, int]:
    """a and b moved outwards to where characters begin."""
    while a > 0 and text[a] & 0xC0 == 0x80:
        a -= 1
    while b < len(text) and text[b] & 0xC0 == 0x80:
        b += 1
    return a, b


def fuzzy(text: bytes, spaces: np.ndarray) -> list[Match]:
    """Notices with errors in a folded text; spaces: where its spaces stand. A notice is looked for where its core and a
    seed can stand; of matches of it that overlap, the one with the fewest edits (then the first) counts."""
    found = []
    for notice, want, seeds in _search():
        core = notice.core.encode()
        if not notice.core_errors and core not in text:
            continue
        seen: list[tuple[int, int, int]] = []  # start, end and edits of matches, by bytes
        for a, b in _windows(text, notice, seeds):
            a, b = _at_characters(text, a, b)
            if not notice.core_errors and text.find(core, a, b) < 0:
                continue
            piece = text[a:b].decode("utf-8", "surrogatepass")
            open_ = [(0, len(piece))]  # where matches are still looked for: the best comes first, then both sides of it
            while open_:
                lo, hi = open_.pop()
                m = want.search(piece, lo, hi) if hi - lo >= len(notice.phrase) - notice.errors else None
                if m and m.end() > m.start():
                    open_ += [(lo, m.start()), (m.end(), hi)]
                    if (edits := sum(m.fuzzy_counts)) <= notice.errors:
                        start = a + len(piece[: m.start()].encode("utf-8", "surrogatepass"))
                        seen.append((start, start + len(m.group().encode("utf-8", "surrogatepass")), edits))
        best: list[tuple[int, int, int]] = []
        for m in sorted(seen):
            if best and m[0] < best[-1][1]:
                if m[2] < best[-1][2]:
                    best[-1] = m
            else:
                best.append(m)
        for start, end, edits in best:
            lo = int(np.searchsorted(spaces, start)) - 1
            found.append(Match(notice.label, edits, len(notice.phrase), lo, lo + text.count(b" ", start, end)))
    return found


def scan(text: str | None) -> tuple[int, int, int | None, int | None, str, str, float, list[Match]]:
    """n_words, n_base, first_word, last_word, base_labels, labels, score and the fuzzy matches of a whole text."""
    folded = fold(text or "")
    spaces = np.flatnonzero(np.frombuffer(folded, np.uint8) == 32)  # the word of number i follows the i-th space
    n_words = max(0, len(spaces) - 1)
    places, base = [], set()
    for phrase, label in BASE.items():
        want = f" {phrase} ".encode()
        at = folded.find(want)
        while at >= 0:
            places.append(at)
            base.add(label)
            at = folded.find(want, at + 1)
    first, last = (int(np.searchsorted(spaces, f(places))) if places else None for f in (min, max))
    matches = fuzzy(folded, spaces)
    labels = base | {m.label for m in matches}
    score = 1.0 if places else max((1 - m.edits / m.length for m in matches), default=0.0)
    return n_words, len(places), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score, matches


_SPANS = pa.list_(pa.struct([("label", pa.string()), ("edits", pa.int32()), ("first_word", pa.int64()), ("last_word", pa.int64())]))
_ROW = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, matches array<struct<label:string,edits:int,first_word:bigint,last_word:bigint>>"


def scan_documents(docs: DataFrame) -> DataFrame:
    """One row for each document: base places, labels, score, and the spans (in words) of the fuzzy matches."""

    def run(batches):
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), _SPANS]
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"]
        for batch in slices(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                *row, matches = scan(text)
                rows.append((*row, [{"label": m.label, "edits": m.edits, "first_word": m.first_word, "last_word": m.last_word} for m in matches]))
            columns = list(zip(*rows, strict=True)) or [[]] * len(types)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=names)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(run, _ROW)
