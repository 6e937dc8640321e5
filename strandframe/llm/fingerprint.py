"""Homomorphic multiset hash of a document's paragraphs.

A paragraph (a run of characters without line ends that holds a word) is hashed to a wide vector: ``STRONG`` lanes
modulo 2^64, drawn by BLAKE2b from its bytes, and ``WIDE`` lanes modulo 2^32, into each of which fall the signed
hashes of its runs of three words. A document's fingerprint is the lane-wise sum of its paragraphs' vectors. So

* it doesn't depend on the order of the paragraphs;
* paragraphs are put in by addition and taken out by subtraction (``insert``, ``delete``), without the others;
* texts of equal paragraphs have equal fingerprints, others differ in the strong lanes;
* since the wide lanes hold small signed sums, the cosine of two of them estimates the share of word runs in common
  (the standard error is about 1/sqrt(WIDE)).

The query compares a text with an edited one, whose second half is the beginning of the next document. Texts are
shuffled once, by ranges of (doc_id, text) of about the same number of bytes; the first document of a range goes to the
range before as well, so no task needs another's rows, and no order over the whole table is made in one task.

Defined results: null is the empty text; a text without words has the fingerprint of zeros; likeness is 1 for equal
fingerprints, else 0 where one is without word runs; null ids come first; rows that share an id follow one another in
the order of their texts; a table of one document is its own next; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandframe.llm.common import by_ranges, slices, small
from strandframe.llm.words import shingles, words_at

WIDE, STRONG, RUN = 256, 4, 3
_PARAGRAPH = re.compile(rb"[^\r\n\x0b\x0c]+")
_LINE_END = np.zeros(256, bool)
_LINE_END[[0x0A, 0x0B, 0x0C, 0x0D]] = True


class Fingerprint:
    """The sum of paragraph vectors."""

    __slots__ = ("strong", "wide")

    def __init__(self, strong: np.ndarray | None = None, wide: np.ndarray | None = None):
        self.strong = np.zeros(STRONG, np.uint64) if strong is None else strong
        self.wide = np.zeros(WIDE, np.uint32) if wide is None else wide

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.strong + other.strong, self.wide + other.wide)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.strong - other.strong, self.wide - other.wide)

    def insert(self, text: str) -> Fingerprint:
        return self + of_text(text)

    def delete(self, text: str) -> Fingerprint:
        return self - of_text(text)

    def hex(self) -> str:
        return (self.strong.astype("<u8").tobytes() + self.wide.astype("<u4").tobytes()).hex()

    @classmethod
    def from_hex(cls, text: str) -> Fingerprint:
        raw = bytes.fromhex(text)
        return cls(np.frombuffer(raw[: 8 * STRONG], "<u8").copy(), np.frombuffer(raw[8 * STRONG :], "<u4").copy())

    def likeness(self, other: Fingerprint) -> float:
        """Between 0 and 1; 1 for equal fingerprints."""
        a, b = self.wide.view(np.int32).astype(np.float64), other.wide.view(np.int32).astype(np.float64)
        if np.array_equal(a, b) and np.array_equal(self.strong, other.strong):
            return 1.0
        norm = float(np.sqrt((a @ a) * (b @ b)))
        return min(1.0, max(0.0, float(a @ b) / norm)) if norm else 0.0


def of_text(text: str | None) -> Fingerprint:
    """The fingerprint of a whole text: the sum over its paragraphs, whose words are hashed together."""
    data = (text or "").encode("utf-8", "surrogatepass")
    hashes, starts = words_at(data)
    if not len(hashes):
        return Fingerprint()
    digests = b"".join([hashlib.blake2b(p, digest_size=8 * STRONG).digest() for p in _PARAGRAPH.findall(data) if p.strip()])
    strong = np.frombuffer(digests, np.uint64).reshape(-1, STRONG).sum(0, dtype=np.uint64)
    number = np.searchsorted(np.flatnonzero(_LINE_END[np.frombuffer(data, np.uint8)]), starts)  # of each word's paragraph
    runs = []
    for size in range(1, RUN + 1):  # runs of RUN words; a paragraph of fewer words is one run
        if len(hashes) < size:
            break
        first, last = number[: len(number) - size + 1], number[size - 1 :]
        within = first == last
        if size < RUN:
            within &= np.append(True, first[1:] != number[: len(first) - 1]) & np.append(number[size:] != last[:-1], True)
        if within.any():
            runs.append(shingles(hashes, size)[within] if within.sum() * 2 > len(within) or size == RUN else _some(hashes, np.flatnonzero(within), size))
    runs_ = np.concatenate(runs)
    lanes = (runs_ >> np.uint64(32)).astype(np.int64) % WIDE
    odd = runs_ & np.uint64(1) == 1
    sums = np.bincount(lanes[odd], minlength=WIDE) - np.bincount(lanes[~odd], minlength=WIDE)
    return Fingerprint(strong, (sums & 0xFFFFFFFF).astype(np.uint32))


def _some(hashes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """The runs of size words that start at the given words."""
    return np.concatenate([shingles(hashes[i : i + size], size) for i in at.tolist()])


def edited(text: str, following: str) -> str:
    """text with its second half replaced by as much of the beginning of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every text; no shuffle."""

    def run(batches):
        for batch in slices(batches):
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t or "") for t in texts], pa.int64()), pa.array([of_text(t).hex() for t in texts])], names=["doc_id", "n_chars", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


_ROW = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every text."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranged, parts = by_ranges(slim, max(1, slim.rdd.getNumPartitions()))
    first_id = F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id"))["doc_id"]
    ids = ranged.groupBy("part").agg(first_id.alias("f_first")).withColumnRenamed("part", "f_part")
    order = Window.orderBy("f_part")
    last = F.max("f_part").over(Window.partitionBy(F.lit(0)))
    firsts = ids.select("f_part", "f_first", F.coalesce(F.lag("f_part").over(order), last).alias("f_before"))  # a row for each range
    own = ranged.withColumn("ahead", F.lit(False))
    begins = ranged.join(small(firsts, parts), (F.col("part") == F.col("f_part")) & F.col("doc_id").eqNullSafe(F.col("f_first")))
    ahead = begins.groupBy("f_before", "doc_id").agg(F.min("text").alias("text")).select("doc_id", "text", F.col("f_before").alias("part"), F.lit(True).alias("ahead"))
    dealt = own.unionByName(ahead).repartitionById(parts, "part").sortWithinPartitions("part", "ahead", F.col("doc_id").asc_nulls_first(), "text")

    def run(batches):
        held: tuple | None = None  # the document whose next one is still to come: part, id, text, fingerprint
        for batch in slices(batches):
            rows = []
            for part, ahead_, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                print_ = of_text(text)
                if held is not None:
                    _, id_, before, fp = held
                    new = edited(before, text)
                    changed = of_text(new)
                    rows.append((id_, len(before), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), fp.hex(), changed.hex(), fp.likeness(changed), fp.likeness(print_)))
                held = None if ahead_ else (part, doc_id, text, print_)
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[x.split()[0] for x in _ROW.split(", ")])

    return dealt.select("part", "ahead", "doc_id", "text").mapInArrow(run, _ROW)
