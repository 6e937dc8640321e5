"""Aligned reads of BAM files, in many partitions a file.

A BAM file is a row of compressed blocks (BGZF), each with the same sixteen bytes in front. These end a line for Spark's text
reader, so files are split between blocks by Spark itself, in any store, and a row is one block. Blocks are numbered within
their file, and ``PIECE`` of them decompressed together by one task.

A read may begin in one block and end in another, and where a piece's first read begins isn't written anywhere. It is taken
to be the first place from which reads follow each other up to the piece's end, one of them whole. Then what a piece has
behind its last whole read and what the next one has before its first (all of it, if it has no whole one) must make whole
reads exactly; if they don't, the job fails. So no read is lost or made up.

Defined results: a file without reads gives no rows; a file that is cut off, or isn't BGZF, is an error; a read longer than a
piece is an error (a piece has some 4 MB); so is a header longer than that.
"""

from __future__ import annotations

import functools
import re
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from strandframe.model import InputError
from strandframe.session import stage
from strandframe.sources.files import numbered_lines

#: The bytes in front of a block; letters of bases, CIGAR operations, sizes of tags' values.
MAGIC = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff\x06\x00BC\x02\x00"
SEQ, OPS = "=ACMGRSVTWYHKDBN", "MIDNSHP=X"
TAG_SIZES = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
#: Blocks of a piece (64 kB each, at most).
PIECE = 64
_READ = "qname string, flag string, rname string, pos int, mapq int, cigar string, rnext string, pnext int, tlen int, seq string, qual string, md_string string"
_FIXED = struct.Struct("<iiBBHHHiiii")
_NAME = re.compile(rb"[!-~]+\x00")


def _inflate(block: bytes) -> bytes:
    """A block's content; block: what follows MAGIC."""
    size = int.from_bytes(block[:2], "little") + 1 - len(MAGIC)
    if size != len(block):
        raise InputError(f"a block of {size} bytes has {len(block)}")
    out = zlib.decompress(block[2:-8], -15)
    if len(out) != int.from_bytes(block[-4:], "little") or zlib.crc32(out) != int.from_bytes(block[-8:-4], "little"):
        raise InputError("a block's content doesn't have its size or check sum")
    return out


def _header(data: bytes) -> tuple[list[str], int]:
    """The references' names, and where the first read begins."""
    if data[:4] != b"BAM\x01":
        raise InputError("not a BAM file")
    at = 8 + int.from_bytes(data[4:8], "little")
    n, names = int.from_bytes(data[at : at + 4], "little"), []
    at += 4
    for _ in range(n):
        size = int.from_bytes(data[at : at + 4], "little")
        names.append(data[at + 4 : at + 3 + size].decode())
        at += 8 + size
    if at > len(data):
        raise InputError("the header is longer than a piece, or cut off")
    return names, at


def _plausible(data: bytes, at: int, refs: int) -> int | None:
    """The end of the read at a place, if one can begin there (or the end of the data, if it isn't all there); else None."""
    if at + 4 > len(data):
        return len(data)
    size = int.from_bytes(data[at : at + 4], "little")
    if not 34 <= size < 1 << 28:
        return None
    if at + 36 > len(data):
        return len(data)
    ref, pos, name, _, _, ops, _, length, next_ref, next_pos, _ = _FIXED.unpack_from(data, at + 4)
    if not (-1 <= ref < refs and -1 <= next_ref < refs and pos >= -1 and next_pos >= -1 and name >= 2 and length >= 0 and 32 + name + 4 * ops + (length + 1) // 2 + length <= size):
        return None
    if at + 36 + name <= len(data) and not _NAME.fullmatch(data, at + 36, at + 36 + name):
        return None
    return at + 4 + size


def _first(data: bytes, refs: int) -> int | None:
    """The first place from which reads follow each other to the end of the data, one of them whole; None without such a
    place."""
    for start in range(len(data)):
        at, whole = _plausible(data, start, refs), False
        while at is not None and at < len(data):
            whole, at = True, _plausible(data, at, refs)
        if at is not None and (whole or at == len(data) and start + 4 + int.from_bytes(data[start : start + 4], "little") == at):
            return start
    return None


def _md(data: bytes, at: int, end: int) -> str:
    """The value of the MD tag among the tags."""
    while at + 3 <= end:
        tag, kind = data[at : at + 2], chr(data[at + 2])
        at += 3
        if kind in "ZH":
            stop = data.index(0, at, end)
            if tag == b"MD" and kind == "Z":
                return data[at:stop].decode()
            at = stop + 1
        elif kind == "B":
            at += 5 + TAG_SIZES[chr(data[at])] * int.from_bytes(data[at + 1 : at + 5], "little")
        else:
            at += TAG_SIZES[kind]
    return ""


def _read(data: bytes, at: int, names: list[str]) -> dict:
    """The read whose size stands at a place, as a line of SAM has it."""
    end = at + 4 + int.from_bytes(data[at : at + 4], "little")
    ref, pos, name, mapq, _, ops, flag, length, next_ref, next_pos, tlen = _FIXED.unpack_from(data, at + 4)
    at += 36
    qname = data[at : at + name - 1].decode()
    at += name
    cigar = "".join(f"{c >> 4}{OPS[c & 15]}" for c in struct.unpack_from(f"<{ops}I", data, at))
    at += 4 * ops
    packed = data[at : at + (length + 1) // 2]
    seq = "".join([SEQ[b >> 4] + SEQ[b & 15] for b in packed])[:length]
    at += len(packed)
    qual = data[at : at + length]
    text = "*" if not length or qual[:1] == b"\xff" else qual.translate(bytes((b + 33) & 255 for b in range(256))).decode("latin-1")
    rname = names[ref] if ref >= 0 else "*"
    rnext = "*" if next_ref < 0 else "=" if next_ref == ref else names[next_ref]
    return {"qname": qname, "flag": str(flag), "rname": rname, "pos": pos + 1, "mapq": mapq, "cigar": cigar or "*", "rnext": rnext, "pnext": next_pos + 1, "tlen": tlen, "seq": seq or "*", "qual": text, "md_string": _md(data, at + length, end)}


def _whole(data: bytes, start: int) -> tuple[list[int], int]:
    """Where the whole reads from a place on begin, and where they end."""
    places, at = [], start
    while at + 4 <= len(data) and (end := at + 4 + int.from_bytes(data[at : at + 4], "little")) <= len(data):
        places.append(at)
        at = end
    return places, at


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes]]:
    """(file, piece, content) of blocks that follow each other by (file, piece, number)."""
    key, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if (row["file"], row["piece"]) != key:
                if held:
                    yield *key, b"".join(held)
                key, held = (row["file"], row["piece"]), []
            held.append(_inflate(row["block"]))
    if held:
        yield *key, b"".join(held)


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for file, _, data in _pieces(batches):
        names, begin = _header(data)
        yield pa.RecordBatch.from_pylist([{"h_file": file, "names": names, "begin": begin}], pa.schema([("h_file", pa.string()), ("names", pa.list_(pa.string())), ("begin", pa.int64())]))


_DECODED = f"file string, piece long, border boolean, head binary, tail binary, read struct<{_READ.replace(' ', ':').replace(',:', ',')}>"


def _decoded(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The whole reads of each piece, and a row of what it has of others: before its first and behind its last one."""
    names: dict[str, tuple[list[str], int]] = {}

    def remembered() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                if (file := batch.column("file")[i].as_py()) not in names:
                    names[file] = (batch.column("names")[i].as_py(), batch.column("begin")[i].as_py())
            yield batch.select(["file", "piece", "block"])

    for file, piece, data in _pieces(remembered()):
        refs, begin = names[file]
        start = begin if piece == 0 else _first(data, len(refs))
        places, end = _whole(data, start) if start is not None else ([], len(data))  # else all of it belongs to what is before
        own = {"file": file, "piece": piece, "border": False, "head": None, "tail": None}
        for k in range(0, len(places), 1000):
            yield pa.RecordBatch.from_pylist([own | {"read": _read(data, p, refs)} for p in places[k : k + 1000]], schema)
        yield pa.RecordBatch.from_pylist([own | {"border": True, "head": data[:start] if piece else b"", "tail": data[end:], "read": None}], schema)


def _joined(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The reads that lie across borders: in a piece's tail and the next one's head."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            data = (row["tail"] or b"") + (row["head"] or b"")
            places, end = _whole(data, 0)
            if data:
                if end < len(data):
                    raise InputError(f"reads of {row['file']} don't meet behind piece {row['piece']}: the file is cut off, or a read is longer than a piece")
                out += [_read(data, p, row["names"]) for p in places]
        yield pa.RecordBatch.from_pylist(out, schema)


def bam(spark: SparkSession, path: str | list[str], mapped_only: bool = False) -> DataFrame:
    """The reads of BAM files, with the columns of files.sam(). mapped_only: without unmapped ones."""
    lines = numbered_lines(spark, path, MAGIC.decode("latin-1"), "ISO-8859-1")
    bad = F.raise_error(F.concat(F.lit("not a BGZF file: "), "file")).cast("boolean")
    blocks = lines.filter(F.when((F.col("line") == 0) & (F.length(F.col("value").cast("binary")) > 0), bad).otherwise(F.col("line") > 0))
    blocks = blocks.select("file", F.floor((F.col("line") - 1) / PIECE).alias("piece"), F.col("line").alias("number"), F.col("value").cast("binary").alias("block"))
    first = blocks.filter("piece = 0").repartition("file").sortWithinPartitions("file", "number").select("file", "piece", "block")
    headers = stage(first.mapInArrow(_headers, "h_file string, names array<string>, begin long"), "bam-headers")
    placed = blocks.join(headers, F.col("file") == F.col("h_file")).repartition("file", "piece").sortWithinPartitions("file", "piece", "number").select("file", "piece", "block", "names", "begin")
    decoded = stage(placed.mapInArrow(functools.partial(_decoded, schema=to_arrow_schema(StructType.fromDDL(_DECODED))), _DECODED), "bam-pieces")
    edges = decoded.filter("border").select("file", "piece", "head", "tail")
    ahead = edges.select(F.col("file").alias("a_file"), (F.col("piece") - 1).alias("a_piece"), F.col("head").alias("a_head"))
    met = edges.drop("head").join(ahead, (F.col("file") == F.col("a_file")) & (F.col("piece") == F.col("a_piece")), "left").join(headers, F.col("file") == F.col("h_file"))
    across = met.select("file", "piece", "tail", F.col("a_head").alias("head"), "names").mapInArrow(functools.partial(_joined, schema=to_arrow_schema(StructType.fromDDL(_READ))), _READ)
    out = decoded.filter("not border").select("read.*").unionByName(across)
    return out.filter(F.col("flag").cast("int").bitwiseAND(4) == 0) if mapped_only else out
