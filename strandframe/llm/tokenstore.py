"""Token-id files of directly addressable codes (DAC).

A file holds the ids of consecutive documents. An id is split into chunks of 8 bits, the lowest first. Level k holds
the k-th chunk of every id that has one, and a bitmap telling which of them goes on at the next level; an id's place
at the next level is the number of continuation bits before its own, which the rank directory (set bits before each
block of 512) gives with one look and a count within a block. So any token is read without decoding others.

Layout (little endian): magic ``DAC1``, uint32 levels, uint64 documents, uint64 ids; document ids (int64), first id
of each document within the file (uint64, one more than documents); then for each level uint64 entries, rank
directory (uint64), bitmap words (uint64), chunks (uint8), each padded to 8 bytes.

Files are made by range of doc_id and written under a temporary name, then renamed: a task that is run again after
the loss of an executor writes the same file again, and no reader sees half a file. A range is one file for each
``FILE_IDS`` ids or so (a document is never cut), which bounds what a task holds; names rise with doc_id.

Scale: one shuffle (of the texts, by ranges of about the same number of bytes; the rows of one id may be several
ranges); where a document starts among all ids comes from a running sum over files (one row for each file). Word ids
are looked up by the batch, so the tokenizer sees each different word once for each cache's life. A text with the string
of an added token goes to the library whole, so it is taken as the library takes it.

Defined results: null and empty texts have the end id alone; rows with a null id come first; repeated rows are
documents of their own, in the order of their texts; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandframe.llm.common import by_ranges, shared_dir, slices, small, stage
from strandframe.llm.pretokens import WordCache, groups

MAGIC = b"DAC1"
BLOCK = 512
#: Ids after which a range begins another file, and files of a range at most (by the width of the number in their names).
FILE_IDS, RANGE_FILES = 8_000_000, 1 << 20
NO_ID = -(2**63)
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def _padded(data: bytes) -> bytes:
    return data + b"\0" * (-len(data) % 8)


def pack(ids: np.ndarray) -> list[bytes]:
    """The levels of ids (not negative, below 2^32)."""
    out, rest = [], ids.astype(np.uint32)
    while len(rest) or not out:
        more = rest > 255
        bits = np.packbits(np.append(more, np.zeros(-len(more) % BLOCK, bool)), bitorder="little")
        ones = _ONES[bits].reshape(-1, BLOCK // 8).sum(1, dtype=np.uint64)
        ranks = np.concatenate((np.zeros(1, np.uint64), np.cumsum(ones, dtype=np.uint64)))
        out.append(struct.pack("<Q", len(rest)) + ranks.tobytes() + bits.tobytes() + _padded((rest & 255).astype(np.uint8).tobytes()))
        rest = rest[more] >> 8
    return out


class TokenFile:
    """One file's contents; nothing is decoded before it is asked for."""

    def __init__(self, data: bytes | memoryview):
        magic, levels, docs, self.n_ids = struct.unpack_from("<4sIQQ", data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = 24
        self.doc_ids = np.frombuffer(data, np.int64, docs, at)
        self.starts = np.frombuffer(data, np.uint64, docs + 1, at + 8 * docs)
        at += 8 * (2 * docs + 1)
        self.levels = []
        for _ in range(levels):
            (n,) = struct.unpack_from("<Q", data, at)
            blocks = -(-n // BLOCK)
            ranks = np.frombuffer(data, np.uint64, blocks + 1, at + 8)
            at += 8 + 8 * (blocks + 1)
            bits = np.frombuffer(data, np.uint8, blocks * BLOCK // 8, at)
            at += blocks * BLOCK // 8
            self.levels.append((np.frombuffer(data, np.uint8, n, at), bits, ranks))
            at += n + -n % 8

    def __len__(self) -> int:
        return self.n_ids

    def __getitem__(self, i: int) -> int:
        """The i-th id, by one look into each of its levels."""
        if not 0 <= i < self.n_ids:
            raise IndexError(i)
        value = 0
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            value |= int(chunks[i]) << 8 * k
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // BLOCK
            inside = np.unpackbits(bits[block * BLOCK // 8 : (i >> 3) + 1], bitorder="little")[: i - block * BLOCK]
            i = int(ranks[block]) + int(inside.sum())
        return value

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids start to stop."""
        stop = self.n_ids if stop is None else stop
        lo, hi, out = start, stop, None
        places: np.ndarray | None = None
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            if lo >= hi:
                break
            part = chunks[lo:hi].astype(np.uint32) << np.uint32(8 * k)
            if out is None or places is None:
                out, places = part, np.arange(hi - lo)
            else:
                out[places] |= part
            flags = np.unpackbits(bits[lo >> 3 : (hi + 7) >> 3], bitorder="little")[lo & 7 : (lo & 7) + hi - lo].astype(bool)
            places = places[flags]
            block = lo // BLOCK
            before = int(np.unpackbits(bits[block * BLOCK // 8 : (lo >> 3) + 1], bitorder="little")[: lo - block * BLOCK].sum()) if lo else 0
            lo = int(ranks[block]) + before if lo < len(chunks) else int(ranks[-1])
            hi = lo + int(flags.sum())
        return np.empty(0, np.uint32) if out is None else out

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))


def file_bytes(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    levels = pack(ids)
    starts = np.concatenate(([0], np.cumsum(lengths))).astype(np.uint64)
    return b"".join([struct.pack("<4sIQQ", MAGIC, len(levels), len(doc_ids), len(ids)), doc_ids.astype(np.int64).tobytes(), starts.tobytes(), *levels])


def write_file(path: str, data: bytes) -> None:
    """Write under a name of its own, then rename: whole or not at all, and safe to repeat."""
    fs, where = pafs.FileSystem.from_uri(path)
    own = f"{where}.{os.getpid()}-{os.urandom(6).hex()}.tmp"
    fs.create_dir(os.path.dirname(where), recursive=True)
    with fs.open_output_stream(own) as out:
        out.write(data)
    fs.move(own, where)


class LibraryEncoder:
    """The tokenizers library, for a tokenizer's definition (JSON), with a cache of words in front of it."""

    def __init__(self, definition: bytes):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_buffer(definition)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache = WordCache(self._words, most=800_000)  # the library is slow on words it meets anew

    def _words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        # A word is a match of the tokenizer's own split pattern, and by itself is split no further.
        ids = [e.ids for e in self.tokenizer.encode_batch_fast([w.decode("utf-8", "surrogatepass") for w in words], add_special_tokens=False)]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for part in ids for i in part), np.int32, int(lengths.sum())), lengths

    def encode(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray]]:
        """(index of the text, ids of it or, if it is long, of its next piece), in order."""
        whole = {i: t for i, t in enumerate(texts) if t and any(x in t for x in self.added)}
        done = -1
        for group in groups([None if i in whole else t for i, t in enumerate(texts)] if whole else texts):
            ids, upto = self.cache.ids(group)
            for i, a, b in group.docs:
                if i in whole and i != done:
                    yield i, np.array(self.tokenizer.encode(whole[i], add_special_tokens=False).ids, np.int32)
                else:
                    yield i, ids[upto[a] : upto[b]]
                done = i


_encoders: dict[bytes, LibraryEncoder] = {}


def library_encoder(definition: bytes) -> LibraryEncoder:
    """This process's encoder for a definition."""
    key = hashlib.sha256(definition).digest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = LibraryEncoder(definition)
    return _encoders[key]


def write(docs: DataFrame, tokenizer_path: str, end_id: int = 0, folder: str | None = None, file_ids: int = FILE_IDS) -> tuple[str, DataFrame]:
    """Encode every text and write the files; (folder, manifest: file, n_docs, n_ids), the manifest staged."""
    spark = docs.sparkSession
    folder = folder or shared_dir(spark, "tokens")
    with open(tokenizer_path, "rb") as f:
        definition = spark.sparkContext.broadcast(f.read())  # a tokenizer's definition: under 2 MB
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ranged, parts = by_ranges(slim, max(1, slim.rdd.getNumPartitions()))

    def flush(file: int, doc_ids: list[int], chunks: list[np.ndarray], lengths: list[int]) -> pa.RecordBatch:
        ids = np.concatenate(chunks)
        write_file(f"{folder}/{file:016d}.dac", file_bytes(np.array(doc_ids, np.int64), np.array(lengths, np.int64), ids))
        return pa.RecordBatch.from_arrays([pa.array([file], pa.int64()), pa.array([len(doc_ids)], pa.int64()), pa.array([len(ids)], pa.int64())], names=["file", "n_docs", "n_ids"])

    def run(batches):
        encoder = library_encoder(definition.value)
        end = np.array([end_id], np.int32)
        file, held, doc_ids, chunks, lengths = None, 0, [], [], []
        for batch in slices(batches):
            numbers, names, texts = (c.to_pylist() for c in batch.columns)
            done = 0
            for i, ids in encoder.encode(texts):
                if i >= done:  # the first piece of its text
                    first = numbers[i] * RANGE_FILES
                    if file is None or first > file or held >= file_ids:
                        if doc_ids:
                            yield flush(file, doc_ids, chunks, lengths)
                        file = first if file is None or first > file else file + 1
                        held, doc_ids, chunks, lengths = 0, [], [], []
                    doc_ids.append(NO_ID if names[i] is None else names[i])
                    lengths.append(1)
                    chunks.append(end)
                    held += 1
                    done = i + 1
                chunks.insert(len(chunks) - 1, ids)
                lengths[-1] += len(ids)
                held += len(ids)
        if doc_ids:
            yield flush(file, doc_ids, chunks, lengths)

    dealt = ranged.repartitionById(parts, "part").sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), "text")
    return folder, stage(dealt.select("part", "doc_id", "text").mapInArrow(run, "file long, n_docs long, n_ids long"), "token-manifest")


def read(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""

    def run(batches):
        for batch in slices(batches):
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                file = TokenFile(content.as_buffer())
                starts, n = file.starts.astype(np.int64), len(file.doc_ids)
                crc = np.empty(n, np.int64)
                for lo in range(0, n, 256):  # a few documents at once, so that a file's ids are never all unpacked
                    hi = min(n, lo + 256)
                    ids = file.ids(int(starts[lo]), int(starts[hi])).astype("<u4")
                    for i in range(lo, hi):
                        crc[i] = zlib.crc32(ids[starts[i] - starts[lo] : starts[i + 1] - starts[lo]])
                number = int(os.path.basename(path).removesuffix(".dac"))
                names = pa.array(file.doc_ids, mask=file.doc_ids == NO_ID)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, number, np.int64)), names, pa.array(starts[:-1]), pa.array(np.diff(starts)), pa.array(crc)], names=["file", "doc_id", "start", "n_tokens", "ids_crc32"])

    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    base = manifest.select(F.col("file").alias("m_file"), F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.dac").load(folder).select("path", "content")
    docs = files.mapInArrow(run, "file long, doc_id long, start long, n_tokens long, ids_crc32 long")
    joined = docs.join(small(base, manifest.count()), F.col("file") == F.col("m_file"))
    return joined.select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


def roundtrip(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Write all texts' ids and read the files back: (doc_id, start, n_tokens, ids_crc32)."""
    folder, manifest = write(docs, tokenizer_path, end_id)
    if not manifest.take(1):
        return docs.sparkSession.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read(docs.sparkSession, folder, manifest)
