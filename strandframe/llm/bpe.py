"""Byte-level BPE encoding and decoding on length-bucketed, padded numpy matrices.

Different words of a batch are put into matrices by length, one row a word, one column a byte. Each round looks up
the ranks of the pairs that have changed in an open-addressing hash table, every row merges its leftmost pair of
minimum rank, and the column that has become free is closed up, so the matrix loses a column a round; rows without a
pair left leave it. A matrix has at most ``CELLS`` cells, so that wide buckets have few rows. Words over ``WIDEST``
bytes, for which a matrix would cost the square of the length, run the same merges on a heap.

Defined results: null and empty texts have no ids; ids are those of the ranks given, a word that is itself in the
ranks being one id; other columns of the input play no part.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strandframe.llm.common import slices
from strandframe.llm.pretokens import WordCache, gather, groups

NONE = np.int32(2**31 - 1)
#: Longest word, in bytes, that gets a row of a matrix.
WIDEST = 1024
#: Cells of a matrix at most.
CELLS = 2_560_000


class PairTable:
    """Open-addressing hash table: pair of ids -> id of the merged token."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        self.bits = max(4, int(2 * len(left) + 1).bit_length())
        self.mask = (1 << self.bits) - 1
        self.keys = np.full(self.mask + 1, -1, np.int64)
        self.values = np.full(self.mask + 1, NONE, np.int32)
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        waiting, slots = np.arange(len(keys)), self._slot(keys)
        while len(waiting):
            free = self.keys[slots] == -1
            taken, first = np.unique(slots[free], return_index=True)
            placed = np.flatnonzero(free)[first]
            self.keys[taken] = keys[waiting[placed]]
            self.values[taken] = merged[waiting[placed]]
            rest = np.ones(len(waiting), bool)
            rest[placed] = False
            waiting, slots = waiting[rest], slots[rest] + 1 & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged ids of pairs of ids (those below 0: no token), NONE where they don't merge."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        slots = self._slot(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.values[slots], NONE)
        open_ = np.flatnonzero((found != keys) & (found != -1))
        while len(open_):
            slots_ = slots[open_] + 1 & self.mask
            slots[open_] = slots_
            found = self.keys[slots_]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slots_[hit]]
            open_ = open_[~hit & (found != -1)]
        out[(left < 0) | (right < 0)] = NONE
        return out


class ByteBPE:
    """Encoder and decoder of one vocabulary, made of the contents of its rank file (base64 token, space, rank)."""

    def __init__(self, rank_file: bytes):
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, rank_file.splitlines())}
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.token_bytes, self.token_at, self.token_len = _packed(tokens)
        self.text_bytes, self.text_at, self.text_len = _packed([b"%d," % i for i in range(size)])
        self.byte_ids = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        found = array("i")
        for token, rank in self.ranks.items():
            for k in range(1, len(token)):
                if (a := self.ranks.get(token[:k])) is not None and (b := self.ranks.get(token[k:])) is not None:
                    found.extend((a, b, rank))
        self.pairs = PairTable(*np.array(found, np.int32).reshape(-1, 3).T)
        self.cache = WordCache(self.encode_words)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and the number of each word's."""
        whole = [self.ranks.get(w, -1) for w in words]
        parts: list[np.ndarray | None] = [None] * len(words)
        buckets: dict[int, list[int]] = {}
        lengths = np.ones(len(words), np.int64)
        for i, (w, rank) in enumerate(zip(words, whole, strict=True)):
            if rank < 0:
                if len(w) > WIDEST:
                    parts[i] = np.array(self._merge_long(w), np.int32)
                    lengths[i] = len(parts[i])
                else:
                    buckets.setdefault(max(4, 1 << (len(w) - 1).bit_length()) if len(w) > 1 else 4, []).append(i)
        filled = []
        for width, at in buckets.items():
            most = max(1, CELLS // width)
            for k in range(0, len(at), most):
                some = np.array(at[k : k + most])
                ids, n = self._merge_matrix([words[i] for i in some.tolist()], width)
                lengths[some] = n
                filled.append((some, ids, n))
        offsets = np.cumsum(lengths) - lengths
        out = np.empty(int(lengths.sum()), np.int32)
        single = np.array(whole, np.int64)
        out[offsets[single >= 0]] = single[single >= 0]
        for some, ids, n in filled:
            cols = np.arange(ids.shape[1])
            out[(offsets[some][:, None] + cols)[cols < n[:, None]]] = ids[cols < n[:, None]]
        for i, part in enumerate(parts):
            if part is not None:
                out[offsets[i] : offsets[i] + len(part)] = part
        return out, lengths

    def _merge_matrix(self, words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(words)
        sizes = np.fromiter(map(len, words), np.int64, n)
        width = min(width, int(sizes.max()))
        ids = np.full((n, width), -1, np.int32)
        ids[np.arange(width) < sizes[:, None]] = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        result = np.full((n, width), -1, np.int32)
        ranks = self._ranks(ids)
        alive = np.arange(n)
        while ids.shape[1] > 1:
            at = ranks.argmin(1)
            best = ranks[np.arange(len(at)), at]
            if (ended := best == NONE).any():
                result[alive[ended], : ids.shape[1]] = ids[ended]
                go = ~ended
                ids, ranks, alive, at, best = ids[go], ranks[go], alive[go], at[go], best[go]
                if not len(alive):
                    break
            rows = np.arange(len(at))
            ids[rows, at] = best
            cols = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, cols + (cols > at[:, None]), 1)
            cols = cols[:-1]
            ranks = np.take_along_axis(ranks, cols + (cols >= at[:, None]), 1)
            for shift in (-1, 0):
                here = at + shift
                ok = (here >= 0) & (here < ranks.shape[1])
                r, c = rows[ok], here[ok]
                ranks[r, c] = self.pairs(ids[r, c], ids[r, c + 1])
        else:
            result[alive, : ids.shape[1]] = ids
        return result, (result >= 0).sum(1)

    def _ranks(self, ids: np.ndarray) -> np.ndarray:
        return self.pairs(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), -1)

    def _merge_long(self, word: bytes) -> list[int]:
        ids = self.byte_ids[np.frombuffer(word, np.uint8)]
        first = self.pairs(ids[:-1], ids[1:])
        ids = ids.tolist()
        n = len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        at = np.flatnonzero(first != NONE)
        heap = list(zip(first[at].tolist(), at.tolist(), strict=True))
        now = dict(zip(at.tolist(), first[at].tolist(), strict=True))
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            if now.get(i) != rank:
                continue
            gone = after[i]
            ids[i], ids[gone] = rank, -1
            now.pop(gone, None)
            after[i] = after[gone]
            if after[i] >= 0:
                before[after[i]] = i
            for a in (before[i], i):
                now.pop(a, None)
                if a >= 0 and after[a] >= 0:
                    token = self.ranks.get(self.token(ids[a]) + self.token(ids[after[a]]))
                    if token is not None:
                        now[a] = token
                        heapq.heappush(heap, (token, a))
        return [x for x in ids if x >= 0]

    def token(self, i: int) -> bytes:
        return self.token_bytes[self.token_at[i] : self.token_at[i] + self.token_len[i]].tobytes()

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids."""
        return gather(self.token_bytes, self.token_at[ids], self.token_len[ids])

    def encode_texts(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray]]:
        """(index of the text, ids of it or, if it is long, of its next piece), in order."""
        for group in groups(texts):
            ids, upto = self.cache.ids(group)
            for i, a, b in group.docs:
                yield i, ids[upto[a] : upto[b]]


def _packed(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(lengths) - lengths, lengths


_models: dict[bytes, ByteBPE] = {}


def model(rank_file: bytes) -> ByteBPE:
    """The encoder of this process for a rank file."""
    key = hashlib.sha256(rank_file).digest()
    if key not in _models:
        _models.clear()
        _models[key] = ByteBPE(rank_file)
    return _models[key]


def _rank_file(docs: DataFrame, path: str):
    with open(path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file: under 2 MB


def encode(docs: DataFrame, rank_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every text. No shuffle; the rank file is read on the driver and broadcast."""
    ranks = _rank_file(docs, rank_path)

    def run(batches):
        bpe = model(ranks.value)
        for batch in slices(batches):
            parts: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
            for i, ids in bpe.encode_texts(batch.column(1).to_pylist()):
                parts[i].append(ids)
            lengths = [sum(map(len, p)) for p in parts]
            flat = np.concatenate([np.empty(0, np.int32), *(x for p in parts for x in p)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["doc_id", "ids"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, rank_path: str) -> DataFrame:
    """(doc_id, bytes binary) of (doc_id, ids)."""
    ranks = _rank_file(encoded, rank_path)

    def run(batches):
        bpe = model(ranks.value)
        for batch in slices(batches):
            out = [None if ids is None else bpe.decode(np.array(ids, np.int64)).tobytes() for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def encode_digests(docs: DataFrame, rank_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every text: encoded, the ids decoded, both digested.

    Equal to encode() followed by decode(), but ids and bytes don't leave the task.
    """
    ranks = _rank_file(docs, rank_path)

    def run(batches):
        bpe = model(ranks.value)
        for batch in slices(batches):
            n = batch.num_rows
            count, of_ids, of_bytes = [0] * n, [hashlib.sha256() for _ in range(n)], [hashlib.sha256() for _ in range(n)]
            for i, ids in bpe.encode_texts(batch.column(1).to_pylist()):
                if len(ids):
                    if count[i]:
                        of_ids[i].update(b",")
                    count[i] += len(ids)
                    of_ids[i].update(gather(bpe.text_bytes, bpe.text_at[ids], bpe.text_len[ids])[:-1])
                    of_bytes[i].update(bpe.decode(ids))
            columns = [batch.column(0), pa.array(count, pa.int64()), pa.array([h.hexdigest() for h in of_ids]), pa.array([h.hexdigest() for h in of_bytes])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
