"""Toxicity by compression distance: zstandard dictionaries trained on toxic and on ordinary text, compared on windows.

A window is ``FINE`` words of running text (letters and digits, A-Z lower-cased). Its distance is its compressed length
under the ordinary dictionary less that under the toxic dictionary put before the ordinary one: the bytes that
knowledge of toxic text saves. (Two dictionaries side by side differ by chance on ordinary words, by more than a toxic
word saves; with the ordinary one in both, ordinary words cost the same.) Windows stand in a fixed frame that both
dictionaries hold: zstandard finds no match in the last bytes of a block and keeps a block that gains too little as it
is, so the frame makes every byte of the window's own length visible. For speed, ``COARSE`` words are compressed first,
and their windows only where they save a byte or more.

Fitting uses a bounded sample of labelled rows (``SAMPLE`` of each label, none of the held-out ones), of which
``WINDOWS`` windows of each label, spread evenly over the whole texts:

* the ordinary dictionary is trained on windows of ordinary documents;
* the toxic dictionary is trained on windows of toxic documents: on all of them at first, then, ``ROUNDS`` times, on those
  whose distance is above a threshold, calibrated on ordinary windows that the ordinary dictionary hasn't seen: the
  distance that one of 200 of them exceeds. A toxic document is mostly ordinary text; so its dictionary comes to hold
  what ordinary text lacks;
* a document's counts of windows at each distance, and its number of windows, are weighed by a logistic regression,
  fitted on sampled documents that the dictionaries haven't seen; these counts are weighted by the labels' true
  shares, so the score is a calibrated probability and 0.5 the threshold.

Dictionaries are trained in one task, which gets windows; the driver gets two dictionaries and the counts of the
sample. Scoring covers whole texts, without a shuffle.

Defined results: null and empty texts, and texts without letters or digits, get the score of no windows at all;
without labelled rows of both kinds every score is the share of label 1 (0 if there are no labels at all). Rows are
scored alike wherever they occur; other columns play no part. A document's repeated rows and repeated labels count once
in the sample.
"""

from __future__ import annotations

import hashlib
import math
import pickle
import random
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandframe.llm.common import held_out, slices, stage

#: Labelled rows of each label, and windows of each label, that the fit may use.
SAMPLE, WINDOWS = 4000, 64_000
ORDINARY_BYTES = 65_536
#: Size of the toxic dictionary in each round.
ROUNDS = (16_384, 8_192, 4_096, 4_096, 2_048, 2_048, 2_048)
FINE, COARSE = 3, 12
DISTANCES = 8

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_LEAD, _TAIL = b"|compression window lead|", b"\x00\x01end of window\x02"
_CHUNK = 1_000_000


def words(text: str | None) -> Iterator[list[bytes]]:
    """The folded words of a whole text, in pieces of a multiple of COARSE words (the last: what is left)."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)
    at, rest = 0, []
    while at < len(data):
        end = len(data) if len(data) - at <= _CHUNK else data.find(b" ", at + _CHUNK)
        end = len(data) if end < 0 else end
        rest += data[at:end].split()
        at = end
        whole = len(rest) if at >= len(data) else len(rest) // COARSE * COARSE
        if whole:
            yield rest[:whole]
        rest = rest[whole:]


def windows(ws: list[bytes], size: int) -> list[bytes]:
    """Windows of so many words (the last: what is left), one after another."""
    return [b" ".join(ws[i : i + size]) for i in range(0, len(ws), size)]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    how = zstandard.ZstdCompressionParameters(window_log=18, hash_log=17, chain_log=17, search_log=7, min_match=4, target_length=64, strategy=zstandard.STRATEGY_LAZY, write_content_size=0, write_checksum=0, write_dict_id=0)
    content = zstandard.ZstdCompressionDict(dictionary + _TAIL + _LEAD, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(dict_data=content, compression_params=how)


def _lengths(compressor: zstandard.ZstdCompressor, windows: list[bytes]) -> np.ndarray:
    compress = compressor.compress
    return np.fromiter((len(compress(b"%b %b %b" % (_LEAD, w, _TAIL))) for w in windows), np.int64, len(windows))


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray = field(default_factory=lambda: np.zeros(DISTANCES + 1))
    bias: float = 0.0


class Scorer:
    """A model at work in one process."""

    def __init__(self, model: Model):
        self.model = model
        self.compressors = (_compressor(model.ordinary), _compressor(model.toxic + model.ordinary)) if model.toxic else None

    def distances(self, windows: list[bytes]) -> np.ndarray:
        """The bytes that the toxic dictionary saves of each window."""
        if not self.compressors:
            return np.zeros(len(windows), np.int64)
        a, b = (_lengths(c, windows) for c in self.compressors)
        return a - b

    def counts(self, texts: list[str | None]) -> np.ndarray:
        """For each text, the number of windows at distance 0, 1 ... DISTANCES - 1 or more."""
        out = np.zeros((len(texts), DISTANCES), np.int64)
        for i, text in enumerate(texts):
            for ws in words(text):
                far = np.flatnonzero(self.distances(windows(ws, COARSE)) >= 1).tolist()
                close = [w for k in far for w in windows(ws[k * COARSE : (k + 1) * COARSE], FINE)]
                found = np.bincount(np.clip(self.distances(close), 0, DISTANCES - 1), minlength=DISTANCES)
                out[i] += found
                out[i, 0] += -(-len(ws) // FINE) - len(close)
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        z = features(self.counts(texts)) @ self.model.weights + self.model.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def features(counts: np.ndarray) -> np.ndarray:
    """Logarithms of the number of windows at each distance or more, of all windows, and the share beyond 1."""
    beyond = counts[:, ::-1].cumsum(1)[:, ::-1]
    return np.column_stack((np.log1p(beyond), beyond[:, 2] / np.maximum(1, beyond[:, 0])))


def _trained(samples: list[bytes], size: int, k: int) -> bytes:
    try:
        return zstandard.train_dictionary(size, samples, k=k, d=6, level=3).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: they are the dictionary themselves
        return b" ".join(samples)[-size:]


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, penalty: float = 1.0) -> tuple[np.ndarray, float]:
    """Weighted logistic regression by Newton steps on standardised features."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    a = np.column_stack(((x - mean) / scale, np.ones(len(x))))
    beta = np.zeros(a.shape[1])
    ridge = np.diag([penalty] * x.shape[1] + [1e-3])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        step = np.linalg.solve((a * (w * p * (1 - p))[:, None]).T @ a + ridge, a.T @ (w * (y - p)) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-6:
            break
    weights = beta[:-1] / scale
    return weights, float(beta[-1] - weights @ mean)


def train(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes]:
    """The ordinary and the toxic dictionary of windows of both labels."""
    rng = random.Random(7)
    toxic, ordinary = sorted(toxic), sorted(ordinary)
    rng.shuffle(toxic)
    rng.shuffle(ordinary)
    unseen, seen = ordinary[: len(ordinary) // 3], ordinary[len(ordinary) // 3 :]
    base = _trained(seen, ORDINARY_BYTES, 64)
    plain = _compressor(base)
    length, control = _lengths(plain, toxic), _lengths(plain, unseen)
    kept, found = toxic, b""
    for size in ROUNDS:
        found = _trained(kept, size, 16)
        both = _compressor(found + base)
        threshold = max(1.0, float(np.quantile(control - _lengths(both, unseen), 0.995))) if unseen else 1.0
        far = length - _lengths(both, toxic) > threshold
        if not far.any():
            break
        kept = [w for w, x in zip(toxic, far.tolist(), strict=True) if x]
    return base, found


def spread(text: str | None, most: int) -> list[bytes]:
    """At most so many windows of a whole text, evenly spread over it."""
    all_ = [w for ws in words(text) for w in windows(ws, FINE)]
    return all_ if len(all_) <= most else [all_[i * len(all_) // most] for i in range(most)]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled documents of each label, chosen by a hash of the id; held-out rows take no part."""
    usable = labels.select("doc_id", "toxic").filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    count = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    total = sum(count.values())
    share = count.get(1, 0) / total if total else 0.0
    p = min(max(share, 1e-6), 1 - 1e-6)
    alone = Model(b"", b"", bias=math.log(p / (1 - p)))
    if len(count) < 2:
        return alone
    ids = usable.distinct()
    by_hash = (F.xxhash64(F.lit("toxicity"), "doc_id"), "doc_id")
    picked = [ids.filter(F.col("toxic") == y).orderBy(*by_hash).limit(sample) for y in (0, 1)]
    picked = picked[0].union(picked[1]).select(F.col("doc_id").alias("l_doc"), "toxic")  # at most 2 * sample rows
    joined = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("l_doc"))
    rows = stage(joined.groupBy("l_doc", "toxic").agg(F.min("text").alias("text")).withColumn("hold", F.pmod(F.xxhash64(F.lit("hold"), "l_doc"), F.lit(3)) == 0), "toxic-sample")
    seen = {(r["toxic"], r["hold"]): r["n"] for r in rows.groupBy("toxic", "hold").agg(F.count("*").alias("n")).collect()}
    if any(not seen.get((y, False)) for y in (0, 1)):
        return alone
    each = {y: -(-WINDOWS // seen[y, False]) for y in (0, 1)}

    def cut(batches):
        for batch in slices(batches):
            found = [(y, w) for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for w in spread(text, each[y])]
            yield pa.RecordBatch.from_arrays([pa.array([y for y, _ in found], pa.int32()), pa.array([w for _, w in found], pa.binary())], names=["toxic", "window"])

    def learn(batches):
        both: dict[int, list[bytes]] = {0: [], 1: []}
        for batch in batches:
            for y, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                both[y].append(w)
        if both[0] and both[1]:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(both[1], both[0]))], pa.binary())], names=["model"])

    fitted = rows.filter(~F.col("hold")).select(F.col("toxic").cast("int"), "text").mapInArrow(cut, "toxic int, window binary")
    found = fitted.repartition(1).mapInArrow(learn, "model binary").collect()  # one row: two dictionaries
    if not found:
        return alone
    model = Model(*pickle.loads(found[0]["model"]))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def count_(batches):
        scorer = Scorer(shared.value)
        for batch in slices(batches):
            counts = scorer.counts(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c.tobytes() for c in counts], pa.binary())], names=["toxic", "counts"])

    held = [(0, True), (1, True)]
    hold = rows.filter("hold") if all(seen.get(k) for k in held) else rows  # too few rows: the same again
    rows_ = hold.repartition(max(1, docs.sparkSession.sparkContext.defaultParallelism)).select(F.col("toxic").cast("int"), "text").mapInArrow(count_, "toxic int, counts binary").collect()  # a few numbers a sampled row
    y = np.array([r["toxic"] for r in rows_], float)
    x = features(np.array([np.frombuffer(r["counts"], np.int64) for r in rows_]))
    w = np.where(y == 1, share / y.sum(), (1 - share) / (1 - y).sum()) * len(y)
    model.weights, model.bias = _logistic(x, y, w)
    return model


_scorers: dict[bytes, Scorer] = {}


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries: 68 kB
    shared_id = hashlib.sha256(pickle.dumps(model)).digest()

    def run(batches):
        scorer = _scorers.get(shared_id)
        if scorer is None:
            _scorers.clear()
            scorer = _scorers[shared_id] = Scorer(shared.value)
        for batch in slices(batches):
            scores = scorer.scores(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return slim.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labelled rows, score every row."""
    return score(docs, fit(docs, labels))
