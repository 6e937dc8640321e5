"""Language identification: multinomial logistic regression on TF-IDF character n-grams, trained by FTRL-proximal
with elastic-net penalties, calibrated by a temperature.

Features: runs of 1 to ``LONGEST`` code points of the lower-cased text, each stretch of other characters than letters
being one space, hashed to ``BUCKETS``; log(1 + count) times the inverse document frequency, scaled to length 1.

Learning uses text and language of rows that are not held out (crc32 of the id modulo 5 is not 0) and whose language
is given. Document frequencies are counted over all of them, in one pass: each partition adds up its own and sends one
row of fixed size, and these are added in a tree. The weights are fitted on a sample of ``SAMPLE`` of these rows (one
of each language, if there are more languages), the first of each language by a hash, evenly: in one task, which gets
their features, not their texts, and sends the model, not the features, to the driver. A fifth of the sample is kept
for the temperature, found by golden-section search on the mean log loss. The penalty on absolute values makes the
weights sparse.

Prediction covers whole texts, in one pass without a shuffle; the model is broadcast (64 kB for each language).

Defined results: null texts and texts without a letter are ``und`` with score 0; so is every text if there is nothing
to learn from. Ties go to the first language in code-point order. Every language with a text that has a letter is
learned. Repeated rows count as often as they stand; other columns play no part.
"""

from __future__ import annotations

import math
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandframe.llm.common import held_out, slices, stage

LONGEST, BUCKETS = 4, 1 << 14
SAMPLE = 2000
_LETTER = regex.compile(r"\p{L}")
_NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
_CHUNK = 1 << 20
_M = np.uint64(0x9E3779B97F4A7C15)


def _counts(codes: np.ndarray) -> np.ndarray:
    """How often each bucket occurs among the n-grams of the code points."""
    total = np.zeros(BUCKETS, np.int64)
    for at in range(0, max(1, len(codes)), _CHUNK):  # pieces overlap by what an n-gram reaches beyond its start
        piece = codes[at : at + _CHUNK + LONGEST - 1].astype(np.uint64)
        begins = min(_CHUNK, len(codes) - at)
        h = np.zeros(len(piece), np.uint64)
        for n in range(1, LONGEST + 1):
            if len(piece) < n:
                break
            h = (h[: len(piece) - n + 1] + piece[n - 1 :] + np.uint64(n)) * _M
            h ^= h >> np.uint64(29)
            total += np.bincount(((h[:begins] * _M) >> np.uint64(50)).astype(np.int64), minlength=BUCKETS)
    return total


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a whole text's n-grams, rising, and log(1 + count) of each; none without a letter."""
    if not text or not _LETTER.search(text):
        return np.empty(0, np.int64), np.empty(0)
    clean = _NOT_LETTERS.sub(" ", text.lower())
    counts = _counts(np.frombuffer(clean.encode("utf-32-le", "surrogatepass"), np.uint32))
    at = np.flatnonzero(counts)
    return at, np.log1p(counts[at])


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # bucket x language
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, at: np.ndarray, tf: np.ndarray) -> np.ndarray:
        x = tf * self.idf[at]
        return (x / (np.sqrt(x @ x) or 1.0)) @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        at, tf = ngrams(text)
        if not len(at) or not self.languages:
            return "und", 0.0
        z = self.logits(at, tf) / self.temperature
        p = np.exp(z - z.max())
        best = int(p.argmax())
        return self.languages[best], float(p[best] / p.sum())


class FTRL:
    """Follow the regularised leader, proximal form, for multinomial logistic regression: per-coordinate rates, l1 and
    l2 penalties."""

    def __init__(self, buckets: int, classes: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.05, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((buckets + 1, classes)), np.zeros((buckets + 1, classes))

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) > self.l1, w, 0.0)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int, weight: float = 1.0) -> None:
        at, x = np.append(at, len(self.z) - 1), np.append(x, 1.0)
        w = self.weights(at)
        s = x @ w
        p = np.exp(s - s.max())
        p /= p.sum()
        p[label] -= 1
        g = weight * x[:, None] * p
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def fit_features(rows: list[tuple[str, np.ndarray, np.ndarray]], idf: np.ndarray, epochs: int = 3, seed: int = 5) -> Model:
    """rows: (language, buckets, log counts)."""
    languages = sorted({r[0] for r in rows})
    index = {x: i for i, x in enumerate(languages)}
    order = np.random.default_rng(seed).permutation(len(rows))
    cut = len(rows) - len(rows) // 5
    fit, hold = order[:cut], order[cut:]
    learner = FTRL(BUCKETS, len(languages))
    for _ in range(epochs):
        for i in fit:
            language, at, tf = rows[i]
            x = tf * idf[at]
            learner.learn(at, x / (np.sqrt(x @ x) or 1.0), index[language])
    w = learner.weights(slice(None))
    model = Model(languages, idf.astype(np.float32), w[:-1].astype(np.float32), w[-1])
    if len(hold):
        logits = np.array([model.logits(rows[i][1], rows[i][2]) for i in hold])
        truth = np.array([index[rows[i][0]] for i in hold])
        model.temperature = calibrate(logits, truth)
    return model


def calibrate(logits: np.ndarray, truth: np.ndarray) -> float:
    """The temperature of least mean log loss, between 0.5 (held rows without an error would make it vanish) and 20."""

    def loss(log_t: float) -> float:
        z = logits / math.exp(log_t)
        z = z - z.max(1, keepdims=True)
        return float((np.log(np.exp(z).sum(1)) - z[np.arange(len(z)), truth]).mean())

    lo, hi, g = math.log(0.5), math.log(20.0), (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return math.exp((lo + hi) / 2)


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """The number of rows and, for each bucket, the rows that have it."""

    def run(batches):
        total, n = np.zeros(BUCKETS, np.int64), 0
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                total[ngrams(text)[0]] += 1
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([np.append(total, n).tobytes()], pa.binary())], names=["df"])

    def add(a: bytes, b: bytes) -> bytes:
        return (np.frombuffer(a, np.int64) + np.frombuffer(b, np.int64)).tobytes()

    parts = docs.select("text").mapInArrow(run, "df binary").rdd.map(lambda r: bytes(r[0]))
    total = np.frombuffer(parts.treeReduce(add, depth=3), np.int64) if parts.getNumPartitions() else np.zeros(BUCKETS + 1, np.int64)
    return int(total[-1]), total[:-1]


def _nothing() -> Model:
    return Model([], np.zeros(BUCKETS), np.zeros((BUCKETS, 0)), np.zeros(0))


def sampled(usable: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(lang, unit, text) of the first rows of each language by a hash, evenly, that have a letter."""
    usable = usable.filter(F.col("text").rlike(r"\p{L}"))
    counts = stage(usable.groupBy(F.col("lang").alias("c_lang")).agg(F.count("*").alias("n")), "langid-counts")
    each = max(1, sample // max(1, counts.count()))
    # A threshold on the hash leaves about twice as many rows of a language as wanted, before they are ranked.
    unit = F.pmod(F.xxhash64(F.lit("langid"), "doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    near = usable.withColumn("unit", unit).join(counts, F.col("lang") == F.col("c_lang")).filter(F.col("unit") * F.col("n") < 2 * each + 20)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("unit", "doc_id"))
    return near.select("lang", "unit", "doc_id", "text").withColumn("rank", rank).filter(F.col("rank") <= each).select("lang", "unit", "text")


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from the rows of docs (text, lang) that aren't held out and have a language."""
    usable = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).filter(F.col("lang").isNotNull() & ~held_out())
    n, df = document_frequencies(usable)
    if not n:
        return _nothing()
    idf = np.log((1 + n) / (1 + df)) + 1

    def cut(batches):
        for batch in slices(batches):
            both = [ngrams(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array([x.astype(kind).tobytes() for x in part], pa.binary()) for part, kind in zip(zip(*both, strict=True), (np.uint16, np.float32), strict=True))], names=["lang", "unit", "at", "tf"])

    def learn(batches):
        rows = sorted((row for batch in slices(batches) for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)), key=lambda r: r[:3])
        if rows:
            model = fit_features([(lang, np.frombuffer(at, np.uint16).astype(np.int64), np.frombuffer(tf, np.float32)) for lang, _, at, tf in rows], idf)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    features = sampled(usable, sample).mapInArrow(cut, "lang string, unit double, at binary, tf binary")
    found = features.repartition(1).mapInArrow(learn, "model binary").collect()  # one row: the model
    return pickle.loads(found[0]["model"]) if found else _nothing()


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in slices(batches):
            found = [shared.value.predict(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return slim.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Learn from docs, predict every row."""
    return predict(docs, fit(docs))


def recognised(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents whose language is recognised (letters, and a score of ``least`` at least), as they are.

    The texts pass the tasks once, with their rows, so nothing is joined; the decision is made where the row is.
    """
    model = fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def run(batches):
        for batch in slices(batches):
            found = [shared.value.predict(t) for t in batch.column(place).to_pylist()]
            yield batch.filter(pa.array([x != "und" and s >= least for x, s in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
