"""Personal data by base patterns and a skip-chain conditional random field.

Base spans (code points, end exclusive), leftmost and not overlapping within a kind:

* email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
* ip ``[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)`` with parts up to 255
* card ``[0-9]([\\x20-]?[0-9])+`` with 14 to 19 digits that pass Luhn's test
* phone ``\\+[0-9][\\x20().0-9-]+[0-9]`` with 10 to 15 digits

The field works on the tokens (runs without white space) that have a digit or an at sign; any other token is surely no
entity and cuts the chain. Its variables are the tokens' labels (none or a kind). Potentials: of each token, from its
shape and its neighbours' words; of neighbouring tokens in a chain; and skip edges between tokens of a document that
are equal or similar (the same digits, or the same letters and digits), wherever they stand. Loopy belief propagation
passes messages over all of them for ``ROUNDS`` rounds at most, so that evidence at one place decides the label at the
other. Skip edges of a group of k equal tokens form a star with a common variable, so there are k of them.

Learning: the base patterns label the tokens of a bounded sample of documents (``SAMPLE``, first by a hash; ``TOKENS`` of
each, evenly spread; none of the labels table is used). All potentials are fitted together by pseudo-likelihood: each
token's label given its features, its neighbours' labels in the chain and the commonest label of the others of its
groups. Features of a token leave out its own marks for a third of the tokens, its surroundings for another (so that
shape and surroundings count without each other). The fit runs in one task, which gets numbers, not texts.

Added spans: tokens with a kind's belief of ``LEAST`` or more that no base span touches, and whose shape is that kind's
(its digits in number, or an at sign with text on both sides); neighbouring tokens that have the digits of a base span
together (a number written with spaces) count as one. Base spans always stay.

Defined results: null is the empty text, without spans; rows stand for themselves; other columns play no part. Texts
are handled whole; no shuffle.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strandframe.llm.common import slices
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")  # a run of digits is tried once: elsewhere in it nothing else is found
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_SOME = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"(?<!\S)\S*?[0-9@]\S*")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_NUMERIC = re.compile(r"[0-9().+,;:-]+")
_NOT_ALNUM = re.compile(r"[\W_]+")

SAMPLE, TOKENS, LEAST, ROUNDS = 2000, 500, 0.9, 10
FEATURES = 1 << 12
#: Weight, in logs, of a base span for its tokens' labels.
EVIDENCE = 12.0
#: Weight, in logs, of equal labels at both ends of a skip edge, before pairs have been seen.
PRIOR = 6.0


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """The email pattern's matches, found from the at signs: the pattern itself looks at each run of letters anew."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        lo = at
        while lo > free and text[lo - 1] in _LOCAL_SET:
            lo -= 1
        if lo < at and (m := _DOMAIN.match(text, at)):
            out.append((lo, m.end()))
            free = m.end()
            at = text.find("@", free)
        else:
            free = max(free, at + 1)
            at = text.find("@", at + 1)
    return out


_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all base spans, sorted."""
    if not _SOME.search(text):
        return []
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    out.sort()
    return out


def rendered(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


@dataclass
class Tokens:
    spans: list[tuple[int, int]]
    texts: list[str]
    adjacent: np.ndarray  # whether a token directly follows the one before
    before: list[str]
    after: list[str]


def tokens(text: str) -> Tokens:
    spans, before, after = [], [], []
    adjacent = []
    for m in _TOKEN.finditer(text):
        a, b = m.span()
        gap = text[spans[-1][1] : a] if spans and a - spans[-1][1] < 8 else None
        adjacent.append(gap is not None and not gap.strip())
        left = text[max(0, a - 40) : a].split()
        right = text[b : b + 40].split()
        before.append(left[-1].lower() if left else "")
        after.append(right[0].lower() if right else "")
        spans.append((a, b))
    return Tokens(spans, [text[a:b] for a, b in spans], np.array(adjacent, bool), before, after)


def shape(token: str) -> str:
    """The token with runs of digits as 9, of letters as a; digits beyond it count by number."""
    return re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", "9", token))[:24]


def _bucket(*what: object) -> int:
    return int.from_bytes(hashlib.blake2b(repr(what).encode("utf-8", "surrogatepass"), digest_size=4).digest(), "little") % FEATURES


def features(t: Tokens, i: int, drop: int = -1) -> list[int]:
    """Hashed features; drop: leaves the token's own marks (0) or its surroundings (1) out."""
    own, digits = t.texts[i], len(_NOT_DIGIT.sub("", t.texts[i]))
    core = own.strip(".,;:!?\"'()[]<>")
    out = [_bucket("bias")]
    if drop != 0:
        out += [_bucket("shape", shape(core)), _bucket("digits", min(digits, 20)), _bucket("letters", bool(re.search(r"[^\W\d_]", core)), "@" in core, core.count("."), core.startswith("+")), _bucket("luhn", digits >= 14 and luhn(_NOT_DIGIT.sub("", core)))]
    if drop != 1:
        out += [_bucket("before", t.before[i] if not _SOME.search(t.before[i]) else shape(t.before[i])), _bucket("after", t.after[i] if not _SOME.search(t.after[i]) else shape(t.after[i]))]
    return out


def written_apart(t: Tokens, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, str]]:
    """(first token, last token, digits) of neighbouring tokens without letters, of which no base span has any, that have
    together the last ten digits of a base span of ten digits or more."""
    known = {d[-10:] for a, _, b in base if len(d := _NOT_DIGIT.sub("", text[a:b])) >= 10}
    out: list[tuple[int, int, str]] = []
    if not known:
        return out
    free = _touched(t, base) == 0
    for i in range(len(t.texts)):
        if out and i <= out[-1][1]:
            continue
        digits = ""
        for j in range(i, len(t.texts)):
            if not free[j] or j > i and not t.adjacent[j] or not _NUMERIC.fullmatch(t.texts[j]) or len(digits) > 19:
                break
            digits += _NOT_DIGIT.sub("", t.texts[j])
            if j > i and digits[-10:] in known and len(digits) <= 19:
                out.append((i, j, digits))
                break
    return out


def same_groups(t: Tokens, text: str = "", base: list[tuple[int, int, int]] | None = None) -> list[list[int]]:
    """Groups of tokens that are equal or similar: the same letters and digits, or the same last ten of seven digits or
    more, where the tokens of one base span, and those written apart, have their digits together."""
    by: dict[tuple[str, str], list[int]] = {}
    whole: dict[int, str] = {}
    starts, ends = _bounds(t)
    for a, _, b in base or []:
        digits = _NOT_DIGIT.sub("", text[a:b])
        if len(digits) >= 7:
            whole |= dict.fromkeys(range(int(np.searchsorted(ends, a, "right")), int(np.searchsorted(starts, b, "left"))), digits)
    for i, j, digits in written_apart(t, text, base or []):
        whole |= dict.fromkeys(range(i, j + 1), digits)
    for i, own in enumerate(t.texts):
        by.setdefault(("text", _NOT_ALNUM.sub("", own).lower()), []).append(i)
        digits = whole.get(i, _NOT_DIGIT.sub("", own))
        if len(digits) >= 7:
            by.setdefault(("digits", digits[-10:]), []).append(i)
    return list({tuple(g): g for k, g in by.items() if len(g) > 1 and len(k[1]) >= 4}.values())


@dataclass
class Model:
    unary: np.ndarray  # feature x label
    chain: np.ndarray  # label x label
    skip: np.ndarray

    def beliefs(self, t: Tokens, text: str, base: list[tuple[int, int, int]]) -> np.ndarray:
        """The probability of each label (none first) of each token, by loopy belief propagation; the base spans are
        evidence."""
        n, k = len(t.texts), len(KINDS) + 1
        own = np.array([self.unary[features(t, i)].sum(0) for i in range(n)])
        known = _touched(t, base)
        own[known > 0, known[known > 0]] += EVIDENCE
        groups = same_groups(t, text, base)
        follow = np.flatnonzero(t.adjacent)
        if not len(follow) and not groups:
            return _softmax(own)
        # Nodes: tokens, then a common variable for each group. Edges: chain and skip.
        a = np.concatenate((follow - 1, *(np.array(g) for g in groups))).astype(np.int64)
        b = np.concatenate((follow, *(np.full(len(g), n + j) for j, g in enumerate(groups)))).astype(np.int64)
        pots = np.concatenate((np.repeat(self.chain[None], len(follow), 0), np.repeat(self.skip[None], len(a) - len(follow), 0)))
        base = np.concatenate((own, np.zeros((len(groups), k))))
        forth, back = np.zeros((len(a), k)), np.zeros((len(a), k))  # messages a -> b and b -> a, in logs
        for _ in range(ROUNDS):
            total = base.copy()
            np.add.at(total, b, forth)
            np.add.at(total, a, back)
            new_forth = _logsumexp((total[a] - back)[:, :, None] + pots, 1)
            new_back = _logsumexp((total[b] - forth)[:, None, :] + pots, 2)
            new_forth -= new_forth.max(1, keepdims=True)
            new_back -= new_back.max(1, keepdims=True)
            moved = max(np.abs(new_forth - forth).max(), np.abs(new_back - back).max())
            forth, back = 0.5 * (forth + new_forth), 0.5 * (back + new_back)  # damped
            if moved < 1e-3:
                break
        total = base
        np.add.at(total, b, forth)
        np.add.at(total, a, back)
        return _softmax(total[:n])

    def spans(self, text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """Base spans, and all spans."""
        base = base_spans(text)
        if not _SOME.search(text):
            return base, base
        t = tokens(text)
        covered = _touched(t, base) > 0
        if covered.all():
            return base, base
        belief = self.beliefs(t, text, base)
        added = []
        for i, j, _ in written_apart(t, text, base):
            kinds = belief[i : j + 1, 1:].argmax(1)
            a, b = _core(t.texts[i], t.spans[i][0])[0], _core(t.texts[j], t.spans[j][0])[1]
            if (kinds == kinds[0]).all() and belief[i : j + 1, 1:].max(1).min() >= LEAST and _fits(int(kinds[0]), text[a:b]):
                added.append((a, int(kinds[0]), b))
                covered[i : j + 1] = True
        for i in np.flatnonzero(~covered & (belief[:, 1:].max(1) >= LEAST)):
            kind = int(belief[i, 1:].argmax())
            a, b = _core(t.texts[i], t.spans[i][0])
            if _fits(kind, text[a:b]):
                added.append((a, kind, b))
        return base, sorted(base + added)


def _core(token: str, at: int) -> tuple[int, int]:
    left = token.lstrip(".,;:!?\"'([<")
    a = at + len(token) - len(left)
    return a, a + len(left.rstrip(".,;:!?\"')]>"))


def _fits(kind: int, token: str) -> bool:
    digits = len(_NOT_DIGIT.sub("", token))
    letters = bool(re.search(r"[^\W\d_]", token))
    if kind == 0:
        return bool(re.fullmatch(r"[^\s@]+@[^\s@]+", token))
    if kind == 1:
        parts = re.findall(r"[0-9]+", token)
        return not letters and len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return not letters and 13 <= digits <= 19
    return not letters and 10 <= digits <= 15


def _bounds(t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    return np.array([a for a, _ in t.spans], np.int64), np.array([b for _, b in t.spans], np.int64)


def _touched(t: Tokens, base: list[tuple[int, int, int]]) -> np.ndarray:
    """The label of each token by the base spans: 0 for none, else 1 + kind."""
    labels = np.zeros(len(t.spans), np.int64)
    starts, ends = _bounds(t)
    for a, kind, b in base:
        lo, hi = np.searchsorted(ends, a, "right"), np.searchsorted(starts, b, "left")
        labels[lo:hi] = kind + 1
    return labels


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


#: A token to learn from: its features, label, the labels before and after it in its chain (-1: none), and the commonest
#: label of the others of each of its groups.
Example = tuple[list[int], int, int, int, list[int]]


def examples(text: str | None, most: int = TOKENS) -> list[Example]:
    """The tokens of a whole text, or so many of them, evenly spread, labelled by the base spans."""
    if not text or not _SOME.search(text):
        return []
    t = tokens(text)
    base = base_spans(text)
    labels = _touched(t, base).tolist()
    of_group: dict[int, list[int]] = {}
    for g in same_groups(t, text, base):
        seen = Counter(labels[i] for i in g)
        for i in g:
            others = seen - Counter([labels[i]])
            of_group.setdefault(i, []).append(min(others, key=lambda y: (-others[y], y)))
    n = len(labels)
    out = []
    for i in range(n) if n <= most else [k * n // most for k in range(most)]:
        before = labels[i - 1] if t.adjacent[i] else -1
        after = labels[i + 1] if i + 1 < n and t.adjacent[i + 1] else -1
        out.append((features(t, i, _bucket("drop", i, t.texts[i]) % 3 - 1), labels[i], before, after, of_group.get(i, [])))
    return out


def fit_examples(rows: list[Example], epochs: int = 8, rate: float = 0.3, seed: int = 3) -> Model:
    """All potentials, by pseudo-likelihood with steps of AdaGrad. To begin with, equal tokens favour equal labels."""
    k = len(KINDS) + 1
    rng = np.random.default_rng(seed)
    unary, chain, skip = np.zeros((FEATURES, k)), np.zeros((k, k)), PRIOR * np.eye(k)
    unary[_bucket("bias"), 0] = 1.0
    squares = [np.full_like(x, 1e-2) for x in (unary, chain, skip)]

    def step(which: int, table: np.ndarray, at, g: np.ndarray) -> None:
        np.add.at(squares[which], at, g * g)
        np.add.at(table, at, -rate * g / np.sqrt(squares[which][at]))

    for _ in range(epochs):
        for r in rng.permutation(len(rows)):
            at, label, before, after, groups = rows[r]
            z = unary[at].sum(0)
            if before >= 0:
                z = z + chain[before]
            if after >= 0:
                z = z + chain[:, after]
            for other in groups:
                z = z + skip[:, other]
            p = _softmax(z[None])[0]
            p[label] -= 1
            step(0, unary, at, p + 1e-4 * unary[at])
            if before >= 0:
                step(1, chain, before, p + 1e-3 * chain[before])
            if after >= 0:
                step(1, chain, (slice(None), after), p + 1e-3 * chain[:, after])
            for other in groups:
                step(2, skip, (slice(None), other), p + 1e-3 * (skip[:, other] - PRIOR * np.eye(k)[other]))
    return Model(unary, chain, (skip + skip.T) / 2)


def fit_texts(texts: list[str | None]) -> Model:
    """Learn from the base spans of whole texts."""
    return fit_examples([x for text in texts for x in examples(text)])


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from ``sample`` documents with digits or at signs, the first by a hash, equal rows once.

    Only hashes are ranked (each task sends at most sample of them); then texts up to the last hash taken are fetched.
    """
    some = docs.select("text", F.xxhash64(F.lit("pii"), "doc_id", "text").alias("h")).filter(F.col("text").rlike("[0-9@]"))
    last = some.select("h").orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    if last is None:
        return fit_texts([])

    def cut(batches):
        for batch in slices(batches):
            found = [pickle.dumps(examples(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["h", "examples"])

    def learn(batches):
        rows = sorted(row for batch in batches for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        model = fit_examples([x for _, part in rows for x in pickle.loads(part)])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    picked = some.filter(F.col("h") <= last).groupBy("h").agg(F.min("text").alias("text"))
    found = picked.mapInArrow(cut, "h long, examples binary").repartition(1).mapInArrow(learn, "model binary").collect()  # one row
    return pickle.loads(found[0]["model"])


_ROW = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find(docs: DataFrame, model: Model) -> DataFrame:
    """Counts and digest of the base spans and all spans of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 160 kB

    def run(batches):
        for batch in slices(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                base, spans = shared.value.spans(text or "")
                counts = [sum(k == kind for _, k, _ in base) for kind in range(4)]
                rows.append((*counts, hashlib.sha256(rendered(base).encode()).hexdigest(), rendered(spans)))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            types = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=[x.split()[0] for x in _ROW.split(", ")])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(run, _ROW)


def find_pii(docs: DataFrame) -> DataFrame:
    """Learn from docs, find in every row."""
    return find(docs, fit(docs))


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind in angle brackets; of overlapping spans, the first and longest."""
    out, at = [], 0
    for a, kind, b in sorted(spans, key=lambda s: (s[0], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{KINDS[kind].upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with personal data masked in their texts; n_chars, if there, follows the text."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs))
    columns = docs.columns
    place = columns.index("text")
    length = columns.index("n_chars") if "n_chars" in columns else None

    def run(batches):
        for batch in slices(batches):
            texts = [t if t is None else masked(t, shared.value.spans(t)[1]) for t in batch.column(place).to_pylist()]
            arrays = list(batch.columns)
            arrays[place] = pa.array(texts, pa.string())
            if length is not None:
                old = batch.column(length).to_pylist()
                arrays[length] = pa.array([n if t is None else len(t) for t, n in zip(texts, old, strict=True)], batch.schema.field(length).type)
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return docs.mapInArrow(run, docs.schema)
