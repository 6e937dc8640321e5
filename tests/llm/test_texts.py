"""Language, toxicity, personal data, fingerprints, licences."""

import hashlib
import random
import re
import time

import numpy as np
import pytest

from strandframe.llm import fingerprint, langid, licenses, pii, toxicity


def test_language_on_held_out_rows(small_docs):
    truth = {r["doc_id"]: r["lang"] for r in small_docs.collect()}
    rows = [r for r in langid.identify(small_docs).collect() if r["held_out"]]
    assert rows and np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in rows]) > 0.95


def test_language_of_odd_rows(odd, empty):
    rows = {r["doc_id"]: r for r in langid.identify(odd).collect()}
    assert all(rows[i]["lang_pred"] == "und" and rows[i]["score"] == 0 for i in (1, 2, 3))
    assert all(0 <= r["score"] <= 1 for r in rows.values()) and langid.identify(empty).count() == 0
    kept = langid.recognised(odd, 0.0)
    assert kept.columns == odd.columns and {1, 2, 3}.isdisjoint(r["doc_id"] for r in kept.collect())


def test_language_without_labels(odd):
    from pyspark.sql import functions as F

    assert {r["lang_pred"] for r in langid.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_ngram_counts_match_a_plain_count():
    a, b = langid.ngrams("AB ab"), langid.ngrams("ab...AB")
    assert np.array_equal(a[0], b[0]) and np.allclose(a[1], b[1])
    long_ = "the cat " * 300_000  # over one piece
    at, tf = langid.ngrams(long_)
    assert np.isclose(np.expm1(tf).sum(), sum(len(long_) - n + 1 for n in range(1, langid.LONGEST + 1)), rtol=1e-6)


def test_temperature_mends_overconfidence():
    rng = np.random.default_rng(0)
    z = rng.normal(size=(4000, 3))
    p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    truth = np.array([rng.choice(3, p=q) for q in p])
    assert 2.5 < langid.calibrate(3 * z, truth) < 3.6


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    rows = [r for r in toxicity.score_toxicity(docs, labels).collect() if r["held_out"] and r["doc_id"] in truth]
    toxic, clean = ([r["score"] for r in rows if truth[r["doc_id"]] == y] for y in (1, 0))
    assert np.mean([a > b for a in toxic for b in clean]) > 0.8


def test_toxicity_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(4, 1), (6, 0), (7, None), (None, 1)], "doc_id long, toxic int")
    rows = toxicity.score_toxicity(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert {r["predicted"] for r in toxicity.score_toxicity(odd, labels.limit(0)).collect()} == {0} and toxicity.score_toxicity(empty, labels).count() == 0


def plain_words(text):
    return re.sub("[\x00-\x2f\x3a-\x60\x7b-\x7f]", " ", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")).encode().split()


def test_toxicity_counts_match_plain_windows(monkeypatch):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    prose = [" ".join(rng.choice(vocabulary) for _ in range(200)) for _ in range(40)]
    muck = [" ".join(w if rng.random() < 0.9 else rng.choice(["vilest", "muckraker", "wretched"]) for w in t.split()) for t in prose]
    base, found = toxicity.train([w for t in muck for w in toxicity.spread(t, 100)], [w for t in prose for w in toxicity.spread(t, 100)])
    scorer = toxicity.Scorer(toxicity.Model(base, found))
    lead, tail = toxicity._LEAD + b" ", b" " + toxicity._TAIL

    def saved(window):
        both = (toxicity._compressor(d).compress(lead + window + tail) for d in (base, found + base))
        return len(next(both)) - len(next(both))

    monkeypatch.setattr(toxicity, "_CHUNK", 500)
    texts = [None, "", "?!", muck[0] + ". Über Größe", prose[1], muck[2] * 20]
    for text, got in zip(texts, scorer.counts(texts), strict=True):
        w, want = plain_words(text), np.zeros(toxicity.DISTANCES, int)
        for i in range(0, len(w), toxicity.COARSE):
            part = w[i : i + toxicity.COARSE]
            near = saved(b" ".join(part)) < 1
            for k in range(0, len(part), toxicity.FINE):
                want[0 if near else min(toxicity.DISTANCES - 1, max(0, saved(b" ".join(part[k : k + toxicity.FINE]))))] += 1
        assert got.tolist() == want.tolist()
    assert scorer.counts([muck[5]])[0, 2:].sum() > scorer.counts([prose[5]])[0, 2:].sum()


def test_windows_are_spread_over_a_whole_text():
    text = " ".join(f"w{i}" for i in range(30_000))
    some = toxicity.spread(text, 50)
    assert len(some) == 50 and some[0].startswith(b"w0 ") and int(some[-1].split()[0][1:]) > 29_000 and toxicity.spread("a b", 50) == [b"a b"]


def test_toxicity_takes_repeated_rows_once(spark):
    rows = [(i, "good plain words stand here now") for i in range(40)] + [(i, "vilest muck stands here now") for i in range(40, 80)]
    docs = spark.createDataFrame(rows + rows[:1] * 3000, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 40)) for i in range(80)] * 2, "doc_id long, toxic int")
    one, two = toxicity.fit(docs, labels), toxicity.fit(spark.createDataFrame(rows, docs.schema), labels.distinct())
    assert (one.ordinary, one.toxic) == (two.ordinary, two.toxic)


def plain_spans(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in re.sub("[^0-9]", "", m.group())][::-1]
        if 14 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


def test_base_spans_match_the_patterns():
    rng = random.Random(2)
    for letters in ("ab@.-+_1 é", "12. ", "0123456789- ", "+1() -23456"):
        for _ in range(6000):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 45)))
            assert pii.base_spans(text) == plain_spans(text), text


def test_skip_chain_adds_repeats():
    texts = [f"call +1 ({i:03}) 555-{i + 2000} or mail u{i}@mail.example.com at 10.0.0.{i % 250} ok" for i in range(300)] + ["page 12 of 300 in 1999, see 4.2"] * 100
    m = pii.fit_texts(texts)
    text = "call +1 (456) 555-2186 now. Later 14565552186 rang."
    base, spans = m.spans(text)
    assert base == plain_spans(text) and set(base) <= set(spans) and (34, 3, 45) in spans
    apart = "call +1 (456) 555-2186 now. Later (456) 555-2186 rang, and page 12 300."
    base_, spans_ = m.spans(apart)
    assert set(base_) <= set(spans_) and [apart[a:b] for a, k, b in spans_ if k == 3] == ["+1 (456) 555-2186", "456) 555-2186"]
    assert m.spans("page 12 of 300 in 1999, see 4.2")[1] == []
    assert pii.masked(text, spans) == "call <PHONE> now. Later <PHONE> rang."


def test_pii_of_odd_rows(odd, empty):
    rows = {r["doc_id"]: r for r in pii.find_pii(odd).collect()}
    nine = rows[9]
    assert (nine["n_email"], nine["n_ip"], nine["n_card"], nine["n_phone"]) == (1, 1, 1, 1)
    text = next(r["text"] for r in odd.collect() if r["doc_id"] == 9)
    assert nine["base_sha256"] == hashlib.sha256(pii.rendered(plain_spans(text)).encode()).hexdigest()
    assert rows[1]["base_sha256"] == hashlib.sha256(b"").hexdigest() and rows[1]["spans"] == "" and pii.find_pii(empty).count() == 0
    hidden = pii.redacted(odd)
    assert hidden.columns == odd.columns
    for r in hidden.collect():
        assert r["text"] is None or (r["n_chars"] == len(r["text"]) and plain_spans(r["text"]) == [])


def test_fingerprint_is_a_multiset_hash():
    a, b = "first paragraph here now\nsecond one is longer than that", "second one is longer than that\nfirst paragraph here now"
    assert fingerprint.of_text(a).hex() == fingerprint.of_text(b).hex() != fingerprint.of_text(a + "\nmore").hex()
    assert fingerprint.of_text(a).insert("more of it").delete("more of it").hex() == fingerprint.of_text(a).hex()
    assert fingerprint.of_text("x y\nx y").hex() != fingerprint.of_text("x y").hex() and fingerprint.of_text(None).hex() == fingerprint.of_text(" \n ").hex()
    assert fingerprint.Fingerprint.from_hex(fingerprint.of_text(a).hex()).likeness(fingerprint.of_text(b)) == 1.0


def test_fingerprint_sums_its_paragraphs():
    rng = random.Random(1)
    for _ in range(500):
        text = "".join(rng.choice("ab  \n\n\tc\r") for _ in range(rng.randint(0, 60)))
        total = fingerprint.Fingerprint()
        for p in re.split(r"[\n\r\x0b\x0c]+", text):
            total = total + fingerprint.of_text(p)
        assert total.hex() == fingerprint.of_text(text).hex()


def plain_likeness(a, b):
    """The cosine of the lanes of two texts of one paragraph a line, counted run by run without a bound."""
    from strandframe.llm.words import shingles, words_at

    lanes = []
    for text in (a, b):
        own = [0] * fingerprint.WIDE
        for line in filter(str.strip, text.split("\n")):
            hashes, _ = words_at(line.encode())
            for h in shingles(hashes, min(fingerprint.RUN, len(hashes))).tolist():
                own[(h >> 32) % fingerprint.WIDE] += 1 if h & 1 else -1
        lanes.append(own)
    dot = [sum(x * y for x, y in zip(p, q, strict=True)) for p, q in ((lanes[0], lanes[1]), (lanes[0], lanes[0]), (lanes[1], lanes[1]))]
    return max(0.0, dot[0] / (dot[1] * dot[2]) ** 0.5)


@pytest.mark.parametrize("a,b", [(40_000, 40_001), (65_536, 65_537), (131_072, 70_000), (3, 4)])
def test_likeness_of_long_repetition(a, b):
    x, y = "foo bar baz\n" * a + "one more line of words", "foo bar baz\n" * b
    got = fingerprint.of_text(x).likeness(fingerprint.of_text(y))
    assert abs(got - plain_likeness(x, y)) < 1e-9 and (got > 0.99 or a < 9)


def test_edits_of_all_rows(odd, empty, small_docs):
    assert fingerprint.compare_with_edits(empty).count() == 0
    for docs in (odd, small_docs):
        ordered = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "") for r in docs.collect()))
        want = sorted((hashlib.sha256(fingerprint.edited(t, ordered[(i + 1) % len(ordered)][2]).encode()).hexdigest(), len(t)) for i, (_, _, t) in enumerate(ordered))
        rows = fingerprint.compare_with_edits(docs).collect()
        assert sorted((r["edited_sha256"], r["n_chars"]) for r in rows) == want
        assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    long_ = [r for r in rows if r["n_chars"] > 500]
    assert np.mean([r["near_edited"] > r["near_next"] for r in long_]) > 0.95


def plain_licences(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_licences_match_a_plain_scan(small_docs):
    texts = ["Under the MIT-License", "under the mit license under the mit license", "cc by nc cc by nc-nd", "éunder the mit license", "CC-BY-NC", "", None, "İunder the mit license", "x under  the\nmit\tlicense"]
    for text in texts + [r["text"] for r in small_docs.collect()]:
        assert licenses.scan(text)[:5] == plain_licences(text), text


@pytest.mark.parametrize("text,labels", [("undr the mit licence", "mit"), ("licensed under the Apche License, version 2.0", "apache-2"), ("under the bsd license", ""), ("Licensed under CC BY-ND", ""), ("GNU Lesser General Public License", "lgpl"), ("a permit under the license", "")])
def test_licences_with_errors(text, labels):
    assert licenses.scan(text)[5] == labels


@pytest.mark.parametrize("text,label,places", [
    ("x apache licnse versin 2 y apache license version 2 z", "apache-2", [1, 6]), ("apache license version 2 y apache licnse versin 2", "apache-2", [0, 5]),
    ("a gnu genral public licence b gnu general public license c gnu generl public license", "gpl", [1, 6, 11]), ("gnu generl public license " * 7, "gpl", [4 * i for i in range(7)]),
])
def test_every_place_is_found(text, label, places):
    assert [m.first_word for m in licenses.scan(text)[7] if m.label == label] == places


def test_places_against_edit_distances():
    notice = next(n for n in licenses.NOTICES if n.label == "gpl")

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    rng = random.Random(6)
    for _ in range(40):
        words, planted = [], []
        for _ in range(rng.randint(1, 6)):
            words += [rng.choice(["zebra", "quartz", "violin"]) for _ in range(rng.randint(1, 3))]
            copy = list(notice.phrase)
            for _ in range(rng.randint(0, notice.errors)):
                at = rng.choice([i for i, c in enumerate(copy) if c.isalpha() and i > len(notice.core)])
                copy[at] = rng.choice("jkw")
            planted.append((len(words), distance("".join(copy), notice.phrase)))
            words += "".join(copy).split()
        found = [(m.first_word, m.edits) for m in licenses.scan(" ".join(words))[7] if m.label == "gpl"]
        assert found == [p for p in planted if p[1] <= notice.errors]


def test_wide_characters_are_single_edits():
    assert licenses.scan("apache l\uff49cense v\uff45rs\uff49on 2")[5] == "apache-2" and licenses.scan("x" * 40 + " \U0001f600under the m\U0001f600it license")[5] in ("", "mit")


def test_work_grows_with_the_text():
    took = []
    for n in (4000, 32_000):
        text = "licensed under cc by nc gnu general public license " * n
        began = time.process_time()
        row = licenses.scan(text)
        took.append(time.process_time() - began)
        assert row[:4] == (9 * n, n, 2, 9 * (n - 1) + 2) and row[5] == "cc-by-nc,gpl" and sum(m.label == "gpl" for m in row[7]) == n
        assert [m.first_word for m in row[7] if m.label == "gpl"][:3] == [5, 14, 23]
    assert took[1] < 24 * took[0]


def test_licences_of_odd_rows(odd, empty):
    rows = {r["doc_id"]: r for r in licenses.scan_documents(odd).collect()}
    assert (rows[1]["n_words"], rows[1]["first_word"], rows[1]["labels"], rows[1]["score"]) == (0, None, "", 0.0) and licenses.scan_documents(empty).count() == 0
