import pytest

#: Rows that every operator must take: null, empty, blank, very long and repeated texts, null ids.
ODD = [
    (1, None, "en", "a"), (2, "", "en", None), (3, "   \n\t ", None, "a"), (4, "The quick brown fox jumps over the lazy dog. " * 3, "en", "b"), (5, "x" * 3000, None, "b"),
    (6, "der Hund und die Katze schlafen unter dem Baum " * 400, "de", "c"), (7, "The quick brown fox jumps over the lazy dog. " * 3, "en", "b"), (7, "The quick brown fox jumps over the lazy dog. " * 3, "en", "b"),
    (None, "nobody knows my id", "en", "c"), (8, "é世界 ñandú 😀 don't 's I'll\x1c\x85 １２", "es", "c"), (9, "mail a.b@mail.example.com or +1 (456) 555-2186, card 4337166598464399, ip 10.2.3.4", "en", "a"),
]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(*r, len(r[1] or ""), "clash", 0.5) for r in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, ids string, score double").repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
