import collections
import zlib

import numpy as np

from newsmart.llm import language as L
from newsmart.llm.queries import op8_language_id


def slow_ngrams(text):
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    out = collections.Counter()
    for word in letters.split():
        out.update(word)
        padded = f" {word} "
        out.update(padded[i : i + 2] for i in range(len(padded) - 1))
        out.update(padded[i : i + 3] for i in range(len(padded) - 2))
    return out


def packed(gram):
    out = 0
    for c in gram:
        out = out << 21 | ord(c)
    return out


def test_ngrams_match_definition():
    for text in ("Hello, world", "é ü", "a", "a b", "12 ab-cd", "ǅ日本 x", "..", "aa  aa"):
        grams, counts = L.ngrams(text)
        assert dict(zip(grams.tolist(), counts.tolist(), strict=True)) == {packed(g): n for g, n in slow_ngrams(text).items()}


def test_out_of_place_distance():
    ranks = L.Ranks({"x": np.array([1, 2, 3]), "y": np.array([3, 2, 1])}, 3)
    assert ranks.sorted[1].tolist() == [1, 2, 3] and ranks.rank[1].tolist() == [2, 1, 0]


def test_query_learns_from_the_other_rows_and_is_accurate(spark):
    rows = op8_language_id(spark, "/root/testdata/sf0.01").collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(lang)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.98 * len(held)


def test_profiles_match_counting(spark, documents):
    texts = [(1, "abc abd", "en", "s"), (2, "abc", "en", "s"), (3, "xyz", "fr", "s"), (4, "q", None, "s"), (5, None, "fr", "s")]
    got = L.profiles(documents(texts), size=5)
    for lang in ("en", "fr"):
        total = collections.Counter()
        for _, t, k, _ in texts:
            if k == lang and t:
                total += slow_ngrams(t)
        want = sorted(total, key=lambda g: (-total[g], packed(g)))[:5]
        assert got[lang].tolist() == [packed(g) for g in want]


def test_awkward_rows(awkward, nothing):
    rows = L.identify(awkward).collect()
    assert len(rows) == awkward.count()
    assert all((r["lang_pred"], r["score"]) == ("und", 0.0) for r in rows if r["doc_id"] in (2, 3, 4, 7))
    assert {r["held_out"] for r in rows if r["doc_id"] is None} == {False}
    assert L.identify(nothing).count() == 0
