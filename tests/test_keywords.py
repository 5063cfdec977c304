"""Keyword statistics for any number of keywords and any corpus (AGG-13..15, PRJ-5, SRT-2)."""

import datetime as dt

import pytest

from newsmart.operators import keywords as K
from newsmart.plans.medallion import keyword_totals

SCHEMA = "title string, description string, Title2 string, year int, month int, day int, publishedAt date"


def corpus(spark, texts):
    return spark.createDataFrame([("t", t, "x", 2024, 3, i + 1, dt.date(2024, 3, i + 1)) for i, t in enumerate(texts)], SCHEMA)


@pytest.mark.parametrize("k", [1, 3, 5, 8])
def test_every_keyword_counts(spark, k):
    words = ["alpha", "bravo", "charlie", "delta", "foxtrot", "hotel"]
    df = corpus(spark, [" ".join(words[: i + 1]) for i in range(6)])
    top = K.top_keyword_array(K.word_counts(df), k)
    got = {r["rank"]: r["keyword"] for r in K.keyword_occurrences(df, top).collect()}
    assert got == {i + 1: w for i, w in enumerate(words[:k])}
    assert {r["keyword"] for r in keyword_totals(df, k).collect()} == set(words[:k])
    counts = {r["day"]: r["todas_top3"] for r in K.all_keywords_daily(df, top).collect()}
    assert counts == {d: int(d >= min(k, 6)) for d in range(1, 7)}


@pytest.mark.parametrize("texts", [["none of it"], [None], ["alpha"], ["alpha bravo", "bravo"]])
def test_short_corpora(spark, texts):
    df = corpus(spark, texts)
    words = {w for t in texts if t for w in t.split() if len(w) > 4}
    top = K.top_keyword_array(K.word_counts(df), 3)
    assert {r["keyword"] for r in K.keyword_occurrences(df, top).collect()} == words
    assert K.keyword_histogram(K.keyword_occurrences(df, top)).count() == sum(len(set(t.split()) & words) for t in texts if t)
    assert sum(r["todas_top3"] for r in K.all_keywords_daily(df, top).collect()) == sum(
        bool(words) and t is not None and all(w in t for w in words) for t in texts
    )


def test_full_word_list_in_order(spark):
    rows = K.ranked_words(K.word_counts(corpus(spark, ["bravo alpha bravo", "delta charlie bravo alpha"]))).orderBy("position").collect()
    assert [(r["position"], r["Palavra"], r["Quantidade"]) for r in rows] == [(1, "bravo", 3), (2, "alpha", 2), (3, "charlie", 1), (4, "delta", 1)]


def test_wide_columns_have_distinct_names(spark):
    df = corpus(spark, ["Dengue dengue title"])
    out = K.with_keyword_columns(df, ["Dengue", "dengue", "DENGUE", "Title", "dengue"])
    assert out.columns[len(df.columns):] == ["Dengue", "kw_dengue", "kw_DENGUE_2", "kw_Title", "kw_dengue_3"]
    assert [out.collect()[0][c] for c in out.columns[len(df.columns):]] == [2, 2, 2, 1, 2]
