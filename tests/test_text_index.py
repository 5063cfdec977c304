"""Boolean queries and the positional inverted index (RA-1)."""

import os
import random

import pytest

from pyspark.sql import functions as F

from newsmart.operators import boolean_query, search, text_index
from newsmart.operators.boolean_query import And, Not, Or, Phrase

SCHEMA = "id int, title string, description string, content string, day string"


def articles(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


WORDS = ["ana", "anab", "ban", "Ban", "b", "", "a\nna", "naïve", "NAÏVE", "ana\tban", "çan"]


def random_rows(n, seed):
    r = random.Random(seed)
    text = lambda: None if r.random() < 0.1 else " ".join(r.choices(WORDS, k=r.randint(0, 8)))
    return [(i, text(), text(), text(), f"2024-03-0{1 + i % 3}") for i in range(n)]


def test_same_rows_as_the_scan(spark, tmp_dir):
    df = articles(spark, random_rows(200, 1))
    assert text_index.index_articles(df, tmp_dir, F.col("day")) == ["2024-03-01", "2024-03-02", "2024-03-03"]
    r = random.Random(2)
    rows = df.collect()
    phrases = ["", " ", "an", "ana ban", "ana  ban", " ana", "b ", "nab b", "zzz", "naïve ban"]
    while len(phrases) < 14:
        text = r.choice([x for row in rows for x in row[1:4] if x])
        at = r.randint(0, len(text) - 1)
        phrases.append(text[at : at + r.randint(1, 12)])
    for q in phrases:
        for where in (None, "title") if " " in q else (None,):
            want = sorted(x["id"] for x in df.filter(search.phrase_match(q, where)).collect())
            got = text_index.search(spark, tmp_dir, q, where)
            assert got.columns == df.columns
            assert sorted(x["id"] for x in got.collect()) == want, (q, where)


def test_days_are_replaced_and_chosen(spark, tmp_dir):
    one = articles(spark, [(1, "red fox", None, None, "x"), (2, "fox", None, None, "x")])
    text_index.index_articles(one, tmp_dir, "2024-03-01")
    text_index.index_articles(articles(spark, [(3, "fox red", None, None, "x")]), tmp_dir, "2024-03-02")
    ids = lambda q, days=None: sorted(x["id"] for x in text_index.search(spark, tmp_dir, q, days=days).collect())
    assert ids("fox") == [1, 2, 3] and ids("fox", days=["2024-03-02"]) == [3] and ids("red fox") == [1]
    text_index.index_articles(articles(spark, [(4, "a fox", "b", "c", "x")]), tmp_dir, "2024-03-01")
    assert ids("fox") == [3, 4] and ids("red") == [3]


def test_only_the_terms_postings_are_read(spark, tmp_dir):
    text_index.index_articles(articles(spark, random_rows(100, 3)), tmp_dir, F.col("day"))
    matched = text_index.Matched(spark, tmp_dir, ["ban", "naïve", "ban"], None)
    assert matched.rarest[0] == 1
    plan = text_index.postings_of(spark, tmp_dir, matched, 1, ["title"])._jdf.queryExecution().executedPlan().toString()
    bucket = text_index._bucket_of("naïve")
    assert f"(bucket#" in plan and f"= {bucket})" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "EqualTo(term,naïve)" in plan or "In(term, [naïve])" in plan
    folders = os.listdir(os.path.join(tmp_dir, "postings", "index_day=2024-03-01"))
    assert len([f for f in folders if f.startswith("bucket=")]) > 3


def test_boolean_trees():
    parse = boolean_query.parse
    assert parse("climate change") == Phrase("climate change")
    assert parse('a  b AND "c (d"') == And((Phrase("a  b"), Phrase("c (d")))
    assert parse("a OR b AND c") == Or((Phrase("a"), And((Phrase("b"), Phrase("c")))))
    assert parse("(a OR b) NOT c") == And((Or((Phrase("a"), Phrase("b"))), Not(Phrase("c"))))
    assert parse("+a b -c") == And((Phrase("a"), Not(Phrase("c"))))
    assert parse("-a") == Not(Phrase("a"))
    assert parse("well-known and - x") == Phrase("well-known and - x")
    assert boolean_query.phrases(parse('a OR NOT ("b" a)')) == ["a", "b"]
    for bad in ("", "  ", "(", ")", "a AND", "OR a", '"a', "()", "a (b", "NOT", '""', "a)", "a AND OR b"):
        with pytest.raises(ValueError):
            parse(bad)


def test_boolean_by_scan_and_by_index(spark, tmp_dir):
    df = articles(spark, random_rows(150, 5))
    text_index.index_articles(df, tmp_dir, F.col("day"))
    rows = df.collect()
    holds = lambda row, p: any(p in (x or "").lower() and x is not None for x in row[1:4])
    for q, want in {
        "ana AND ban": lambda r: holds(r, "ana") and holds(r, "ban"),
        "anab OR NOT ban": lambda r: holds(r, "anab") or not holds(r, "ban"),
        '+naïve çan -"b "': lambda r: holds(r, "naïve") and not holds(r, "b "),
        "NOT (ana OR çan)": lambda r: not (holds(r, "ana") or holds(r, "çan")),
    }.items():
        ids = sorted(r["id"] for r in rows if want(r))
        assert sorted(r["id"] for r in search.search_articles(df, q=q, boolean=True).collect()) == ids, q
        assert sorted(r["id"] for r in text_index.search_boolean(spark, tmp_dir, q).collect()) == ids, q


def test_empty_day(spark, tmp_dir):
    assert text_index.index_articles(articles(spark, []), tmp_dir, F.col("day")) == []
