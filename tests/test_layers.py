"""Bronze, silver and gold operators on hand-made rows (FIXTURES.md §2, SURVEY §2.12)."""

import datetime as dt

from pyspark.sql import functions as F

from newsmart.operators import analysis, gold, keywords
from newsmart.operators.bronze import to_bronze
from newsmart.operators.silver import merge_silver, to_silver

from .conftest import article


def test_dedup_keeps_page_one_and_nulls_compare_equal(landing_df):
    rows = [
        article(page=2, content=None),
        article(page=1, content="kept"),
        article(title=None, publishedAt=None, url="u1", page=1),
        article(title=None, publishedAt=None, url="u2", page=1),
    ]
    bronze = to_bronze(landing_df(rows)).collect()
    assert len(bronze) == 2
    assert {r["content"] for r in bronze if r["title"] == "Title"} == {"kept"}
    assert [r["url"] for r in bronze if r["title"] is None] == ["u1"]


def test_silver_cleaning(landing_df):
    rows = [
        article(title="[Removed]", publishedAt="2024-01-01T00:00:00Z"),
        article(title=None, author=None, publishedAt="2024-01-01T01:30:00Z", url="x"),
        article(title="t2", author="", source=None, publishedAt="2024-01-02T00:00:00Z"),
    ]
    silver = {r["url"] if r["title"] is None else r["title"]: r for r in to_silver(to_bronze(landing_df(rows))).collect()}
    assert set(silver) == {"x", "t2"}
    assert silver["x"]["author"] == "Não Informado"
    assert silver["x"]["publishedAt"] == dt.date(2024, 1, 1)
    assert (silver["x"]["year"], silver["x"]["month"], silver["x"]["day"]) == (2024, 1, 1)
    assert silver["t2"]["author"] == ""
    assert silver["t2"]["source_id"] is None and silver["t2"]["source_name"] is None


def test_silver_merge_whole_rows_and_keys(landing_df):
    base = to_silver(to_bronze(landing_df([article()])))
    later = base.withColumn("load_date", F.date_add("load_date", 1))
    assert merge_silver(base, base).count() == 1
    assert merge_silver(later, base).count() == 2  # Q6: two load days stay twice
    kept = merge_silver(later, base, dedup_keys=["title", "publishedAt"]).collect()
    assert len(kept) == 1 and kept[0]["load_date"] == dt.date(2024, 3, 26)


def _silver(landing_df):
    rows = [
        article(title="a", content=None, publishedAt="2024-01-05T00:00:00Z"),
        article(title="b", publishedAt=None, author=None, source=("s2", None)),
        article(title="c", source=("s3", None), author="Bia"),
    ]
    return to_silver(to_bronze(landing_df(rows)), lenient=True)


def test_gold_counts_keep_null_groups_and_count_content(landing_df):
    silver = _silver(landing_df)
    by_day = {r["day"]: r["number_articles"] for r in gold.count_articles(silver, ["day"]).collect()}
    assert by_day == {5: 0, None: 1, 25: 1}  # Q1 (null content not counted), Q2 (null group kept)
    rows_by_day = {r["day"]: r["quantidade"] for r in analysis.count_rows(silver, ["day"]).collect()}
    assert rows_by_day == {5: 1, 25: 1}  # notebook drops null keys and counts rows


def test_grouping_sets_equal_separate_aggregates(landing_df):
    silver = _silver(landing_df)
    allc = gold.all_gold_counts(silver)
    for table, keys in gold.GOLD_AGGREGATES.items():
        got = sorted(map(tuple, allc.filter(F.col("gold_table") == table).select(*keys, "number_articles").collect()), key=repr)
        want = sorted(map(tuple, gold.count_articles(silver, keys).collect()), key=repr)
        assert got == want, table


def test_dimensions_and_fact(landing_df):
    silver = _silver(landing_df)
    sources = {r["source_name"]: r["source_id"] for r in gold.dim_source(silver).collect()}
    assert sources == {"Source One": 0, None: 1}  # one null member (Q11), nulls last
    authors = {r["author"]: r["id_authors"] for r in gold.dim_author(silver).collect()}
    assert authors == {"Ana": 0, "Bia": 1, "Não Informado": 2}
    fact = gold.fact_articles(silver, gold.dim_author(silver), gold.dim_source(silver))
    assert "author" not in fact.columns and "source_name" not in fact.columns
    got = {r["title"]: (r["id_authors"], r["source_id"]) for r in fact.collect()}
    assert got == {"a": (0, 0), "b": (2, 1), "c": (1, 1)}


def test_stable_dimension_keeps_old_ids(spark):
    old = spark.createDataFrame([(0, "zed"), (1, "amy")], "id_authors long, author string")
    silver = spark.createDataFrame([("amy",), ("bob",), (None,), ("zed",)], "author string")
    got = {r["author"]: r["id_authors"] for r in gold.dim_author(silver, existing=old).collect()}
    assert got == {"zed": 0, "amy": 1, "bob": 2, None: 3}


def test_dense_ids_many_partitions(spark):
    values = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).cast("string").alias("k"))
    ids = gold.dim_author(values.withColumnRenamed("k", "author"))
    got = [(r["id_authors"], r["author"]) for r in ids.orderBy("id_authors").collect()]
    assert [g[0] for g in got] == list(range(5000))
    assert [g[1] for g in got] == sorted(g[1] for g in got)


def test_word_counts_semantics(spark):
    df = spark.createDataFrame(
        [("abcd abcde Dengue dengue dengue,",), (None,), ("aneax anea.",)], "description string"
    )
    counts = {r["Palavra"]: r["Quantidade"] for r in keywords.word_counts(df).collect()}
    assert counts == {"abcde": 1, "Dengue": 1, "dengue": 1, "dengue,": 1, "aneax": 1, "anea.": 1}


def test_keyword_histogram_and_all(spark):
    df = spark.createDataFrame(
        [(2024, 1, 1, "aneax anea. zzzzz"), (2024, 1, 1, None), (2024, 1, 2, "nothing")],
        "year int, month int, day int, description string",
    )
    occ = keywords.keyword_occurrences(df, ["anea.", "zzzzz"])
    hist = {(r["keyword"], r["day"], r["occurrences"]): r["contagem"] for r in keywords.keyword_histogram(occ).collect()}
    assert hist == {("anea.", 1, 2): 1, ("zzzzz", 1, 1): 1}
    allk = {r["day"]: r["todas_top3"] for r in keywords.all_keywords_daily(df, ["anea.", "zzzzz"]).collect()}
    assert allk == {1: 1, 2: 0}  # null description counts as not containing (Q15 fix)
    tot = {(r["keyword"], r["day"]): r["occurrences"] for r in keywords.keyword_daily_total(occ).collect()}
    assert tot[("anea.", 1)] == 2 and tot[("anea.", 2)] == 0


def test_profile(spark):
    df = spark.createDataFrame([("a", None), (None, None)], "x string, y int")
    got = [tuple(r) for r in analysis.profile(df).orderBy("position").collect()]
    assert got == [(0, "x", "string", 1, 2), (1, "y", "int", 0, 2)]


def test_word_options_and_wide_keyword_columns(spark):
    df = spark.createDataFrame([("Dengue dengue, (dengue) xx",)], "description string")
    counts = {r["Palavra"]: r["Quantidade"] for r in keywords.word_counts(df, lower=True, strip_punct=True).collect()}
    assert counts == {"dengue": 3}  # Q13 options: one spelling
    wide = keywords.with_keyword_columns(df.withColumn("dengue", F.lit(0)), ["dengue", "xx"])
    row = wide.first()
    assert row["kw_dengue"] == 3 and row["xx"] == 1 and row["dengue"] == 0  # Q22: no overwrite
    flags = keywords.with_keyword_columns(df, ["dengue"], mode="contains").first()
    assert flags["dengue"] is True
    assert keywords.top_keywords(keywords.word_counts(df, lower=True, strip_punct=True), 3) == ["dengue"]


def test_top_k_ties_break_on_name(spark):
    silver = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), ("b",), ("c",)], "source_name string")
    got = [tuple(r) for r in analysis.top_sources(silver, 2).collect()]
    assert got == [("a", 2), ("b", 2)]  # Q16: equal counts ordered by name
    counts = spark.createDataFrame([("zeta", 3), ("alpha", 3), ("mid", 2)], "Palavra string, Quantidade long")
    assert [r[0] for r in keywords.top_words(counts, 2).collect()] == ["alpha", "zeta"]


def test_stray_pandas_index_dropped(spark, tmp_dir):
    import os

    import pandas as pd

    from newsmart.sources import read_table

    path = os.path.join(tmp_dir, "legacy")
    os.makedirs(path)
    frame = pd.concat([pd.DataFrame({"title": ["a"]}), pd.DataFrame({"title": ["b"]})])  # index 0, 0
    frame.to_parquet(os.path.join(path, "2024-03-26.parquet"))
    raw = spark.read.parquet(path)
    assert "__index_level_0__" in raw.columns
    assert read_table(spark, path).columns == ["title"]  # Q17
