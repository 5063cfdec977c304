"""How much the steps shuffle, write and send to the driver."""

import glob
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from newsmart import fixtures as fx
from newsmart.operators import text_index, word_states
from newsmart.operators.silver import drop_copies
from newsmart.sources import read_envelopes, write_landing, write_partitions
from newsmart.streaming import incremental

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _documents(spark, folder: str) -> str:
    rows = [(i, f"title {i % 7}\nsome words of text {i}", "en", f"src{i % 3}", 30) for i in range(60)] + [(60, None, None, None, None)]
    spark.createDataFrame(rows, DOCUMENT).write.parquet(os.path.join(folder, "documents.parquet"))
    return folder


def test_landing_is_compressed_and_its_texts_are_dealt_once(spark, tmp_dir):
    sf_dir = _documents(spark, tmp_dir)
    write_landing(fx.landing_envelopes(spark, sf_dir), f"{tmp_dir}/plain")
    dealt = fx.landing_envelopes(spark, sf_dir, by_day=True)
    plan = _plan(dealt)
    assert plan.index("Generate") < plan.index("Exchange")  # dealt first, then delivered several times
    write_landing(dealt, f"{tmp_dir}/packed", compression="gzip", by_day=True)
    rows = lambda name: sorted(str(r[:-1]) for r in read_envelopes(spark, f"{tmp_dir}/{name}").drop("_file").select("articles", "window_start", "page", "ingest_date", F.lit(0)).collect())
    assert rows("packed") == rows("plain") and len(rows("plain")) == 61 * 2 + 13
    files = glob.glob(f"{tmp_dir}/packed/ingest_date=*/*")
    assert files and all(f.endswith(".json.gz") for f in files)


def test_tables_are_compressed(spark, tmp_dir):
    write_partitions(spark.range(3).withColumn("d", F.lit("x")), f"{tmp_dir}/t", "d")
    file = glob.glob(f"{tmp_dir}/t/d=x/*.parquet")[0]
    assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"


def test_copies_are_dropped_without_a_shuffle_of_the_others(spark, monkeypatch):
    rows = [("a", None, 1.0), (None, "a", 1.0), ("a", None, 1.0), ("b", "b", -0.0), ("b", "b", 0.0), (None, None, None), (None, None, None), ("c", "c", 2.0)]
    df = spark.createDataFrame(rows, "x string, y string, z double")
    want = sorted(map(str, df.dropDuplicates().collect()))
    assert len(want) == 5 and sorted(map(str, drop_copies(df).collect())) == want
    monkeypatch.setattr("newsmart.operators.silver.FEW_COPIES", 1)  # many copies: all rows are compared
    assert sorted(map(str, drop_copies(df).collect())) == want
    assert "Exchange" not in _plan(drop_copies(df.filter("x = 'c'")))


def test_word_states_of_short_words_and_wordless_articles(spark, tmp_dir):
    text = "steady İİİİ steady abcd"  # four letters that are eight in lower case
    silver = spark.createDataFrame(
        [("2024-02-01", 2024, 1, 1, text), ("2024-02-01", 2024, 1, 2, "steady"), ("2024-02-01", None, None, None, None)],
        "load_date string, year int, month int, day int, description string",
    ).withColumn("load_date", F.col("load_date").cast("date"))
    word_states.store_days(silver, tmp_dir, ["2024-02-01"])
    stored = spark.read.parquet(f"{tmp_dir}/states")
    get = lambda kind: sorted(map(str, (tuple(r) for r in stored.filter(F.col("kind") == kind).select("year", "day", "token", "n").collect())))
    assert get("words") == ["(None, None, 'steady', 3)"]
    dated = [(2024, 1, "steady", 2), (2024, 1, "İİİİ", 1), (2024, 1, None, 0), (2024, 2, "steady", 1), (2024, 2, None, 0), (None, None, None, 0)]
    assert get("dated") == sorted(map(str, dated))


def test_a_space_at_the_end_of_a_phrase_looks_no_term_up(spark, tmp_dir, monkeypatch):
    rows = [(1, "la vie", None), (2, "voi la", "x"), (3, "voila a", None), (4, "la", "b la c"), (5, "a  la  b", None), (6, None, None), (7, "", " ")]
    df = spark.createDataFrame([(i, t, d, None) for i, t, d in rows], "id int, title string, description string, content string")
    text_index.index_articles(df, tmp_dir, "2024-03-01")
    asked = []
    terms_for = text_index.terms_for
    monkeypatch.setattr(text_index, "terms_for", lambda spark, path, part, *rest: asked.append(part) or terms_for(spark, path, part, *rest))
    for q in ("la ", " la", " la ", " ", "  ", "voi la", "a  la "):
        want = [i for i, t, d in rows if q in (t or "") or q in (d or "")]
        assert sorted(r["id"] for r in text_index.search(spark, tmp_dir, q).collect()) == want, q
    assert set(asked) <= {"la", "voi", "a", ""} and asked.count("") == 2  # the inner ones of "  " and "a  la "
    assert not glob.glob(f"{tmp_dir}/_staged/index_day=*")  # the articles are stored once


def test_keys_are_looked_for_by_their_digests(spark, tmp_dir):
    batch = spark.createDataFrame([("a", "2024-03-10T00:00:00Z"), (None, None)], "title string, publishedAt string")
    stored = spark.createDataFrame([("a", "2024-03-10T00:00:00Z", 0), ("b", "2024-03-10T00:00:00Z", 0), (None, None, 0), ("a", None, 0)], "title string, publishedAt string, batch_id int")
    stored = stored.withColumn("published_day", F.col("publishedAt").cast("date"))
    stored.write.partitionBy("published_day", "batch_id").parquet(f"{tmp_dir}/t")
    days = [r[0] for r in stored.select("published_day").distinct().collect()]
    known = incremental.already_stored(batch, f"{tmp_dir}/t", 1, days)
    assert sorted(map(str, (tuple(r) for r in known.collect()))) == ["('a', '2024-03-10T00:00:00Z')", "(None, None)"]
    sides = [line for line in _plan(known).splitlines() if "SemiJoin" in line or "LeftSemi" in line]
    assert sides and all("_digest" in line and "title" not in line for line in sides)
