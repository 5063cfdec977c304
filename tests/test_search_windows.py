"""Search parameters (RA-1..6, RA-11, RA-12) and batch windows (RA-7, RA-8)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsmart.operators import search, windows


@pytest.fixture()
def arts(spark):
    rows = [
        ("s1", "Dengue rises", "cases of dengue", None, "https://news.site.com/a", "pt", "2024-03-25T10:00:00"),
        ("s2", "Other", "nothing here", "DENGUE dengue", "https://m.other.org/b", "en", "2024-03-26T00:00:00"),
        ("s3", "Third", None, None, "ftp://files.site.com/c", "en", "2024-03-27T12:00:00"),
        (None, "Fourth", "x", "y", None, "pt", None),
    ]
    df = spark.createDataFrame(
        rows, "source_id string, title string, description string, content string, url string, "
              "language string, ts string"
    )
    return df.withColumn("published_ts", F.to_timestamp("ts").cast("timestamp_ntz"))


def titles(df):
    return sorted(r["title"] for r in df.collect())


def test_phrase_search_fields(arts):
    assert titles(search.search_articles(arts, q="dengue")) == ["Dengue rises", "Other"]
    assert titles(search.search_articles(arts, q="dengue", search_in="title")) == ["Dengue rises"]
    with pytest.raises(ValueError):
        search.search_articles(arts, q="x", search_in="body")


def test_sources_domains_interval_language(arts):
    assert titles(search.search_articles(arts, sources=["s1", "s3"])) == ["Dengue rises", "Third"]
    with pytest.raises(ValueError):
        search.search_articles(arts, sources=[f"s{i}" for i in range(21)])
    with pytest.raises(ValueError):
        search.search_articles(arts, sources=["s1", 2])
    assert titles(search.search_articles(arts, domains=["site.com"])) == ["Dengue rises", "Third"]
    assert titles(search.search_articles(arts, exclude_domains=["other.org"])) == ["Dengue rises", "Fourth", "Third"]
    got = search.search_articles(arts, date_from="2024-03-26T00:00:00", date_to="2024-03-27T12:00:00")
    assert titles(got) == ["Other", "Third"]
    assert titles(search.search_articles(arts, language="en")) == ["Other", "Third"]
    with pytest.raises(ValueError):
        search.search_articles(arts, language="xx")


def test_sort_and_page(arts):
    page1 = search.sort_and_page(arts, page_size=2, page=1)
    assert [r["title"] for r in page1.collect()] == ["Third", "Other"]
    page2 = search.sort_and_page(arts, page_size=2, page=2)
    assert [r["title"] for r in page2.collect()] == ["Dengue rises", "Fourth"]
    rel = search.sort_and_page(arts, "relevancy", page_size=1, q="dengue")
    assert [r["title"] for r in rel.collect()] == ["Other"]
    scores = arts.sparkSession.createDataFrame([("s2", 9), ("s3", 4), (None, 7)], "source_id string, popularity int")
    popular = search.sort_and_page(arts, "popularity", popularity=scores).collect()
    assert [(r["title"], r["popularity"]) for r in popular] == [("Other", 9), ("Third", 4), ("Dengue rises", 0), ("Fourth", 0)]
    assert {r["popularity"] for r in search.sort_and_page(arts, "popularity").collect()} == {0, 1}
    assert "TakeOrderedAndProject" in page2._jdf.queryExecution().executedPlan().toString()


def test_unknown_sources_and_catalogue(spark):
    cat = spark.createDataFrame([("s1", "health", "pt", "br"), ("s2", "science", "en", "us")],
                                "source_id string, category string, language string, country string")
    assert [r[0] for r in search.unknown_sources(spark, ["s1", "nope"], cat).collect()] == ["nope"]
    assert [r[0] for r in search.filter_catalogue(cat, category="science").collect()] == ["s2"]
    with pytest.raises(ValueError):
        search.filter_catalogue(cat, category="weather")


def test_request_parameters(spark):
    df = spark.createDataFrame([(1, "https://x.com/?q=a&foo=1&page=2#frag"), (2, "https://x.com/p")],
                               "page_id long, url string")
    params = search.query_parameters(df)
    assert [tuple(r) for r in params.orderBy("position").collect()] == [
        (1, 0, "q", "a"), (1, 1, "foo", "1"), (1, 2, "page", "2")]
    assert [tuple(r) for r in search.unknown_parameters(params).collect()] == [(1, 1, "foo")]


def test_windows_and_counts(spark, arts):
    wins = windows.backfill_windows(spark, F.lit("2024-03-27").cast("date"), 3)
    got = {r["window_start"]: r["articles"] for r in windows.count_per_window(arts, wins).collect()}
    assert got == {dt.datetime(2024, 3, 25): 1, dt.datetime(2024, 3, 26): 1, dt.datetime(2024, 3, 27): 1}
    # A window crossing midnight is matched on both of its dates.
    hour = windows.past_hour_window(spark, F.lit("2024-03-27T00:30:00").cast("timestamp_ntz"), lag_hours=24)
    r = hour.first()
    assert (r["window_start"], r["window_end"]) == (dt.datetime(2024, 3, 25, 23, 30), dt.datetime(2024, 3, 26, 0, 30))
    assert windows.count_per_window(arts, hour).first()["articles"] == 1
    day = windows.day_window(spark, F.lit("2024-03-27T15:00:00").cast("timestamp_ntz")).first()
    assert day["window_start"] == dt.datetime(2024, 3, 27, 0, 0, 59)
    plan = windows.count_per_window(arts, wins)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_landing_completeness(spark):
    """Hourly windows of a day are apart; a page that came twice counts once."""
    a, b, c = (dt.datetime(2024, 3, 25, h) for h in (8, 9, 10))
    rows = [(a, 1, 150, 100), (b, 1, 120, 100), (b, 2, 120, 20), (b, 2, 120, 19), (c, 1, 1, 1), (c, 1, 1, 1)]
    df = spark.createDataFrame(rows, "window_start timestamp_ntz, page int, totalResults long, n_articles long")
    got = {r["window_start"]: tuple(r)[1:] for r in windows.landing_completeness(df).collect()}
    assert got == {a: (150, 2, 1, 100, 1, False), b: (120, 2, 2, 120, 0, True), c: (1, 1, 1, 1, 0, True)}


def test_window_bounds_text(spark):
    wins = windows.backfill_windows(spark, F.lit("2024-03-27").cast("date"), 1)
    r = windows.window_bounds_text(wins).first()
    assert (r["from"], r["to"]) == ("2024-03-27T00:00:00", "2024-03-27T23:59:59")


def test_window_join_without_broadcast_is_keyed_and_equal(spark, arts):
    wins = windows.backfill_windows(spark, F.lit("2024-03-27").cast("date"), 3)
    small = sorted(map(tuple, windows.count_per_window(arts, wins).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = windows.count_per_window(arts, wins)
        plan = big._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, big.collect())) == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan


def test_seek_pages_equal_offset_pages(spark):
    """Nulls, equal times, equal URLs and whole copies over page ends; every row comes once."""
    from newsmart.operators.search import page_after, sort_and_page

    times = [None, "2024-03-01 10:00:00", "2024-03-01 10:00:00.000001", "2024-03-02 00:00:00"]
    rows = [(i % 7, times[i % 4], None if i % 5 == 0 else f"u{i % 3}", "tion " * (i % 2)) for i in range(90)]
    rows += [(1, times[1], "u1", "same")] * 8
    df = spark.createDataFrame(rows, "n int, at string, url string, content string").selectExpr(
        "n", "cast(at as timestamp_ntz) published_ts", "url", "cast(n as string) source_id", "content", "content title", "content description"
    )
    scores = spark.createDataFrame([(str(k), k % 2) for k in range(6)], "source_id string, popularity int")
    for how in ({"sort_by": "publishedAt"}, {"sort_by": "relevancy", "q": "tion"}, {"sort_by": "popularity", "popularity": scores}):
        token, seen, number = None, [], 0
        while True:
            page, token = page_after(df, token, page_size=3 if number < 20 else 7, **how)
            got = [tuple(r) for r in page.collect()]
            if number < 3:
                at = sort_and_page(df, page_size=3, page=number + 1, **how).collect()
                assert [(r["published_ts"], r["url"]) for r in at] == [(x[1], x[2]) for x in got]
            seen, number = seen + got, number + 1
            if token is None:
                break
        everything = sort_and_page(df, page_size=1000, **how).collect()
        assert sorted(map(repr, seen)) == sorted(repr(tuple(r)) for r in everything)
    with pytest.raises(ValueError, match="token"):
        page_after(df, "nonsense")
    _, token = page_after(df, page_size=3)
    with pytest.raises(ValueError, match="token"):
        page_after(df, token, sort_by="relevancy", q="tion")


def test_a_late_page_starts_with_a_range(spark, tmp_dir):
    from newsmart.operators.search import _not_before

    spark.range(10).selectExpr("cast('2024-03-01' as timestamp_ntz) published_ts", "'u' url", "id _ties").write.mode("overwrite").parquet(tmp_dir + "/t")
    late = spark.read.parquet(tmp_dir + "/t").filter(_not_before({"ts": "2024-03-01 10:00:00", "url": "u", "ties": 3}, "published_ts", False))
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(published_ts,2024-03-01T10:00)" in plan.split("PushedFilters")[1]


def test_overlapping_windows_and_a_hot_instant(spark):
    import random

    r = random.Random(3)
    base = dt.datetime(2024, 3, 1)
    times = [base + dt.timedelta(microseconds=r.randint(0, 3 * 86_400_000_000)) for _ in range(500)] + [base + dt.timedelta(hours=30)] * 1000
    arts = spark.createDataFrame([(t,) for t in times] + [(None,)], "published_ts timestamp_ntz")
    wins = []
    for _ in range(300):
        a = r.choice([*times, base + dt.timedelta(hours=r.randint(-5, 90))])
        wins.append((a, a + dt.timedelta(microseconds=r.choice([0, 1, 3_600_000_000, 86_400_000_000, -5]))))
    wins += [wins[0], (None, base), (base, None)]
    df = spark.createDataFrame(wins, "window_start timestamp_ntz, window_end timestamp_ntz")
    got = sorted((str(x[0]), str(x[1]), x[2]) for x in windows.count_per_window(arts, df).collect())
    want = sorted((str(a), str(b), sum(a <= t <= b for t in times) if a and b else 0) for a, b in wins)
    assert got == want


def test_ten_thousand_windows_make_no_more_rows(spark):
    """The rows that meet do not grow with the overlap: one a distinct instant and two a window."""
    hours = spark.range(10_000).selectExpr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, cast(id as int)) s")
    wins = hours.selectExpr("s window_start", "s + interval 30 days window_end")
    arts = spark.range(20_000).selectExpr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, cast(id % 100 as int)) published_ts")
    counted = windows.count_per_window(arts, wins)
    assert counted.agg(F.min("articles"), F.max("articles"), F.count("*")).first() == (0, 20_000, 10_000)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_latest_written_partition(spark, tmp_dir):
    """A younger file in an older folder."""
    import os

    from newsmart.sources import read_latest_partition, read_latest_written, write_partitions

    for day, n in (("2024-03-02", 1), ("2024-03-01", 2)):
        write_partitions(spark.range(n).selectExpr("id", f"date'{day}' load_date"), tmp_dir, "load_date")
    assert read_latest_written(spark, tmp_dir).count() == 2 and read_latest_partition(spark, tmp_dir).count() == 1
    old = os.path.join(tmp_dir, "load_date=2024-03-02")
    for name in os.listdir(old):
        os.utime(os.path.join(old, name), (4e9, 4e9))
    assert read_latest_written(spark, tmp_dir).count() == 1
