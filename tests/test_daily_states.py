"""Gold in O(day): running totals by differences, word states, keyword tables (AGG-1..15, TOP-2)."""

import datetime as dt
import os
import random

import pytest

from pyspark.sql import functions as F

from newsmart.operators import gold, keyword_table, keywords, word_states
from newsmart.plans import medallion
from newsmart.plans.medallion import Layout, read_published, run_gold, run_gold_day
from newsmart.schemas import SILVER
from newsmart.sources import read_table, write_partitions

DAYS = [dt.date(2024, 3, d) for d in (1, 2, 3)]
WORDS = ["alpha", "Alpha", "alphabet", "beta5", "gamma.", "g.mma", "well-known", "tiny", "delta", "(delta)"]


def silver_rows(seed, day, n=40):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        dated = r.random() > 0.1
        date = dt.date(2024, 1, r.randint(1, 4))
        text = None if r.random() < 0.1 else " \n".join(r.choices(WORDS, weights=range(1, 11), k=r.randint(0, 9)))
        rows.append(dict(
            author=f"a{r.randint(0, 3)}", title=f"t{day}{i}", description=text, url=f"u{i}", urlToImage=None,
            publishedAt=date if dated else None, content=None if r.random() < 0.2 else "c", language="en", load_date=day,
            year=date.year if dated else None, month=date.month if dated else None, day=date.day if dated else None,
            source_id="s", source_name=None if r.random() < 0.2 else f"n{r.randint(0, 2)}",
        ))
    return rows


def write_day(spark, layout, rows):
    df = spark.createDataFrame([tuple(x[f.name] for f in SILVER.fields) for x in rows], SILVER)
    write_partitions(df, layout.silver, "load_date")


def counts(spark, layout):
    rows = read_published(spark, layout, layout.gold(medallion.COUNTS)).filter(F.col("gold_table") != gold.APPLIED)
    return sorted(map(repr, rows.select("gold_table", *gold.GROUPING_COLUMNS, "number_articles").collect()))


def expected_counts(spark, layout):
    return sorted(map(repr, gold.all_gold_counts(read_table(spark, layout.silver)).collect()))


def totals(df):
    return sorted(map(tuple, df.select("keyword", "year", "month", "day", "occurrences").collect()))


@pytest.mark.parametrize("versioned", [False])
def test_running_totals_and_states(spark, tmp_dir, versioned, monkeypatch):
    layout = Layout(tmp_dir, versioned)
    for k, day in enumerate(DAYS):
        write_day(spark, layout, silver_rows(k, day))
        run_gold_day(spark, layout)
    assert counts(spark, layout) == expected_counts(spark, layout)
    keyword = lambda: totals(read_published(spark, layout, layout.gold(medallion.KEYWORDS)))
    whole = lambda: totals(medallion.keyword_totals(read_table(spark, layout.silver)))
    assert keyword() == whole()

    run_gold_day(spark, layout, str(DAYS[1]))  # the same day again
    assert counts(spark, layout) == expected_counts(spark, layout) and keyword() == whole()

    write_day(spark, layout, silver_rows(9, DAYS[1], 7))  # the day with other, fewer rows: groups vanish
    publish = medallion._publish
    monkeypatch.setattr(medallion, "_publish", lambda lay, df, path, **kw: publish(lay, df, path, **kw) or (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        run_gold_day(spark, layout, str(DAYS[1]))  # fails right after the totals were published
    monkeypatch.undo()
    run_gold_day(spark, layout, str(DAYS[1]))
    assert counts(spark, layout) == expected_counts(spark, layout) and keyword() == whole()
    versions = os.listdir(os.path.join(layout.gold("_counts_by_day"), f"load_date={DAYS[1]}"))
    assert len(versions) == 1


def test_a_day_after_a_full_rebuild(spark, tmp_dir):
    layout = Layout(tmp_dir)
    for k, day in enumerate(DAYS[:2]):
        write_day(spark, layout, silver_rows(k, day))
    run_gold(spark, layout)
    write_day(spark, layout, silver_rows(2, DAYS[2]))
    run_gold_day(spark, layout)
    assert counts(spark, layout) == expected_counts(spark, layout)
    write_day(spark, layout, silver_rows(5, DAYS[0]))
    run_gold_day(spark, layout, str(DAYS[0]))
    assert counts(spark, layout) == expected_counts(spark, layout)


def test_a_run_reads_its_day_only(spark, tmp_dir, monkeypatch):
    layout = Layout(tmp_dir)
    for k, day in enumerate(DAYS):
        write_day(spark, layout, silver_rows(k, day))
        run_gold_day(spark, layout)
    read = []
    part = medallion.read_partition
    monkeypatch.setattr(medallion, "read_partition", lambda s, p, c, v: (read.append((p, str(v))), part(s, p, c, v))[1])
    write_day(spark, layout, silver_rows(7, DAYS[2]))
    run_gold_day(spark, layout)
    assert {v for p, v in read if p == layout.silver} == {str(DAYS[2])}


def test_top_words_by_threshold(spark, tmp_dir):
    r = random.Random(1)
    rows = []
    for day in range(1, 6):  # a word that is nowhere first may be first of all
        texts = [f"peak{day}"] * 30 + ["steady"] * 20 + [f"rare{r.randint(0, 40)}" for _ in range(40)]
        rows += [(dt.date(2024, 3, day), 2024, 1, 1, t) for t in texts]
    df = spark.createDataFrame(rows, "load_date date, year int, month int, day int, description string")
    assert word_states.store_days(df, tmp_dir) and word_states.candidate_bound(spark, tmp_dir, 3) >= 6
    for k in (1, 3, 20, 500):
        want = [tuple(x) for x in keywords.top_words(keywords.word_counts(df), k).collect()]
        assert [tuple(x) for x in word_states.top_words_over_days(spark, tmp_dir, k).collect()] == want
    assert word_states.top_words_over_days(spark, tmp_dir, 1).first()["Palavra"] == "steady"
    assert sorted(map(tuple, word_states.word_totals(spark, tmp_dir).collect())) == sorted(map(tuple, keywords.word_counts(df).collect()))


def test_keywords_with_special_characters_are_read_once(spark, tmp_dir, monkeypatch):
    layout = Layout(tmp_dir)
    for k, day in enumerate(DAYS):
        write_day(spark, layout, silver_rows(k, day))
        word_states.store_days(spark.read.parquet(layout.silver).filter(F.col("load_date") == F.lit(day)), tmp_dir + "/s")
    chosen = ["gamma.", "g.mma", "well-known", "Alpha", "(delta)"]
    assert [word_states.is_plain(k) for k in chosen] == [False, False, True, True, False]
    silver = read_table(spark, layout.silver)
    want = totals(keywords.keyword_daily_total(keywords.keyword_occurrences(silver, chosen)))
    assert totals(word_states.keyword_daily_total(spark, tmp_dir + "/s", layout.silver, chosen)) == want
    monkeypatch.setattr(word_states, "read_partition", None)  # the kept sums are enough the second time
    assert totals(word_states.keyword_daily_total(spark, tmp_dir + "/s", layout.silver, chosen)) == want


def test_many_literal_keywords(spark):
    rows = [x for k, day in enumerate(DAYS) for x in silver_rows(k, day)]
    df = spark.createDataFrame([tuple(x[f.name] for f in SILVER.fields) for x in rows], SILVER)
    chosen = ["alpha", "Alpha", "a", "pha", "gamma.", "(delta)", "nothing", "lpha beta", "known \n", "aa"]
    occ = keywords.keyword_occurrences(df, chosen, literal=True)
    hist = lambda d: sorted(map(tuple, d.select("keyword", "year", "month", "day", "occurrences", "contagem").collect()))
    assert hist(keyword_table.keyword_histogram(df, chosen)) == hist(keywords.keyword_histogram(occ))
    assert totals(keyword_table.keyword_daily_total(df, chosen)) == totals(keywords.keyword_daily_total(occ))
    assert keyword_table.keyword_histogram(df, []).count() == 0
    plan = keyword_table.literal_occurrences(df, [f"word{i}" for i in range(1000)])._jdf.queryExecution().executedPlan().toString()
    assert "Nested" not in plan and "Cartesian" not in plan


def files_of(layout):
    return {d: sorted(os.listdir(os.path.join(layout.silver, d))) for d in os.listdir(layout.silver) if d.startswith("load_date")}


def test_merge_by_keys_rewrites_only_the_days_hit(spark, tmp_dir):
    from newsmart.plans.medallion import _merge_day_by_keys
    from newsmart.operators.silver import merge_silver

    layout = Layout(tmp_dir)
    row = lambda title, day, url: dict(silver_rows(0, day, 1)[0], title=title, url=url)
    frame = lambda rows: spark.createDataFrame([tuple(x[f.name] for f in SILVER.fields) for x in rows], SILVER)
    d1, d2, d3 = DAYS
    loads = {
        d3: [row("a", d3, "1"), row("b", d3, "2"), row(None, d3, "3")],
        d2: [row("x", d2, "4"), row("y", d2, "5")],
        d1: [row("x", d1, "6"), row("a", d1, "9"), row("a", d1, "8"), row(None, d1, "7")],
    }
    write_partitions(merge_silver(frame(loads[d3]), None, ["title"]), layout.silver, "load_date")
    before = files_of(layout)
    _merge_day_by_keys(spark, layout, frame(loads[d2]), str(d2), ["title"])
    assert files_of(layout)[f"load_date={d3}"] == before[f"load_date={d3}"]  # shares no key
    _merge_day_by_keys(spark, layout, frame(loads[d1]), str(d1), ["title"])
    got = lambda: {(r["title"], str(r["load_date"]), r["url"]) for r in read_table(spark, layout.silver).collect()}
    want = {("x", str(d1), "6"), ("a", str(d1), "8"), (None, str(d1), "7"), ("b", str(d3), "2"), ("y", str(d2), "5")}
    assert got() == want
    before = files_of(layout)
    _merge_day_by_keys(spark, layout, frame(loads[d3]), str(d3), ["title"])  # again: older days win, and are not rewritten
    after = files_of(layout)
    assert got() == want and {d for d in after if after[d] != before[d]} == {f"load_date={d3}"}
    _merge_day_by_keys(spark, layout, frame([row("b", d1, "0")]), str(d1), ["title"])  # takes the last row of the third day
    assert got() == (want - {("b", str(d3), "2")}) | {("b", str(d1), "0")}
    assert f"load_date={d3}" not in files_of(layout)
