"""Incremental bronze and streaming operators (RA-9, RA-10)."""

import datetime as dt
import os

import pytest

from pyspark.sql import functions as F

from newsmart.sources import read_table, write_landing
from newsmart.streaming import (
    append_new_articles,
    compact_bronze_day,
    read_incremental_bronze,
    run_incremental_bronze,
    run_to_parquet,
    windowed_counts,
)

from .conftest import article
from .test_sources_sinks import _envelopes


def test_incremental_bronze_is_order_free_and_idempotent(spark, tmp_dir):
    land, bronze, ck = (os.path.join(tmp_dir, n) for n in ("landing", "bronze", "ck"))
    d = dt.date(2024, 3, 25)
    # Page 2 re-delivers "a" without content; it lands first.
    write_landing(_envelopes(spark, [(d, 2, [article(title="a", content=None)])]), land)
    run_incremental_bronze(spark, land, bronze, ck)
    write_landing(_envelopes(spark, [(d, 1, [article(title="a", content="full"), article(title="b")])]), land)
    run_incremental_bronze(spark, land, bronze, ck)
    rows = {r["title"]: r for r in read_incremental_bronze(spark, bronze).collect()}
    assert set(rows) == {"a", "b"}
    assert rows["a"]["content"] == "full"  # provenance order, not arrival order
    assert read_table(spark, bronze).count() == 3  # two batches appended, nothing rewritten
    run_incremental_bronze(spark, land, bronze, ck)  # nothing new: unchanged
    assert read_table(spark, bronze).count() == 3
    day = str(rows["a"]["load_date"])
    compact_bronze_day(spark, bronze, day)
    assert read_table(spark, bronze).count() == 2
    assert os.listdir(os.path.join(bronze, f"load_date={day}")) == ["batch_id=-1"]
    rows = {r["title"]: r for r in read_incremental_bronze(spark, bronze).collect()}
    assert rows["a"]["content"] == "full"


def test_clean_source_archives_consumed_files(spark, tmp_dir):
    land, bronze, ck, arch = (os.path.join(tmp_dir, n) for n in ("landing", "bronze", "ck", "archive"))
    d = dt.date(2024, 3, 25)
    write_landing(_envelopes(spark, [(d, 1, [article(title="a")])]), land)
    kw = dict(clean_source="archive", archive_dir=arch)
    run_incremental_bronze(spark, land, bronze, ck, **kw)
    write_landing(_envelopes(spark, [(dt.date(2024, 3, 26), 1, [article(title="b")])]), land)
    run_incremental_bronze(spark, land, bronze, ck, **kw)
    archived = [f for _, _, fs in os.walk(arch) for f in fs if f.endswith(".json")]
    assert archived, "files of a completed batch are archived once a later batch commits"
    assert read_incremental_bronze(spark, bronze).count() == 2


def test_stream_dedup_loses_nothing(spark, tmp_dir):
    """Several micro-batches, repeats across them, and articles far older than those before."""
    land, out, ck = (os.path.join(tmp_dir, n) for n in ("landing", "out", "ck"))
    d = dt.date(2024, 3, 25)
    old = dict(title="old", publishedAt="2023-01-01T00:00:00Z")
    write_landing(_envelopes(spark, [(d, 1, [article(title="a"), article(title="b")])], ingest=dt.date(2024, 3, 26)), land)
    write_landing(_envelopes(spark, [(d, 2, [article(title="a", content=None), article(**old)])], ingest=dt.date(2024, 3, 27)), land)
    write_landing(_envelopes(spark, [(d, 3, [article(title=None, publishedAt=None), article(**old), article(title="c")])],
                             ingest=dt.date(2024, 3, 28)), land)
    rows = append_new_articles(spark, land, out, ck, max_files_per_trigger=1).collect()
    assert sorted(str(r["title"]) for r in rows) == ["None", "a", "b", "c", "old"]
    write_landing(_envelopes(spark, [(d, 4, [article(title=None, publishedAt=None), article(title="d")])], ingest=dt.date(2024, 3, 29)), land)
    rows = append_new_articles(spark, land, out, ck).collect()
    assert sorted(str(r["title"]) for r in rows) == ["None", "a", "b", "c", "d", "old"]


def test_replayed_batch_writes_the_same_rows(spark, tmp_dir):
    from newsmart.sources.landing import read_envelopes
    from newsmart.streaming.incremental import new_article_writer

    land, out = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "out")
    d = dt.date(2024, 3, 25)
    write_landing(_envelopes(spark, [(d, 1, [article(title="a"), article(title="b")])]), land)
    batch = read_envelopes(spark, land)
    for _ in range(2):
        new_article_writer(out)(batch, 0)
        new_article_writer(out)(batch, 1)  # all known by now
        assert sorted(r["title"] for r in read_table(spark, out).collect()) == ["a", "b"]


def test_malformed_landing_fails_the_stream(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing", "ingest_date=2024-03-26")
    os.makedirs(land)
    with open(os.path.join(land, "part-0.json"), "w") as f:
        f.write('{"status": "ok", "articles": [{"title"\n')
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ_FILE|corrupt"):
        run_incremental_bronze(spark, os.path.dirname(land), os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "ck"))


def test_stream_reads_original_files(spark, tmp_dir):
    from .test_sources_sinks import _art_json, _write_original

    land, bronze = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "bronze")
    _write_original(land, "2024-03-25 (Page 2).json", {"status": "ok", "totalResults": 1, "articles": [_art_json(title="p2")]})
    run_incremental_bronze(spark, land, bronze, os.path.join(tmp_dir, "ck"), multi_line=True)
    assert [(r["title"], r["page"]) for r in read_incremental_bronze(spark, bronze).collect()] == [("p2", 2)]


def test_new_checkpoint_over_stored_batches_is_refused(spark, tmp_dir):
    land, bronze = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "bronze")
    write_landing(_envelopes(spark, [(dt.date(2024, 3, 25), 1, [article(title="one")])]), land)
    run_incremental_bronze(spark, land, bronze, os.path.join(tmp_dir, "ck"))
    with pytest.raises(ValueError, match="checkpoint"):
        run_incremental_bronze(spark, land, bronze, os.path.join(tmp_dir, "other"))


def test_incremental_bronze_feeds_silver(spark, tmp_dir):
    from newsmart.plans.medallion import Layout, run_silver
    from newsmart.schemas import SILVER

    layout, d = Layout(tmp_dir), dt.date(2024, 3, 25)
    for page, content in ((2, None), (1, "full")):
        write_landing(_envelopes(spark, [(d, page, [article(title="a", content=content)])]), layout.landing)
        run_incremental_bronze(spark, layout.landing, layout.bronze, os.path.join(tmp_dir, "ck"))
    assert run_silver(spark, layout) == ["2024-03-26"] or run_silver(spark, layout)
    rows = read_table(spark, layout.silver)
    assert [r["content"] for r in rows.collect()] == ["full"] and set(rows.columns) == set(SILVER.names)


def test_windowed_counts(spark, tmp_dir):
    ev = os.path.join(tmp_dir, "events")
    rows = [(dt.datetime(2024, 1, 1, h, m), "view") for h in range(5) for m in (0, 30)]
    spark.createDataFrame(rows, "ts timestamp_ntz, kind string").write.parquet(ev)
    s = spark.readStream.schema("ts timestamp_ntz, kind string").parquet(ev)
    out2 = os.path.join(tmp_dir, "counts")
    run_to_parquet(windowed_counts(s, "ts", ("kind",), "1 hour", "2 hours"), out2, out2 + "_ck")
    got = sorted((r["window_start"].hour, r["n"]) for r in spark.read.parquet(out2).collect())
    # max event 04:30 -> watermark 02:30: windows ending by then are final.
    assert got == [(0, 2), (1, 2)]


def _stored(spark, out):
    return sorted((str(r["title"]), r["batch_id"]) for r in read_table(spark, out).collect())


def test_folding_keeps_a_days_files_few(spark, tmp_dir):
    from newsmart.sources.landing import read_envelopes
    from newsmart.streaming import fold_article_batches
    from newsmart.streaming.incremental import new_article_writer

    out, d = os.path.join(tmp_dir, "out"), dt.date(2024, 3, 25)
    batches = []
    for k, titles in enumerate((["a", "b"], ["b", "c"], ["d", None], ["a", "e"])):
        land = os.path.join(tmp_dir, f"landing{k}")
        rows = [article(title=t, publishedAt=None if t is None else f"2024-03-2{k // 2}T10:00:00Z") for t in titles]
        write_landing(_envelopes(spark, [(d, 1, rows)]), land)
        batches.append(read_envelopes(spark, land))
    for k in range(3):
        new_article_writer(out)(batches[k], k)
    # a, b and c were published on the 20th (batches 0 and 1); d on the 21st; None on no day.
    assert _stored(spark, out) == [("None", 2), ("a", 0), ("b", 0), ("c", 1), ("d", 2)]
    assert fold_article_batches(spark, out, before=2, at_least=2) == ["2024-03-20"]
    assert _stored(spark, out) == [("None", 2), ("a", -1), ("b", -1), ("c", -1), ("d", 2)]
    assert fold_article_batches(spark, out, before=2, at_least=2) == []
    new_article_writer(out)(batches[2], 2)  # a replay after the fold
    new_article_writer(out)(batches[3], 3)
    assert _stored(spark, out) == [("None", 2), ("a", -1), ("a", 3), ("b", -1), ("c", -1), ("d", 2), ("e", 3)]  # another publishedAt


def test_a_fold_that_was_interrupted_is_finished(spark, tmp_dir, monkeypatch):
    from newsmart.sources.landing import read_envelopes
    from newsmart.streaming import incremental

    out, d = os.path.join(tmp_dir, "out"), dt.date(2024, 3, 25)
    for k in range(2):
        land = os.path.join(tmp_dir, f"landing{k}")
        write_landing(_envelopes(spark, [(d, 1, [article(title=f"t{k}")])]), land)
        incremental.new_article_writer(out)(read_envelopes(spark, land), k)
    finish = incremental._finish_folds
    calls = []
    monkeypatch.setattr(incremental, "_finish_folds", lambda s, p: finish(s, p) if not calls.append(1) and len(calls) == 1 else None)
    incremental.fold_article_batches(spark, out, before=2, at_least=2)  # ends right after the log
    assert _stored(spark, out) == [("t0", 0), ("t1", 1)]
    monkeypatch.undo()
    incremental.new_article_writer(out)(read_envelopes(spark, os.path.join(tmp_dir, "landing0")), 2)
    assert _stored(spark, out) == [("t0", -1), ("t1", -1)]


def test_only_touched_days_are_read(spark, tmp_dir):
    from newsmart.sources.landing import read_envelopes
    from newsmart.streaming.incremental import already_stored, new_article_writer

    out, d = os.path.join(tmp_dir, "out"), dt.date(2024, 3, 25)
    land = os.path.join(tmp_dir, "landing")
    rows = [article(title=f"t{k}", publishedAt=f"2024-03-{10 + k}T10:00:00Z") for k in range(9)]
    write_landing(_envelopes(spark, [(d, 1, rows)]), land)
    new_article_writer(out)(read_envelopes(spark, land), 0)
    batch = spark.createDataFrame([("t0", "2024-03-10T10:00:00Z"), ("new", "2024-03-18T09:00:00Z")], "title string, publishedAt string")
    known = already_stored(batch, out, 1, [dt.date(2024, 3, 10), dt.date(2024, 3, 18)])
    assert [r["_title"] for r in known.collect()] == ["t0"]
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "IN (2024-03-10,2024-03-18)" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "ReadSchema: struct<title:string,publishedAt:string>" in plan  # of the articles, the keys only


def _batch(spark, rows):
    return spark.createDataFrame([(dt.datetime(2024, 1, 1, h, m), k) for h, m, k in rows], "ts timestamp_ntz, kind string")


def test_reconciled_counts_lose_no_late_row(spark, tmp_dir):
    from newsmart.streaming.reconciled import count_writer, fold_counts, read_reconciled_counts

    write = count_writer(tmp_dir, "ts", ("kind",), "1 hour", "2 hours")
    batches = [
        [(h, m, "view") for h in range(6) for m in (0, 30)],  # newest 05:30, so windows to 03:00 are closed
        [(0, 5, "view"), (2, 59, "view"), (3, 1, "view"), (0, 5, "buy"), (7, 59, "view")],
        [(5, 0, "view"), (6, 0, "view")],  # newest 07:59: the window to 06:00 is not open, that to 07:00 is
    ]
    for k, rows in enumerate(batches):
        write(_batch(spark, rows), k)
        write(_batch(spark, rows), k)  # a replay
    want = {("view", 0): (3, 1), ("view", 1): (2, 0), ("view", 2): (3, 1), ("view", 3): (3, 0), ("view", 4): (2, 0), ("buy", 0): (1, 1)}
    got = lambda **kw: {(r["kind"], r["window_start"].hour): (r["n"], r["late"]) for r in read_reconciled_counts(spark, tmp_dir, ("kind",), **kw).collect()}
    assert got() == want
    rest = {("view", 5): (3, 0), ("view", 6): (1, 0), ("view", 7): (1, 0)}
    assert got(closed_only=False) == want | rest
    fold_counts(spark, tmp_dir, 2, ("kind",))
    assert {x for x in os.listdir(tmp_dir) if x.startswith("batch_id")} == {"batch_id=-2", "batch_id=2"}
    assert got(closed_only=False) == want | rest
    write(_batch(spark, batches[2]), 2)  # a replay behind the fold
    write(_batch(spark, [(0, 0, "view")]), 3)
    fold_counts(spark, tmp_dir, 4, ("kind",))
    assert got()[("view", 0)] == (4, 2) and not {"batch_id=-2", "batch_id=2"} & set(os.listdir(tmp_dir))


def test_completeness_reports_by_deadline(spark, tmp_dir):
    """Complete, incomplete at the deadline, late after it, past the deadline at once; repeats report nothing."""
    from newsmart.streaming import completeness_stream

    kind = "window_start timestamp_ntz, page int, totalResults long, n_articles long, landed_at timestamp_ntz, extra string"
    at = lambda h, m=0: dt.datetime(2024, 3, 1, h, m)
    batches = [
        [(at(0), 1, 150, 100, at(1)), (at(0), 2, 150, 50, at(1)), (at(1), 1, 150, 100, at(1)), (None, 1, 1, 1, at(1)), (at(1), None, 1, 1, at(1))],
        [(at(1), 1, 150, 90, at(4)), (at(0), 1, 150, 100, at(4)), (at(3), 1, 0, 0, at(4))],
        [(at(1), 2, 150, 50, at(5)), (at(2), 1, 10, 9, at(5))],  # the window of 02:00 is past its deadline when it lands
        [(at(2), 1, 10, 10, at(6)), (at(1), 2, 150, 50, at(6))],
    ]
    src, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    got = []
    for rows in batches:
        spark.createDataFrame([(*r, "x") for r in rows], kind).coalesce(1).write.mode("append").parquet(src)
        run_to_parquet(completeness_stream(spark.readStream.schema(kind).parquet(src)), out, out + "_ck", 2)
        now = sorted((r["window_start"].hour, *tuple(r)[1:]) for r in spark.read.parquet(out).collect())
        got.append([x for x in now if x not in [y for g in got for y in g]])
    assert got == [
        [(0, "complete", 150, 2, 2, 150)],
        [(1, "incomplete", 150, 2, 1, 100), (3, "complete", 0, 0, 1, 0)],
        [(1, "complete_late", 150, 2, 2, 150), (2, "incomplete", 10, 1, 1, 9)],
        [(2, "complete_late", 10, 1, 1, 10)],
    ]
