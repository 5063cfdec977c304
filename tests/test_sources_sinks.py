"""Landing reads in both layouts, sinks by write-then-read, and the medallion run."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from newsmart.plans.medallion import Layout, read_gold_counts, run_bronze, run_daily, run_gold, run_silver
from newsmart.schemas import ARTICLE_COLUMNS
from newsmart.sources import (
    export_csv,
    latest_partition,
    publish,
    read_csv_export,
    read_envelopes,
    read_landing,
    read_latest_partition,
    read_table,
    write_bronze,
    write_landing,
)

from .conftest import article


def _art_json(**kw):
    a = article(**kw)
    src = a.pop("source")
    a["source"] = None if src is None else {"id": src[0], "name": src[1]}
    return a


def _write_original(folder, name, envelope):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(json.dumps(envelope, indent=1))


def test_original_file_names_give_provenance(spark, tmp_dir):
    land = os.path.join(tmp_dir, "raw")
    _write_original(land, "2024-03-25 (Page 2).json",
                    {"status": "ok", "totalResults": 150, "articles": [_art_json(title="p2")]})
    _write_original(land, "2024-03-26.json", {"status": "ok", "totalResults": 1, "articles": [_art_json(title="p1")]})
    _write_original(land, "2024-03-27.json", {"totalResults": 0})  # no articles key -> no rows
    rows = {r["title"]: r for r in read_landing(spark, land, multi_line=True).collect()}
    assert set(rows) == {"p1", "p2"}
    assert (rows["p2"]["window_start"], rows["p2"]["page"], rows["p2"]["totalResults"]) == (dt.datetime(2024, 3, 25), 2, 150)
    assert (rows["p1"]["window_start"], rows["p1"]["page"]) == (dt.datetime(2024, 3, 26), 1)
    assert rows["p1"]["source"]["name"] == "Source One"


def test_empty_landing_reads_zero_rows(spark, tmp_dir):
    os.makedirs(os.path.join(tmp_dir, "empty"))
    assert read_envelopes(spark, os.path.join(tmp_dir, "empty")).isEmpty()


def _envelopes(spark, pages, ingest=dt.date(2024, 3, 26)):
    """pages: list of (window_start, page, [article dicts]), landed on ``ingest``."""
    from newsmart.schemas import ENVELOPE
    from pyspark.sql import types as T

    schema = T.StructType(ENVELOPE.fields + [T.StructField("window_start", T.TimestampNTZType()),
                                             T.StructField("page", T.IntegerType()),
                                             T.StructField("ingest_date", T.DateType())])
    rows = []
    for wd, page, arts in pages:
        arts_rows = [tuple(({"id": a["source"][0], "name": a["source"][1]} if a["source"] else None)
                           if c == "source" else a[c] for c in ARTICLE_COLUMNS) for a in arts]
        start = wd if isinstance(wd, dt.datetime) else dt.datetime.combine(wd, dt.time())
        rows.append(("ok", len(arts), arts_rows, start, page, ingest))
    return spark.createDataFrame(rows, schema)


def test_landing_writer_skips_empty_pages_and_round_trips(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    d = dt.datetime(2024, 3, 25, 7)
    env = _envelopes(spark, [(d, 1, [article(title="a"), article(title="b")]), (d, 2, [])])
    write_landing(env, land)
    assert [d for d in os.listdir(land) if d.startswith("ingest_date=")] == ["ingest_date=2024-03-26"]
    rows = read_landing(spark, land).collect()
    assert sorted(r["title"] for r in rows) == ["a", "b"] and {r["page"] for r in rows} == {1}
    assert {r["window_start"] for r in rows} == {d} and {r["ingest_date"] for r in rows} == {dt.date(2024, 3, 26)}


def test_bronze_write_replaces_only_its_day(spark, tmp_dir, landing_df):
    from newsmart.operators.bronze import to_bronze

    path = os.path.join(tmp_dir, "bronze")
    write_bronze(to_bronze(landing_df([article(title="d1")]), "2024-03-01"), path)
    write_bronze(to_bronze(landing_df([article(title="d2")]), "2024-03-02"), path)
    write_bronze(to_bronze(landing_df([article(title="d2b")]), "2024-03-02"), path)
    got = sorted((str(r["load_date"]), r["title"]) for r in read_table(spark, path).collect())
    assert got == [("2024-03-01", "d1"), ("2024-03-02", "d2b")]
    latest = latest_partition(read_table(spark, path), "load_date")
    assert [r["title"] for r in latest.collect()] == ["d2b"]
    listed = read_latest_partition(spark, path, "load_date")
    assert [r["title"] for r in listed.collect()] == ["d2b"]
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_date" in plan and "2024-03-02" in plan  # static pruning


def test_publish_swaps_and_can_rewrite_its_input(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    publish(spark.range(3), path)
    publish(read_table(spark, path).withColumn("id", F.col("id") + 10), path)
    assert sorted(r[0] for r in read_table(spark, path).collect()) == [10, 11, 12]
    assert not [p for p in os.listdir(tmp_dir) if ".staging-" in p or ".old-" in p]


def test_csv_export_is_lossless(spark, tmp_dir):
    path = os.path.join(tmp_dir, "csv")
    texts = ["a", "", None, "  lead and trail  ", "tab\t", 'q"uote', "line\nbreak\n", "\r\n x", "\\", '"', '""', "a,b", " ", "x\r"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    export_csv(df, path)
    assert {r["i"]: r["s"] for r in read_csv_export(spark, path, df.schema).collect()} == dict(enumerate(texts))


def test_medallion_round_trip_twice(spark, tmp_dir):
    _round_trip(spark, Layout(tmp_dir))


def test_medallion_round_trip_versioned(spark, tmp_dir):
    _round_trip(spark, Layout(tmp_dir, versioned=True))
    assert os.path.exists(os.path.join(tmp_dir, "silver", "_CURRENT"))


def _round_trip(spark, layout):
    from newsmart.plans.medallion import read_published

    d = dt.date(2024, 3, 25)
    pages = [
        (d, 1, [article(title="a", author=None), article(title="b", source=("s2", None), content=None)]),
        (d, 2, [article(title="a", content=None)]),  # duplicate of page 1's "a"
    ]
    write_landing(_envelopes(spark, pages), layout.landing)
    assert run_bronze(spark, layout, load_date="2024-03-26")
    landed = [f for _, _, fs in os.walk(layout.landing) for f in fs if f.endswith(".json")]
    archived = [f for _, _, fs in os.walk(layout.archive) for f in fs if f.endswith(".json")]
    assert not landed and archived  # every landed file moved once
    assert not run_bronze(spark, layout)  # landing consumed: nothing to do
    assert run_silver(spark, layout) == ["2024-03-26"]
    first = run_gold(spark, layout)
    snapshot = {t: sorted(map(tuple, read_published(spark, layout, p).collect()), key=repr) for t, p in first.items()}
    # Second daily run over the same bronze day: silver dedups whole rows, gold is the same.
    assert run_silver(spark, layout)
    second = run_gold(spark, layout)
    again = {t: sorted(map(tuple, read_published(spark, layout, p).collect()), key=repr) for t, p in second.items()}
    assert snapshot == again
    assert [tuple(r) for r in read_gold_counts(spark, layout, "aggregateByYear").collect()] == [(2024, 1)]
    assert read_published(spark, layout, layout.silver).count() == 2
    authors = {r["author"] for r in read_published(spark, layout, layout.gold("dim_author")).collect()}
    assert authors == {"Não Informado", "Ana"}
    # Q3: separate outputs, sorted by their keys with nulls last (SRT-3)
    assert read_gold_counts(spark, layout, "aggregateByMonth").columns == ["month", "number_articles"]
    assert read_gold_counts(spark, layout, "aggregateByYearMonthDay").columns == ["year", "month", "day", "number_articles"]
    assert [r["source_name"] for r in read_gold_counts(spark, layout, "aggregateBySource").collect()] == ["Source One", None]
    totals = read_published(spark, layout, first["keyword_totals"])
    assert totals.columns == ["keyword", "year", "month", "day", "occurrences"] and totals.count() == 1
    assert run_daily(spark, layout) != {}


def test_publish_version_pointer(spark, tmp_dir):
    from newsmart.sources import publish_version, read_current

    path = os.path.join(tmp_dir, "gold_t")
    publish_version(spark.range(2), path)
    publish_version(read_current(spark, path).withColumn("id", F.col("id") + 5), path)
    assert sorted(r[0] for r in read_current(spark, path).collect()) == [5, 6]
    publish_version(spark.range(1), path)
    assert sorted(d for d in os.listdir(path) if d.startswith("v=")) == ["v=1", "v=2"]  # keep=2
    assert open(os.path.join(path, "_CURRENT")).read().strip() == "v=2"


def test_silver_day_merge_touches_only_its_partition(spark, tmp_dir):
    layout = Layout(tmp_dir)
    d1, d2 = dt.date(2024, 3, 26), dt.date(2024, 3, 27)
    write_landing(_envelopes(spark, [(dt.date(2024, 3, 25), 1, [article(title="a")])], ingest=d1), layout.landing)
    run_bronze(spark, layout)
    run_silver(spark, layout)
    day1 = os.path.join(layout.silver, "load_date=2024-03-26")
    stamp = {f: os.path.getmtime(os.path.join(day1, f)) for f in os.listdir(day1)}
    write_landing(_envelopes(spark, [(dt.date(2024, 3, 26), 1, [article(title="b")])], ingest=d2), layout.landing)
    run_bronze(spark, layout)
    run_silver(spark, layout)
    run_silver(spark, layout)  # the same day again: whole-row dedup within the day
    assert {f: os.path.getmtime(os.path.join(day1, f)) for f in os.listdir(day1)} == stamp
    rows = sorted((str(r["load_date"]), r["title"]) for r in read_table(spark, layout.silver).collect())
    assert rows == [("2024-03-26", "a"), ("2024-03-27", "b")]


def test_incremental_gold_equals_full_counts_and_is_idempotent(spark, tmp_dir):
    from newsmart.operators import gold as G
    from newsmart.plans.medallion import run_gold_day

    layout = Layout(tmp_dir)
    days = [(dt.date(2024, 3, 26), [article(title="a"), article(title="b", author=None)]),
            (dt.date(2024, 3, 27), [article(title="c", author="Zoe", source=("s9", None)), article(title="d", content=None)])]
    for ingest, arts in days:
        write_landing(_envelopes(spark, [(dt.date(2024, 3, 25), 1, arts)], ingest=ingest), layout.landing)
        run_bronze(spark, layout)
        run_silver(spark, layout)
        written = run_gold_day(spark, layout)
    silver = read_table(spark, layout.silver)

    def snapshot():
        return {t: sorted(map(tuple, read_gold_counts(spark, layout, t).collect()), key=repr) for t in G.GOLD_AGGREGATES}

    first = snapshot()
    for t, keys in G.GOLD_AGGREGATES.items():
        assert first[t] == sorted(map(tuple, G.count_articles(silver, keys).collect()), key=repr), t
    run_gold_day(spark, layout, "2024-03-27")  # re-running a day changes nothing
    assert snapshot() == first
    ids = {r["author"]: r["id_authors"] for r in read_table(spark, written["dim_author"]).collect()}
    assert ids == {"Ana": 0, "Não Informado": 1, "Zoe": 2}  # day-1 members first, then new ones
    assert read_table(spark, written["articles"]).count() == 4


def test_run_daily_incremental_gold(spark, tmp_dir):
    layout = Layout(tmp_dir)
    for ingest, title in ((dt.date(2024, 3, 26), "a"), (dt.date(2024, 3, 27), "b")):
        write_landing(_envelopes(spark, [(dt.date(2024, 3, 25), 1, [article(title=title)])], ingest=ingest),
                      layout.landing)
        written = run_daily(spark, layout, incremental_gold=True)
    assert read_table(spark, written["articles"]).count() == 2
    by_year = [tuple(r) for r in read_gold_counts(spark, layout, "aggregateByYear").collect()]
    assert by_year == [(2024, 2)]
    assert run_daily(spark, layout, incremental_gold=True)  # nothing landed: silver/gold re-run, same result
    assert [tuple(r) for r in read_gold_counts(spark, layout, "aggregateByYear").collect()] == [(2024, 2)]


def test_archive_keeps_folders_and_moves_every_file(spark, tmp_dir):
    from newsmart.sources import archive_files

    land, arch = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "archive")
    files = []
    for day in range(20):
        folder = os.path.join(land, f"ingest_date=2024-03-{day + 1:02d}")
        os.makedirs(folder)
        for part in range(2):
            path = os.path.join(folder, f"part-0000{part}.json")  # same names in every folder
            open(path, "w").write("{}\n")
            files.append(path)
    assert archive_files(spark, files, arch, root=land) == 40
    moved = [os.path.relpath(os.path.join(d, f), arch) for d, _, fs in os.walk(arch) for f in fs
             if f.endswith(".json")]
    assert len(moved) == 40 and not [f for _, _, fs in os.walk(land) for f in fs if f.endswith(".json")]
    assert archive_files(spark, files, arch, root=land) == 0  # already moved: nothing to do


def test_one_bronze_run_has_one_load_day(spark, tmp_dir):
    """Days landed together load together (the reference writes one bronze file per
    run), so the silver step, which takes the newest bronze day, sees all of them."""
    layout = Layout(tmp_dir)
    for ingest, title in ((dt.date(2024, 3, 26), "a"), (dt.date(2024, 3, 27), "b")):
        write_landing(_envelopes(spark, [(dt.date(2024, 3, 25), 1, [article(title=title)])], ingest=ingest),
                      layout.landing)
    run_bronze(spark, layout)
    run_silver(spark, layout)
    rows = sorted((r["title"], str(r["load_date"])) for r in read_table(spark, layout.silver).collect())
    assert rows == [("a", "2024-03-27"), ("b", "2024-03-27")]
    # A later, older backfill day loads as its own day, not as the newest folder seen before.
    write_landing(_envelopes(spark, [(dt.date(2024, 3, 20), 1, [article(title="c")])], ingest=dt.date(2024, 3, 21)),
                  layout.landing)
    run_bronze(spark, layout)
    assert {str(r["load_date"]) for r in read_table(spark, layout.bronze).collect()} == {"2024-03-27", "2024-03-21"}


def _titles(spark, layout):
    return sorted((str(r["load_date"]), r["title"]) for r in read_table(spark, layout.silver).collect())


def test_late_load_days_reach_silver(spark, tmp_dir):
    layout = Layout(tmp_dir)
    for ingest, title in ((dt.date(2024, 3, 27), "new"), (dt.date(2024, 3, 21), "late"), (dt.date(2024, 3, 25), "later")):
        write_landing(_envelopes(spark, [(dt.date(2024, 3, 20), 1, [article(title=title)])], ingest=ingest), layout.landing)
        assert run_bronze(spark, layout) == str(ingest)
    assert run_silver(spark, layout) == ["2024-03-21", "2024-03-25", "2024-03-27"]
    write_landing(_envelopes(spark, [(dt.date(2024, 3, 20), 1, [article(title="oldest")])], ingest=dt.date(2024, 3, 1)), layout.landing)
    written = run_daily(spark, layout, incremental_gold=True)
    assert _titles(spark, layout)[0] == ("2024-03-01", "oldest") and len(_titles(spark, layout)) == 4
    assert [r["title"] for r in read_table(spark, written["articles"]).collect()] == ["oldest"]  # the day just loaded


def test_daily_run_on_original_files(spark, tmp_dir):
    layout = Layout(tmp_dir)
    _write_original(layout.landing, "2024-03-25.json", {"status": "ok", "totalResults": 150, "articles": [_art_json(title="p1")]})
    _write_original(layout.landing, "2024-03-25 (Page 2).json",
                    {"status": "ok", "totalResults": 150, "articles": [_art_json(title="p1", content=None), _art_json(title="p2")]})
    assert run_daily(spark, layout, load_date="2024-03-26", multi_line=True)
    rows = {r["title"]: r["content"] for r in read_table(spark, layout.silver).collect()}
    assert rows == {"p1": "body", "p2": "body"}  # page 1 kept
    assert sorted(os.path.basename(f) for f in os.listdir(layout.archive) if f.endswith(".json")) == [
        "2024-03-25 (Page 2).json", "2024-03-25.json"
    ]
    assert run_daily(spark, layout, load_date="2024-03-26", multi_line=True)  # nothing landed
    assert read_table(spark, layout.silver).count() == 2


def test_files_of_a_failed_run_are_loaded_by_the_next(spark, tmp_dir):
    from newsmart.sources import claim_landing

    layout = Layout(tmp_dir)
    write_landing(_envelopes(spark, [(dt.date(2024, 3, 25), 1, [article(title="a")])]), layout.landing)
    claim_landing(spark, layout.landing, layout.inflight)  # a run that got no further
    write_landing(_envelopes(spark, [(dt.date(2024, 3, 25), 1, [article(title="b")])]), layout.landing)
    assert run_bronze(spark, layout) == "2024-03-26"
    assert sorted(r["title"] for r in read_table(spark, layout.bronze).collect()) == ["a", "b"]
    archived = [f for _, _, fs in os.walk(layout.archive) for f in fs if f.endswith(".json")]
    assert len(archived) == 2 and run_bronze(spark, layout) is None


def test_first_silver_load_keeps_equal_rows(spark, tmp_dir, landing_df):
    from newsmart.operators.silver import merge_silver, to_silver
    from newsmart.operators.bronze import add_load_date

    rows = to_silver(add_load_date(landing_df([article(title="a"), article(title="a")])))
    assert merge_silver(rows, None).count() == 2  # Q6: nothing to merge with
    assert merge_silver(rows, rows).count() == 1


def test_dedup_ties_do_not_depend_on_input_order(landing_df):
    from newsmart.operators.bronze import to_bronze

    copies = [article(title="a", content=c) for c in ("x", "b", None, "c")]
    kept = {to_bronze(landing_df(rows)).first()["content"] for rows in (copies, copies[::-1], copies[1:] + copies[:1])}
    assert len(kept) == 1


def test_hourly_windows_order_copies(landing_df):
    from newsmart.operators.bronze import to_bronze

    late = article(title="a", content="late") | {"window_start": dt.datetime(2024, 3, 25, 9)}
    early = article(title="a", content="now") | {"window_start": dt.datetime(2024, 3, 25, 8)}
    assert [r["content"] for r in to_bronze(landing_df([late, early])).collect()] == ["now"]


def test_extra_article_keys_pass_through(spark, tmp_dir):
    from pyspark.sql import types as T

    layout = Layout(tmp_dir)
    _write_original(layout.landing, "2024-03-25.json", {"articles": [_art_json(title="a") | {"tone": "calm"}, _art_json(title="b")]})
    run_bronze(spark, layout, "2024-03-26", multi_line=True, extra_fields=[T.StructField("tone", T.StringType())])
    _write_original(layout.landing, "2024-03-26.json", {"articles": [_art_json(title="c") | {"tone": "loud"}]})
    run_bronze(spark, layout, "2024-03-27", multi_line=True)  # not asked for: not read
    run_silver(spark, layout)
    rows = read_table(spark, layout.silver, merge_schema=True).collect()
    assert {r["title"]: r["tone"] for r in rows} == {"a": "calm", "b": None, "c": None}
