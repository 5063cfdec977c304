"""The daily batch: landing -> bronze -> silver -> gold, as thin writers around the
DataFrame operators (the reference's ``bronze_step``, ``silver_step`` and ``gold_step``).

Fixes stated in SURVEY §2.12: landing files are archived only after the bronze write
commits (Q21); silver and gold are published by staging + swap, so a run never
overwrites a table it is reading (Q7); the gold month and year-month-day tables go to
separate outputs (Q3); an empty landing zone writes nothing (SRC-2).
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsmart.operators import analysis, gold, keywords, word_states
from newsmart.operators.bronze import to_bronze
from newsmart.operators.silver import drop_copies, merge_silver, to_silver
from newsmart.session import cut_lineage, delete_path, pin_utc, run_concurrently, scratch_path
from newsmart.sources import (
    archive_days,
    archive_files,
    claim_landing,
    explode_articles,
    latest_partition_value,
    loose_files,
    partition_values,
    path_exists,
    publish,
    publish_version,
    read_current,
    read_envelopes,
    read_partition,
    read_table,
    with_provenance,
    write_bronze,
    write_partitions,
)
from newsmart.sources.writers import PARQUET_OPTIONS
from newsmart.streaming.incremental import first_deliveries


@dataclass(frozen=True)
class Layout:
    """Zone folders under one root (any Hadoop-compatible URI). ``versioned=True``
    publishes silver and gold as pointer-switched versions (for object stores, where a
    folder rename is a copy); otherwise by staging + rename."""

    root: str
    versioned: bool = False

    def _p(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def landing(self) -> str:
        return self._p("landing")

    @property
    def inflight(self) -> str:
        return self._p("landing_inflight")

    @property
    def archive(self) -> str:
        return self._p("landing_archive")

    @property
    def bronze(self) -> str:
        return self._p("bronze")

    @property
    def silver(self) -> str:
        return self._p("silver")

    def gold(self, table: str) -> str:
        return self._p(f"gold/{table}")


# The seven count tables are partitions (``gold_table=<name>``) of one published table, written
# by one job; the keyword totals (metric 4.3) are a table of their own.
COUNTS = "counts"
KEYWORDS = "keyword_totals"
TOP_KEYWORDS = 3


def _publish(layout: Layout, df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    if layout.versioned:
        publish_version(df, path, partition_by=partition_by)
    else:
        publish(df, path, partition_by=partition_by)


def keyword_totals(silver: DataFrame, k: int = TOP_KEYWORDS) -> DataFrame:
    """AGG-15 for the gold mart: occurrences per day of each of the ``k`` most frequent words."""
    top = keywords.top_keyword_array(keywords.word_counts(silver), k)
    return keywords.keyword_daily_total(keywords.keyword_occurrences(silver, top))


def read_gold_counts(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    """One of the seven count tables, sorted by its keys, nulls last (SRT-3). Only that
    table's partition is read."""
    keys = gold.GOLD_AGGREGATES[table]
    rows = read_published(spark, layout, layout.gold(COUNTS)).filter(F.col("gold_table") == table)
    return analysis.sorted_by(rows.select(*keys, "number_articles"), keys)


def _exists(spark: SparkSession, layout: Layout, path: str) -> bool:
    return path_exists(spark, f"{path}/_CURRENT" if layout.versioned else path)


def read_published(spark: SparkSession, layout: Layout, path: str) -> DataFrame:
    """A silver or gold table as the layout publishes it."""
    return read_current(spark, path) if layout.versioned else read_table(spark, path)


def run_bronze(
    spark: SparkSession,
    layout: Layout,
    load_date: dt.date | str | None = None,
    multi_line: bool = False,
    archive: bool = True,
    extra_fields: list[T.StructField] | None = None,
) -> str | None:
    """Load every landing file into bronze, then archive the files. Returns the load day,
    or None when the landing zone is empty (SRC-2, by folder listing).

    With ``archive`` the landed folders are first moved to ``landing_inflight``, by one
    rename a day, so that files landed while this runs wait for the next run; a run that
    failed leaves its folders there, and the next run loads them too. ``multi_line`` reads
    the original layout, one indented document a file; ``extra_fields`` are article keys beyond
    the schema, passed on to silver.

    One run, one load day (the reference writes one bronze file per run): ``load_date``, or
    the newest landing day among the folders loaded (no clock, so a re-run gives the same
    day), or today for files outside our layout."""
    pin_utc(spark)
    source = layout.landing
    if archive:
        claim_landing(spark, layout.landing, layout.inflight)
        source = layout.inflight
    landed, loose = partition_values(spark, source, "ingest_date"), loose_files(spark, source)
    if not landed and not loose:
        return None
    day = str(load_date or max(landed, default=None) or dt.datetime.now(dt.UTC).date())
    articles = explode_articles(with_provenance(read_envelopes(spark, source, multi_line, extra_fields)))
    write_bronze(to_bronze(articles, day), layout.bronze)
    if archive:
        archive_days(spark, source, layout.archive, landed)
        archive_files(spark, loose, layout.archive, root=source)
    return day


def _bronze_day(spark: SparkSession, layout: Layout, day: str) -> DataFrame:
    """One load day of bronze; days that the stream wrote in batches are deduplicated here."""
    rows = read_partition(spark, layout.bronze, "load_date", day)
    return first_deliveries(rows) if "batch_id" in rows.columns else rows


def _silver_days(spark: SparkSession, layout: Layout) -> set[str]:
    if not _exists(spark, layout, layout.silver):
        return set()
    if layout.versioned:  # whole versions: the days are in the rows (one row a day reaches the driver)
        days = read_published(spark, layout, layout.silver).select("load_date").distinct().collect()
        return {str(r["load_date"]) for r in days}
    return set(partition_values(spark, layout.silver, "load_date"))


def run_silver(spark: SparkSession, layout: Layout, dedup_keys: list[str] | None = None,
               lenient: bool = False, day: str | None = None) -> list[str]:
    """Bronze days -> silver rows, merged into the silver table: ``day``, or every bronze day
    that silver doesn't hold yet, however late it was landed (when there is none, the newest
    day again). Returns the days merged.

    Silver is partitioned by ``load_date``. The default dedup compares whole rows,
    ``load_date`` included, so rows of different load days are never duplicates: only the
    days being loaded are merged (with what silver already holds for a day that is re-run)
    and only their partitions are rewritten. Daily cost follows the day, not the table's
    history. ``dedup_keys`` compares across days: the key columns of the table tell which partitions
    hold a key of the new day, and later ones that lose a row to it are rewritten too, no others. The
    versioned (object store) layout publishes whole versions and merges the whole table. The very
    first load is not deduplicated unless by keys (SURVEY Q6)."""
    pin_utc(spark)
    held = [d for d in partition_values(spark, layout.bronze, "load_date") if not d.startswith("__")]
    if not held:
        return []
    known = _silver_days(spark, layout)
    days = [str(day)] if day else sorted(set(held) - known) or [max(held)]
    for one in days:
        first = not _exists(spark, layout, layout.silver)
        new = to_silver(_bronze_day(spark, layout, one), lenient)
        if dedup_keys and not first and not layout.versioned:
            _merge_day_by_keys(spark, layout, new, one, dedup_keys)
            continue
        if dedup_keys or layout.versioned:
            existing = None if first else read_published(spark, layout, layout.silver)
            by_day = ["load_date"] if dedup_keys and not layout.versioned else None
            _publish(layout, merge_silver(new, existing, dedup_keys), layout.silver, by_day)
            continue
        if first:
            write_partitions(merge_silver(new, None), layout.silver, "load_date")
            continue
        stored = read_partition(spark, layout.silver, "load_date", one)
        if one in known:
            # The write replaces the partition this plan reads: materialise it first.
            merged = cut_lineage(merge_silver(new, stored))
        else:  # none of the day's rows are there: bronze left few copies
            merged = drop_copies(new.unionByName(stored, allowMissingColumns=True))
        write_partitions(merged, layout.silver, "load_date")
    return days


def _same_key(left: DataFrame, right: DataFrame, keys: list[str]) -> list:
    return [left[k].eqNullSafe(right[f"_{k}"]) for k in keys]


def _kept_aside(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to a scratch folder once (compressed, which a checkpoint is not)."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**PARQUET_OPTIONS).parquet(path)
    return df.sparkSession.read.parquet(path)


def _merge_day_by_keys(spark: SparkSession, layout: Layout, new: DataFrame, day: str, keys: list[str]) -> None:
    """Merge one load day into a silver table that holds a row per key, the earliest load first."""
    # The day's rows are shuffled once and kept aside; all that follows reads them there.
    new = _kept_aside(merge_silver(new, None, keys), "silver-day")
    wanted = new.select(*(F.col(k).alias(f"_{k}") for k in keys))
    stored = read_table(spark, layout.silver).select(*keys, "load_date")
    held = cut_lineage(stored.join(wanted, _same_key(stored, wanted, keys), "left_semi"))  # of the history, what the day has too
    one = F.lit(day).cast("date")
    earlier = held.filter(F.col("load_date") < one).select(*(F.col(k).alias(f"_{k}") for k in keys))
    new = new.join(earlier, _same_key(new, earlier, keys), "left_anti")
    losing = [r[0] for r in held.filter(F.col("load_date") > one).select("load_date").distinct().collect()]  # load days
    stored = read_partition(spark, layout.silver, "load_date", day)
    again = day in partition_values(spark, layout.silver, "load_date")
    merged = merge_silver(new, stored, keys) if again else new.unionByName(stored, allowMissingColumns=True)
    if losing:
        later = read_table(spark, layout.silver).filter(F.col("load_date").isin(losing))
        winners = new.select(*(F.col(k).alias(f"_{k}") for k in keys))
        merged = merged.unionByName(later.join(winners, _same_key(later, winners, keys), "left_anti"), allowMissingColumns=True)
    if losing or again:  # the write replaces partitions that this plan reads
        merged = _kept_aside(merged, "silver-merged")
    write_partitions(merged, layout.silver, "load_date")
    if not losing:
        return
    left = {r[0] for r in merged.select("load_date").distinct().collect()}
    for d in set(losing) - left:  # a day that lost all its rows
        delete_path(spark, f"{layout.silver}/load_date={d}")


def run_gold(spark: SparkSession, layout: Layout, stable_ids: bool = False) -> dict[str, str]:
    """All gold outputs from silver. The seven counts come from one grouping-sets
    aggregate (one scan, one write); the dimensions are materialised once and feed both their
    own table and the fact join."""
    pin_utc(spark)
    silver = read_published(spark, layout, layout.silver)
    written: dict[str, str] = {}

    _publish(layout, gold.all_gold_counts(silver), layout.gold(COUNTS), partition_by=["gold_table"])
    written[COUNTS] = layout.gold(COUNTS)
    _publish(layout, keyword_totals(silver), layout.gold(KEYWORDS))
    written[KEYWORDS] = layout.gold(KEYWORDS)

    def dimension(name: str, build) -> DataFrame:
        existing = None
        if stable_ids and _exists(spark, layout, layout.gold(name)):
            existing = read_published(spark, layout, layout.gold(name))
        # Written once; the fact join reads the published copy (the old one is only
        # read while the new one is staged).
        _publish(layout, build(silver, existing), layout.gold(name))
        written[name] = layout.gold(name)
        return read_published(spark, layout, layout.gold(name))

    dims = run_concurrently({
        "dim_author": lambda: dimension("dim_author", gold.dim_author),
        "dim_source": lambda: dimension("dim_source", gold.dim_source),
    })
    authors, sources = dims["dim_author"], dims["dim_source"]
    _publish(layout, gold.fact_articles(silver, authors, sources), layout.gold("articles"))
    written["articles"] = layout.gold("articles")
    return written


def _held_totals(spark: SparkSession, layout: Layout) -> tuple[DataFrame | None, dict[str, str]]:
    """The running totals and the versions of the days that they hold."""
    if not _exists(spark, layout, layout.gold(COUNTS)):
        return None, {}
    totals = read_published(spark, layout, layout.gold(COUNTS))
    held = gold.applied(totals)
    return (totals, held) if held else (None, {})  # those of a full rebuild name no days


def _version_path(layout: Layout, day: str, version: str) -> str:
    return f"{layout.gold('_counts_by_day')}/load_date={day}/version={version}"


def _new_totals(spark: SparkSession, layout: Layout, silver_day: DataFrame, day: str) -> DataFrame:
    totals, held = _held_totals(spark, layout)
    version = uuid.uuid4().hex[:12]
    read = lambda d, v: spark.read.parquet(_version_path(layout, d, v))
    gold.day_counts(silver_day).write.parquet(_version_path(layout, day, version))
    plus, versions = [read(day, version)], held | {day: version}
    minus = [read(day, held[day])] if day in held else []
    if totals is None and _exists(spark, layout, layout.gold(COUNTS)):
        for d in set(partition_values(spark, layout.silver, "load_date")) - set(versions):
            gold.day_counts(read_partition(spark, layout.silver, "load_date", d)).write.parquet(_version_path(layout, d, version))
            plus.append(read(d, version))
            versions[d] = version
    return gold.change_totals(totals, plus, minus, versions)


def _drop_old_versions(spark: SparkSession, layout: Layout) -> None:
    """Versions of a day's counts that the published totals do not hold."""
    _, held = _held_totals(spark, layout)
    for d in partition_values(spark, layout.gold("_counts_by_day"), "load_date"):
        for v in partition_values(spark, f"{layout.gold('_counts_by_day')}/load_date={d}", "version"):
            if held.get(d) != v:
                delete_path(spark, _version_path(layout, d, v))


def _keyword_totals_by_states(spark: SparkSession, layout: Layout, silver_day: DataFrame, day: str) -> DataFrame:
    states = layout.gold("_words_by_day")
    known = set(word_states.days_held(spark, states))
    word_states.store_days(silver_day, states, [day])
    for d in set(partition_values(spark, layout.silver, "load_date")) - known - {day}:  # days before there were states
        word_states.store_days(read_partition(spark, layout.silver, "load_date", d), states, [d])
    top = [r["Palavra"] for r in word_states.top_words_over_days(spark, states, TOP_KEYWORDS).collect()]
    return word_states.keyword_daily_total(spark, states, layout.silver, top)


def run_gold_day(spark: SparkSession, layout: Layout, day: str | None = None) -> dict[str, str]:
    """Incremental gold for one load day (default: the newest silver day); reads only
    that day's silver partition, and re-running a day gives the same gold.

    * counts: the day's seven grouping-set counts are kept as a version of that day; what the day
      counted before is taken off the totals and the new counts are added, so a run costs the groups,
      not days x groups. The totals name the versions that they hold and are published with
      those names at once, so a run that failed at any point is repeated without counting twice;
    * keyword totals: from the word states of all days (``operators.word_states``);
    * dimensions: stable ids, extended with the day's new authors and sources;
    * facts: the day's articles with their ids replace that day's fact partition.

    Days of silver that the totals do not hold (gold was built in full so far) are counted first, in
    one pass. Ids are stable (numbered in first-seen-day order, then value order), unlike
    ``run_gold``, which renumbers everything in value order."""
    pin_utc(spark)
    day = day or latest_partition_value(spark, layout.silver, "load_date")
    if day is None:
        return {}
    day = str(day)
    silver_day = read_partition(spark, layout.silver, "load_date", day)
    written: dict[str, str] = {}

    def counts() -> None:
        _publish(layout, _new_totals(spark, layout, silver_day, day), layout.gold(COUNTS), partition_by=["gold_table"])
        written[COUNTS] = layout.gold(COUNTS)
        _drop_old_versions(spark, layout)

    def keyword_totals_by_states() -> None:
        _publish(layout, _keyword_totals_by_states(spark, layout, silver_day, day), layout.gold(KEYWORDS))
        written[KEYWORDS] = layout.gold(KEYWORDS)

    def dimension(name: str, build) -> DataFrame:
        existing = read_published(spark, layout, layout.gold(name)) if _exists(spark, layout, layout.gold(name)) else None
        _publish(layout, build(silver_day, existing), layout.gold(name))
        written[name] = layout.gold(name)
        return read_published(spark, layout, layout.gold(name))

    dims = run_concurrently({
        "dim_author": lambda: dimension("dim_author", gold.dim_author),
        "dim_source": lambda: dimension("dim_source", gold.dim_source),
        COUNTS: counts,
        KEYWORDS: keyword_totals_by_states,
    })
    authors, sources = dims["dim_author"], dims["dim_source"]
    write_partitions(gold.fact_articles(silver_day, authors, sources), layout.gold("articles"), "load_date")
    written["articles"] = layout.gold("articles")
    return written


def run_daily(spark: SparkSession, layout: Layout, load_date: dt.date | str | None = None,
              stable_ids: bool = False, incremental_gold: bool = False, multi_line: bool = False) -> dict[str, str]:
    """bronze -> silver -> gold, each step only when its input exists. With
    ``incremental_gold`` the gold step reads only the days just loaded (``run_gold_day``);
    ``multi_line`` reads landed files of the original layout."""
    day = run_bronze(spark, layout, load_date, multi_line)
    days = run_silver(spark, layout)
    if day and day not in days:  # a day loaded again
        days += run_silver(spark, layout, day=day)
    if not days:
        return {}
    if not incremental_gold:
        return run_gold(spark, layout, stable_ids)
    written: dict[str, str] = {}
    for one in days:
        written = run_gold_day(spark, layout, one)
    return written
