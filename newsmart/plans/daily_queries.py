"""Registered queries of the states kept by load day, keyword tables, window sweeps and file choice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmart import fixtures as fx
from newsmart.functions.text import date_prefix
from newsmart.operators import gold, keyword_table, keywords, search, windows, word_states
from newsmart.operators.bronze import flatten_source
from newsmart.plans import medallion
from newsmart.plans.queries import _KEYWORD_CTES, _arriving_days, _catalogue_sql, _grouping_sets_oracle, _silver
from newsmart.plans.registry import register
from newsmart.session import pin_utc, scratch_path
from newsmart.sources.tables import read_latest_written, read_table
from newsmart.sources.writers import path_exists, write_bronze
from newsmart.streaming import completeness, incremental

# ---------------------------------------------------------------- gold in O(day)


def _days_of_gold(spark: SparkSession, sf_dir: str, name: str) -> medallion.Layout:
    """The three load days, each with its incremental gold; then the second day's once more."""
    pin_utc(spark)
    layout = medallion.Layout(scratch_path(spark, name))
    days = []
    for _ in _arriving_days(spark, sf_dir, layout):
        days.append(medallion.run_bronze(spark, layout))
        medallion.run_silver(spark, layout)
        medallion.run_gold_day(spark, layout)
    medallion.run_gold_day(spark, layout, days[1])
    return layout


def _by_day(sql: str) -> str:
    return sql.replace("PARTITION BY title, publishedAt", "PARTITION BY load_date, title, publishedAt")


@register("gold_running_totals", ("AGG-1", "AGG-2", "AGG-3", "AGG-4", "AGG-5", "AGG-6", "AGG-7", "SNK-5"), _by_day(_grouping_sets_oracle()))
def gold_running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seven published counts as running totals, changed by each day's difference."""
    layout = _days_of_gold(spark, sf_dir, "running-totals")
    totals = medallion.read_published(spark, layout, layout.gold(medallion.COUNTS))
    return totals.filter(F.col("gold_table") != gold.APPLIED).select("gold_table", *gold.GROUPING_COLUMNS, "number_articles")


@register("keyword_totals_by_state", ("AGG-15", "TOP-2"), fx.oracle_by_day(
    "SELECT keyword, year, month, day, CAST(coalesce(sum(occurrences), 0) AS BIGINT) AS occurrences FROM occ "
    "WHERE year IS NOT NULL AND month IS NOT NULL AND day IS NOT NULL GROUP BY keyword, year, month, day",
    _KEYWORD_CTES,
))
def keyword_totals_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published totals of the top three words, from the word states of the three days."""
    layout = _days_of_gold(spark, sf_dir, "keyword-states")
    return medallion.read_published(spark, layout, layout.gold(medallion.KEYWORDS))


_TOP = 50


@register("top_words_over_days", ("AGG-12", "TOP-2"), fx.oracle(
    f"SELECT Palavra, Quantidade FROM word_counts ORDER BY Quantidade DESC, Palavra LIMIT {_TOP}", _KEYWORD_CTES
))
def top_words_over_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent words of all load days by the threshold algorithm over the days' states."""
    silver = _silver(spark, sf_dir)
    path = scratch_path(spark, "word-states")
    word_states.store_days(silver, path)
    return word_states.top_words_over_days(spark, path, _TOP)


@register("daily_run_late_keys", ("SET-2", "DST-2", "SRC-3"), fx.oracle_by_day(
    "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY load_date, url NULLS LAST) AS rn FROM silver) WHERE rn = 1"
))
def daily_run_late_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver with one row a title, the earliest load first, where the newest load day lands first: later
    days lose rows to the older ones, and only their partitions are rewritten."""
    pin_utc(spark)
    layout = medallion.Layout(scratch_path(spark, "daily-run-keys"))
    for _ in _arriving_days(spark, sf_dir, layout, late_first=True):
        medallion.run_bronze(spark, layout)
        medallion.run_silver(spark, layout, dedup_keys=["title"])
    return read_table(spark, layout.silver)


@register("stream_completeness", ("RA-8", "MTH-1"), """
    WITH art AS (SELECT CAST(doc_id % 6 AS INTEGER) AS w, doc_id // 6 // 100 + 1 AS page FROM documents),
    stated AS (SELECT w, count(*) + CASE WHEN w % 3 = 0 THEN 250 ELSE 0 END AS total FROM art GROUP BY w),
    pages AS (SELECT w, page, count(*) AS n, page % 3 AS batch FROM art WHERE w % 2 = 0 OR page % 4 <> 0 GROUP BY w, page),
    upto AS (
      SELECT w, b.batch, total, (total + 99) // 100 AS expected, count(page) AS landed, CAST(coalesce(sum(n), 0) AS BIGINT) AS articles,
             min(p.batch) AS first_batch
      FROM range(3) b(batch) JOIN stated ON true JOIN pages p USING (w) WHERE p.batch <= b.batch GROUP BY w, b.batch, total
    ),
    done AS (SELECT w, min(batch) AS batch FROM upto WHERE landed >= expected AND articles >= total GROUP BY w),
    timer AS (SELECT w, greatest(min(batch), CASE WHEN w <= 3 THEN 0 WHEN w = 4 THEN 1 ELSE 2 END) AS batch FROM upto GROUP BY w),
    reports AS (
      SELECT t.w, t.batch, 'incomplete' AS status FROM timer t LEFT JOIN done d USING (w) WHERE d.batch IS NULL OR d.batch > t.batch
      UNION ALL
      SELECT d.w, d.batch, CASE WHEN d.batch > t.batch THEN 'complete_late' ELSE 'complete' END FROM done d JOIN timer t USING (w)
    )
    SELECT TIMESTAMP '2023-11-15 00:00:00' + to_hours(w) AS window_start, status, CAST(total AS BIGINT) AS total_results,
           CAST(expected AS BIGINT) AS expected_pages, landed AS landed_pages, articles AS landed_articles
    FROM reports JOIN upto USING (w, batch)
""")
def stream_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports on six landing windows whose pages land in three batches, an hour apart, the first six
    hours after the first window: four windows are past their deadline then, the others after the next ones."""
    pin_utc(spark)
    root = scratch_path(spark, "stream-completeness")
    batch = (F.col("page") % 3).cast("int")
    landed_at = F.lit(fx.BASE_TS).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(6) + batch)
    pages = fx.landed_pages(spark, sf_dir).withColumn("landed_at", landed_at).withColumn("arrival", batch)
    pages.hint("rebalance", "arrival").write.partitionBy("arrival").parquet(f"{root}/outside")
    for one in range(3):
        if not path_exists(spark, f"{root}/outside/arrival={one}"):
            continue
        arrived = spark.read.parquet(f"{root}/outside/arrival={one}")
        arrived.write.mode("append").parquet(f"{root}/pages")
        reports = completeness.completeness_stream(spark.readStream.schema(arrived.schema).parquet(f"{root}/pages"))
        incremental.run_to_parquet(reports, f"{root}/reports", f"{root}/_checkpoint", spark.sparkContext.defaultParallelism)
    return spark.read.parquet(f"{root}/reports")


# ---------------------------------------------------------------- many keywords

_MANY = 300


def _many(k: int) -> str:
    return _KEYWORD_CTES + f""",
many AS (SELECT Palavra FROM word_counts ORDER BY Quantidade DESC, Palavra LIMIT {k}),
many_occ AS (
  SELECT Palavra AS keyword, year, month, day,
         CAST((length(t) - length(replace(t, lower(Palavra), ''))) // length(lower(Palavra)) AS INTEGER) AS occurrences
  FROM (SELECT *, lower(description) AS t FROM silver) CROSS JOIN many
  WHERE year IS NOT NULL AND month IS NOT NULL AND day IS NOT NULL
)"""


def _most_frequent(silver: DataFrame, k: int) -> list[str]:
    return keywords.top_keywords(keywords.word_counts(silver), k)


@register("keyword_histogram_many", ("AGG-13", "FLT-4", "STR-4"), fx.oracle(
    "SELECT keyword, year, month, day, occurrences, count(*) AS contagem FROM many_occ WHERE occurrences > 0 "
    "GROUP BY keyword, year, month, day, occurrences",
    _many(_MANY),
))
def keyword_histogram_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The histogram of the 300 most frequent words, as literals, in one pass over the texts."""
    silver = _silver(spark, sf_dir)
    return keyword_table.keyword_histogram(silver, _most_frequent(silver, _MANY))


@register("keyword_daily_total_many", ("AGG-15", "STR-4"), fx.oracle(
    "SELECT keyword, year, month, day, CAST(coalesce(sum(occurrences), 0) AS BIGINT) AS occurrences FROM many_occ "
    "GROUP BY keyword, year, month, day",
    _many(_MANY),
))
def keyword_daily_total_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = _silver(spark, sf_dir)
    return keyword_table.keyword_daily_total(silver, _most_frequent(silver, _MANY))


# ---------------------------------------------------------------- windows, files, catalogue, dates


@register("window_counts_overlapping", ("RA-7",), fx.oracle(
    """
    SELECT w.window_start, w.window_end, count(a.published_ts) AS articles
    FROM wins w LEFT JOIN arts a ON a.published_ts BETWEEN w.window_start AND w.window_end
    GROUP BY w.window_start, w.window_end
    """,
    fx.ORACLE_SEARCHABLE + """,
    wins AS (
      SELECT TIMESTAMP '2023-11-15 00:00:00' + to_hours(CAST(i AS INTEGER)) AS window_start,
             TIMESTAMP '2023-11-15 00:00:00' + to_hours(CAST(i AS INTEGER)) + INTERVAL 7 DAY AS window_end
      FROM range(2880) t(i)
    )
    """,
))
def window_counts_overlapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window of seven days from each hour of the calendar: an article is in 169 of them."""
    pin_utc(spark)
    start = F.lit(fx.BASE_TS).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))
    wins = spark.range(24 * fx.CALENDAR_DAYS).select(start.alias("window_start"))
    wins = wins.withColumn("window_end", F.col("window_start") + F.expr("interval 7 days"))
    return windows.count_per_window(fx.searchable_articles(spark, sf_dir), wins)


@register("silver_latest_written", ("SRC-3",), fx.oracle("SELECT * FROM bronze WHERE load_date = DATE '2024-02-02'"))
def silver_latest_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze partition written last, which is not the newest day's: the second day is stored again."""
    pin_utc(spark)
    path = scratch_path(spark, "bronze")
    write_bronze(fx.bronze_articles(spark, sf_dir), path)
    again = fx.bronze_articles(spark, sf_dir).filter(F.col("load_date") == F.lit("2024-02-02").cast("date"))
    write_bronze(again, path)
    return flatten_source(read_latest_written(spark, path, "load_date"))


@register("published_dates", ("STR-6",), fx.oracle(
    "SELECT split_part(publishedAt, 'T', 1) AS published_date, count(*) AS articles FROM bronze GROUP BY 1"
))
def published_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles by the date part of their publication time, as text."""
    pin_utc(spark)
    day = date_prefix("publishedAt").alias("published_date")
    return fx.bronze_articles(spark, sf_dir).groupBy(day).agg(F.count(F.lit(1)).alias("articles"))


@register("source_catalogue_filtered", ("RA-11",), fx.oracle(
    f"SELECT 'category' AS chosen, * FROM catalogue WHERE category = '{search.CATEGORY_OPTIONS[1]}' UNION ALL "
    f"SELECT 'country' AS chosen, * FROM catalogue WHERE country = '{search.COUNTRY_OPTIONS[2]}' UNION ALL "
    f"SELECT 'both' AS chosen, * FROM catalogue WHERE category = '{search.CATEGORY_OPTIONS[0]}' AND language = 'en' "
    f"AND country = '{search.COUNTRY_OPTIONS[0]}'",
    _catalogue_sql(),
))
def source_catalogue_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue by category, by country, and by all three parameters."""
    catalogue = fx.source_catalogue(spark, sf_dir)
    chosen = {
        "category": search.filter_catalogue(catalogue, category=search.CATEGORY_OPTIONS[1]),
        "country": search.filter_catalogue(catalogue, country=search.COUNTRY_OPTIONS[2]),
        "both": search.filter_catalogue(catalogue, search.CATEGORY_OPTIONS[0], "en", search.COUNTRY_OPTIONS[0]),
    }
    first, *rest = (df.select(F.lit(name).alias("chosen"), *catalogue.columns) for name, df in chosen.items())
    for df in rest:
        first = first.unionByName(df)
    return first
