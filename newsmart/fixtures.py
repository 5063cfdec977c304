"""News articles derived from the driver's ``documents`` table (FIXTURES.md §3).

The reference ships no data, so the registered queries land articles built from
``documents`` by Spark itself; their volume grows with the table. Every document
becomes one article with its *whole* text as description and content, and its first
line as title. Nulls, ``[Removed]`` titles and missing sources are injected by fixed
rules on ``doc_id``; no row is filtered out. Publication times fall on a calendar of
120 days at any number of documents, so days, windows and pages grow with the table, and
articles share title and time. Some have no time, empty content or white space around it.
Landing holds every article twice: page 1, and a re-delivered page 2 copy with null
content; every fifth a third time, on page 1 again with other content, a tie that only the
content decides.

``ORACLE_CHAIN`` is the same derivation (plus bronze and silver) in DuckDB SQL, used
by ``oracle_sql()``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmart.operators.bronze import to_bronze
from newsmart.operators.silver import to_silver

# Fixed values of the fixture: base instant, days of the calendar, seconds between two
# documents' times of day, first load day, landing windows of the completeness report.
BASE_TS = "2023-11-15 00:00:00"
CALENDAR_DAYS = 120
SPACING_SECONDS = 97 * 60
BASE_LOAD_DATE = "2024-02-01"
REPORT_WINDOWS = 6


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def article_base(spark: SparkSession, sf_dir: str, by_day: bool = False) -> DataFrame:
    """``by_day`` deals the documents by their load day, each text once."""
    d = read(spark, sf_dir, "documents")
    if by_day:
        d = d.withColumn("_day", F.col("doc_id") % 3).hint("rebalance", "_day")
    doc = F.col("doc_id")
    published = F.lit(BASE_TS).cast("timestamp_ntz") + F.make_dt_interval(
        (doc % CALENDAR_DAYS).cast("int"), F.lit(0), F.lit(0), ((doc % 1440) * SPACING_SECONDS % 86400).cast("decimal(18,6)")
    )
    return d.select(
        doc,
        _null_when(doc % 3 == 0, F.col("source")).alias("source_id"),
        _null_when(doc % 41 == 0, F.concat(F.lit("name_"), F.col("source"))).alias("source_name"),
        _null_when(doc % 7 == 0, F.concat(F.col("lang"), F.lit("_author_"), (doc % 17).cast("string"))).alias("author"),
        F.when(doc % 23 == 0, F.lit("[Removed]"))
        .when(doc % 29 == 0, F.lit(None))
        .otherwise(F.substring_index(F.col("text"), "\n", 1))
        .alias("title"),
        _null_when(doc % 13 == 0, F.col("text")).alias("description"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/a/"), doc.cast("string")).alias("url"),
        F.when(doc % 11 == 0, F.lit(None))
        .when(doc % 19 == 0, F.lit(""))
        .when(doc % 17 == 0, F.concat(F.lit("  "), F.col("text"), F.lit(" \t")))
        .otherwise(F.col("text"))
        .alias("content"),
        F.col("lang").alias("language"),
        _null_when(doc % 31 == 0, F.date_format(published, "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("publishedAt"),
        F.date_trunc("hour", published).cast("timestamp_ntz").alias("window_start"),
        F.date_add(F.lit(BASE_LOAD_DATE).cast("date"), (doc % 3).cast("int")).alias("load_date"),
    )


def landing_articles(spark: SparkSession, sf_dir: str, by_day: bool = False) -> DataFrame:
    """Flat landing rows as ``read_landing`` yields them: article columns (``source``
    nested) + ``load_date``, ``window_start`` (the hourly landing window) and ``page``."""
    base = article_base(spark, sf_dir, by_day)
    source = F.struct(F.col("source_id").alias("id"), F.col("source_name").alias("name"))
    # All deliveries come from one scan: (page, delivery).
    delivery = lambda page, n: F.struct(F.lit(page).alias("page"), F.lit(n).alias("delivery"))
    twice = F.array(delivery(1, 1), delivery(2, 1))
    again = F.array(delivery(1, 1), delivery(2, 1), delivery(1, 2))
    paged = base.select("*", F.inline(F.when(F.col("doc_id") % 5 == 0, again).otherwise(twice)))
    content = (
        F.when(F.col("page") == 2, F.lit(None))
        .when(F.col("delivery") == 2, F.concat(F.lit("again "), F.col("url")))
        .otherwise(F.col("content"))
    )
    return paged.select(
        source.alias("source"), "author", "title", "description", "url",
        F.lit(None).cast("string").alias("urlToImage"), "publishedAt",
        content.alias("content"), "language", "load_date", "window_start", "page",
    )


def bronze_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_bronze(landing_articles(spark, sf_dir))


def silver_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(bronze_articles(spark, sf_dir))


ORACLE_CHAIN = r"""
article_base AS (
  SELECT doc_id,
    CASE WHEN doc_id % 3 = 0 THEN NULL ELSE source END AS source_id,
    CASE WHEN doc_id % 41 = 0 THEN NULL ELSE 'name_' || source END AS source_name,
    CASE WHEN doc_id % 7 = 0 THEN NULL ELSE lang || '_author_' || CAST(doc_id % 17 AS VARCHAR) END AS author,
    CASE WHEN doc_id % 23 = 0 THEN '[Removed]' WHEN doc_id % 29 = 0 THEN NULL
         ELSE split_part(text, chr(10), 1) END AS title,
    CASE WHEN doc_id % 13 = 0 THEN NULL ELSE text END AS description,
    'https://' || source || '.example.com/a/' || CAST(doc_id AS VARCHAR) AS url,
    CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 19 = 0 THEN ''
         WHEN doc_id % 17 = 0 THEN '  ' || text || ' ' || chr(9) ELSE text END AS content,
    lang AS language,
    CASE WHEN doc_id % 31 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS publishedAt,
    date_trunc('hour', ts) AS window_start,
    DATE '2024-02-01' + CAST(doc_id % 3 AS INTEGER) AS load_date
  FROM (SELECT *, TIMESTAMP '2023-11-15 00:00:00' + to_days(CAST(doc_id % 120 AS INTEGER))
                    + to_seconds((doc_id % 1440) * 5820 % 86400) AS ts FROM documents)
),
landing AS (
  SELECT source_id, source_name, author, title, description, url, CAST(NULL AS VARCHAR) AS urlToImage,
         publishedAt, content, language, load_date, window_start, 1 AS page
  FROM article_base
  UNION ALL
  SELECT source_id, source_name, author, title, description, url, CAST(NULL AS VARCHAR) AS urlToImage,
         publishedAt, CAST(NULL AS VARCHAR) AS content, language, load_date, window_start, 2 AS page
  FROM article_base
  UNION ALL
  SELECT source_id, source_name, author, title, description, url, CAST(NULL AS VARCHAR) AS urlToImage,
         publishedAt, 'again ' || url AS content, language, load_date, window_start, 1 AS page
  FROM article_base WHERE doc_id % 5 = 0
),
bronze AS (
  SELECT source_id, source_name, author, title, description, url, urlToImage, publishedAt, content, language, load_date
  FROM (SELECT *, row_number() OVER (PARTITION BY title, publishedAt
                                     ORDER BY window_start NULLS LAST, page NULLS LAST, url NULLS LAST,
                                              md5(concat_ws(chr(31), source_id, source_name, author, title, description, urlToImage,
                                                            publishedAt, content, language))) AS rn
        FROM landing)
  WHERE rn = 1
),
silver AS (
  SELECT coalesce(author, 'Não Informado') AS author, title, description, url, urlToImage,
         CAST(ts AS DATE) AS publishedAt, content, language, load_date,
         CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
         source_id, source_name
  FROM (SELECT *, strptime(publishedAt, '%Y-%m-%dT%H:%M:%SZ') AS ts FROM bronze)
  WHERE title IS DISTINCT FROM '[Removed]'
)
"""


def oracle(sql: str, extra_ctes: str = "") -> str:
    """Prefix ``sql`` with the fixture chain (and optional extra CTEs)."""
    chain = ORACLE_CHAIN.strip()
    if extra_ctes:
        chain = chain + ",\n" + extra_ctes.strip()
    return f"WITH {chain}\n{sql.strip()}"


def oracle_by_day(sql: str, extra_ctes: str = "") -> str:
    """``oracle`` for runs that load each day by itself: copies are dropped within a load day."""
    return oracle(sql, extra_ctes).replace("PARTITION BY title, publishedAt", "PARTITION BY load_date, title, publishedAt")


def searchable_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze articles, source flattened, with the publication instant as
    ``published_ts`` (TIMESTAMP_NTZ in UTC) for interval search and sorting."""
    from newsmart.functions import parse_timestamp
    from newsmart.operators.bronze import flatten_source

    b = flatten_source(bronze_articles(spark, sf_dir))
    return b.withColumn("published_ts", parse_timestamp("publishedAt").cast("timestamp_ntz"))


def source_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per ``documents.source``: its language (that of its first document),
    document count, and a category and country assigned from the source number."""
    from newsmart.operators.search import CATEGORY_OPTIONS, COUNTRY_OPTIONS

    d = read(spark, sf_dir, "documents")
    per = d.groupBy(F.col("source").alias("source_id")).agg(
        F.min_by("lang", "doc_id").alias("language"), F.count(F.lit(1)).alias("documents")
    )
    n = F.regexp_extract("source_id", r"(\d+)$", 1).cast("int")
    cats = F.array(*[F.lit(c) for c in CATEGORY_OPTIONS])
    ctry = F.array(*[F.lit(c) for c in COUNTRY_OPTIONS])
    return per.select(
        "source_id",
        F.element_at(cats, (n % len(CATEGORY_OPTIONS)) + 1).alias("category"),
        "language",
        F.element_at(ctry, (n % len(COUNTRY_OPTIONS)) + 1).alias("country"),
        "documents",
    )


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing log for the completeness report, one row per landed envelope: ``window_start``,
    ``page``, ``totalResults`` as stated and ``n_articles``. Every document is an article of one
    of six hourly windows and of a page of 100, so windows and pages grow with the table. Every
    third window states 250 articles more than it has; every other one lost the pages whose
    number is a multiple of 4. First pages were delivered twice, the second time shortened."""
    doc = F.col("doc_id")
    nth = F.floor(doc / REPORT_WINDOWS)
    window = (doc % REPORT_WINDOWS).cast("int")
    pages = (
        read(spark, sf_dir, "documents").select(window.alias("w"), (F.floor(nth / 100) + 1).cast("int").alias("page"))
        .groupBy("w", "page").agg(F.count(F.lit(1)).alias("n_articles"))
    )
    totals = pages.groupBy("w").agg(F.sum("n_articles").alias("n"))
    stated = totals.select("w", (F.col("n") + F.when(F.col("w") % 3 == 0, 250).otherwise(0)).cast("long").alias("totalResults"))
    landed = pages.join(stated, "w").filter((F.col("w") % 2 == 0) | (F.col("page") % 4 != 0))
    deliveries = F.when(F.col("page") == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    again = landed.select("*", F.explode(deliveries).alias("again"))
    start = F.lit(BASE_TS).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("w"))
    return again.select(
        start.alias("window_start"), "page", "totalResults",
        (F.col("n_articles") - F.col("again")).cast("long").alias("n_articles"),
    )


ORACLE_SEARCHABLE = r"""
arts AS (
  SELECT *, strptime(publishedAt, '%Y-%m-%dT%H:%M:%SZ') AS published_ts FROM bronze
)
"""


def landing_envelopes(spark: SparkSession, sf_dir: str, by_day: bool = False) -> DataFrame:
    """Landing rows as response envelopes ready for the landing writer: one envelope
    per delivered article (so no page is ever gathered into one row here), landed on
    the article's load day. ``by_day``: dealt by that day before an article is delivered several times."""
    from newsmart.schemas import ARTICLE_COLUMNS

    rows = landing_articles(spark, sf_dir, by_day)
    article = F.struct(*[F.col(c) for c in ARTICLE_COLUMNS])
    return rows.select(
        F.lit("ok").alias("status"), F.lit(1).cast("long").alias("totalResults"),
        F.array(article).alias("articles"), "window_start", "page",
        F.col("load_date").alias("ingest_date"),
    )
