"""

Every query reads the driver's tables (through ``newsmart.fixtures``) and returns a
DataFrame; those that land, stream, publish or number rows run jobs while being built.
Each carries an equivalent DuckDB oracle over the same tables;
column names are aliased identically on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmart import fixtures as fx
from newsmart.functions.text import HOST_PATTERN, WHITESPACE_RUN
from newsmart.operators import analysis, gold, keywords, search, windows
from newsmart.operators.bronze import flatten_source
from newsmart.operators.keys import number_rows
from newsmart.operators.silver import merge_silver
from newsmart.plans import medallion
from newsmart.plans.registry import register
from newsmart.schemas import SILVER
from newsmart.session import pin_utc, run_concurrently, scratch_path
from newsmart.sources import landing as landing_src
from newsmart.sources.tables import partition_values, read_latest_partition, read_table
from newsmart.sources.writers import archive_days, path_exists, write_bronze, write_landing
from newsmart.streaming import incremental, reconciled


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return fx.silver_articles(spark, sf_dir)


# ---------------------------------------------------------------- landing / bronze / silver


@register(
    "landing_articles", ("SRC-1", "SRC-5", "SET-1", "STC-1", "JSN-1", "JSN-2"),
    fx.oracle("SELECT * FROM landing"),
)
def landing_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture landed as JSON Lines and read back."""
    pin_utc(spark)
    path = scratch_path(spark, "landing")
    write_landing(fx.landing_envelopes(spark, sf_dir), path)
    rows = flatten_source(landing_src.read_landing(spark, path))
    return rows.withColumnRenamed("ingest_date", "load_date").drop("_file", "totalResults")


@register("bronze_dedup", ("DST-1",), fx.oracle("SELECT * FROM bronze"))
def bronze_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return flatten_source(fx.bronze_articles(spark, sf_dir))


@register(
    "silver_articles",
    ("FLT-1", "FLT-2", "NUL-1", "DAT-1", "DAT-2", "DAT-3", "DAT-4", "DAT-5", "PRJ-2", "PRJ-3"),
    fx.oracle("SELECT * FROM silver"),
)
def silver_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)


# ---------------------------------------------------------------- gold aggregates

_AGG_QUERY_NAMES = {
    "articles_by_year": "aggregateByYear",
    "articles_by_month": "aggregateByMonth",
    "articles_by_day": "aggregateByDay",
    "articles_by_ymd": "aggregateByYearMonthDay",
    "articles_by_source": "aggregateBySource",
    "articles_by_author": "aggregateByAuthor",
    "articles_by_source_author": "aggregateBySourceAuthor",
}
_AGG_IDS = dict(zip(_AGG_QUERY_NAMES, ("AGG-1", "AGG-2", "AGG-3", "AGG-4", "AGG-5", "AGG-6", "AGG-7")))


def _register_gold_aggregate(qname: str, table: str) -> None:
    keys = gold.GOLD_AGGREGATES[table]
    k = ", ".join(keys)
    sql = fx.oracle(f"SELECT {k}, count(content) AS number_articles FROM silver GROUP BY {k}")

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return gold.count_articles(_silver(spark, sf_dir), keys)

    run.__name__ = qname
    register(qname, (_AGG_IDS[qname], "PRJ-4"), sql)(run)


for _q, _t in _AGG_QUERY_NAMES.items():
    _register_gold_aggregate(_q, _t)


def _grouping_sets_oracle() -> str:
    cols = gold.GROUPING_COLUMNS
    sets = ", ".join("(" + ", ".join(keys) + ")" for keys in gold.GOLD_AGGREGATES.values())
    gid = f"grouping_id({', '.join(cols)})"
    case = " ".join(
        f"WHEN {gid} = {gold.grouping_id_of(keys)} THEN '{t}'" for t, keys in gold.GOLD_AGGREGATES.items()
    )
    return fx.oracle(
        f"SELECT CASE {case} END AS gold_table, {', '.join(cols)}, count(content) AS number_articles "
        f"FROM silver GROUP BY GROUPING SETS ({sets})"
    )


@register("gold_grouping_sets", ("AGG-1", "AGG-2", "AGG-3", "AGG-4", "AGG-5", "AGG-6", "AGG-7"), _grouping_sets_oracle())
def gold_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.all_gold_counts(_silver(spark, sf_dir))


# ---------------------------------------------------------------- dimensions and fact

_DIM_AUTHOR_SQL = """
dim_author AS (
  SELECT row_number() OVER (ORDER BY author NULLS LAST) - 1 AS id_authors, author
  FROM (SELECT DISTINCT author FROM silver)
),
dim_source AS (
  SELECT row_number() OVER (ORDER BY source_name NULLS LAST) - 1 AS source_id, source_name
  FROM (SELECT DISTINCT source_name FROM silver)
)
"""


@register("dim_author", ("DST-3", "KEY-1"), fx.oracle("SELECT * FROM dim_author", _DIM_AUTHOR_SQL))
def dim_author(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_author(_silver(spark, sf_dir))


@register("dim_source", ("DST-3", "KEY-2"), fx.oracle("SELECT * FROM dim_source", _DIM_AUTHOR_SQL))
def dim_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_source(_silver(spark, sf_dir))


@register(
    "fact_articles", ("JON-1", "JON-2", "PRJ-3"),
    fx.oracle(
        """
        SELECT s.title, s.description, s.url, s.urlToImage, s.publishedAt, s.content, s.language,
               s.load_date, s.year, s.month, s.day, a.id_authors, d.source_id
        FROM silver s
        LEFT JOIN dim_author a ON s.author IS NOT DISTINCT FROM a.author
        LEFT JOIN dim_source d ON s.source_name IS NOT DISTINCT FROM d.source_name
        """,
        _DIM_AUTHOR_SQL,
    ),
)
def fact_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = _silver(spark, sf_dir)
    dims = run_concurrently({"a": lambda: gold.dim_author(silver), "s": lambda: gold.dim_source(silver)})
    return gold.fact_articles(silver, dims["a"], dims["s"])


# ---------------------------------------------------------------- notebook analysis


@register(
    "rows_by_date", ("AGG-8", "FLT-5"),
    fx.oracle("SELECT day, month, year, count(*) AS quantidade FROM silver "
              "WHERE day IS NOT NULL AND month IS NOT NULL AND year IS NOT NULL GROUP BY day, month, year"),
)
def rows_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.rows_by_date(_silver(spark, sf_dir))


@register(
    "rows_by_month", ("AGG-9", "FLT-5"),
    fx.oracle("SELECT month, count(*) AS quantidade FROM silver WHERE month IS NOT NULL GROUP BY month"),
)
def rows_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.rows_by_month(_silver(spark, sf_dir))


@register(
    "rows_by_year", ("AGG-10", "FLT-5"),
    fx.oracle("SELECT year, count(*) AS quantidade FROM silver WHERE year IS NOT NULL GROUP BY year"),
)
def rows_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.rows_by_year(_silver(spark, sf_dir))


@register(
    "top_sources", ("AGG-11", "TOP-1"),
    fx.oracle("SELECT source_name, count(*) AS quantidade FROM silver WHERE source_name IS NOT NULL "
              "GROUP BY source_name ORDER BY quantidade DESC, source_name LIMIT 10"),
)
def top_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.top_sources(_silver(spark, sf_dir), 10)


@register(
    "source_author_ranked", ("SRT-1",),
    fx.oracle("SELECT source_name, author, count(content) AS number_articles FROM silver "
              "GROUP BY source_name, author ORDER BY number_articles DESC, source_name NULLS LAST, author NULLS LAST"),
)
def source_author_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = gold.count_articles(_silver(spark, sf_dir), ["source_name", "author"])
    return analysis.ranked(counts, "number_articles", ["source_name", "author"])


@register("silver_export_csv", ("SNK-6",), fx.oracle("SELECT * FROM silver"))
def silver_export_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver exported as CSV (the spreadsheet export) and read back with its schema."""
    from newsmart.sources.writers import export_csv, read_csv_export

    silver = _silver(spark, sf_dir)
    path = scratch_path(spark, "silver-csv")
    export_csv(silver, path)
    return read_csv_export(spark, path, silver.schema)


@register("silver_head", ("LIM-1",), fx.oracle("SELECT * FROM silver ORDER BY url LIMIT 2"))
def silver_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.head(_silver(spark, sf_dir), 2, ["url"])


def _profile_oracle() -> str:
    parts = [
        f"SELECT {i} AS position, '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS data_type, "
        f"count({f.name}) AS non_null, count(*) AS row_count FROM silver"
        for i, f in enumerate(SILVER.fields)
    ]
    return fx.oracle("\nUNION ALL\n".join(parts))


@register("silver_profile", ("PRF-1",), _profile_oracle())
def silver_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.profile(_silver(spark, sf_dir))


# ---------------------------------------------------------------- words and keywords

_KEYWORD_CTES = f"""
word_counts AS (
  SELECT w AS Palavra, count(*) AS Quantidade
  FROM (SELECT unnest(string_split_regex(description, '{WHITESPACE_RUN}')) AS w FROM silver)
  WHERE length(w) > 4
  GROUP BY w
),
top3 AS (
  SELECT Palavra, Quantidade, row_number() OVER (ORDER BY Quantidade DESC, Palavra) AS rank
  FROM word_counts ORDER BY Quantidade DESC, Palavra LIMIT 3
),
occ AS (
  SELECT t.rank, t.Palavra AS keyword, s.year, s.month, s.day,
         CAST(len(regexp_extract_all(lower(s.description), lower(t.Palavra))) AS INTEGER) AS occurrences
  FROM silver s CROSS JOIN top3 t
)
"""


def _keywords_input(spark: SparkSession, sf_dir: str):
    silver = _silver(spark, sf_dir)
    return silver, keywords.top_keyword_array(keywords.word_counts(silver), 3)


@register(
    "word_counts", ("AGG-12", "STR-1", "STR-2", "FLT-3", "PRJ-4"),
    fx.oracle("SELECT * FROM word_counts", _KEYWORD_CTES),
)
def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords.word_counts(_silver(spark, sf_dir))


@register(
    "top_words", ("TOP-2", "SRT-2"),
    fx.oracle("SELECT Palavra, Quantidade FROM top3", _KEYWORD_CTES),
)
def top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords.top_words(keywords.word_counts(_silver(spark, sf_dir)), 3)


@register(
    "keyword_histogram", ("AGG-13", "FLT-4", "STR-3", "STR-4", "PRJ-5"),
    fx.oracle(
        "SELECT keyword, year, month, day, occurrences, count(*) AS contagem FROM occ "
        "WHERE year IS NOT NULL AND month IS NOT NULL AND day IS NOT NULL AND occurrences IS NOT NULL "
        "AND occurrences <> 0 GROUP BY keyword, year, month, day, occurrences",
        _KEYWORD_CTES,
    ),
)
def keyword_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver, slots = _keywords_input(spark, sf_dir)
    return keywords.keyword_histogram(keywords.keyword_occurrences(silver, slots))


@register(
    "keyword_daily_total", ("AGG-15",),
    fx.oracle(
        "SELECT keyword, year, month, day, CAST(coalesce(sum(occurrences), 0) AS BIGINT) AS occurrences FROM occ "
        "WHERE year IS NOT NULL AND month IS NOT NULL AND day IS NOT NULL GROUP BY keyword, year, month, day",
        _KEYWORD_CTES,
    ),
)
def keyword_daily_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver, slots = _keywords_input(spark, sf_dir)
    return keywords.keyword_daily_total(keywords.keyword_occurrences(silver, slots))


@register(
    "keyword_all_daily", ("AGG-14", "BOO-1", "STR-5"),
    fx.oracle(
        """
        SELECT s.year, s.month, s.day,
               count(*) FILTER (WHERE coalesce(regexp_matches(lower(s.description), lower(k.k1)), false)
                                  AND coalesce(regexp_matches(lower(s.description), lower(k.k2)), false)
                                  AND coalesce(regexp_matches(lower(s.description), lower(k.k3)), false)) AS todas_top3
        FROM silver s CROSS JOIN (SELECT max(Palavra) FILTER (WHERE rank = 1) AS k1,
                                         max(Palavra) FILTER (WHERE rank = 2) AS k2,
                                         max(Palavra) FILTER (WHERE rank = 3) AS k3 FROM top3) k
        WHERE s.year IS NOT NULL AND s.month IS NOT NULL AND s.day IS NOT NULL
        GROUP BY s.year, s.month, s.day
        """,
        _KEYWORD_CTES,
    ),
)
def keyword_all_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver, slots = _keywords_input(spark, sf_dir)
    return keywords.all_keywords_daily(silver, slots)


# ---------------------------------------------------------------- search (re-aimed API surface)


_ART = fx.ORACLE_SEARCHABLE
SEARCH_Q = "ouen"


def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return fx.searchable_articles(spark, sf_dir)


def _sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


@register(
    "article_search", ("RA-1",),
    fx.oracle(
        f"SELECT * FROM arts WHERE coalesce(contains(lower(title), '{SEARCH_Q}'), false) "
        f"OR coalesce(contains(lower(description), '{SEARCH_Q}'), false) "
        f"OR coalesce(contains(lower(content), '{SEARCH_Q}'), false)",
        _ART,
    ),
)
def article_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search_articles(_articles(spark, sf_dir), q=SEARCH_Q)


@register(
    "article_search_title", ("RA-1",),
    fx.oracle(f"SELECT * FROM arts WHERE coalesce(contains(lower(title), '{SEARCH_Q}'), false)", _ART),
)
def article_search_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search_articles(_articles(spark, sf_dir), q=SEARCH_Q, search_in="title")


_SOURCES = ["src0", "src1", "src2"]


@register(
    "search_sources", ("RA-2",),
    fx.oracle(f"SELECT * FROM arts WHERE source_id IN ({_sql_list(_SOURCES)})", _ART),
)
def search_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search_articles(_articles(spark, sf_dir), sources=_SOURCES)


_DOMAINS = ["example.net", "example.org"]
_EXCLUDE = ["blog.tionsh.example.net", "ththed.example.org"]


def _host_sql(col: str) -> str:
    return f"nullif(lower(regexp_extract({col}, '{HOST_PATTERN}', 2)), '')"


def _domain_sql(host: str, domains) -> str:
    return "(" + " OR ".join(f"({host} = '{d}' OR ends_with({host}, '.{d}'))" for d in domains) + ")"


@register(
    "search_domains", ("RA-3",),
    fx.oracle(
        f"SELECT page_id, url, host FROM (SELECT page_id, url, {_host_sql('url')} AS host FROM pages) "
        f"WHERE coalesce({_domain_sql('host', _DOMAINS)}, false) "
        f"AND NOT coalesce({_domain_sql('host', _EXCLUDE)}, false)"
    ),
)
def search_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newsmart.functions import url_host

    pages = fx.read(spark, sf_dir, "pages").select("page_id", "url", url_host("url").alias("host"))
    return pages.filter(search.domain_filter(_DOMAINS, _EXCLUDE))


_FROM, _TO, _LANG = "2023-12-01T00:00:00", "2023-12-15T23:59:59", "en"


@register(
    "search_interval", ("RA-4",),
    fx.oracle(
        f"SELECT * FROM arts WHERE published_ts >= TIMESTAMP '{_FROM}' AND published_ts <= TIMESTAMP '{_TO}' "
        f"AND language = '{_LANG}'",
        _ART,
    ),
)
def search_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search_articles(_articles(spark, sf_dir), date_from=_FROM, date_to=_TO, language=_LANG)


@register(
    "search_page", ("RA-6",),
    fx.oracle("SELECT * FROM arts ORDER BY published_ts DESC NULLS LAST, url NULLS LAST LIMIT 20 OFFSET 20", _ART),
)
def search_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.sort_and_page(_articles(spark, sf_dir), "publishedAt", page_size=20, page=2)


def _relevance_sql(q: str) -> str:
    return " + ".join(
        f"coalesce(len(regexp_extract_all(lower({f}), '\\Q{q.lower()}\\E')), 0)" for f in search.SEARCH_IN_OPTIONS
    )


@register(
    "search_relevancy", ("RA-1", "RA-6"),
    fx.oracle(
        f"SELECT *, CAST({_relevance_sql(SEARCH_Q)} AS INTEGER) AS relevance FROM arts "
        f"WHERE coalesce(contains(lower(title), '{SEARCH_Q}'), false) "
        f"OR coalesce(contains(lower(description), '{SEARCH_Q}'), false) "
        f"OR coalesce(contains(lower(content), '{SEARCH_Q}'), false) "
        "ORDER BY relevance DESC, published_ts DESC NULLS LAST, url NULLS LAST LIMIT 10",
        _ART,
    ),
)
def search_relevancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.search_articles(_articles(spark, sf_dir), q=SEARCH_Q)
    return search.sort_and_page(found, "relevancy", page_size=10, page=1, q=SEARCH_Q)


_REQUESTED = ["src0", "src1", "nope"]


@register(
    "unknown_sources", ("RA-5",),
    fx.oracle(
        "SELECT r.source_id FROM (VALUES " + ", ".join(f"('{s}')" for s in _REQUESTED) + ") r(source_id) "
        "WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.source = r.source_id)"
    ),
)
def unknown_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalogue = fx.source_catalogue(spark, sf_dir)
    return search.unknown_sources(spark, _REQUESTED, catalogue)


def _catalogue_sql() -> str:
    cats = "[" + _sql_list(search.CATEGORY_OPTIONS) + "]"
    ctry = "[" + _sql_list(search.COUNTRY_OPTIONS) + "]"
    return (
        "catalogue AS (\n"
        "  SELECT source AS source_id,\n"
        f"    ({cats})[CAST(regexp_extract(source, '(\\d+)$', 1) AS INTEGER) % {len(search.CATEGORY_OPTIONS)} + 1] AS category,\n"
        "    arg_min(lang, doc_id) AS language,\n"
        f"    ({ctry})[CAST(regexp_extract(source, '(\\d+)$', 1) AS INTEGER) % {len(search.COUNTRY_OPTIONS)} + 1] AS country,\n"
        "    count(*) AS documents\n"
        "  FROM documents GROUP BY source\n)"
    )


@register(
    "source_catalogue", ("RA-11",),
    fx.oracle("SELECT * FROM catalogue WHERE language = 'en'", _catalogue_sql()),
)
def source_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.filter_catalogue(fx.source_catalogue(spark, sf_dir), language="en")


@register(
    "request_check", ("RA-12",),
    fx.oracle(
        "SELECT request_id, position, name FROM ("
        "  SELECT page_id AS request_id, CAST(unnest(range(len(parts))) AS INTEGER) AS position,"
        "         split_part(unnest(parts), '=', 1) AS name"
        "  FROM (SELECT page_id, list_filter(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&'), lambda x: x <> '') AS parts"
        "        FROM pages))"
        f" WHERE name NOT IN ({_sql_list(search.REQUEST_PARAMETERS)})"
    ),
)
def request_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = fx.read(spark, sf_dir, "pages")
    return search.unknown_parameters(search.query_parameters(pages))


# ---------------------------------------------------------------- batch windows


@register(
    "window_counts", ("RA-7", "DAT-6", "DAT-7"),
    fx.oracle(
        """
        SELECT w.window_start, w.window_end, count(a.published_ts) AS articles,
               strftime(w.window_start, '%Y-%m-%dT%H:%M:%S') AS "from",
               strftime(w.window_end, '%Y-%m-%dT%H:%M:%S') AS "to"
        FROM wins w LEFT JOIN arts a ON a.published_ts BETWEEN w.window_start AND w.window_end
        GROUP BY w.window_start, w.window_end
        """,
        _ART + """,
        wins AS (
          SELECT CAST(d AS TIMESTAMP) AS window_start, CAST(d AS TIMESTAMP) + INTERVAL 86399 SECOND AS window_end
          FROM (SELECT (SELECT max(CAST(substr(publishedAt, 1, 10) AS DATE)) FROM landing) - CAST(i AS INTEGER) AS d FROM range(50) t(i))
        )
        """,
    ),
)
def window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    arts = _articles(spark, sf_dir)
    # The newest day is that of the landed rows: no deduplication is needed to know it.
    last_day = fx.article_base(spark, sf_dir).select(F.to_date(F.max(F.substring("publishedAt", 1, 10)))).scalar()
    wins = windows.backfill_windows(spark, last_day, 50)
    return windows.window_bounds_text(windows.count_per_window(arts, wins, "published_ts"))


@register(
    "landing_completeness", ("RA-8", "MTH-1"),
    """
    WITH art AS (
      SELECT CAST(doc_id % 6 AS INTEGER) AS w, doc_id // 6 // 100 + 1 AS page FROM documents
    ),
    stated AS (
      SELECT w, count(*) + CASE WHEN w % 3 = 0 THEN 250 ELSE 0 END AS total_results FROM art GROUP BY w
    ),
    landed AS (SELECT * FROM art WHERE w % 2 = 0 OR page % 4 <> 0)
    SELECT window_start, total_results, expected_pages, landed_pages, landed_articles,
           greatest(expected_pages - landed_pages, 0) AS missing_pages,
           landed_pages >= expected_pages AND landed_articles >= total_results AS complete
    FROM (
      SELECT TIMESTAMP '2023-11-15 00:00:00' + to_hours(w) AS window_start, total_results,
             CAST((total_results + 99) // 100 AS BIGINT) AS expected_pages,
             count(DISTINCT page) AS landed_pages, count(*) AS landed_articles
      FROM landed JOIN stated USING (w) GROUP BY w, total_results)
    """,
)
def landing_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return windows.landing_completeness(fx.landed_pages(spark, sf_dir), 100)


# ---------------------------------------------------------------- silver merge, latest partition, stable ids


_DAY2 = "2024-02-02"


@register(
    "silver_merge", ("SET-2", "DST-2"),
    fx.oracle(f"SELECT * FROM silver WHERE load_date >= DATE '{_DAY2}' UNION "
              f"SELECT * FROM silver WHERE load_date <= DATE '{_DAY2}'"),
)
def silver_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing silver holds load days 1-2, the new load re-delivers day 2 and adds
    day 3: whole-row duplicates collapse."""
    silver = _silver(spark, sf_dir)
    day2 = F.lit(_DAY2).cast("date")
    return merge_silver(silver.filter(F.col("load_date") >= day2), silver.filter(F.col("load_date") <= day2))


@register(
    "silver_merge_keys", ("SET-2", "DST-2", "DST-1"),
    fx.oracle(
        """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY title, publishedAt
                                       ORDER BY load_date NULLS LAST, url NULLS LAST, content NULLS LAST) AS rn
          FROM (SELECT * FROM silver UNION SELECT * REPLACE (load_date + 1 AS load_date) FROM silver))
        WHERE rn = 1
        """
    ),
)
def silver_merge_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every article re-delivered one load day later: with ``dedup_keys`` the earliest
    load wins (SURVEY Q6 option)."""
    silver = _silver(spark, sf_dir)
    redelivered = silver.withColumn("load_date", F.date_add("load_date", 1))
    return merge_silver(redelivered, silver, dedup_keys=["title", "publishedAt"])


@register(
    "silver_latest", ("SRC-3",),
    fx.oracle("SELECT * FROM bronze WHERE load_date = (SELECT max(load_date) FROM bronze)"),
)
def silver_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze rows of the newest load day, read from stored bronze: the day is found by
    listing folders, and only its files are opened."""
    pin_utc(spark)
    path = scratch_path(spark, "bronze")
    write_bronze(fx.bronze_articles(spark, sf_dir), path)
    return flatten_source(read_latest_partition(spark, path, "load_date"))


@register(
    "dim_author_stable", ("KEY-1", "RA-5"),
    fx.oracle(
        "SELECT * FROM old_dim UNION ALL SELECT * FROM new_dim",
        """
        old_dim AS (
          SELECT row_number() OVER (ORDER BY author NULLS LAST) - 1 AS id_authors, author
          FROM (SELECT DISTINCT author FROM silver WHERE language = 'en')
        ),
        new_dim AS (
          SELECT (SELECT coalesce(max(id_authors) + 1, 0) FROM old_dim)
                 + row_number() OVER (ORDER BY author NULLS LAST) - 1 AS id_authors, author
          FROM (SELECT DISTINCT author FROM silver s
                WHERE NOT EXISTS (SELECT 1 FROM old_dim o WHERE o.author IS NOT DISTINCT FROM s.author))
        )
        """,
    ),
)
def dim_author_stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids kept from an earlier dimension (built from English articles); authors seen
    since are numbered after its maximum (SURVEY Q10 option)."""
    silver = _silver(spark, sf_dir)
    old = gold.dim_author(silver.filter(F.col("language") == "en"))
    return gold.dim_author(silver, existing=old)


# ---------------------------------------------------------------- streaming


@register(
    "incremental_bronze", ("RA-9", "SNK-1", "SNK-2", "SRC-4", "SRC-5", "JSN-1", "JSN-2"),
    fx.oracle_by_day("SELECT * FROM bronze"),
)
def incremental_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the fixture as JSON pages (on each article's load day), load bronze from
    them with a file stream in several micro-batches, and return the deduplicated
    bronze."""
    pin_utc(spark)
    root = scratch_path(spark, "incremental-bronze")
    write_landing(fx.landing_envelopes(spark, sf_dir), f"{root}/landing", compression="gzip")
    incremental.run_incremental_bronze(
        spark, f"{root}/landing", f"{root}/bronze", f"{root}/_checkpoint", max_files_per_trigger=_files_a_batch(spark)
    )
    stored = incremental.read_incremental_bronze(spark, f"{root}/bronze")
    return flatten_source(stored).drop("window_start", "page")


def _files_a_batch(spark: SparkSession) -> int:
    """As many landing files a micro-batch as there are cores, a third of them in these queries,
    whose landing zone has three days and so three files at least."""
    return max(1, spark.sparkContext.defaultParallelism // 8)


def _state_partitions(spark: SparkSession) -> int:
    """Streaming state sized to the cluster: one partition per core."""
    return spark.sparkContext.defaultParallelism


@register(
    "stream_dedup", ("RA-10", "DST-1"),
    fx.oracle("SELECT title, publishedAt, count(*) AS copies FROM bronze GROUP BY title, publishedAt"),
)
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming dedup of landed pages over several micro-batches. The copy kept is the first to
    arrive, which depends on the files; that each key is there, and once, does not."""
    pin_utc(spark)
    root = scratch_path(spark, "stream-dedup")
    write_landing(fx.landing_envelopes(spark, sf_dir), f"{root}/landing", compression="gzip")
    kept = incremental.append_new_articles(
        spark, f"{root}/landing", f"{root}/out", f"{root}/_checkpoint", max_files_per_trigger=_files_a_batch(spark)
    )
    return kept.groupBy("title", "publishedAt").agg(F.count(F.lit(1)).alias("copies"))


@register(
    "stream_hourly_counts", ("RA-10",),
    fx.oracle(
        """
        SELECT * FROM (
          SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
                 time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
                 event_type, count(*) AS n
          FROM events GROUP BY ALL)
        WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR
        """
    ),
)
def stream_hourly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly event counts per type from a file stream of the ``events`` table staged
    by day. A window is emitted once the 2-hour watermark passes its end, so the windows of
    the last two hours are not in the result: they are still open."""
    pin_utc(spark)
    root = scratch_path(spark, "stream-hourly")
    events = fx.read(spark, sf_dir, "events").withColumn("event_date", F.to_date("ts"))
    events.hint("rebalance", "event_date").write.partitionBy("event_date").parquet(f"{root}/events")
    stream = spark.readStream.schema(events.schema).parquet(f"{root}/events")
    counts = incremental.windowed_counts(stream, "ts", ("event_type",), "1 hour", "2 hours")
    incremental.run_to_parquet(counts, f"{root}/out", f"{root}/_checkpoint", _state_partitions(spark))
    return spark.read.parquet(f"{root}/out")


@register(
    "stream_late_counts", ("RA-10",),
    """
    WITH arrived AS (
      SELECT *, CASE WHEN event_id % 5 = 0 THEN 2 WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS batch FROM events WHERE ts IS NOT NULL
    ),
    marks AS (
      SELECT b.batch, (SELECT max(ts) FROM arrived a WHERE a.batch < b.batch) - INTERVAL 2 HOUR AS mark
      FROM (SELECT DISTINCT batch FROM arrived) b
    )
    SELECT * FROM (
      SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
             event_type, count(*) AS n,
             count(*) FILTER (WHERE coalesce(time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= mark, false)) AS late
      FROM arrived JOIN marks USING (batch) GROUP BY ALL)
    WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR
    """,
)
def stream_late_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly event counts per type where a third and then a fifth of all events come in a second and a
    third batch, far behind the watermark: none is lost, and each window says how many were late."""
    pin_utc(spark)
    root = scratch_path(spark, "stream-late")
    event = F.col("event_id")
    batch = F.when(event % 5 == 0, 2).when(event % 3 == 0, 1).otherwise(0)
    events = fx.read(spark, sf_dir, "events").withColumn("arrival", batch)
    events.hint("rebalance", "arrival").write.partitionBy("arrival").parquet(f"{root}/outside")
    for one in range(3):  # each arrival is a folder of its own, drained before the next one comes
        if path_exists(spark, f"{root}/outside/arrival={one}"):
            arrived = spark.read.parquet(f"{root}/outside/arrival={one}")
            arrived.write.mode("append").parquet(f"{root}/events")
            stream = spark.readStream.schema(arrived.schema).parquet(f"{root}/events")
            reconciled.run_reconciled_counts(stream, f"{root}/counts", f"{root}/_checkpoint", "ts", ("event_type",))
    return reconciled.read_reconciled_counts(spark, f"{root}/counts", ("event_type",))


# ---------------------------------------------------------------- the daily batch, end to end


@register(
    "daily_run", ("SNK-1", "SNK-2", "SNK-3", "SNK-4", "SNK-5", "SRC-2", "SRC-3", "SRC-4", "SET-2", "DST-2",
                  "JON-1", "JON-2"),
    fx.oracle_by_day(
        """
        SELECT s.title, s.description, s.url, s.urlToImage, s.publishedAt, s.content, s.language,
               s.load_date, s.year, s.month, s.day, a.id_authors, d.source_id
        FROM silver s
        LEFT JOIN dim_author a ON s.author IS NOT DISTINCT FROM a.author
        LEFT JOIN dim_source d ON s.source_name IS NOT DISTINCT FROM d.source_name
        """,
        _DIM_AUTHOR_SQL,
    ),
)
def daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's schedule on the fixture: each load day's pages are landed, then
    that day's bronze step (dedup, write, archive) and silver step (newest bronze day
    merged into silver, published by swap) run; the gold step runs after the last
    day. Returns the gold fact table as written."""
    pin_utc(spark)
    layout = medallion.Layout(scratch_path(spark, "daily-run"))
    for _ in _arriving_days(spark, sf_dir, layout):
        medallion.run_bronze(spark, layout)
        medallion.run_silver(spark, layout)
    written = medallion.run_gold(spark, layout)
    return medallion.read_published(spark, layout, written["articles"])


def _arriving_days(spark: SparkSession, sf_dir: str, layout: medallion.Layout, late_first: bool = False):
    """The schedule: the fixture is landed by one scan beside the landing zone, then each load
    day's folder is moved into it in turn (the last day first with ``late_first``)."""
    outside = f"{layout.root}/outside"
    write_landing(fx.landing_envelopes(spark, sf_dir, by_day=True), outside, compression="gzip", by_day=True)
    days = sorted(partition_values(spark, outside, "ingest_date"))
    for day in [days[-1], *days[:-1]] if late_first else days:
        archive_days(spark, outside, layout.landing, [day])
        yield day


_INCREMENTAL_DIMS = """
dim_author_inc AS (
  SELECT row_number() OVER (ORDER BY first_day, author NULLS LAST) - 1 AS id_authors, author
  FROM (SELECT author, min(load_date) AS first_day FROM silver GROUP BY author)
),
dim_source_inc AS (
  SELECT row_number() OVER (ORDER BY first_day, source_name NULLS LAST) - 1 AS source_id, source_name
  FROM (SELECT source_name, min(load_date) AS first_day FROM silver GROUP BY source_name)
)
"""


@register(
    "daily_run_incremental", ("SNK-5", "KEY-1", "KEY-2", "AGG-1", "JON-1", "JON-2"),
    fx.oracle_by_day(
        """
        SELECT s.title, s.description, s.url, s.urlToImage, s.publishedAt, s.content, s.language,
               s.load_date, s.year, s.month, s.day, a.id_authors, d.source_id
        FROM silver s
        LEFT JOIN dim_author_inc a ON s.author IS NOT DISTINCT FROM a.author
        LEFT JOIN dim_source_inc d ON s.source_name IS NOT DISTINCT FROM d.source_name
        """,
        _INCREMENTAL_DIMS,
    ),
)
def daily_run_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily schedule with incremental gold: after each load day's bronze and
    silver steps, gold is updated from that day's silver only. Returns the gold fact
    table as written (ids stable: numbered by first load day, then value)."""
    pin_utc(spark)
    layout = medallion.Layout(scratch_path(spark, "daily-run-incremental"))
    written = {}
    for _ in _arriving_days(spark, sf_dir, layout):
        written = medallion.run_daily(spark, layout, incremental_gold=True)
    return read_table(spark, written["articles"])


@register("daily_run_late_days", ("SRC-1", "SRC-3", "SNK-2", "SNK-3", "SET-2"), fx.oracle_by_day("SELECT * FROM silver"))
def daily_run_late_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after a late schedule: the newest load day lands first, the older ones after it;
    the silver step merges every bronze day that it doesn't hold yet."""
    pin_utc(spark)
    layout = medallion.Layout(scratch_path(spark, "daily-run-late"))
    for _ in _arriving_days(spark, sf_dir, layout, late_first=True):
        medallion.run_bronze(spark, layout)
        medallion.run_silver(spark, layout)
    return read_table(spark, layout.silver)


@register("stream_to_silver", ("RA-9", "SRC-4", "SET-2", "DST-1"), fx.oracle_by_day("SELECT * FROM silver"))
def stream_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver from the incremental bronze that the landing stream writes, days out of order."""
    pin_utc(spark)
    layout = medallion.Layout(scratch_path(spark, "stream-to-silver"))
    for _ in _arriving_days(spark, sf_dir, layout, late_first=True):
        incremental.run_incremental_bronze(spark, layout.landing, layout.bronze, f"{layout.root}/_checkpoint")
        medallion.run_silver(spark, layout)
    return read_table(spark, layout.silver)


@register("gold_counts_sorted", ("SRT-3", "AGG-7", "SNK-5"), fx.oracle_by_day(
    "SELECT source_name, author, count(content) AS number_articles, "
    "row_number() OVER (ORDER BY source_name NULLS LAST, author NULLS LAST) AS position "
    "FROM silver GROUP BY source_name, author"
))
def gold_counts_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A published gold count table, read back sorted by its keys, nulls last; ``position`` shows
    the order to an order-insensitive comparison."""
    pin_utc(spark)
    layout = medallion.Layout(scratch_path(spark, "gold-counts"))
    for _ in _arriving_days(spark, sf_dir, layout):
        medallion.run_bronze(spark, layout)
    medallion.run_silver(spark, layout)
    medallion.run_gold(spark, layout)
    rows = medallion.read_gold_counts(spark, layout, "aggregateBySourceAuthor")
    order = [F.asc_nulls_last("source_name"), F.asc_nulls_last("author")]
    return number_rows(rows, order, "_place").withColumn("position", F.col("_place") + 1).drop("_place")


@register("word_list_ranked", ("SRT-2", "AGG-12"), fx.oracle(
    "SELECT row_number() OVER (ORDER BY Quantidade DESC, Palavra) AS position, Palavra, Quantidade FROM word_counts",
    _KEYWORD_CTES,
))
def word_list_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords.ranked_words(keywords.word_counts(_silver(spark, sf_dir)))


def _top(k: int) -> str:
    return _KEYWORD_CTES.replace("LIMIT 3", f"LIMIT {k}")


@register("keyword_histogram_top5", ("AGG-13", "FLT-4", "PRJ-5"), fx.oracle(
    "SELECT keyword, year, month, day, occurrences, count(*) AS contagem FROM occ "
    "WHERE year IS NOT NULL AND month IS NOT NULL AND day IS NOT NULL AND occurrences IS NOT NULL "
    "AND occurrences <> 0 GROUP BY keyword, year, month, day, occurrences",
    _top(5),
))
def keyword_histogram_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = _silver(spark, sf_dir)
    top = keywords.top_keyword_array(keywords.word_counts(silver), 5)
    return keywords.keyword_histogram(keywords.keyword_occurrences(silver, top))


@register("keyword_daily_total_top5", ("AGG-15",), fx.oracle(
    "SELECT keyword, year, month, day, CAST(coalesce(sum(occurrences), 0) AS BIGINT) AS occurrences FROM occ "
    "WHERE year IS NOT NULL AND month IS NOT NULL AND day IS NOT NULL GROUP BY keyword, year, month, day",
    _top(5),
))
def keyword_daily_total_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = _silver(spark, sf_dir)
    return medallion.keyword_totals(silver, 5)


_WIDE = ["erand", "Erand", "title", "thion"]


@register("keyword_wide", ("PRJ-5", "STR-4"), fx.oracle(
    "SELECT *, " + ", ".join(
        f"CAST(len(regexp_extract_all(lower(description), '{w.lower()}')) AS INTEGER) AS {name}"
        for w, name in zip(_WIDE, ("erand", "kw_Erand", "kw_title", "thion"), strict=True)
    ) + " FROM silver"
))
def keyword_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide form, with words that differ in case only and one that is a column's name."""
    return keywords.with_keyword_columns(_silver(spark, sf_dir), _WIDE)
