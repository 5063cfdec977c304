"""Registered queries of article search: boolean queries, the inverted index, seek paging."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmart import fixtures as fx
from newsmart.operators import search, text_index
from newsmart.plans.registry import register
from newsmart.session import pin_utc, scratch_path

_ART = fx.ORACLE_SEARCHABLE


def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return fx.searchable_articles(spark, sf_dir)


def _holds(phrase: str, fields=search.SEARCH_IN_OPTIONS) -> str:
    return "(" + " OR ".join(f"coalesce(contains(lower({f}), '{phrase.lower()}'), false)" for f in fields) + ")"


BOOLEAN_Q = '+(ouen OR "and the") -"by of" tion NOT (eau AND ment)'


@register("article_search_boolean", ("RA-1",), fx.oracle(
    f"SELECT * FROM arts WHERE ({_holds('ouen')} OR {_holds('and the')}) AND NOT {_holds('by of')} "
    f"AND NOT ({_holds('eau')} AND {_holds('ment')})",
    _ART,
))
def article_search_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search_articles(_articles(spark, sf_dir), q=BOOLEAN_Q, boolean=True)


def _indexed(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "text-index")
    text_index.index_articles(_articles(spark, sf_dir), path, F.col("load_date"))
    return path


PHRASE = "n the o"


@register("article_search_indexed", ("RA-1",), fx.oracle(f"SELECT * FROM arts WHERE {_holds(PHRASE)}", _ART))
def article_search_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A phrase that begins and ends within words, by the index of the three load days."""
    return text_index.search(spark, _indexed(spark, sf_dir), PHRASE)


INDEXED_Q = '"Es the" OR (eauou AND "la " NOT qu)'


@register("article_search_indexed_boolean", ("RA-1",), fx.oracle(
    f"SELECT * FROM arts WHERE load_date IN (DATE '2024-02-01', DATE '2024-02-03') AND "
    f"({_holds('es the', ['title', 'content'])} OR ({_holds('eauou', ['title', 'content'])} AND "
    f"{_holds('la ', ['title', 'content'])} AND NOT {_holds('qu', ['title', 'content'])}))",
    _ART,
))
def article_search_indexed_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A boolean query over two fields of two load days, as set operations on the phrases' hits."""
    path = _indexed(spark, sf_dir)
    return text_index.search_boolean(spark, path, INDEXED_Q, "title,content", ["2024-02-01", "2024-02-03"])


PAGE = 20


def _page_sql(order: str, extra: str = "") -> str:
    return f"SELECT *{extra} FROM arts ORDER BY {order}published_ts DESC NULLS LAST, url NULLS LAST LIMIT {PAGE} OFFSET {2 * PAGE}"


def _third_page(df: DataFrame, **kwargs) -> DataFrame:
    token = None
    for _ in range(3):
        page, token = search.page_after(df, token, page_size=PAGE, **kwargs)
    return page


@register("search_seek_page", ("RA-6",), fx.oracle(_page_sql(""), _ART))
def search_seek_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third page, each found behind the last row of the one before."""
    return _third_page(_articles(spark, sf_dir))


def _relevance_sql(q: str) -> str:
    return " + ".join(f"coalesce(len(regexp_extract_all(lower({f}), '\\Q{q}\\E')), 0)" for f in search.SEARCH_IN_OPTIONS)


@register("search_seek_relevancy", ("RA-1", "RA-6"), fx.oracle(
    _page_sql("relevance DESC, ", f", CAST({_relevance_sql('tion')} AS INTEGER) AS relevance"), _ART
))
def search_seek_relevancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _third_page(_articles(spark, sf_dir), sort_by="relevancy", q="tion")


@register("search_popularity", ("RA-6",), fx.oracle(
    "SELECT a.*, coalesce(p.n, 0) AS popularity FROM arts a LEFT JOIN (SELECT source_id, count(*) AS n FROM arts GROUP BY source_id) p "
    f"USING (source_id) ORDER BY popularity DESC, published_ts DESC NULLS LAST, url NULLS LAST LIMIT {PAGE} OFFSET {2 * PAGE}", _ART
))
def search_popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third page of articles of the sources with most articles, by seeking."""
    return _third_page(_articles(spark, sf_dir), sort_by="popularity")
