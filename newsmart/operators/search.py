"""Article search over landed tables (RA-1..6, RA-11, RA-12).

The reference forwards these parameters to a remote search service after checking
them; here the same parameters filter, sort and page the landed articles with
DataFrame expressions. Matching rules are ours and documented per function.
"""

from __future__ import annotations

import base64
import datetime as dt
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmart.functions import count_matches, url_host
from newsmart.functions.columns import as_col
from newsmart.operators.boolean_query import boolean_match
from newsmart.session import cut_lineage

# The parameter values the search API accepts.
SEARCH_IN_OPTIONS = ("title", "description", "content")
CATEGORY_OPTIONS = ("business", "entertainment", "general", "health", "science", "sports", "technology")
LANGUAGE_OPTIONS = ("ar", "de", "en", "es", "fr", "he", "it", "nl", "no", "pt", "ru", "sv", "ud", "zh")
COUNTRY_OPTIONS = (
    "ae", "ca", "ch", "cn", "co", "cu", "cz", "de", "eg", "fr", "gb", "gr", "hk", "hu", "id", "ie", "il",
    "in", "it", "jp", "mx", "my", "ng", "nl", "no", "nz", "ph", "pl", "pt", "ro", "rs", "ru", "sa", "se",
    "sg", "si", "sk", "th", "za",
)
SORT_BY_OPTIONS = ("relevancy", "popularity", "publishedAt")
REQUEST_PARAMETERS = (
    "q", "searchIn", "sources", "domains", "excludeDomains", "from", "to", "language", "sortBy",
    "pageSize", "page",
)
MAX_SOURCES = 20


def _check_str_list(name: str, values) -> list[str]:
    if not isinstance(values, (list, tuple)):
        raise ValueError(f"'{name}' must be a list")
    for v in values:
        if not isinstance(v, str):
            raise ValueError(f"every item of '{name}' must be a string")
    return list(values)


def _check_option(name: str, value, options: Sequence[str]) -> None:
    if value is not None and value not in options:
        raise ValueError(f"'{name}' must be one of {', '.join(options)}; got {value!r}")


# ---------------------------------------------------------------- RA-1: phrase search


def search_fields(search_in: str | Sequence[str] | None) -> list[str]:
    if search_in is None:
        return list(SEARCH_IN_OPTIONS)
    fields = search_in.split(",") if isinstance(search_in, str) else list(search_in)
    for f in fields:
        _check_option("searchIn", f, SEARCH_IN_OPTIONS)
    return fields


def phrase_match(q: str, search_in: str | Sequence[str] | None = None) -> Column:
    """RA-1: the phrase ``q`` occurs (case-insensitive, literal) in any searched field."""
    phrase = F.lower(F.lit(q))
    conds = [F.coalesce(F.contains(F.lower(F.col(f)), phrase), F.lit(False)) for f in search_fields(search_in)]
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def query_match(q: str, search_in: str | Sequence[str] | None = None) -> Column:
    """RA-1: the boolean query ``q`` (``AND``/``OR``/``NOT``, ``+``/``-``, quotes, parentheses) matches."""
    return boolean_match(q, lambda phrase: phrase_match(phrase, search_in))


def relevance(q: str, search_in: str | Sequence[str] | None = None) -> Column:
    """Number of literal occurrences of ``q`` over the searched fields (RA-6 relevancy)."""
    parts = [F.coalesce(count_matches(f, q, literal=True), F.lit(0)) for f in search_fields(search_in)]
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out


# ---------------------------------------------------------------- RA-2/3: sources, domains


def source_filter(sources, col: str = "source_id") -> Column:
    """RA-2: at most 20 source ids, all strings."""
    ids = _check_str_list("sources", sources)
    if len(ids) > MAX_SOURCES:
        raise ValueError(f"at most {MAX_SOURCES} sources may be chosen")
    return F.coalesce(F.col(col).isin(ids), F.lit(False))


def _host_matches(host: Column, domains: list[str]) -> Column:
    conds = [(host == d.lower()) | host.endswith("." + d.lower()) for d in domains]
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return F.coalesce(out, F.lit(False))


def domain_filter(domains=None, exclude_domains=None, url_col: str = "url") -> Column:
    """RA-3: keep URLs whose host is, or is under, one of ``domains``; drop those under
    ``exclude_domains`` (a URL without a host is kept by an exclude-only filter)."""
    host = url_host(url_col)
    cond = F.lit(True)
    if domains is not None:
        d = _check_str_list("domains", domains)
        cond = cond & (_host_matches(host, d) if d else F.lit(False))
    if exclude_domains is not None:
        x = _check_str_list("excludeDomains", exclude_domains)
        if x:
            cond = cond & ~_host_matches(host, x)
    return cond


# ---------------------------------------------------------------- RA-4: interval, language


def _ts_literal(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, dt.datetime):
        v = v.isoformat()
    return F.to_timestamp(F.lit(str(v)))


def interval_filter(ts_col: str | Column, date_from=None, date_to=None) -> Column:
    """RA-4: ``from <= ts <= to``, both ends inclusive and optional."""
    ts = as_col(ts_col)
    cond = F.lit(True)
    if date_from is not None:
        cond = cond & (ts >= _ts_literal(date_from))
    if date_to is not None:
        cond = cond & (ts <= _ts_literal(date_to))
    return F.coalesce(cond, F.lit(False))


def language_filter(language: str, col: str = "language") -> Column:
    _check_option("language", language, LANGUAGE_OPTIONS)
    return F.coalesce(F.col(col) == language, F.lit(False))


def search_articles(
    df: DataFrame,
    q: str | None = None,
    search_in: str | Sequence[str] | None = None,
    sources=None,
    domains=None,
    exclude_domains=None,
    date_from=None,
    date_to=None,
    language: str | None = None,
    ts_col: str = "published_ts",
    boolean: bool = False,
) -> DataFrame:
    """RA-1..4 together: every given parameter narrows the result (a conjunction). ``q`` is one
    phrase, or with ``boolean`` a query in the search service's syntax.
    ``df`` needs the searched text fields, ``source_id``, ``url``, ``language`` and a
    timestamp ``ts_col`` for the interval."""
    cond = F.lit(True)
    if q is not None:
        cond = cond & (query_match if boolean else phrase_match)(q, search_in)
    elif search_in is not None:
        search_fields(search_in)
    if sources is not None:
        cond = cond & source_filter(sources)
    if domains is not None or exclude_domains is not None:
        cond = cond & domain_filter(domains, exclude_domains)
    if date_from is not None or date_to is not None:
        cond = cond & interval_filter(ts_col, date_from, date_to)
    if language is not None:
        cond = cond & language_filter(language)
    return df.filter(cond)


# ---------------------------------------------------------------- RA-6: sort and page


def with_popularity(df: DataFrame, popularity: DataFrame | None = None) -> DataFrame:
    """``df`` with the ``popularity`` of each article's source: that of the table ``popularity(source_id,
    popularity)``, or the source's number of articles in ``df``; 0 where it is not known."""
    if popularity is None:
        popularity = df.groupBy("source_id").agg(F.count(F.lit(1)).alias("popularity"))
    known = popularity.filter("source_id is not null").select("source_id", "popularity")
    return df.join(known, "source_id", "left").select(*df.columns, F.coalesce("popularity", F.lit(0)).alias("popularity"))


def _ranked(df: DataFrame, sort_by: str, q: str | None, search_in, popularity: DataFrame | None) -> tuple[DataFrame, str | None]:
    """``df`` with the column that ``sort_by`` puts before the time, and that column's name."""
    _check_option("sortBy", sort_by, SORT_BY_OPTIONS)
    if sort_by == "popularity":
        return with_popularity(df, popularity), "popularity"
    if sort_by == "relevancy":
        if q is None:
            raise ValueError("relevancy sorting needs q")
        return df.withColumn("relevance", relevance(q, search_in)), "relevance"
    return df, None


def sort_and_page(
    df: DataFrame,
    sort_by: str = "publishedAt",
    page_size: int = 100,
    page: int = 1,
    q: str | None = None,
    search_in: str | Sequence[str] | None = None,
    ts_col: str = "published_ts",
    popularity: DataFrame | None = None,
) -> DataFrame:
    """RA-6: newest first (ties by URL), by relevancy to ``q``, or by popularity of the source
    (``with_popularity``); then one page.

    Plans as a top-(page*size) ``TakeOrderedAndProject`` with an offset: each task keeps
    at most page*size rows."""
    if page_size < 1 or page < 1:
        raise ValueError("pageSize and page must be positive")
    df, rank = _ranked(df, sort_by, q, search_in, popularity)
    order = [F.desc_nulls_last(ts_col), F.asc_nulls_last("url")]
    order = [F.desc(rank), *order] if rank else order
    return df.orderBy(*order).offset((page - 1) * page_size).limit(page_size)


_TIES = "_ties"


def _token(values: dict) -> str:
    return base64.urlsafe_b64encode(json.dumps(values).encode()).decode()


def _values(token: str, sort_by: str) -> dict:
    try:
        out = json.loads(base64.urlsafe_b64decode(token.encode()))
        if set(out) == {"sort", "rank", "ts", "url", "ties", "seen"} and out["sort"] == sort_by:
            return out
    except ValueError:  # not base64, not UTF-8 or not JSON
        pass
    raise ValueError(f"not a continuation token of a {sort_by!r} search: {token!r}")


def _not_before(last: dict, ts_col: str, rank_col: str | None) -> Column:
    """Rows at or behind the last row of a page. Its first half, a plain range, can be pushed to a scan."""
    ts, url = F.col(ts_col), F.col("url")
    at = F.lit(last["ts"]).cast("timestamp_ntz")
    behind = F.lit(False) if last["ts"] is None else ts.isNull() | (ts < at)
    further = F.lit(False) if last["url"] is None else url.isNull() | (url > F.lit(last["url"]))
    same = ts.eqNullSafe(at) & (further | (url.eqNullSafe(F.lit(last["url"])) & (F.col(_TIES) >= last["ties"])))
    if rank_col:
        rank = F.col(rank_col)
        return (rank <= last["rank"]) & ((rank < last["rank"]) | behind | same)
    near = ts.isNull() if last["ts"] is None else ts.isNull() | (ts <= at)
    return near & (behind | same)


def page_after(
    df: DataFrame,
    token: str | None = None,
    sort_by: str = "publishedAt",
    page_size: int = 100,
    q: str | None = None,
    search_in: str | Sequence[str] | None = None,
    ts_col: str = "published_ts",
    ties: Sequence[str] | None = None,
    popularity: DataFrame | None = None,
) -> tuple[DataFrame, str | None]:
    """RA-6 by seeking: the page behind ``token`` (the first without one) in the order of
    ``sort_and_page``, and the token of the next page (None behind the last).

    A token holds the place of the page's last row, so a later page starts with a range filter
    and keeps ``page_size`` rows a task, whatever its number. Rows equal in time and URL are told
    apart by a hash of ``ties`` (default: all columns); rows equal in that too are counted."""
    if page_size < 1:
        raise ValueError("pageSize must be positive")
    given = df.columns
    df, rank = _ranked(df, sort_by, q, search_in, popularity)
    columns = df.columns
    keyed = df.withColumn(_TIES, F.xxhash64(*(ties or given)))
    order = [F.desc_nulls_last(ts_col), F.asc_nulls_last("url"), F.asc(_TIES)]
    order = [F.desc(rank), *order] if rank else order
    last = _values(token, sort_by) if token else None
    if last:
        keyed = keyed.filter(_not_before(last, ts_col, rank))
    page = keyed.orderBy(*order).offset(last["seen"] if last else 0).limit(page_size)
    page = cut_lineage(page)  # page_size rows, so that the token is that of the page returned
    key = {"rank": F.col(rank) if rank else F.lit(0), "ts": F.col(ts_col).cast("timestamp_ntz").cast("string"),
           "url": F.col("url"), "ties": F.col(_TIES)}
    rows = page.orderBy(*order).select(*(c.alias(n) for n, c in key.items())).collect()
    if len(rows) < page_size:
        return page.select(*columns), None
    end = rows[-1].asDict()
    seen = sum(r.asDict() == end for r in rows)
    if last and all(last[n] == end[n] for n in key):
        seen += last["seen"]
    return page.select(*columns), _token({"sort": sort_by, **end, "seen": seen})


# ---------------------------------------------------------------- RA-5, RA-11: source catalogue


def unknown_sources(spark: SparkSession, requested, catalogue: DataFrame, col: str = "source_id") -> DataFrame:
    """RA-5: requested ids missing from the catalogue. The request is a parameter list of at
    most 20 ids, so the catalogue is filtered by them first (the test reaches the scan); at
    most 20 rows of it meet the anti join."""
    ids = _check_str_list("sources", requested)
    if len(ids) > MAX_SOURCES:
        raise ValueError(f"at most {MAX_SOURCES} sources may be chosen")
    req = spark.createDataFrame([(i,) for i in ids], f"{col} string")
    known = catalogue.filter(F.col(col).isin(ids)).select(col).distinct()
    return req.join(known, col, "left_anti")


def filter_catalogue(
    catalogue: DataFrame, category: str | None = None, language: str | None = None, country: str | None = None
) -> DataFrame:
    """RA-11: sources filtered by category, language and country (checked values)."""
    _check_option("category", category, CATEGORY_OPTIONS)
    _check_option("language", language, LANGUAGE_OPTIONS)
    _check_option("country", country, COUNTRY_OPTIONS)
    cond = F.lit(True)
    for name, value in (("category", category), ("language", language), ("country", country)):
        if value is not None:
            cond = cond & (F.col(name) == value)
    return catalogue.filter(cond)


# ---------------------------------------------------------------- RA-12: request validation


def query_parameters(df: DataFrame, url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """Request log from URLs: ``(request_id, position, name, value)`` per query-string
    parameter (``?a=1&b=2``); URLs without a query string give no rows."""
    query = F.regexp_extract(F.col(url_col), r"\?([^#]*)", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: p != F.lit(""))
    return df.select(F.col(id_col).alias("request_id"), F.posexplode(pairs).alias("position", "pair")).select(
        "request_id", "position",
        F.substring_index("pair", "=", 1).alias("name"),
        F.when(F.instr("pair", "=") > 0, F.expr("substr(pair, instr(pair, '=') + 1)")).alias("value"),
    )


def unknown_parameters(params: DataFrame) -> DataFrame:
    """RA-12: parameter names a search request may not carry."""
    return params.filter(~F.col("name").isin(list(REQUEST_PARAMETERS))).select("request_id", "position", "name")
