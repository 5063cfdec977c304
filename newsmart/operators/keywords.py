"""Word frequency and keyword statistics (AGG-12..15, TOP-2, SRT-2, BOO-1, PRJ-5,
STR-1..5).

Semantics kept from the reference: words are split on whitespace, case and
punctuation kept, only words longer than 4 characters count (Q12, Q13). A keyword is
matched as a *regex* over the lower-cased description (Q14) unless ``literal``.

The top-k keywords never go through the driver: they are a scalar subquery (a
``TakeOrderedAndProject`` of k rows) whose k-element array is spliced into the
per-article expressions, so the whole analysis is one Spark plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmart.functions import contains_match, count_matches
from newsmart.functions.text import split_on_whitespace
from newsmart.operators.keys import number_rows

# The output names Palavra, Quantidade, contagem and todas_top3 are the reference's.
MIN_WORD_LENGTH = 4  # words must be strictly longer than this (the code says > 4)
DATE_KEYS = ["year", "month", "day"]


def _clean(word: Column, lower: bool, strip_punct: bool) -> Column:
    if lower:
        word = F.lower(word)
    if strip_punct:
        word = F.regexp_replace(word, r"^[\p{Punct}]+|[\p{Punct}]+$", "")
    return word


def words(df: DataFrame, col: str = "description", lower: bool = False, strip_punct: bool = False) -> DataFrame:
    """One row per word longer than 4 characters (``Palavra``).

    The split array is exploded first and every later step is a plain column
    expression, so the whole chain stays in generated code (array lambdas would be
    interpreted); the empty tokens of whitespace runs fall out with the length test."""
    raw = df.select(F.explode(split_on_whitespace(col)).alias("_w"))
    cleaned = raw.select(_clean(F.col("_w"), lower, strip_punct).alias("Palavra"))
    return cleaned.filter(F.length("Palavra") > MIN_WORD_LENGTH)


def word_counts(df: DataFrame, col: str = "description", lower: bool = False, strip_punct: bool = False) -> DataFrame:
    """AGG-12: ``(Palavra, Quantidade)``. The explode is pipelined into a partial
    count, so hot words are pre-aggregated in every task before the shuffle."""
    return words(df, col, lower, strip_punct).groupBy("Palavra").agg(F.count(F.lit(1)).alias("Quantidade"))


def top_words(counts: DataFrame, k: int = 3) -> DataFrame:
    """TOP-2 / SRT-2: the k most frequent words, ties by the word."""
    return counts.orderBy(F.desc("Quantidade"), F.asc("Palavra")).limit(k)


def top_keyword_array(counts: DataFrame, k: int = 3) -> Column:
    """The k most frequent words in rank order, as one array-valued scalar subquery
    (a k-row ``TakeOrderedAndProject`` gathered into one row: bounded by k)."""
    ranked = top_words(counts, k).select(
        F.transform(
            F.sort_array(
                F.collect_list(F.struct((-F.col("Quantidade")).alias("q"), F.col("Palavra").alias("w")))
            ),
            lambda e: e.getField("w"),
        ).alias("kw")
    )
    return ranked.scalar()


def ranked_words(counts: DataFrame) -> DataFrame:
    """SRT-2: the full word list with its ``position`` (from 1), most frequent first, ties by
    the word. Range-partitioned, so no task holds the list."""
    numbered = number_rows(counts, [F.desc("Quantidade"), F.asc("Palavra")], "_place")
    return numbered.select((F.col("_place") + 1).alias("position"), "Palavra", "Quantidade")


def _with_keywords(df: DataFrame, keywords: list[str] | Column, col: str) -> DataFrame:
    """``df`` reduced to date keys and the lower-cased text (lowered once for all
    keywords), with the keywords as one array column ``_kw``. The array (possibly a
    subquery, of any length) is referenced once, so it is evaluated once."""
    kw = keywords if isinstance(keywords, Column) else F.array(*[F.lit(k) for k in keywords]).cast("array<string>")
    return df.select(*DATE_KEYS, F.lower(F.col(col)).alias("_text"), F.coalesce(kw, F.array().cast("array<string>")).alias("_kw"))


def keyword_occurrences(
    df: DataFrame, keywords: list[str] | Column, col: str = "description", literal: bool = False
) -> DataFrame:
    """Long form of PRJ-5: one row per (article, keyword) with ``rank`` (from 1), ``keyword``,
    the date keys and ``occurrences`` (null for a null description). All keywords of the
    array count, however many there are; none give no rows."""
    each = _with_keywords(df, keywords, col).select(*DATE_KEYS, "_text", F.posexplode("_kw").alias("_at", "keyword"))
    return each.filter(F.col("keyword").isNotNull()).select(
        *DATE_KEYS, (F.col("_at") + 1).alias("rank"), "keyword",
        count_matches("_text", F.col("keyword"), literal, lowered=True).alias("occurrences"),
    )


def keyword_histogram(occurrences: DataFrame) -> DataFrame:
    """AGG-13 + FLT-4: per keyword, day and per-article occurrence count, the number
    of articles (``contagem``); zero and null counts and null dates are dropped."""
    kept = occurrences.dropna(subset=DATE_KEYS + ["occurrences"]).filter(F.col("occurrences") != 0)
    return kept.groupBy("keyword", *DATE_KEYS, "occurrences").agg(F.count(F.lit(1)).alias("contagem"))


def keyword_daily_total(occurrences: DataFrame) -> DataFrame:
    """AGG-15 (documented metric 4.3): total occurrences of each keyword per day."""
    kept = occurrences.dropna(subset=DATE_KEYS)
    return kept.groupBy("keyword", *DATE_KEYS).agg(
        F.coalesce(F.sum("occurrences"), F.lit(0)).cast("long").alias("occurrences")
    )


def all_keywords_daily(
    df: DataFrame, keywords: list[str] | Column, col: str = "description", literal: bool = False
) -> DataFrame:
    """AGG-14 + BOO-1: per day, articles whose description contains every keyword, of
    however many there are. Days with none are kept; a null description counts as not
    containing (Q15 fix), as does every description when there is no keyword."""
    base = _with_keywords(df, keywords, col)
    every = F.forall("_kw", lambda w: F.coalesce(contains_match("_text", w, literal, lowered=True), F.lit(False)))
    flag = every & (F.size("_kw") > 0)
    return base.dropna(subset=DATE_KEYS).groupBy(*DATE_KEYS).agg(F.count_if(flag).alias("todas_top3"))


def with_keyword_columns(
    df: DataFrame, keywords: list[str], col: str = "description", mode: str = "count", literal: bool = False
) -> DataFrame:
    """PRJ-5 wide form: one column per keyword (counts or presence flags). Existing
    columns of the same name are kept and the keyword column gets a ``kw_`` prefix
    (the reference would overwrite them, Q22). Names are compared as Spark compares them,
    without case; a further repeat gets a number."""
    fn = count_matches if mode == "count" else contains_match
    taken, out = {c.lower() for c in df.columns}, []
    for w in keywords:
        names = (w, f"kw_{w}", *(f"kw_{w}_{i}" for i in range(2, len(keywords) + len(taken) + 2)))
        name = next(x for x in names if x.lower() not in taken)
        taken.add(name.lower())
        out.append(fn(col, w, literal).alias(name))
    return df.select("*", *out)


def top_keywords(counts: DataFrame, k: int = 3) -> list[str]:
    """The k words as Python strings, for the wide form (k rows to the driver)."""
    return [r["Palavra"] for r in top_words(counts, k).collect()]
