"""Many literal keywords in one pass over the text (AGG-13, AGG-15, STR-4).

``keywords.keyword_occurrences`` searches each text once per keyword. Here a text is cut into words
once. What a word holds of the keywords is found once per distinct word: its substrings of the
keywords' lengths are joined with the keyword table, by equality. Then the words of the articles are
joined with that, and summed. So the cost follows the text and the matches, not text times
keywords. A keyword without white space lies within one word, so the counts are the same;
those with white space are searched the other way.

Keywords are literal and compared in lower case; the rows are those of ``keyword_occurrences`` with
``literal=True``, less the articles without an occurrence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmart.functions import count_matches
from newsmart.functions.text import split_on_whitespace
from newsmart.operators import keywords as kw


def _table(df: DataFrame, keywords: list[str]) -> DataFrame:
    rows = df.sparkSession.createDataFrame([(k,) for k in dict.fromkeys(keywords)], "keyword string")
    return rows.withColumn("_low", F.lower("keyword"))


def words_with_keywords(vocabulary: DataFrame, table: DataFrame) -> DataFrame:
    """``(token, keyword, n)``: how often each word of ``vocabulary(token)``, in lower case, holds a
    keyword of ``table(keyword, _low)``; pairs without an occurrence are left out."""
    lengths = [r[0] for r in table.select(F.char_length("_low")).distinct().collect() if r[0]]  # as many as the longest keyword has characters
    size = F.char_length("token")
    each = F.explode(F.array(*map(F.lit, sorted(lengths))).cast("array<int>"))
    pieces = vocabulary.select("token", each.alias("_l")).filter(size >= F.col("_l")).select(
        "token", F.explode(F.expr("transform(sequence(1, char_length(token) - _l + 1), i -> substring(token, i, _l))")).alias("_low")
    )
    held = pieces.distinct().join(table, "_low")
    return held.select("token", "keyword", count_matches("token", F.col("_low"), literal=True, lowered=True).alias("n"))


def literal_occurrences(df: DataFrame, keywords: list[str], col: str = "description") -> DataFrame:
    """``(keyword, year, month, day, occurrences)``: a row per article and keyword that occurs in it."""
    spaced = [k for k in keywords if any(c.isspace() for c in k)]
    table = _table(df, [k for k in keywords if k and k not in spaced])
    articles = df.select(F.monotonically_increasing_id().alias("_id"), *kw.DATE_KEYS, F.lower(col).alias("_text"))
    words = articles.select("_id", *kw.DATE_KEYS, F.explode(split_on_whitespace("_text")).alias("token"))
    vocabulary = words.filter("token != ''").select("token").distinct()
    held = words_with_keywords(vocabulary, table)
    found = words.join(held, "token").groupBy("_id", *kw.DATE_KEYS, "keyword").agg(F.sum("n").cast("int").alias("occurrences"))
    found = found.select("keyword", *kw.DATE_KEYS, "occurrences")
    if spaced:
        other = kw.keyword_occurrences(df, list(dict.fromkeys(spaced)), col, literal=True).filter("occurrences > 0")
        found = found.unionByName(other.select(*found.columns))
    return found


def keyword_histogram(df: DataFrame, keywords: list[str], col: str = "description") -> DataFrame:
    """AGG-13 for any number of literal keywords."""
    return kw.keyword_histogram(literal_occurrences(df, keywords, col))


def keyword_daily_total(df: DataFrame, keywords: list[str], col: str = "description") -> DataFrame:
    """AGG-15 for any number of literal keywords: every keyword on every day that has an article."""
    found = literal_occurrences(df, keywords, col).dropna(subset=kw.DATE_KEYS)
    days = df.dropna(subset=kw.DATE_KEYS).select(*kw.DATE_KEYS).distinct()
    every = F.explode(F.array(*map(F.lit, dict.fromkeys(keywords))).cast("array<string>"))
    zero = days.select(every.alias("keyword"), *kw.DATE_KEYS, F.lit(0).alias("occurrences"))
    total = F.sum("occurrences").cast("long").alias("occurrences")
    return zero.unionByName(found).groupBy("keyword", *kw.DATE_KEYS).agg(total)
