"""Word counts kept by load day (AGG-12, TOP-2, AGG-15), so that a day's run reads that day only.

A load day leaves two small tables, partitioned by the day and replaced when it is run again:

* ``words``: its counts per word, most frequent first in each file;
* ``dated``: its counts per publication date and word, with a row for each date of its articles.

*Top k.* ``top_words_over_days`` finds the words of largest total over all days by a threshold
algorithm in three steps: the sums of each day's k first words give a bound that k words reach; a
word can reach it only if it has the bound divided by the number of days on some day, a
filter that the scan of the sorted files skips by; the totals of those words alone are summed.

*Totals per date.* A keyword is a regular expression over the lower-cased text. One without
special characters occurs in a text as often as in its words (words hold no white space, nor does
it), so its totals come from ``dated``. For others the texts are read, once per load day and
keyword, and the sums are kept (``patterns``)."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newsmart.functions import count_matches
from newsmart.functions.text import split_on_whitespace
from newsmart.operators import keywords as kw
from newsmart.session import delete_path
from newsmart.sources.tables import partition_values, read_partition, read_table
from newsmart.sources.writers import PARQUET_OPTIONS, path_exists

_SPECIAL = set("\\.[]{}()*+?^$|")  # characters that may be more than themselves in a pattern
WORDS, DATED = "words", "dated"
_HAS_DATE = "year is not null and month is not null and day is not null"


def _write(df: DataFrame, path: str, *partitions: str) -> None:
    df.write.mode("overwrite").options(**PARQUET_OPTIONS).option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def store_days(silver: DataFrame, path: str, days: list[str] | None = None, col: str = "description") -> list[str]:
    """Keep the states of the load days in ``silver`` (``days``, if they are known) by one scan and one
    write; returns the days."""
    spark = silver.sparkSession
    if days is None:
        days = [str(r[0]) for r in silver.select("load_date").distinct().collect()]
    for day in days:  # a day without words must not keep its former ones; patterns are sums of its former texts
        for kind in (WORDS, DATED):
            delete_path(spark, f"{path}/states/kind={kind}/load_date={day}")
        delete_path(spark, f"{path}/patterns/load_date={day}")
    key = ["load_date", *kw.DATE_KEYS]
    # A null beside the words stands for the article itself, so that dates without words are there too.
    tokens = silver.select(*key, F.explode(F.concat(F.array(F.lit(None).cast("string")), F.coalesce(split_on_whitespace(col), F.array().cast("array<string>")))).alias("token"))
    longest = F.greatest(F.length("token"), F.length(F.lower("token")))  # lower case may be longer
    tokens = tokens.filter(F.col("token").isNull() | (longest > kw.MIN_WORD_LENGTH))
    # The sums per word are made of those per date, so the tokens are shuffled once and not for each of the
    # two. The length is an aggregate, which is not tested before the shuffle: both kinds read the same one.
    # What the shuffles leave is sized by volume and goes to the files as it is.
    dated = tokens.groupBy(*key, "token").agg(F.count("token").alias("n"))
    words = dated.groupBy("load_date", "token").agg(F.sum("n").alias("n"), F.max(F.length("token")).alias("_length"))
    words = words.filter(F.col("_length") > kw.MIN_WORD_LENGTH).drop("_length")
    of_kind = lambda df, kind: df.select(F.lit(kind).alias("kind"), *df.columns)
    counts = of_kind(dated, DATED).unionByName(of_kind(words, WORDS), allowMissingColumns=True)
    counts = counts.select("kind", *key, "token", "n").sortWithinPartitions("kind", "load_date", F.desc("n"), "token")
    _write(counts, f"{path}/states", "kind", "load_date")
    return days


def _states(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return read_table(spark, f"{path}/states").filter(F.col("kind") == kind)


def _words(spark: SparkSession, path: str) -> DataFrame:
    return _states(spark, path, WORDS).select("load_date", F.col("token").alias("Palavra"), F.col("n").alias("Quantidade"))


def days_held(spark: SparkSession, path: str) -> list[str]:
    """The load days with states (an article has a row of its own among the dated ones)."""
    return partition_values(spark, f"{path}/states/kind={DATED}", "load_date")


def word_totals(spark: SparkSession, path: str) -> DataFrame:
    """AGG-12 over all stored days."""
    return _words(spark, path).groupBy("Palavra").agg(F.sum("Quantidade").alias("Quantidade"))


def candidate_bound(spark: SparkSession, path: str, k: int) -> int:
    """A count that every word of the top k has on some day at least."""
    days = max(1, len(days_held(spark, path)))
    nth = F.row_number().over(W.partitionBy("load_date").orderBy(F.desc("Quantidade"), "Palavra"))
    first = _words(spark, path).withColumn("_nth", nth).filter(F.col("_nth") <= k)
    sums = first.groupBy("Palavra").agg(F.sum("Quantidade").alias("q")).orderBy(F.desc("q")).limit(k)
    reached, least = sums.agg(F.count(F.lit(1)), F.min("q")).first()
    return -(-least // days) if reached == k else 0


def top_words_over_days(spark: SparkSession, path: str, k: int) -> DataFrame:
    """TOP-2 over all stored days, exactly: ``(Palavra, Quantidade)``, ties by the word."""
    words = _words(spark, path)
    bound = candidate_bound(spark, path, k)
    candidates = words.filter(F.col("Quantidade") >= F.lit(bound)).select("Palavra").distinct()
    totals = words.join(candidates, "Palavra", "left_semi").groupBy("Palavra").agg(F.sum("Quantidade").alias("Quantidade"))
    return kw.top_words(totals, k)


def is_plain(keyword: str) -> bool:
    """The keyword, as a pattern, matches itself only, and within a word only."""
    return not (set(keyword) & _SPECIAL) and not any(c.isspace() for c in keyword)


def _pattern_sums(spark: SparkSession, path: str, silver: str, keyword: str) -> DataFrame:
    """The kept sums of a keyword with special characters; days without one are read and kept first."""
    name = hashlib.md5(keyword.encode()).hexdigest()
    for day in days_held(spark, path):
        if not path_exists(spark, f"{path}/patterns/load_date={day}/keyword_id={name}"):
            day_rows = read_partition(spark, silver, "load_date", day)
            found = kw.keyword_daily_total(kw.keyword_occurrences(day_rows, [keyword]))
            _write(found.select("*", F.lit(day).cast("date").alias("load_date"), F.lit(name).alias("keyword_id")), f"{path}/patterns", "load_date", "keyword_id")
            if not path_exists(spark, f"{path}/patterns/load_date={day}/keyword_id={name}"):  # no dated article: an empty folder says so
                found.limit(0).write.mode("overwrite").parquet(f"{path}/patterns/load_date={day}/keyword_id={name}")
    rows = read_table(spark, f"{path}/patterns").filter(F.col("keyword_id") == name)
    return rows.select("keyword", *kw.DATE_KEYS, "occurrences")


def keyword_daily_total(spark: SparkSession, path: str, silver: str, keywords: list[str]) -> DataFrame:
    """AGG-15 over all stored days: occurrences of each keyword on each publication date, zeros included.
    ``silver``: the table's path, read only for keywords with special characters."""
    plain = [k for k in keywords if is_plain(k)]
    wanted = F.array(*map(F.lit, plain)).cast("array<string>")
    dated = _states(spark, path, DATED).filter(_HAS_DATE)
    tokens = dated.select(*kw.DATE_KEYS, F.lower("token").alias("_t"), "n", F.explode(wanted).alias("keyword"))
    found = tokens.filter(F.contains("_t", F.lower("keyword"))).select(
        "keyword", *kw.DATE_KEYS, (F.col("n") * count_matches("_t", F.col("keyword"), lowered=True)).alias("occurrences")
    )
    for keyword in keywords:
        if not is_plain(keyword):
            found = found.unionByName(_pattern_sums(spark, path, silver, keyword))
    dates = dated.filter("token is null").select(*kw.DATE_KEYS).distinct()
    zero = dates.select(F.explode(F.array(*map(F.lit, keywords)).cast("array<string>")).alias("keyword"), *kw.DATE_KEYS, F.lit(0).cast("long").alias("occurrences"))
    every = zero.unionByName(found.select(*zero.columns))
    return every.groupBy("keyword", *kw.DATE_KEYS).agg(F.sum("occurrences").cast("long").alias("occurrences"))
