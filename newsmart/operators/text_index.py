"""Article search by a positional inverted index (RA-1).

A load day's articles are indexed once, as four tables partitioned by the day:

* ``docs``: the articles, numbered (``doc``);
* ``postings``: a row for each place of a term (searched field, article, number of the term in
  it, whether another follows), in buckets of the term, sorted by term;
* ``terms``: each term with its number of places;
* ``grams``: each run of three characters of a term, in buckets of the run.

Terms are what single spaces separate in the lower-cased text; so a phrase, cut the same way, occurs
in a text exactly where its first part ends a term, its inner ones are the next terms and its
last begins one (a phrase of one part: where a term contains it). That keeps the substring
semantics of ``phrase_match``, and no text has to be read to verify a hit. A phrase that begins or
ends with a space asks there only that some term precedes or follows, which the places of its other
parts tell; nothing is looked up for it. Parts that need not be
whole terms are looked up by their runs of three characters, shorter ones in the term list.

A search reads the term tables, then of the postings only the buckets of the terms found (folders)
and their row groups (sorted by term): the rarest part's first; only articles that hold the two rarest
parts are looked at for the others. A day indexed again replaces its own
partitions."""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmart.operators import boolean_query
from newsmart.operators.search import SEARCH_IN_OPTIONS, search_fields
from newsmart.session import cut_lineage
from newsmart.sources.tables import partition_values, read_table
from newsmart.sources.writers import PARQUET_OPTIONS

INDEX_DAY = "index_day"
BUCKETS = 64
GRAM = 3
#: So many terms or articles found are named in a filter that the scan can push down; more are joined.
LITERALS = 1000


def _bucket(col: str | Column) -> Column:
    return (F.crc32(F.col(col).cast("binary") if isinstance(col, str) else col.cast("binary")) % BUCKETS).cast("int")


def _bucket_of(text: str) -> int:
    return zlib.crc32(text.encode()) % BUCKETS


def _grams(text: str) -> Column:
    return F.expr(f"array_distinct(transform(sequence(1, char_length({text}) - {GRAM - 1}), i -> substring({text}, i, {GRAM})))")


def _write(df: DataFrame, path: str, order: list[str], *partitions: str) -> None:
    """Files of a bucket are sized by their volume; a heavy one is split."""
    sized = df.hint("rebalance", *partitions).sortWithinPartitions(*partitions, *order)
    sized.write.mode("overwrite").options(**PARQUET_OPTIONS).option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def index_articles(articles: DataFrame, path: str, day: str | Column) -> list[str]:
    """Index ``articles`` (with the searched fields as columns) under their load day, a date or a column.
    Returns the days (re)indexed."""
    spark = articles.sparkSession
    day = F.lit(day) if isinstance(day, str) else day
    numbered = articles.select("*", F.monotonically_increasing_id().alias("doc"), day.cast("date").alias(INDEX_DAY))
    staged = f"{path}/_staged"  # numbers are read back, so they are those of the articles stored
    numbered = numbered.sortWithinPartitions(INDEX_DAY, "doc")
    numbered.write.mode("overwrite").options(**PARQUET_OPTIONS).partitionBy(INDEX_DAY).parquet(staged)
    days = sorted(partition_values(spark, staged, INDEX_DAY))
    if not days:
        return []
    docs = read_table(spark, staged)

    fields = F.array(*(F.struct(F.lit(f).alias("field"), F.lower(F.col(f)).alias("text")) for f in SEARCH_IN_OPTIONS))
    texts = docs.select(INDEX_DAY, "doc", F.inline(fields)).filter("text is not null")
    parts = texts.select(INDEX_DAY, "doc", "field", F.split("text", " ").alias("parts")).withColumn("last", F.size("parts") - 1)
    postings = parts.select(INDEX_DAY, "doc", "field", "last", F.posexplode("parts").alias("at", "term"))
    postings = postings.select(INDEX_DAY, "doc", "field", "at", (F.col("at") < F.col("last")).alias("more"), "term")
    _write(postings.withColumn("bucket", _bucket("term")), f"{path}/postings", ["term", "field", "doc", "at"], INDEX_DAY, "bucket")

    held = _of_days(read_table(spark, f"{path}/postings"), days)
    terms = held.groupBy(INDEX_DAY, "bucket", "term").agg(F.count("*").alias("places"))
    _write(terms, f"{path}/terms", ["term"], INDEX_DAY)
    held = _of_days(read_table(spark, f"{path}/terms"), days).filter(F.char_length("term") >= GRAM)
    grams = held.select(INDEX_DAY, F.explode(_grams("term")).alias("gram"), "bucket", "term", "places")
    _write(grams.withColumn("gram_bucket", _bucket("gram")), f"{path}/grams", ["gram", "term"], INDEX_DAY, "gram_bucket")
    for one in days:  # last: a day is searched once its articles are there
        _put_in_place(spark, staged, f"{path}/docs", f"{INDEX_DAY}={one}")
    return days


def _put_in_place(spark: SparkSession, staged: str, path: str, folder: str) -> None:
    """Move a folder of the staged table into the table, in place of the one that is there."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    source, target = hadoop(f"{staged}/{folder}"), hadoop(f"{path}/{folder}")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    fs.delete(target, True)
    if not fs.rename(source, target):
        raise OSError(f"could not move {source} to {target}")


def _lowered(spark: SparkSession, text: str) -> str:
    """Lower case by the rules that the texts were lowered by."""
    return spark.range(1).select(F.lower(F.lit(text))).first()[0]


def _of_days(table: DataFrame, days: Sequence[str] | None) -> DataFrame:
    return table if days is None else table.filter(F.col(INDEX_DAY).isin([F.lit(str(d)).cast("date") for d in days]))


def terms_for(spark: SparkSession, path: str, part: str, first: bool, last: bool, days: Sequence[str] | None = None) -> DataFrame:
    """``(index_day, bucket, term, places)``: the terms that the part of a phrase may be: itself, one
    that ends with it (``first``), begins with it (``last``) or contains it (both)."""
    columns = [INDEX_DAY, "bucket", "term", "places"]
    term = F.col("term")
    fits = term.contains(part) if first and last else term.endswith(part) if first else term.startswith(part) if last else term == part
    runs = sorted({part[i : i + GRAM] for i in range(len(part) - GRAM + 1)})
    if not first or not runs:  # sorted by term: a beginning or a whole term prunes row groups
        return _of_days(read_table(spark, f"{path}/terms"), days).filter(fits).select(*columns)
    grams = _of_days(read_table(spark, f"{path}/grams"), days)
    grams = grams.filter(F.col("gram_bucket").isin(sorted({_bucket_of(r) for r in runs})) & F.col("gram").isin(runs) & fits)
    return grams.groupBy(*columns).agg(F.count("*").alias("_runs")).filter(F.col("_runs") == len(runs)).select(*columns)


class Matched:
    """The terms that each part of a phrase may be (``k``: the part's number), with what a driver may know
    of them: each part's number of postings and buckets (``BUCKETS`` at most), and the terms where they
    are few."""

    def __init__(
        self, spark: SparkSession, path: str, parts: list[str], days: Sequence[str] | None, first: bool = True, last: bool = True
    ):
        """``first``, ``last``: the first part may be the end of a term, the last one the beginning of one."""
        ends = len(parts) - 1
        each = (terms_for(spark, path, p, first and k == 0, last and k == ends, days).withColumn("k", F.lit(k)) for k, p in enumerate(parts))
        self.terms = cut_lineage(reduce(DataFrame.unionByName, each))
        rows = self.terms.groupBy("k").agg(F.sum("places").alias("n"), F.collect_set("bucket").alias("buckets")).collect()
        self.buckets = {r["k"]: r["buckets"] for r in rows}
        sizes = {r["k"]: r["n"] for r in rows}
        self.rarest = sorted(range(len(parts)), key=lambda k: (sizes.get(k, 0), k))
        few = self.terms.select("k", "term").distinct().limit(LITERALS + 1).collect()
        self.few = few if len(few) <= LITERALS else None


def postings_of(
    spark: SparkSession, path: str, matched: Matched, k: int, fields: list[str], days: Sequence[str] | None = None, edge: Column | None = None
) -> DataFrame:
    """``(index_day, doc, field, at)``, a row a place, of the terms of part ``k``; read from their buckets only.
    ``edge``: what else holds of a place."""
    table = _of_days(read_table(spark, f"{path}/postings"), days)
    table = table.filter(F.col("bucket").isin(matched.buckets.get(k, [])) & F.col("field").isin(fields))
    if matched.few is not None:
        table = table.filter(F.col("term").isin([r["term"] for r in matched.few if r["k"] == k]))
    if edge is not None:
        table = table.filter(edge)
    keys = [INDEX_DAY, "bucket", "term"]
    return table.join(matched.terms.filter(F.col("k") == k).select(*keys), keys, "left_semi").select(INDEX_DAY, "doc", "field", "at")


def phrase_hits(
    spark: SparkSession, path: str, q: str, search_in: str | Sequence[str] | None = None, days: Sequence[str] | None = None
) -> DataFrame:
    """``(index_day, doc)`` of the articles in which the phrase occurs, as ``phrase_match`` has it."""
    fields = search_fields(search_in)
    parts = _lowered(spark, q).split(" ")
    # An empty part at an end may be the end of any term: it asks only that there is one.
    before, after = len(parts) > 1 and parts[0] == "", len(parts) > 1 and parts[-1] == ""
    inner = parts[before : len(parts) - after]
    key = [INDEX_DAY, "doc", "field"]
    if not inner:  # a single space: a text of two terms
        places = _of_days(read_table(spark, f"{path}/postings"), days)
        return places.filter(F.col("field").isin(fields) & (F.col("at") == 1)).select(INDEX_DAY, "doc").distinct()
    matched = Matched(spark, path, inner, days, not before, not after)
    first, *rest = matched.rarest

    def places_of(k: int) -> DataFrame:
        edges = [F.col("at") > 0] * (before and k == 0) + [F.col("more")] * (after and k == len(inner) - 1)
        return postings_of(spark, path, matched, k, fields, days, reduce(Column.__and__, edges) if edges else None)

    found = places_of(first)
    if not rest:
        return found.select(INDEX_DAY, "doc").distinct()
    starts_of = lambda df, k: df.select(*key, (F.col("at") - k).alias("start"))
    starts = starts_of(found, first)
    for nth, k in enumerate(rest):
        others = places_of(k)
        if nth:  # the two rarest parts say where to look for the others
            others = others.join(starts.select(*key).distinct(), key, "left_semi")
        starts = starts.join(starts_of(others, k), [*key, "start"], "left_semi")
        if nth == 0 and len(rest) > 1:
            starts = cut_lineage(starts)
    return starts.select(INDEX_DAY, "doc").distinct()


def _tree_hits(spark, path, tree, search_in, days) -> DataFrame:
    """The articles of a boolean query, as set operations on those of its phrases."""
    key = [INDEX_DAY, "doc"]
    every = lambda: _of_days(read_table(spark, f"{path}/docs"), days).select(*key)
    if isinstance(tree, boolean_query.Phrase):
        return phrase_hits(spark, path, tree.text, search_in, days)
    if isinstance(tree, boolean_query.Not):
        return every().join(_tree_hits(spark, path, tree.one, search_in, days), key, "left_anti")
    if isinstance(tree, boolean_query.Or):
        return reduce(DataFrame.union, (_tree_hits(spark, path, p, search_in, days) for p in tree.any)).distinct()
    wanted = [p for p in tree.all if not isinstance(p, boolean_query.Not)]
    hits = [_tree_hits(spark, path, p, search_in, days) for p in wanted] or [every()]
    out = reduce(lambda a, b: a.join(b, key, "left_semi"), hits)
    for p in tree.all:
        if isinstance(p, boolean_query.Not):
            out = out.join(_tree_hits(spark, path, p.one, search_in, days), key, "left_anti")
    return out


def _fetch(spark: SparkSession, path: str, hits: DataFrame) -> DataFrame:
    """The articles of ``hits``, from their days and, where they are few, their row groups only (a file
    holds a run of article numbers)."""
    hits = cut_lineage(hits)
    days = [r[INDEX_DAY] for r in hits.select(INDEX_DAY).distinct().collect()]
    few = hits.select("doc").distinct().limit(LITERALS + 1).collect()
    docs = read_table(spark, f"{path}/docs").filter(F.col(INDEX_DAY).isin(days))
    if len(few) <= LITERALS:
        docs = docs.filter(F.col("doc").isin([r["doc"] for r in few]))
    return docs.join(hits, [INDEX_DAY, "doc"], "left_semi").drop(INDEX_DAY, "doc")


def search(
    spark: SparkSession, path: str, q: str, search_in: str | Sequence[str] | None = None, days: Sequence[str] | None = None
) -> DataFrame:
    """The indexed articles that hold the phrase ``q``: the rows of ``search_articles`` over them."""
    return _fetch(spark, path, phrase_hits(spark, path, q, search_in, days))


def search_boolean(
    spark: SparkSession, path: str, q: str, search_in: str | Sequence[str] | None = None, days: Sequence[str] | None = None
) -> DataFrame:
    """The indexed articles that a boolean ``q`` matches."""
    return _fetch(spark, path, _tree_hits(spark, path, boolean_query.parse(q), search_in, days))
