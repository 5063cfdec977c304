"""Language identification by rank-order profiles (operator 8).

A language's profile is the order of its most frequent character n-grams. A document's own
n-grams are ordered the same way, and its language is the one whose profile has them least
out of place: the sum, over the document's n-grams, of the distance between both ranks, or
the profile's length where the profile lacks one.

Profiles are counted over all training rows: each task adds up what it reads, Spark sums
the tasks' counts per language and n-gram, and only the first ``size`` ranks of each
language, a stated bound, reach the tasks that predict.

Cases: a null text or one without a letter gives ``und`` and score 0; without a training
row every text does; ties go to the language first by name, ties in frequency to the smaller
n-gram; equal rows get equal answers; an empty table gives no rows; other columns are not read."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newsmart.llm.common import slices

MAX_N = 3
PROFILE_SIZE = 400
UNKNOWN = "und"
_SPACE = 32
_BITS = 21  # of a code point: three fit a signed long


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The text's n-grams (code points packed into longs, ascending) and their counts. Words
    are runs of letters, lower-cased, with a space before and after; no n-gram spans two."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    points = np.where(_letters()[points], points, _SPACE).astype(np.int64)
    points = np.concatenate(([_SPACE], points, [_SPACE]))
    points = points[np.concatenate(([True], (points[1:] != _SPACE) | (points[:-1] != _SPACE)))]
    letter = points != _SPACE
    grams = [points[letter]]
    packed = points
    for n in range(2, MAX_N + 1):
        packed = (packed[:-1] << _BITS) | points[n - 1 :]
        inside = np.ones(len(packed), bool)
        for k in range(1, n - 1):
            inside &= letter[k : k + len(packed)]
        if n == 2:
            inside &= letter[: len(packed)] | letter[1:]
        grams.append(packed[inside])
    return np.unique(np.concatenate(grams), return_counts=True)


def _ranked(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    return grams[np.argsort(-counts, kind="stable")[:size]]


def profiles(docs: DataFrame, size: int = PROFILE_SIZE) -> dict[str, np.ndarray]:
    """Language -> its ``size`` most frequent n-grams in order, from ``docs(text, lang)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in slices(batches, 0, 32 << 20):
            found: dict[str, list] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found.setdefault(lang, []).append(ngrams(text))
            for lang, parts in found.items():
                grams, of = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
                counts = np.bincount(of, np.concatenate([c for _, c in parts])).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts)], ["lang", "gram", "n"]
                )

    labelled = docs.select("text", "lang").filter("text is not null and lang is not null")
    counts = labelled.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.withColumn("rank", rank).filter(F.col("rank") <= size).select("lang", "gram", "rank")
    ranked: dict[str, list] = {}
    for row in sorted(top.collect()):
        ranked.setdefault(row["lang"], []).append((row["rank"], row["gram"]))
    return {lang: np.array([g for _, g in sorted(rows)], np.int64) for lang, rows in sorted(ranked.items())}


class Ranks:
    """Out-of-place distances to a set of profiles."""

    def __init__(self, by_language: dict[str, np.ndarray], size: int):
        self.names, self.size = list(by_language), size
        self.sorted = [np.sort(p) for p in by_language.values()]
        self.rank = [np.argsort(p, kind="stable") for p in by_language.values()]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.names:
            return UNKNOWN, 0.0
        own = _ranked(*ngrams(text), self.size)
        if not len(own):
            return UNKNOWN, 0.0
        place = np.arange(len(own))
        best = None
        for name, grams, rank in zip(self.names, self.sorted, self.rank, strict=True):
            at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
            out = np.where(grams[at] == own, np.abs(rank[at] - place), self.size)
            total = int(out.sum())
            if best is None or total < best[0]:
                best = (total, name)
        return best[1], 1.0 - best[0] / (self.size * len(own))


def predict(docs: DataFrame, by_language: dict[str, np.ndarray], size: int = PROFILE_SIZE) -> DataFrame:
    """``docs`` with its last column ``text`` replaced by ``lang_pred`` and ``score`` (0 to 1: one
    less the distance as a share of the largest possible)."""
    shared = docs.sparkSession.sparkContext.broadcast(by_language)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        ranks = Ranks(shared.value, size)
        for batch in batches:
            got = [ranks.predict(x.as_py()) for x in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([x for x, _ in got], pa.string()), pa.array([x for _, x in got], pa.float64())],
                [*batch.schema.names[:-1], "lang_pred", "score"],
            )

    from pyspark.sql import types as T

    kept = [f for f in docs.schema.fields if f.name != "text"]
    schema = T.StructType([*kept, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.select(*(f.name for f in kept), "text").mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """A third of the documents, by a hash of the id; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, size: int = PROFILE_SIZE) -> DataFrame:
    """Learn from the rows that are not held out, predict all: doc_id, held_out, lang_pred, score."""
    learned = profiles(docs.filter(~held_out()), size)
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), learned, size)
