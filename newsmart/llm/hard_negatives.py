"""Hard-negative mining with cover trees (operator 13).

For an anchor, its positives are its nearest rows of the same label; a positive's hard negatives
are the nearest rows of other labels whose products lie in a window under the positive's own.
Vectors are integers (``floor(scale * x)``), so every product, tie and window is exact, and so
is the result: the trees only skip what can't belong to it.

1. *Positives.* Rows and anchors of a label meet in blocks; each block of rows is a cover tree.
2. *Top level.* Centers are picked from a bounded sample (``SAMPLE`` rows, farthest first); every
   row goes to its nearest one, whose covering radius is the largest distance of all its rows. An
   anchor is sent only to centers whose radius lets a product fall into one of its windows.
3. *Negatives.* A center's rows are cut in blocks, a cover tree each, searched best first for all
   windows of an anchor at once. Windows of positives with equal scores are one.

Scale: the anchors are a stated share of the rows and meet them in blocks of ``BLOCK`` rows and
``QUERY_BLOCK`` anchors, so no task holds a label, a center or a group of copies. A block returns
``k`` rows a window at most, and these are ranked per anchor after a pre-limit in each task. The
driver holds the sample's centers and the norm bound, nothing else. In high dimensions without
clusters the radii skip little, and the trees verify nearly all rows; the result is the same.

Cases: rows with a null id, label or vector, or a null or non-finite component take no part; an
empty vector's products are zero; of vectors of different lengths the shorter ends in zeros;
a row is never its own positive or negative, nor is another of the same id; equal rows count
each, but an anchor repeated in full is one; products that do not fit a long are an error, as are
components that do not; an empty table gives no rows; other columns are not read."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newsmart.llm.blocks import block_join, matrix, same_width
from newsmart.llm.common import map_arrow, store
from newsmart.llm.cover_tree import CoverTree, Products

SCALE = 256
BLOCK = 4096
QUERY_BLOCK = 2048
SAMPLE = 4096
CENTERS = 256
LEAST = -(1 << 63) + 1
MOST = (1 << 63) - 1


def integer_vectors(embeddings: DataFrame, label: Column, scale: int = SCALE) -> DataFrame:
    """``(vec_id, label, vec)`` of the rows that take part, ``vec`` as longs."""
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    rows = embeddings.filter("vec_id is not null and label is not null and embedding is not null").filter(~odd)
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"), whole.alias("vec"))


def anchors_of(rows: DataFrame, every: int) -> DataFrame:
    """``(vec_id, label, vec, key)``: ``key`` tells anchors of one id apart."""
    chosen = rows.filter(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "label", "vec"])
    return chosen.withColumn("key", F.xxhash64("vec_id", "label", "vec"))


def _search(same: bool, k: int):
    """Of a block of rows and one of anchors (``vec_id, key, label, vec`` and ``low``, ``high`` of its
    windows): per anchor and window, the first ``k`` rows that the tree finds."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        points, queries = same_width(matrix(rows["vec"], np.int64), matrix(anchors["vec"], np.int64))
        out: list[tuple] = []
        if len(points) and len(queries):
            tree = CoverTree(points, np.asarray(rows["vec_id"]), np.asarray(rows["label"]))
            cols = (anchors[c].to_pylist() for c in ("vec_id", "key", "label", "low", "high"))
            for q, own, key, label, low, high in zip(queries, *cols, strict=True):
                for w, found in enumerate(tree.best(q, label, same, own, low, high, k)):
                    out += [(own, key, high[w], i, s) for s, i in found]
        kinds = {"anchor_id": pa.int64(), "key": pa.int64(), "high": pa.int64(), "vec_id": pa.int64(), "score": pa.int64()}
        columns = zip(*out, strict=True) if out else [[]] * len(kinds)
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)], names=list(kinds))

    return run


FOUND = "anchor_id bigint, key bigint, high bigint, vec_id bigint, score bigint"


def _first(found: DataFrame, k: int, *group: str) -> DataFrame:
    nth = F.row_number().over(W.partitionBy(*group).orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", nth).filter(F.col("rank") <= k)


def positives(rows: DataFrame, anchors: DataFrame, k: int, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``(anchor_id, key, rank, vec_id, score)``: each anchor's first ``k`` other rows of its label."""
    wide = anchors.select("label", "vec_id", "key", "vec", F.array(F.lit(LEAST)).alias("low"), F.array(F.lit(MOST)).alias("high"))
    found = block_join(rows, wide, "label", _search(True, k), FOUND, block, query_block)
    return _first(found, k, "anchor_id", "key").select("anchor_id", "key", "rank", "vec_id", "score")


def centers(rows: DataFrame, sample: int = SAMPLE, most: int = CENTERS, block: int = BLOCK) -> tuple[np.ndarray, float]:
    """The tree's top level: about one center a block of rows, ``most`` at most, farthest first among
    ``sample`` rows chosen by hash; and the square of the longest vector of all."""
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    n, longest = rows.agg(F.count("*"), F.max(square)).first()
    some = rows.orderBy(F.xxhash64("vec_id", "vec"), "vec_id").limit(sample).select("vec").toArrow()
    points = matrix(some["vec"], np.int64)
    if not len(points):
        return points, 0.0
    real = points.astype(np.float64)
    real = np.column_stack([real, np.sqrt(np.maximum(longest - (real * real).sum(axis=1), 0))])
    chosen, apart = [0], np.full(len(real), np.inf)
    while len(chosen) < min(most, -(-n // block)):
        apart = np.minimum(apart, 2 * (longest - real @ real[chosen[-1]]))
        if apart.max() <= 1e-9 * longest:
            break
        chosen.append(int(apart.argmax()))
    return points[chosen], float(longest)


def _gaps(vectors: np.ndarray, tops: np.ndarray, longest: float, query: bool) -> Iterator[np.ndarray]:
    """Per top center, the squared distances of the augmented vectors from it (a query's last
    component is zero)."""
    vectors, tops = same_width(vectors, tops)
    products = Products(vectors)
    square = lambda x: (x.astype(np.float64) ** 2).sum(axis=-1)
    rest = lambda x: np.sqrt(np.maximum(longest - square(x), 0))
    for c in tops:
        inner = products(c).astype(np.float64)
        if query:
            yield np.maximum(square(vectors) + longest - 2 * inner, 0)
        else:
            yield np.maximum(2 * (longest - inner - rest(vectors) * rest(c)), 0) + 1e-9 * longest


def to_centers(rows: DataFrame, tops: np.ndarray, longest: float) -> DataFrame:
    """``rows`` with the number of the nearest center and the distance from it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            vectors = matrix(batch.column(2), np.int64)
            best, which = np.full(len(vectors), np.inf), np.zeros(len(vectors), np.int64)
            for c, gap in enumerate(_gaps(vectors, tops, longest, query=False)):
                nearer = gap < best
                best[nearer], which[nearer] = gap[nearer], c
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(which), pa.array(np.sqrt(best))], ["vec_id", "label", "vec", "center", "apart"]
            )

    return map_arrow(rows, run, "vec_id bigint, label bigint, vec array<bigint>, center bigint, apart double")


def _routes(anchors: DataFrame, tops: np.ndarray, radii: dict[int, float], longest: float) -> DataFrame:
    """``anchors`` once for each center that may hold a product within one of its windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = matrix(batch.column(3), np.int64)
            low, high = ([np.array(x) for x in batch.column(c).to_pylist()] for c in (4, 5))
            total = (vectors.astype(np.float64) ** 2).sum(axis=1) + longest
            margin = 0.5 + 1e-9 * total
            for c, gap in enumerate(_gaps(vectors, tops, longest, query=True)):
                if c not in radii:
                    continue
                d = np.sqrt(gap)
                upper = (total - np.maximum(d - radii[c], 0) ** 2) / 2 + margin
                lower = (total - (d + radii[c]) ** 2) / 2 - margin
                goes = [bool(((u >= x) & (v <= y)).any()) for u, v, x, y in zip(upper, lower, low, high, strict=True)]
                part = batch.filter(pa.array(goes))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(np.full(part.num_rows, c, np.int64))], [*part.schema.names, "center"]
                )

    kept = anchors.select("vec_id", "key", "label", "vec", "low", "high")
    kinds = "vec_id bigint, key bigint, label bigint, vec array<bigint>, low array<bigint>, high array<bigint>, center bigint"
    return map_arrow(kept, run, kinds)


def negatives(rows: DataFrame, windows: DataFrame, k: int, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``windows``: anchors with arrays ``low`` and ``high``. ``(anchor_id, key, high, vec_id, score)``:
    per window the first ``k`` rows of other labels."""
    tops, longest = centers(rows, block=block)
    placed = store(to_centers(rows, tops, longest), "centers")
    radii = {r["center"]: r["radius"] for r in placed.groupBy("center").agg(F.max("apart").alias("radius")).collect()}
    routed = store(_routes(windows, tops, radii, longest), "routes")
    found = block_join(placed.drop("apart"), routed, "center", _search(False, k), FOUND, block, query_block)
    return _first(found, k, "anchor_id", "key", "high").drop("rank")


def mine(
    embeddings: DataFrame, every: int = 100, n_positives: int = 5, n_negatives: int = 5, lowest: int = 80, relabelled: int = 7,
    n_labels: int = 10, scale: int = SCALE, block: int = BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``: per anchor (id
    divisible by ``every``) and positive, the first negatives that score ``lowest`` percent of the
    positive's score at least and that score at most. Ids divisible by ``relabelled`` have the next
    of ``n_labels`` labels."""
    label = F.when(F.col("vec_id") % relabelled == 0, (F.col("label") + 1) % n_labels).otherwise(F.col("label"))
    rows = store(integer_vectors(embeddings, label, scale), "vectors")
    anchors = store(anchors_of(rows, every), "anchors")
    near = store(positives(rows, anchors, n_positives, block, query_block), "positives")

    # 100 * score >= lowest * positive: the least whole score; no window where the positive's is negative.
    least = F.expr(f"score * {lowest} div 100 + if(score * {lowest} % 100 > 0, 1, 0)")
    several = near.filter("score >= 0").groupBy("anchor_id", "key").agg(F.sort_array(F.collect_set(F.struct(F.col("score").alias("high"), least.alias("low")))).alias("w"))
    windows = anchors.join(several.withColumnRenamed("anchor_id", "vec_id"), ["vec_id", "key"])
    found = negatives(rows, windows.select(*anchors.columns, "w.low", "w.high"), n_negatives, block, query_block)

    near = near.select("anchor_id", "key", F.col("rank").alias("nth"), F.col("vec_id").alias("positive_id"), F.col("score").alias("high"))
    rank = F.row_number().over(W.partitionBy("anchor_id", "key", "nth").orderBy(F.desc("score"), "vec_id"))
    return near.join(found, ["anchor_id", "key", "high"]).select(
        "anchor_id", "positive_id", rank.alias("rank"), F.col("vec_id").alias("negative_id"),
        F.col("high").alias("positive_score"), F.col("score").alias("negative_score"),
    )
