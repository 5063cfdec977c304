"""Approximate nearest neighbours by learned partitions (operator 12).

1. *Neighbour graph.* Of a bounded sample (``SAMPLE`` rows by hash), each row is joined with the
   ``GRAPH_K`` rows of largest inner product.
2. *Balanced partitioning.* The graph is halved again and again: a start from a smoothed random
   vector, split at its median, then exchanges of equally many vertices between the halves, by
   gain, until none lowers the cut. So the parts of the sample differ by one row at most.
3. *Classifier.* A small network (one hidden layer) learns to tell a vector's part, from the parts
   of its neighbours in the graph. It places every row of the table in its most probable part, and
   ranks the parts for a query.
4. *Search.* A query goes to its most probable parts until their probabilities add up to a
   threshold and they hold enough rows. Rows and queries of a part meet in blocks and are compared
   exactly; a block returns the ``k`` best, which are ranked per query.

The threshold is calibrated, not guessed: for ``CALIBRATION`` queries the true neighbours among all
rows are found by one pass in blocks, and the least threshold is taken that finds ``TARGET`` of
them. Where vectors have no structure it comes out near one, and most parts are searched.

Scale: one task fits on the sample; the driver holds the weights, part sizes (``MOST_PARTS``) and the
calibration's true neighbours, all bounded. A part with any share of the rows is cut in blocks of
``BLOCK``, its queries in blocks of ``QUERY_BLOCK``.

Cases: rows with a null id or vector, a vector that is zero, or one with a null or non-finite
component take no part; of vectors of different lengths the shorter ends in zeros; a row is no
neighbour of its own, nor are others of the same id; equal rows count each as candidates, but a
query repeated in full is answered once; ties go to the smaller id; fewer candidates than ``k``
are all returned; an empty table gives no rows; other columns are not read."""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newsmart.llm.blocks import block_join, matrix, same_width
from newsmart.llm.common import map_arrow, store

SAMPLE = 8192
GRAPH_K = 10
MOST_PARTS = 256
HIDDEN = 128
EPOCHS = 12
CALIBRATION = 512
#: Mean share of the true neighbours that the calibration must find; the task asks for 0.9.
TARGET = 0.94
BLOCK = 8192
QUERY_BLOCK = 2048
FOUND = "query_id bigint, key bigint, vec_id bigint, score double"


def vectors_of(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, vec)`` of the rows that take part, ``vec`` as given; products are of doubles."""
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    rows = embeddings.filter("vec_id is not null and embedding is not null").filter(~odd).filter(some)
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").alias("vec"))


# ---------------------------------------------------------------- the neighbour graph and its parts


def neighbour_graph(points: np.ndarray, k: int) -> np.ndarray:
    """Per point the ``k`` others of largest inner product (fewer, if there are fewer)."""
    n, out = len(points), []
    k = min(k, n - 1)
    if k < 1:
        return np.zeros((n, 0), np.int64)
    small = points.astype(np.float32)
    for at in range(0, n, 128):
        scores = small[at : at + 128] @ small.T
        scores[np.arange(len(scores)), np.arange(at, at + len(scores))] = -np.inf
        out.append(np.argpartition(scores, -k, axis=1)[:, -k:])
    return np.concatenate(out).astype(np.int64)


def _halve(n: int, a: np.ndarray, b: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """True for half of ``n`` vertices (the larger half, if odd), few of the edges ``a``-``b`` being cut."""
    degree = np.bincount(a, minlength=n) + np.bincount(b, minlength=n) + 1.0
    x = rng.standard_normal(n)
    for _ in range(40):  # smooth along the edges; what is left changes slowly on the graph
        x = (x + np.bincount(a, x[b], n) + np.bincount(b, x[a], n)) / degree
        x -= x.mean()
        x /= np.abs(x).max() or 1.0
    side = np.zeros(n, bool)
    side[np.argsort(x, kind="stable")[n // 2 :]] = True
    best, cut = side, int((side[a] != side[b]).sum())
    for _ in range(50):
        across = (side[a] != side[b]) * 2.0 - 1
        gain = np.bincount(a, across, n) + np.bincount(b, across, n)  # how far the cut falls if a vertex changes sides
        ups, downs = np.flatnonzero(~side), np.flatnonzero(side)
        ups, downs = ups[np.argsort(-gain[ups], kind="stable")], downs[np.argsort(-gain[downs], kind="stable")]
        m = min(len(ups), len(downs))
        swaps = int((gain[ups[:m]] + gain[downs[:m]] > 0).sum())
        if not swaps:
            break
        swaps = max(1, swaps // 2)  # neighbours that move together do not gain what each would alone
        side = side.copy()
        side[ups[:swaps]], side[downs[:swaps]] = True, False
        now = int((side[a] != side[b]).sum())
        if now < cut:
            best, cut = side, now
    return best


def balanced_parts(near: np.ndarray, parts: int, seed: int = 0) -> np.ndarray:
    """Part numbers of the vertices, ``parts`` (a power of two) of equal size, one vertex more or less."""
    n, rng = len(near), np.random.default_rng(seed)
    part = np.zeros(n, np.int64)
    a, b = np.repeat(np.arange(n), near.shape[1]), near.ravel()
    groups = [np.arange(n)]
    while len(groups) < parts:
        halves = []
        for own in groups:
            here = np.full(n, -1, np.int64)
            here[own] = np.arange(len(own))
            inner = (here[a] >= 0) & (here[b] >= 0)
            side = _halve(len(own), here[a[inner]], here[b[inner]], rng)
            halves += [own[~side], own[side]]
        groups = halves
    for k, own in enumerate(groups):
        part[own] = k
    return part


# ---------------------------------------------------------------- the classifier


class Router:
    """Probabilities of the parts: scaled input, one hidden layer (ReLU), softmax."""

    def __init__(self, points: np.ndarray, targets: np.ndarray, hidden: int = HIDDEN, epochs: int = EPOCHS, seed: int = 0):
        """``targets``: per point a probability of each part."""
        rng = np.random.default_rng(seed)
        n, width = points.shape
        self.scale = 1.0 / (np.sqrt((points * points).mean()) or 1.0)
        x = (points * self.scale).astype(np.float32)
        shapes = [(width, hidden), (hidden,), (hidden, targets.shape[1]), (targets.shape[1],)]
        self.weights = [(rng.standard_normal(s) * np.sqrt(2 / s[0]) if len(s) == 2 else np.zeros(s)).astype(np.float32) for s in shapes]
        first, second = ([np.zeros_like(w) for w in self.weights] for _ in range(2))
        step, batch = 0, 256
        steps = max(epochs * -(-n // batch), 600)  # small samples are gone through more often
        while step < steps:
            order = rng.permutation(n)
            for at in range(0, n, batch):
                rows = order[at : at + batch]
                step += 1
                rate = 0.003 * max(0.02, 1 - step / steps)
                for w, g, m, v in zip(self.weights, self._slopes(x[rows], targets[rows]), first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)

    def _slopes(self, x: np.ndarray, targets: np.ndarray) -> list[np.ndarray]:
        a, b, c, d = self.weights
        inner = np.maximum(x @ a + b, 0)
        off = (self._softmax(inner @ c + d) - targets) / len(x)
        back = (off @ c.T) * (inner > 0)
        return [x.T @ back, back.sum(axis=0), inner.T @ off, off.sum(axis=0)]

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def __call__(self, points: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        x = (points[:, : len(a)] * self.scale).astype(np.float32)
        x = np.pad(x, ((0, 0), (0, len(a) - x.shape[1])))
        return self._softmax(np.maximum(x @ a + b, 0) @ c + d)


def fit(points: np.ndarray, parts: int, k: int = GRAPH_K) -> Router:
    """The classifier of the parts of the points' neighbour graph."""
    near = neighbour_graph(points, k)
    part = balanced_parts(near, parts)
    targets = np.zeros((len(points), parts), np.float32)
    of = np.column_stack([part, part[near]])  # a point's own part and its neighbours'
    np.add.at(targets, (np.arange(len(points))[:, None], of), 1.0 / of.shape[1])
    return Router(points, targets)


def fit_on(rows: DataFrame, sample: int, parts: int) -> Router | None:
    """``fit`` on ``sample`` rows, chosen by hash, in one task: only the weights reach the driver."""
    some = rows.orderBy(F.xxhash64("vec_id", "vec"), "vec_id").limit(sample).select("vec")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        columns = [batch.column(0) for batch in batches if batch.num_rows]
        if columns:
            router = fit(matrix(pa.chunked_array(columns), np.float64), parts)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(router)], pa.binary())], ["router"])

    found = map_arrow(some, run, "router binary").collect()
    return pickle.loads(found[0]["router"]) if found else None


def n_parts(rows: int, sample: int = SAMPLE, most: int = MOST_PARTS) -> int:
    """About a sixteenth of the root of the number of rows, a power of two, 8 at least; but 32 rows of the
    sample a part."""
    wanted = 2 ** max(3, round(np.log2(max(rows, 1)) / 2 - 4))
    while wanted > 1 and wanted * 32 > min(sample, rows):
        wanted //= 2
    return min(wanted, most)


# ---------------------------------------------------------------- routing and search


def _kind(rows: DataFrame) -> str:
    return rows.schema["vec"].dataType.simpleString()


def to_parts(rows: DataFrame, router: Router) -> DataFrame:
    """``rows`` with the number of their most probable part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            part = router(matrix(batch.column(1), np.float64)).argmax(axis=1) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part.astype(np.int64))], ["vec_id", "vec", "part"])

    return map_arrow(rows, run, f"vec_id bigint, vec {_kind(rows)}, part bigint")


def probes(chances: np.ndarray, sizes: np.ndarray, mass: float, enough: int) -> np.ndarray:
    """Per query and part, whether it is searched: the most probable ones until their probabilities reach
    ``mass`` and they hold ``enough`` rows."""
    order = np.argsort(-chances, axis=1, kind="stable")
    before = np.cumsum(np.take_along_axis(chances, order, axis=1), axis=1) - np.take_along_axis(chances, order, axis=1)
    held = np.cumsum(sizes[order], axis=1) - sizes[order]
    out = np.zeros(chances.shape, bool)
    np.put_along_axis(out, order, (before < mass) | (held < enough), axis=1)
    return out & (sizes > 0)


def route(queries: DataFrame, router: Router, sizes: np.ndarray, mass: float, enough: int) -> DataFrame:
    """``(vec_id, vec, key, part)``: each query once for each part that it searches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            goes = probes(router(matrix(batch.column(1), np.float64)), sizes, mass, enough)
            for p in np.flatnonzero(goes.any(axis=0)).tolist():
                part = batch.filter(pa.array(goes[:, p]))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(part.num_rows, p, np.int64))], ["vec_id", "vec", "key", "part"])

    return map_arrow(queries.select("vec_id", "vec", "key"), run, f"vec_id bigint, vec {_kind(queries)}, key bigint, part bigint")


def exact_products(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, added up from the first component to the last: the same for equal
    vectors, wherever they stand."""
    out = np.zeros(len(rows))
    for c in range(rows.shape[1]):
        out += rows[:, c] * queries[:, c]
    return out


def best_of(points: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query, row, score)``: per query its ``k`` best rows, ties by smaller id, less those of its own
    id. A matrix product with a margin finds the candidates; their scores are computed exactly."""
    out = []
    longest = np.sqrt((points * points).sum(axis=1).max(initial=0.0))
    for at in range(0, len(queries), 128):
        some = queries[at : at + 128]
        rough = some @ points.T
        rough[own[at : at + 128, None] == ids[None, :]] = -np.inf
        margin = 1e-12 * longest * np.sqrt((some * some).sum(axis=1))
        nth = np.partition(rough, -k, axis=1)[:, -k] if rough.shape[1] > k else np.full(len(some), -np.inf)
        q, r = np.nonzero((rough >= (nth - margin)[:, None]) & (rough > -np.inf))
        exact = exact_products(points[r], some[q])
        order = np.lexsort((ids[r], -exact, q))
        q, r, exact = q[order], r[order], exact[order]
        first = np.searchsorted(q, np.arange(len(some)))
        keep = np.arange(len(q)) - first[q] < k
        out.append((q[keep] + at, r[keep], exact[keep]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else tuple(np.zeros(0, t) for t in (int, int, float))


def _compare(k: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        points, asked = same_width(matrix(rows["vec"], np.float64), matrix(queries["vec"], np.float64))
        ids, own, key = (np.asarray(x) for x in (rows["vec_id"], queries["vec_id"], queries["key"]))
        q, r, score = best_of(points, ids, asked, own, k)
        return pa.table({"query_id": own[q], "key": key[q], "vec_id": ids[r], "score": score})

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    nth = F.row_number().over(W.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", nth).filter(F.col("rank") <= k)


def calibrate(placed: DataFrame, queries: DataFrame, router: Router, sizes: np.ndarray, k: int, n: int, target: float) -> tuple[float, float]:
    """The least probability mass that finds ``target`` of the true neighbours of ``n`` queries, and the
    share that it finds. Every row is compared with them, in blocks; each returns its ``k`` best."""
    some = queries.orderBy(F.xxhash64(F.lit("calibration"), "key"), "vec_id").limit(n).toArrow()
    asked = matrix(some["vec"], np.float64)
    own = np.asarray(some["vec_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3 + [np.zeros(0)]  # query, vec_id, part, score: the best so far
        for batch in batches:
            points, queries_ = same_width(matrix(batch.column(1), np.float64), asked)
            ids, part = np.asarray(batch.column(0)), np.asarray(batch.column(2))
            q, r, score = best_of(points, ids, queries_, own, k)
            held = [np.concatenate(x) for x in zip(held, (q, ids[r], part[r], score), strict=True)]
            order = np.lexsort((held[1], -held[3], held[0]))
            held = [x[order] for x in held]
            first = np.searchsorted(held[0], held[0])
            held = [x[np.arange(len(first)) - first < k] for x in held]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], ["query", "vec_id", "part", "score"])

    found = map_arrow(placed.select("vec_id", "vec", "part"), run, "query bigint, vec_id bigint, part bigint, score double")
    nth = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    true = found.withColumn("rank", nth).filter(F.col("rank") <= k).select("query", "part").toPandas()
    if true.empty:
        return 1.0, 1.0
    chances = router(asked)
    order = np.argsort(-chances, axis=1, kind="stable")
    ordered = np.take_along_axis(chances, order, axis=1)
    before = np.zeros_like(chances)  # the mass of the parts ahead of a part
    np.put_along_axis(before, order, np.cumsum(ordered, axis=1) - ordered, axis=1)
    least = np.sort(before[true["query"].to_numpy(), true["part"].to_numpy()])  # a neighbour is found by any larger mass
    at = least[min(len(least) - 1, int(np.ceil(target * len(least))) - 1)]
    mass = float(np.nextafter(np.float32(at), np.float32(2.0)))
    goes = probes(chances, sizes, mass, k + 1)
    return mass, float(goes[true["query"].to_numpy(), true["part"].to_numpy()].mean())


def search(
    embeddings: DataFrame, every: int = 20, k: int = 20, sample: int = SAMPLE, target: float = TARGET,
    block: int = BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest rows found of each row whose id is divisible
    by ``every``."""
    rows = store(vectors_of(embeddings), "vectors")
    n = rows.count()
    queries = rows.filter(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "vec"]).withColumn("key", F.xxhash64("vec_id", "vec"))
    queries = store(queries, "queries")
    parts = n_parts(n, sample)
    router = fit_on(rows, sample, parts)
    if router is None:
        return rows.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    placed = store(to_parts(rows, router), "placed")
    sizes = np.zeros(parts, np.int64)
    for r in placed.groupBy("part").count().collect():
        sizes[r["part"]] = r["count"]
    mass, _ = calibrate(placed, queries, router, sizes, k, CALIBRATION, target)
    own = placed.filter(F.col("vec_id") % every == 0).groupBy("vec_id").count()
    repeated = own.agg(F.max("count")).first()[0] or 0  # rows of a query's own id are no candidates
    routed = store(route(queries, router, sizes, mass, k + repeated), "routed")
    found = block_join(placed, routed, "part", _compare(k), FOUND, block, query_block)
    return _ranked(found, k).select("query_id", "rank", "vec_id", "score")
