import math
import random

import numpy as np
import pytest

from newsmart.llm import hard_negatives
from newsmart.llm.cover_tree import CoverTree
from newsmart.llm.queries import QUERIES
from tests.check import digest, duck_connect

KIND = "vec_id bigint, embedding array<float>, label int, vec string, key string, center string, _i int"


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_query_against_sql(spark, sf):
    fn, sql = QUERIES["op13_hard_negatives"]
    df = fn(spark, f"/root/testdata/{sf}")
    cur = duck_connect(f"/root/testdata/{sf}").execute(sql)
    want = digest([c[0] for c in cur.description], cur.fetchall())
    assert want[1] > 50 and want == digest(df.columns, [tuple(r) for r in df.collect()])


def clouds(n, seed, width=12):
    """Clusters of several widths, single points, exact copies and zeros."""
    rng = np.random.default_rng(seed)
    tops = rng.standard_normal((8, width)) * 40
    x = tops[rng.integers(0, 8, n)] + rng.standard_normal((n, width)) * rng.choice([0.5, 3, 20], (n, 1))
    x[: n // 10] = x[0]
    x[n // 10 : n // 8] = 0
    return np.floor(x).astype(np.int64)


def test_tree_covers_and_separates():
    points = clouds(1500, 1)
    tree = CoverTree(points, np.arange(len(points)), np.zeros(len(points), np.int64))

    def below(node):
        out = list(node.leaves)
        for center, child in zip(node.centers, node.children, strict=True):
            own = below(child)
            apart = np.sqrt(((tree.augmented[own] - tree.augmented[center]) ** 2).sum(axis=1))
            assert (apart <= child.radius + 1e-9).all() and child.radius <= node.radius / 2 + 1e-9
            out += own
        if len(node.centers) > 1:
            c = tree.augmented[node.centers]
            gaps = np.sqrt(np.maximum(((c[:, None] - c[None]) ** 2).sum(axis=2), 0)) + np.eye(len(c)) * 1e9
            assert gaps.min() > node.radius / 2 - 1e-3 * np.sqrt(tree.length)
        return out

    assert sorted(below(tree.root)) == list(range(len(points)))


def test_search_is_exact_and_skips():
    points = clouds(2000, 2)
    labels = np.arange(2000) % 3
    ids = np.random.default_rng(5).permutation(2000)
    tree = CoverTree(points, ids, labels)
    seen = []
    verify = tree._verify
    tree._verify = lambda q, leaves, *rest: (seen.append(len(leaves)), verify(q, leaves, *rest))
    for a in range(0, 2000, 97):
        scores = points @ points[a]
        for same in (True, False):
            ok = ((labels == labels[a]) == same) & (ids != ids[a])
            top = int(scores[ok].max())
            low, high = [-(1 << 60), top * 8 // 10, 0], [1 << 60, top, 5]
            for w, found in enumerate(tree.best(points[a], labels[a], same, ids[a], low, high, 5)):
                mine = ok & (scores >= low[w]) & (scores <= high[w])
                want = sorted(zip((-scores[mine]).tolist(), ids[mine].tolist(), strict=True))[:5]
                assert found == [(-s, i) for s, i in want]
    seen.clear()
    far = points[np.argmax((points**2).sum(axis=1))]
    tree.best(far, 0, True, -1, [int(far @ far) * 9 // 10], [1 << 60], 5)
    assert sum(seen) < 1000  # windows' outside nodes are not verified


def test_large_numbers():
    points = np.array([[1 << 30, 3], [1 << 30, 4], [5, 6]])
    tree = CoverTree(points, np.arange(3), np.zeros(3, np.int64))
    got = tree.best(points[0], 0, True, 0, [0], [1 << 62], 5)
    assert got == [[((1 << 60) + 12, 1), (5 * (1 << 30) + 18, 2)]]
    with pytest.raises(OverflowError):
        CoverTree(points << 10, np.arange(3), np.zeros(3, np.int64)).best(points[0] << 10, 0, True, 0, [0], [1], 5)


def slow(rows, every=100, low=80):
    ok = [r for r in rows if r[0] is not None and r[2] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in v], (lab + 1) % 10 if i % 7 == 0 else lab) for i, v, lab in ok]
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    for i, v, lab in sorted({(i, tuple(v), lab) for i, v, lab in ok if i % every == 0}):
        scored = sorted((-dot(v, w), j, same == lab) for j, w, same in ok if j != i)
        for s, p, _ in [x for x in scored if x[2]][:5]:
            window = [x for x in scored if not x[2] and low * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(i, p, n, j, -s, -t) for n, (t, j, _) in enumerate(window, 1)]
    return sorted(out)


def test_blocks_hot_label_and_copies(spark):
    random.seed(4)
    rng = np.random.default_rng(4)
    vec = rng.standard_normal((3000, 6))
    vec[500:1500] = vec[500]  # a third are copies of one vector
    rows = [(i, [float(x) for x in v], 1 if i % 3 == 0 else random.randint(0, 4), *"abc", 1) for i, v in enumerate(vec)]
    df = spark.createDataFrame(rows, KIND)
    want = slow([r[:3] for r in rows])
    for block, query_block in ((4096, 2048), (200, 7)):
        got = [tuple(r) for r in hard_negatives.mine(df, block=block, query_block=query_block).collect()]
        assert sorted(got) == want


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (100, [1.0, 0.25], 1), (1, [1.0, 1.0], 2), (1, [1.0, 1.0], 2), (2, [0.5, 0.5], 2),
        (3, [1.0], 1), (4, [], 1), (5, [1.0, 0.5, 9.0], 2), (6, None, 1), (None, [1.0, 1.0], 1), (8, [1.0, 1.0], None),
        (9, [nan, 1.0], 1), (10, [inf, 1.0], 1), (11, [None, 1.0], 1), (200, [0.0, 0.0], 2), (300, [-1.0, -1.0], 2),
    ]
    df = spark.createDataFrame([(*r, *"abc", 1) for r in rows], KIND)
    got = sorted(tuple(r) for r in hard_negatives.mine(df).collect())
    assert got == slow(rows) and got
    assert hard_negatives.mine(df.limit(0)).count() == 0
    assert hard_negatives.mine(df.filter("vec_id = 0")).count() == 0  # no other row of the label
