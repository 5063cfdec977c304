import random

import numpy as np
import xxhash

from newsmart.llm import simhash
from newsmart.llm.components import connected_components
from newsmart.llm.queries import op2_simhash_near_dedup
from tests.llm.conftest import SF


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(fps, max_bits=3):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    all_fps = sorted(root)
    for i, a in enumerate(all_fps):
        for b in all_fps[i + 1 :]:
            if (a ^ b).bit_count() <= max_bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in all_fps}


def test_fingerprint_matches_definition():
    for text in ("", None, "one", "one two", "A b C d", "x " * 900, "é ü\x0bB \x1cc d e f", "word " * 3 + "tail"):
        assert simhash.fingerprint(text.encode() if text is not None else None) == slow_fingerprint(text)


def test_query_matches_brute_force(spark):
    got = op2_simhash_near_dedup(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    fps = {d["doc_id"]: slow_fingerprint(d["text"]) for d in docs}
    roots = slow_components(set(fps.values()))
    least = {}
    for d, f in fps.items():
        least[roots[f]] = min(d, least.get(roots[f], d))
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {
        d: (f"{f:016x}", least[roots[f]]) for d, f in fps.items()
    }


def test_links_of_close_fingerprints(spark):
    """Chains, hubs and a group larger than a block give the components of all pairs."""
    random.seed(5)
    fps = []
    for _ in range(30):
        x = random.getrandbits(64)
        for _ in range(random.randint(1, 8)):
            fps.append(x)
            for b in random.sample(range(64), random.randint(1, 4)):
                x ^= 1 << b
    hub = random.getrandbits(64)
    fps += [hub ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a, 20)]
    fps = sorted(set(fps))
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    for segments, block in ((5, 16), (4, 512), (8, 7)):
        links = simhash.near_links(spark.createDataFrame([(f,) for f in signed], "fp bigint"), 3, segments, block)
        pairs = [(r["a"], r["b"]) for r in links.collect()]
        assert all((int(np.int64(a).view(np.uint64)) ^ int(np.int64(b).view(np.uint64))).bit_count() <= 3 for a, b in pairs)
        root = {r["node"]: r["root"] for r in connected_components(links).collect()}
        got = {}
        for f, s in zip(fps, signed, strict=True):
            got.setdefault(root.get(s, s), set()).add(f)
        want = {}
        for f, r in slow_components(fps).items():
            want.setdefault(r, set()).add(f)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_pivot_distances_bound_the_hamming_distance():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 200).astype(np.uint64)
    refs = simhash.pivots()
    d = simhash.pivot_distances(a, refs)
    far = np.abs(d[:, None] - d[None, :]).max(axis=2)
    assert (far <= np.bitwise_count(a[:, None] ^ a[None, :])).all()


def test_components_of_chain_and_empty(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(5, 5)], "a bigint, b bigint")
    assert {r["node"]: r["root"] for r in connected_components(chain).collect()} == {i: 0 for i in range(1, 61)}
    assert connected_components(chain.limit(0)).count() == 0


def test_awkward_rows(awkward, nothing):
    rows = simhash.components(awkward).select("doc_id", "fp", "component_id").collect()
    assert len(rows) == awkward.count()
    zero = [r for r in rows if r["fp"] == 0]
    assert {r["component_id"] for r in zero} == {2} and len(zero) == 5
    kept = simhash.keep_one(awkward)
    assert kept.columns == awkward.columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 1, 2, 5, 6]
    assert simhash.components(nothing).count() == 0 and simhash.keep_one(nothing).count() == 0
