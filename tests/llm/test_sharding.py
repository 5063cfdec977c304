import random
import zlib

from newsmart.llm import sharding
from newsmart.llm.queries import op10_byte_balanced_sharding
from tests.llm.conftest import SF


def check_rows(rows, texts, n):
    """rows and texts in any order; equal texts share a shard, slots have no gap."""
    shard_of = {}
    for r in rows:
        text = texts[r["doc_id"]] or ""
        assert r["size"] == len(text.encode()) + 1 and r["text_crc32"] == zlib.crc32(text.encode())
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < n
        assert shard_of.setdefault(text, r["shard"]) == r["shard"]
    for k in range(n):
        slots = sorted(r["slot"] for r in rows if r["shard"] == k)
        assert slots == list(range(len(slots)))
    return [sum(r["size"] for r in rows if r["shard"] == k) for k in range(n)]


def test_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op10_byte_balanced_sharding(spark, SF).collect()
    assert len(rows) == len(texts)
    sums = check_rows(rows, texts, 16)
    assert max(sums) - min(sums) < 0.05 * max(sums)


def test_differencing():
    assert sorted(sharding.difference([[x, 0] for x in (8, 7, 6, 5, 4)])[0]) == [14, 16]  # the classical example
    random.seed(1)
    for n, m in ((2, 1), (16, 1), (3, 50), (16, 3000)):
        parts = [[random.randint(1, 9999)] + [0] * (n - 1) for _ in range(m)]
        sums, ends = sharding.difference(parts)
        again = [0] * n
        for p, e in zip(parts, ends, strict=True):
            assert sorted(e) == list(range(n))
            for x, slot in zip(p, e, strict=True):
                again[slot] += x
        assert again == sums
    assert max(sums) - min(sums) <= 20


def test_buckets_leave_room_for_large_groups(spark):
    random.seed(3)
    sizes = [random.randint(1, 1000) for _ in range(4000)]
    sizes[:3] = [sum(sizes) // 18, sum(sizes) // 30, sum(sizes) // 60]
    groups = spark.createDataFrame(list(enumerate(sizes)), "k1 bigint, bytes bigint").selectExpr("k1", "-k1 as k2", "bytes")
    for bucket in (300, 100_000):
        got = sharding.group_shards(groups, 16, bucket).collect()
        assert len(got) == len(sizes)
        sums = [0] * 16
        for r in got:
            sums[r["shard"]] += sizes[r["k1"]]
        assert max(sums) - min(sums) < 0.01 * max(sums)


def test_a_group_over_its_share_stays_whole(documents):
    rows = [(i, "the same text" * 10, "en", "s") for i in range(50)] + [(100 + i, "x" * i, "en", "s") for i in range(40)]
    got = sharding.shard_by_bytes(documents(rows), 4).collect()
    sums = sorted(check_rows(got, {r[0]: r[1] for r in rows}, 4))
    assert sums[3] == 50 * 131 and sums[2] - sums[0] <= 40


def test_awkward_rows(awkward, nothing):
    texts = {}
    rows = [r for r in sharding.shard_by_bytes(awkward).collect()]
    assert len(rows) == awkward.count()
    for r in awkward.collect():
        texts[r["doc_id"]] = r["text"]
    named = [r for r in rows if r["doc_id"] is not None]
    assert all(r["size"] == len((texts[r["doc_id"]] or "").encode()) + 1 for r in named)
    assert len({r["shard"] for r in rows if r["size"] == 1}) == 1
    assert sharding.shard_by_bytes(nothing).count() == 0
