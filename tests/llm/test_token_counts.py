import os
import tempfile

import pytest
from pyspark.sql import functions as F

from newsmart.llm import tokenize
from newsmart.llm import token_counts as T
from newsmart.llm.queries import op1_token_counts
from tests.llm.conftest import SF

CHANGE = "doc_id bigint, version string, op string, seq int, source string, lang string, tokens bigint"


def rollup(spark):
    return T.Rollup(spark, tempfile.mkdtemp(prefix="newsmart-test-", dir="/tmp") + "/rollup")


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), CHANGE)


def totals(r):
    return {(x["source"], x["lang"], x["version"]): (x["documents"], x["tokens"]) for x in r.totals().collect()}


def test_signed_changes(spark):
    r = rollup(spark)
    assert totals(r) == {} and r.committed() == []
    assert r.apply("b1", batch(spark, (1, "v1", "insert", 0, "a", "en", 10), (2, "v1", "insert", 0, "a", "en", 5), (1, "v2", "insert", 0, "a", "en", 7)))
    assert totals(r) == {("a", "en", "v1"): (2, 15), ("a", "en", "v2"): (1, 7)}
    # a revision that moves a document to another group, a delete, a delete of nothing
    assert r.apply("b2", batch(spark, (1, "v1", "revise", 0, "b", "fr", 12), (2, "v1", "delete", 0, None, None, None), (9, "v1", "delete", 0, None, None, None)))
    assert totals(r) == {("b", "fr", "v1"): (1, 12), ("a", "en", "v2"): (1, 7)}
    # of several changes the last by seq counts; a deleted document may come back
    assert r.apply("b3", batch(spark, (2, "v1", "insert", 1, "a", "en", 3), (2, "v1", "delete", 0, None, None, None), (2, "v1", "revise", 2, "a", "en", 4)))
    assert totals(r) == {("b", "fr", "v1"): (1, 12), ("a", "en", "v2"): (1, 7), ("a", "en", "v1"): (1, 4)}


def test_batches_count_once(spark):
    r = rollup(spark)
    first = batch(spark, (1, "v", "insert", 0, "a", "en", 10))
    assert r.apply("b1", first) and not r.apply("b1", first)
    assert totals(r) == {("a", "en", "v"): (1, 10)}
    # a batch that failed before its marker is not read, and counts once when sent again
    second = batch(spark, (2, "v", "insert", 0, "a", "en", 1), (1, "v", "revise", 0, "a", "en", 11))
    r.apply("b2", second)
    folder = f"{r.path}/commits/batch=b2"
    for name in os.listdir(folder):
        os.remove(f"{folder}/{name}")
    assert totals(r) == {("a", "en", "v"): (1, 10)}
    assert r.apply("b2", second) and totals(r) == {("a", "en", "v"): (2, 12)}


def test_compaction_keeps_totals_state_and_ids(spark):
    r = rollup(spark)
    load = batch(spark, (1, "v", "insert", 0, "a", "en", 10), (2, "v", "insert", 0, "a", "en", 2), (None, "v", "insert", 0, "a", "en", 1))
    gone = batch(spark, (2, "v", "delete", 0, None, None, None), (1, "v", "revise", 0, "a", "en", 9))
    r.apply("b1", load)
    r.apply("b2", gone)
    small = r.compact(r.path + "-small")
    assert totals(small) == totals(r) == {("a", "en", "v"): (2, 10)}
    assert not small.apply("b1", load) and not small.apply("b2", gone)  # sent again after the fold
    assert totals(small) == {("a", "en", "v"): (2, 10)}
    third = batch(spark, (1, "v", "revise", 0, "a", "en", 20), (2, "v", "insert", 0, "b", "en", 3))
    assert small.apply("b3", third) and not small.apply("b3", third)
    assert totals(small) == {("a", "en", "v"): (2, 21), ("b", "en", "v"): (1, 3)}
    again = small.compact(r.path + "-smaller")  # a fold of a fold knows all of them
    assert not any(again.apply(b, load) for b in ("b1", "b2", "b3")) and totals(again) == totals(small)
    assert rollup(spark).compact(r.path + "-empty").committed() == []
    with pytest.raises(ValueError):
        small.apply(T.FOLDED, load)


def test_a_small_batch_does_not_shuffle_the_ledger(spark):
    r = rollup(spark)
    many = spark.range(5000).selectExpr("id doc_id", "'v' version", "'insert' op", "0 seq", "'a' source", "'en' lang", "id tokens")
    r.apply("b1", many)
    one = spark.read.parquet(f"{r.path}/ledger/batch=b1").filter("doc_id < 3")
    found = r.current(one)
    assert found.count() == 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    first = plan.split("Window ")[-1]  # below the window: the semi join, broadcast, then the shuffle of what is left
    assert "BroadcastHashJoin" in first.split("Exchange hashpartitioning")[1] and "SortMergeJoin" not in plan


def test_nulls_and_empty_batches(spark):
    r = rollup(spark)
    row = (None, "v", "insert", 0, None, None, 4)
    assert r.apply("b1", batch(spark, row, row, (None, "v", "delete", 0, None, None, None)))
    assert r.apply("b2", batch(spark).limit(0)) if False else r.apply("b2", batch(spark, row).limit(0))
    assert totals(r) == {(None, None, "v"): (2, 8)} and r.committed() == ["b1", "b2"]


def test_query_matches_counting(spark):
    byte = T._encoding(T.BYTE_BPE).encode_ordinary
    word = tokenize.load(tokenize.tokenizer_path(T.WORD_BPE))
    count = {T.BYTE_BPE: lambda t: len(byte(t)), T.WORD_BPE: lambda t: len(word.encode(t, add_special_tokens=False).ids)}
    want, seen = {}, set()
    for d in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect():
        if d["text"] in seen:
            continue
        seen.add(d["text"])
        for name in T.VERSIONS:
            key = (d["source"], d["lang"], T.version_of(name))
            n, t = want.get(key, (0, 0))
            want[key] = (n + 1, t + count[name]("\n".join(dict.fromkeys(d["text"].split("\n")))))
    got = {(x["source"], x["lang"], x["version"]): (x["documents"], x["tokens"]) for x in op1_token_counts(spark, SF).collect()}
    assert got == want


def test_awkward_rows(awkward, nothing):
    r = T.maintain(awkward)
    sums = r.totals().agg(F.sum("documents"), F.sum("tokens")).first()
    # ids 1 (twice, one key), 2 to 7, and two rows without id, for each of two versions
    assert sums[0] == 18 and sums[1] > 16000
    assert T.maintain(nothing).totals().count() == 0
