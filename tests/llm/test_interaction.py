import math
import re
from itertools import permutations

import pytest

from newsmart.llm import interaction
from newsmart.llm.queries import QUERIES
from tests.check import digest, duck_connect
from tests.llm.conftest import SF

LABEL = "doc_id bigint, quality int, toxic int, text string, source string"


def slow_masks(rows):
    """Failed filters of (doc_id, text) rows, by the words of the contract."""
    first = {}
    for i, text in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    out = []
    for i, text in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        mask = (len(words) < 200) + 2 * (100 * len(set(words)) < 50 * len(words))
        mask += 4 * (100 * len(re.findall("[A-Z]", text)) > 2 * len(text)) + 8 * bool(re.search(r"[#$%&*|]", text))
        out.append(mask + 16 * (i is not None and i > first[text]))
    return out


def slow_audit(docs, good, toxic):
    """Every order, one after another, over (doc_id, text, part) rows."""
    masks = slow_masks([d[:2] for d in docs])
    out = {}
    for part in {d[2] or "" for d in docs}:
        mine = [(d[0], m) for d, m in zip(docs, masks, strict=True) if (d[2] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left, gone = mine, []
            for step, name in enumerate(order, 1):
                bit = 1 << "ABCDE".index(name)
                removed = [x for x in left if x[1] & bit]
                shapley[name] += len(removed)
                left = [x for x in left if not x[1] & bit]
                out[part, "".join(order), step] = [
                    len(left), len(removed), sum(1 for x in gone if x[1] & bit), sum(1 for x in mine if x[1] == bit),
                    sum(x[0] in good for x in removed), sum(x[0] in toxic for x in removed), name,
                ]
                gone = gone + removed
        for key, row in out.items():
            if key[0] == part:
                row[-1] = shapley[row[-1]] if isinstance(row[-1], str) else row[-1]
    return out


def as_dict(df):
    rows = df.collect()
    got = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in (*interaction.COUNTS, "shapley")] for r in rows}
    assert len(got) == len(rows)
    return got


def test_query_against_sql(spark):
    fn, sql = QUERIES["op11_filter_interaction"]
    df = fn(spark, SF)
    cur = duck_connect(SF).execute(sql)
    assert digest([c[0] for c in cur.description], cur.fetchall()) == digest(df.columns, [tuple(r) for r in df.collect()])


def test_query_against_every_order(spark):
    docs = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    want = slow_audit(docs, {r[0] for r in labels if r["quality"] == 1}, {r[0] for r in labels if r["toxic"] == 1})
    assert as_dict(QUERIES["op11_filter_interaction"][0](spark, SF)) == want


@pytest.mark.parametrize("k", [1, 2, 5, 7])
def test_path_counts(k):
    forward, backward = interaction.path_counts(k)
    for state in range(1 << k):
        size = state.bit_count()
        assert forward[state] == math.factorial(size) and backward[state] == math.factorial(k - size)
    found = interaction.lattice(k)
    assert len(found) == k * 2 ** (k - 1)
    assert sum(paths for *_, paths in found) == k * math.factorial(k)  # every order takes k edges


def test_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame(
        [(1, 1, 0, "x", "y"), (1, 0, 1, "x", "y"), (None, 1, 1, None, None), (2, None, 1, None, None), (99, 1, 1, "z", "z")], LABEL
    )
    docs = [(r["doc_id"], r["text"], r["source"]) for r in awkward.collect()]
    assert as_dict(interaction.audit(awkward, labels)) == slow_audit(docs, {1}, {1, 2})
    empty = interaction.audit(nothing, labels.limit(0))
    assert empty.count() == 0
    assert as_dict(interaction.audit(awkward, labels.limit(0))) == slow_audit(docs, set(), set())


def test_other_filters(spark, documents):
    docs = documents([(1, "a b", "en", "s"), (2, "a b c", "en", "s"), (3, "a b c", "en", "t")])
    labels = spark.createDataFrame([], LABEL)
    got = interaction.audit(docs, labels, {"X": "n_words < 3"}, copies=None, part="lang").collect()
    assert [(r["part"], r["filter_order"], r["step"], r["kept"], r["removed"], r["shapley"]) for r in got] == [("en", "X", 1, 2, 1, 1)]
    with pytest.raises(ValueError):
        interaction.failures(docs, {c: "true" for c in "ABCDEFG"})
