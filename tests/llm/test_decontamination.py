import collections
import hashlib
import re

from newsmart.llm import decontamination as D
from newsmart.llm.queries import QUERIES, op6_benchmark_decontamination
from tests.check import DUCK_TYPE, digest, duck_connect
from tests.llm.conftest import SF

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def slow_report(docs, items, window=10):
    windows = collections.defaultdict(set)
    for name, text in items:
        w = words(text)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k : k + n])].add("" if name is None else str(name))
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), []
        names = set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    names |= windows[tuple(w[k : k + n])]
        found = sorted(names)
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(hit)))
    return out


def rows_of(frame):
    return sorted(
        ((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in frame.collect()), key=repr
    )


def test_query_matches_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert rows_of(op6_benchmark_decontamination(spark, SF)) == sorted(slow_report(docs, items), key=repr)


def test_short_items_repeats_and_blocks(spark, documents):
    items = [
        (1, "one"), (2, "two three"), (3, "a b c d e f g h i j"), (4, "A B C D E F G H I J K L"), (5, None), (6, "..."), (None, "zz yy"),
        (7, "z z z z z z z z z z z"), (7, "two three"),
    ]
    texts = [
        "one", "two. THREE one one", "x a b c d e f g h i j k l a b c d e f g h i j", "a b c d e f g h i", "z " * 30, "zz yy", None, "", "two",
        "b c d e f g h i j k", "é one1 One", "three two",
    ]
    frame = documents([(i, t, "en", "s") for i, t in enumerate(texts)])
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = sorted(slow_report(list(enumerate(texts)), items), key=repr)
    for block in (1, 20, 10**6):
        assert rows_of(D.report(frame, bench, block_chars=block)) == want


def test_longest_matches(spark, documents):
    bench = spark.createDataFrame([(1, "a b c d e f g h i j k l m n o p q r s t u v w")], "item_id bigint, text string")
    text = "x b c d e f g h i j k l m n o p q r s t u v y a b c"
    rows = D.matches(documents([(9, text, "en", "s")]), bench, min_words=10).collect()
    best = {r["suffix"]: (r["length"], r["doc_id"], r["word"]) for r in rows}
    assert best[1] == (21, 9, 1) and best[2] == (20, 9, 2) and 0 not in best


def test_awkward_rows(spark, awkward, nothing):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa")], "item_id bigint, text string")
    rows = D.report(awkward, bench).collect()
    assert [r["n_hit"] for r in rows if r["doc_id"] == 1] == [10, 10] and sum(r["contaminated"] for r in rows) == 2
    kept = D.keep_clean(awkward, bench)
    assert kept.columns == awkward.columns and kept.count() == awkward.count() - 2
    assert D.report(awkward, bench.limit(0)).filter("contaminated").count() == 0
    assert D.report(nothing, bench).count() == 0 and D.keep_clean(nothing, bench).count() == 0


def test_query_against_sql(spark):
    fn, sql = QUERIES["op6_benchmark_decontamination"]
    df = fn(spark, SF)
    cur = duck_connect(SF).execute(sql)
    want = digest([c[0] for c in cur.description], cur.fetchall())
    assert want == digest(df.columns, [tuple(r) for r in df.collect()])
    assert {f.name: DUCK_TYPE[f.dataType.simpleString()] for f in df.schema} == {r[0]: r[1] for r in duck_connect(SF).execute(f"DESCRIBE {sql}").fetchall()}
